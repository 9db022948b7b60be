"""Knockout brackets: rounds built from a list of entries, and checks of finished ones, as relational operations."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def expected_matches(tree_size: int) -> list[int]:
    """Matches of each round of a tree: half its size, and so on to the final."""
    out, n = [], tree_size // 2
    while n:
        out.append(n)
        n //= 2
    return out


def advancement_findings(sides: DataFrame, winners: DataFrame, last_round: int | None = None) -> DataFrame:
    """class_id, round, finding, entry: a winner missing from the next round, a stray in a round whose entry won no match
    in the one before.

    sides: class_id, round (from 0), entry; winners: class_id, round, winner. Null entries and winners are ignored; repeated
    rows count once. last_round: the final (by default the highest round of each class)."""
    p = sides.filter("entry is not null").select("class_id", "round", "entry").distinct()
    w = winners.filter("winner is not null").select("class_id", "round", F.col("winner").alias("entry")).distinct()
    if last_round is None:
        top = p.groupBy("class_id").agg(F.max("round").alias("_top"))
        due = w.join(top, "class_id").filter("round < _top").drop("_top")
    else:
        due = w.filter(F.col("round") < last_round)
    due = due.withColumn("round", F.col("round") + 1)
    missing = due.join(p, ["class_id", "round", "entry"], "left_anti").select("class_id", "round", F.lit("missing").alias("finding"), "entry")
    came = w.withColumn("round", F.col("round") + 1)
    stray = p.filter("round > 0").join(came, ["class_id", "round", "entry"], "left_anti").select("class_id", "round", F.lit("stray").alias("finding"), "entry")
    return missing.unionByName(stray)


def round_size_findings(matches: DataFrame, tree_sizes: DataFrame) -> DataFrame:
    """class_id, round, found, expected of rounds with another number of matches than the tree has (rounds from 0)."""
    found = matches.groupBy("class_id", "round").agg(F.count(F.lit(1)).alias("found"))
    rounds = tree_sizes.withColumn("n", F.floor(F.log2("tree_size")).cast("int")).filter("n >= 1")
    due = rounds.select("class_id", "tree_size", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("round")).select("class_id", "round", F.shiftright("tree_size", 1).alias("_h"), "tree_size")
    due = due.select("class_id", "round", F.floor(F.col("tree_size") / F.pow(F.lit(2), F.col("round") + 1)).cast("long").alias("expected"))
    both = due.join(found, ["class_id", "round"], "full_outer")
    return both.select("class_id", "round", F.coalesce("found", F.lit(0)).alias("found"), F.coalesce("expected", F.lit(0)).alias("expected")).filter("found <> expected")


def repeated_appearances(sides: DataFrame) -> DataFrame:
    """class_id, round, entry, n of entries that stand more than once in a round."""
    return sides.filter("entry is not null").groupBy("class_id", "round", "entry").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def result_findings(matches: DataFrame) -> DataFrame:
    """matches with finding: no winner, no score (and no walkover), a walkover whose winner is the side that forfeits, a winner
    that isn't one of the sides. Columns: class_id, match_id, side1, side2, winner, score, walkover_side."""
    winner_side = F.when(F.col("winner") == F.col("side1"), 1).when(F.col("winner") == F.col("side2"), 2)
    finding = (
        F.when(F.col("winner").isNull(), "no winner")
        .when(winner_side.isNull(), "winner is no side")
        .when(F.col("walkover_side").isNotNull() & (F.col("walkover_side") == winner_side), "forfeiting side won")
        .when(F.col("walkover_side").isNull() & (F.col("score").isNull() | (F.trim("score") == "")), "no score")
    )
    return matches.withColumn("finding", finding).filter("finding is not null").select("class_id", "match_id", "finding")


def first_round(entries: DataFrame, tree_size: int) -> DataFrame:
    """class_id, slot, side1, side2: the first round of a tree from entries in bracket order (class_id, position from 1, entry).

    A side without an entry is a bye (null)."""
    half = tree_size // 2
    e = entries.filter(F.col("position").between(1, tree_size)).withColumn("slot", F.floor((F.col("position") - 1) / 2).cast("int")).withColumn("side", (F.col("position") - 1) % 2 + 1)
    slots = entries.select("class_id").distinct().withColumn("slot", F.explode(F.sequence(F.lit(0), F.lit(half - 1))))
    sides = e.groupBy("class_id", "slot").agg(F.max(F.when(F.col("side") == 1, F.col("entry"))).alias("side1"), F.max(F.when(F.col("side") == 2, F.col("entry"))).alias("side2"))
    return slots.join(sides, ["class_id", "slot"], "left")


def next_round(matches: DataFrame) -> DataFrame:
    """The next round's slots: winners of two neighbouring slots meet. matches: class_id, slot, winner."""
    m = matches.select("class_id", F.floor(F.col("slot") / 2).cast("int").alias("next"), (F.col("slot") % 2 + 1).alias("side"), "winner")
    return m.groupBy("class_id", F.col("next").alias("slot")).agg(F.max(F.when(F.col("side") == 1, F.col("winner"))).alias("side1"), F.max(F.when(F.col("side") == 2, F.col("winner"))).alias("side2"))


def byes(matches: DataFrame) -> DataFrame:
    """Matches with one side only: that side advances without a game."""
    one = F.when(F.col("side1").isNull() != F.col("side2").isNull(), F.coalesce("side1", "side2"))
    return matches.withColumn("winner", F.coalesce("winner", one)) if "winner" in matches.columns else matches.withColumn("winner", one)


def label_winners(labels: DataFrame, players: DataFrame) -> DataFrame:
    """Winner labels with the players they mean.

    labels: class_id, label_id, text, y. players: class_id, player_id, name, y. A label means a player by number (its leading
    digits), by name, or by a name that begins with it; of several players the one nearest in y, then the lowest number."""
    num = F.nullif(F.regexp_extract("text", r"^\s*(\d+)", 1), F.lit("")).cast("long")
    said = F.lower(F.trim(F.regexp_replace("text", r"^\s*\d+\s*", "")))
    lab = labels.withColumn("_n", num).withColumn("_t", said).withColumnRenamed("y", "_ly")
    by = lab.join(players.withColumnRenamed("y", "_py"), "class_id")
    name = F.lower(F.trim("name"))
    last = F.element_at(F.split(name, r"\s+"), -1)
    rank = F.when(F.col("_n") == F.col("player_id"), 0).when(name == F.col("_t"), 1).when((last == F.col("_t")) | ((F.length("_t") >= 3) & (F.startswith(name, F.col("_t")) | F.startswith(last, F.col("_t")))), 2)
    w = Window.partitionBy("class_id", "label_id").orderBy("_r", F.abs(F.col("_ly") - F.col("_py")), "player_id")
    return by.withColumn("_r", rank).filter("_r is not null").withColumn("_k", F.row_number().over(w)).filter("_k = 1").select("class_id", "label_id", "player_id")
