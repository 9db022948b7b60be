"""Best representative of each group of duplicates.

Rows are grouped by canonical rewritings of their names and agreeing years and days of birth. The surviving record is built
field by field: fields are unpivoted to long rows, each value gets votes of its source's trust times its age's decay, votes
are summed by normalised value, the winner of each field is taken by max_by, and the winners are pivoted back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as X
from ..session import stash
from . import names as N
from .clusters import components

HALF_LIFE_DAYS = 3 * 365.0
TRUST = {True: 1.0, False: 0.4}
MIN_SHARED = 0.55  # weight of a rewriting that makes two names of one year one
MIN_ALONE = 0.73  # and without a year
WHOLE = 0.81  # rewritings above this change no letter
MIN_NEAR = 0.8  # nearness of names that only share a part and the year, or a part and the beginning or end of another


def _pair_names(names: DataFrame) -> DataFrame:
    """a, b (name ids), weight: distinct names that share a canonical form, in either order of their parts."""

    def both_ways(text: str) -> set[str]:
        ts = N.tokens(text)
        if len(ts) < 2:
            return {f"x||{''.join(ts)}"} if ts else set()
        return N.registered_forms(" ".join(ts[:-1]), ts[-1]) | N.registered_forms(" ".join(ts[1:]), ts[0])

    def typed(text: str) -> dict[str, float]:
        return {k: w for k, w in N.typed_forms(text).items() if w >= MIN_SHARED}

    reg = stash(N.explode_forms(names, ["name_id"], ["name"], both_ways, False).distinct(), "forms").withColumnRenamed("name_id", "b")
    made = N.explode_forms(names, ["name_id"], ["name"], typed, True).withColumnRenamed("name_id", "a")
    pairs = made.hint("merge").join(reg, "form").filter("a <> b")
    return pairs.groupBy("a", "b").agg(F.max("weight").cast("double").alias("weight"))


def _rarity(nodes: DataFrame) -> DataFrame:
    """name_id, rare: how many names have the rarest part of a name (single letters don't count)."""
    parts = nodes.select("name_id", "key").distinct().select("name_id", F.explode(F.array_distinct(F.split("key", " "))).alias("part")).filter(F.length("part") > 1)
    n = parts.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    return parts.join(n, "part").groupBy("name_id").agg(F.min("n").alias("rare"))


def _is_error(one: str, other: str) -> Column:
    """A name is a misspelling of another only if it has a part that hardly any name has, beside how often the other's parts
    are met: two names that are both common are two names."""
    return F.col(one) <= F.greatest(F.lit(2.0), F.col(other) * 0.15)


def _part_and_end(key: Column) -> Column:
    """One row for each part of a name with the beginning, and with the end, of each other longer part."""
    parts = F.split(key, " ")
    others = lambda p: F.filter(parts, lambda o: (o != p) & (F.length(o) > 4))
    begins = F.transform(parts, lambda p: F.transform(others(p), lambda o: F.concat(p, F.lit("<"), F.substring(o, 1, 4))))
    finishes = F.transform(parts, lambda p: F.transform(others(p), lambda o: F.concat(p, F.lit(">"), F.right(o, F.lit(4)))))
    return F.explode(F.array_distinct(F.flatten(F.concat(begins, finishes))))


def group_players(players: DataFrame) -> DataFrame:
    """player_id, group_id: rows with one group_id describe one person.

    Rows of like name, year and day of birth (a first of January stands for an unknown day) are one node whatever their
    number, so copies make no pairs. Nodes of the same year are joined if their names are one by a rewriting and their days
    don't differ, or if they share a part and are near. A node without a year goes to the one component with its name, else
    to the one with a name that is one by a rewriting, else to the nearest that shares a part and an end; if several fit as
    well it stays alone. Rows without any name stay alone. Null ids are ignored."""
    name = F.coalesce(F.when(F.col("firstname").isNotNull() & F.col("lastname").isNotNull(), F.concat_ws(" ", "firstname", "lastname")), F.col("fullname_raw"), F.concat_ws(" ", "firstname", "lastname"))
    day = F.when(~F.col("date_born").cast("string").rlike(r"-01-01$"), F.col("date_born").cast("string"))
    rows = players.filter("player_id is not null").select("player_id", F.trim(name).alias("name"), F.coalesce(F.col("year_born").cast("int"), F.nullif(F.regexp_extract("date_born", r"^([0-9]{4})-", 1), F.lit("")).cast("int")).alias("year"), day.alias("day"))
    rows = rows.withColumn("key", X.token_key(F.col("name"))).withColumn("key", F.when(F.col("key") != "", F.col("key")))
    rows = stash(rows.withColumn("name_id", F.xxhash64("key")), "rows")
    named = rows.filter("key is not null")
    nodes = named.groupBy("name_id", "year", "day").agg(F.min("player_id").alias("node"), F.any_value("key").alias("key"))
    nodes = stash(nodes, "nodes")
    pairs = stash(_pair_names(nodes.groupBy("name_id").agg(F.any_value("key").alias("name"))), "pairs")
    rare = stash(_rarity(nodes), "rare")
    dated = stash(nodes.filter("year is not null").join(rare, "name_id"), "withyear")
    side = lambda n, c: dated.select("name_id", "year", F.col("key").alias(f"k{n}"), F.col("day").alias(f"d{n}"), F.col("node").alias(c), F.col("rare").alias(f"r{n}"))
    left, right = side(1, "a"), side(2, "b")
    agree = F.col("d1").isNull() | F.col("d2").isNull() | (F.col("d1") == F.col("d2"))
    same = left.select("name_id", "year", "d1", "a").join(right.select("name_id", "year", "d2", "b"), ["name_id", "year"]).filter("a < b").filter(agree).select("a", "b")
    nearness = X.nearness(F.col("k1"), F.col("k2"))
    like = left.withColumnRenamed("name_id", "_a").join(pairs.filter(F.col("weight") >= MIN_ALONE).select(F.col("a").alias("_a"), F.col("b").alias("_b"), "weight"), "_a").join(right.withColumnRenamed("name_id", "_b"), ["_b", "year"]).filter(agree)
    like = like.select("a", "b", "k1", "k2", "r1", "r2", "d1", "d2", "weight")
    part = lambda df, key: df.withColumn("part", F.explode(F.array_distinct(F.split(key, " ")))).filter(F.length("part") > 2)
    most = rare.agg(F.max("rare")).first()[0] or 0  # one number
    faulty = left.filter(F.col("r1") <= max(2.0, most * 0.15))  # only what can be an error looks for its right form
    close = part(faulty, "k1").drop("name_id").join(part(right, "k2").drop("name_id"), ["year", "part"]).filter("a <> b").filter(agree).filter(nearness >= MIN_NEAR)
    close = close.select("a", "b", "k1", "k2", "r1", "r2", "d1", "d2", F.lit(0.0).alias("weight"))
    whole = like.filter(F.col("weight") > WHOLE).select("a", "b")
    guess = like.filter(F.col("weight") <= WHOLE).unionByName(close).filter(_is_error("r1", "r2")).withColumn("near", nearness)
    # A misspelt name goes to one other only, the nearest; so an error that lies between two names never makes them one.
    order = F.struct("weight", (F.col("d1").isNotNull() & F.col("d2").isNotNull()).alias("day"), "near", F.col("r2").alias("often"), -F.col("b"))
    best = guess.groupBy("a").agg(F.max_by("b", order).alias("b")).select("a", "b")
    linked = components(same.unionByName(whole).unionByName(best))
    dated = dated.join(linked, "node", "left")
    initial = F.col("root").isNull() & F.col("key").rlike(r"(^| )[a-z]( |$)")
    dated = stash(dated.withColumn("vague", initial).withColumn("root", F.coalesce("root", "node")).select("node", "root", "name_id", "year", "day", "key", "vague"), "dated")
    vague, dated = dated.filter("vague").drop("root", "vague"), dated.filter("not vague")
    roots = dated.select("name_id", "root", "year").distinct()
    late = nodes.filter("year is null").select("node", "name_id", "key")
    apart = vague.select("node", "name_id", "year", F.col("day").alias("d1")).join(pairs.withColumnRenamed("a", "name_id"), "name_id").join(dated.select(F.col("name_id").alias("b"), "root", "year", F.col("day").alias("d2")), ["b", "year"]).filter(agree)
    apart = apart.select("node", "root", "weight")
    exact = late.drop("key").join(roots, "name_id").select("node", "root", F.lit(2.0).alias("weight"))
    often = rare.select(F.col("name_id").alias("b"), F.col("rare").alias("r2"))
    near = late.join(rare.withColumnRenamed("rare", "r1"), "name_id").join(pairs.filter(F.col("weight") >= MIN_ALONE).withColumnRenamed("a", "name_id"), "name_id").join(often, "b").filter((F.col("weight") > WHOLE) | _is_error("r1", "r2"))
    near = near.join(roots.withColumnRenamed("name_id", "b"), "b").select("node", "root", "weight")
    told = stash(exact.unionByName(near).unionByName(apart), "told")
    ends = _part_and_end
    rest = late.join(told.select("node").distinct(), "node", "left_anti").join(rare, "name_id").select("node", F.col("key").alias("k1"), F.col("rare").alias("r1")).withColumn("end", ends(F.col("k1")))
    known = dated.join(rare, "name_id").select("root", F.col("key").alias("k2"), F.col("rare").alias("r2")).distinct().withColumn("end", ends(F.col("k2")))
    far = rest.join(known, "end").filter(_is_error("r1", "r2")).select("node", "root", nearness.alias("weight")).filter(F.col("weight") >= MIN_NEAR)
    fits = told.unionByName(far).groupBy("node", "root").agg(F.max("weight").alias("weight"))
    w = Window.partitionBy("node").orderBy(F.desc("weight"), "root")
    sole = fits.withColumn("_r", F.row_number().over(w)).withColumn("_w", F.lead("weight").over(w)).filter((F.col("_r") == 1) & (F.col("_w").isNull() | (F.col("_w") < F.col("weight")))).select("node", "root")
    sole = stash(sole, "sole")  # plans stay small: the driver holds a plan anew for each of its stages
    of_node = dated.select("node", "root").unionByName(late.select("node").unionByName(vague.select("node")).join(sole, "node", "left").withColumn("root", F.coalesce("root", "node")).select("node", "root"))
    of_node = nodes.join(of_node, "node").select("name_id", "year", "day", "root")
    cond = rows["name_id"].eqNullSafe(of_node["name_id"]) & rows["year"].eqNullSafe(of_node["year"]) & rows["day"].eqNullSafe(of_node["day"])
    return rows.join(of_node, cond, "left").select(rows["player_id"], F.coalesce("root", rows["player_id"]).alias("group_id"))


def surviving_records(members: DataFrame, id_col: str, fields: list[str], trusted: str, complete: str, updated: str, half_life: float = HALF_LIFE_DAYS) -> DataFrame:
    """group_id, id_col (the surviving row), n_rows and each field's best value.

    members: group_id, id_col, fields, a boolean trusted, a field complete and a timestamp updated. Every non-null value of
    every row votes with the trust of its row times the decay of its age against the newest row; votes are summed by
    normalised value (text is folded), the spelling with most votes stands for it. The id is a field like the others, but an
    id's vote isn't summed and climbs a ladder: a trusted row above any other, one that has complete above one that lacks
    it, then the later one. Ties (votes are compared to nine digits) go to the greater value. A field without values stays null; a null trusted is false; a
    null updated is older than any other; repeated rows of one id count once for the id. No rows give no records."""
    newest = members.agg(F.max(updated)).first()[0]
    age = F.coalesce(F.unix_micros(F.lit(newest).cast("timestamp")) - F.unix_micros(F.col(updated).cast("timestamp")), F.lit(10**18)).cast("double") / 86400e6
    decay = F.pow(F.lit(0.5), age / half_life)
    sure = F.coalesce(F.col(trusted), F.lit(False))
    ladder = sure.cast("double") * 2 + F.col(complete).isNotNull().cast("double")
    late = F.coalesce(F.unix_micros(F.col(updated).cast("timestamp")), F.lit(-(1 << 62)))
    vote = F.when(sure, TRUST[True]).otherwise(TRUST[False]) * decay
    values = [F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("value"), vote.alias("vote"), F.lit(0).cast("long").alias("late")) for f in fields]
    values.append(F.struct(F.lit(id_col).alias("field"), F.col(id_col).cast("string").alias("value"), ladder.alias("vote"), late.alias("late")))
    long = members.select("group_id", F.explode(F.array(*values)).alias("x")).select("group_id", "x.*").filter("value is not null and trim(value) <> ''")
    texts = [f for f, t in members.dtypes if t == "string" and f in fields]
    norm = F.when(F.col("field").isin(texts), F.coalesce(F.nullif(X.token_key(F.col("value")), F.lit("")), F.col("value"))).otherwise(F.lpad("value", 24, "0"))
    is_id = F.col("field") == id_col
    spelled = long.groupBy("group_id", "field", norm.alias("norm"), "value").agg(F.sum("vote").alias("s"), F.max(F.struct("vote", "late")).alias("m")).withColumn("v", F.when(is_id, F.col("m.vote")).otherwise(F.col("s"))).withColumn("late", F.col("m.late"))
    votes = spelled.groupBy("group_id", "field", "norm").agg(F.round(F.sum("v"), 9).alias("votes"), F.max("late").alias("late"), F.max_by("value", F.struct(F.round("v", 9), "value")).alias("value"))
    won = votes.groupBy("group_id", "field").agg(F.max_by("value", F.struct("votes", "late", "norm")).alias("value"), F.count(F.lit(1)).alias("n"))
    wide = won.groupBy("group_id").pivot("field", [id_col, *fields]).agg(F.first("value").alias("value"), F.first("n").alias("n"))
    cast = lambda f: F.col(f"{f}_value").cast(members.schema[f].dataType).alias(f)
    return wide.select("group_id", cast(id_col), F.col(f"{id_col}_n").alias("n_rows"), *[cast(f) for f in fields])
