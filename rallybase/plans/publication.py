"""The publication build: profiles, results, matches and a term index under opaque ids, checked before they are swapped in."""

from __future__ import annotations

import time
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import relational as R


def profiles(players: DataFrame, rankings: DataFrame, licences: DataFrame, clubs: DataFrame, salt: str, preferred_source: int | None = None) -> DataFrame:
    """public_id, player_id, name, year_born, points, position, club: each player with the best ranking and latest licence.

    Best: the latest run of each external id, then over a player's ids the latest run, the preferred source, the last run in
    which points changed (none: last), the points and the external id. rankings: player_id, player_id_ext, data_source_id, run_date,
    points, position, points_change_since_last."""
    one = R.latest_per_group(rankings, ["player_id", "player_id_ext", "data_source_id"], [F.desc("run_date"), F.desc_nulls_last("points")])
    change = rankings.groupBy("player_id", "player_id_ext", "data_source_id").agg(F.max(F.when(F.coalesce("points_change_since_last", F.lit(0)) != 0, F.col("run_date"))).alias("changed"))
    preferred = F.when(F.col("data_source_id") == F.lit(preferred_source), 0).otherwise(1) if preferred_source is not None else F.lit(0)
    best = R.latest_per_group(one.join(change, ["player_id", "player_id_ext", "data_source_id"]), ["player_id"], [F.desc("run_date"), preferred, F.desc_nulls_last("changed"), F.desc_nulls_last("points"), F.desc("player_id_ext")])
    held = R.latest_per_group(licences, ["player_id"], [F.desc("valid_from"), F.desc("club_id")]).join(clubs.select("club_id", F.col("shortname").alias("club")), "club_id", "left")
    name = S.display_name(F.col("is_verified"), F.col("firstname"), F.col("lastname"), F.col("fullname_raw"))
    out = players.select("player_id", name.alias("name"), "year_born").join(best.select("player_id", "points", "position", "run_date"), "player_id", "left").join(held.select("player_id", "club"), "player_id", "left")
    return out.select(S.opaque_id(salt, F.col("player_id")).alias("public_id"), "player_id", "name", "year_born", "points", "position", "run_date", "club")


def winner_from_games(games: DataFrame) -> DataFrame:
    """match_id, winner_side: the side with more games; null if even. games: match_id, game_no, points1, points2."""
    g = games.groupBy("match_id").agg(F.count_if(F.col("points1") > F.col("points2")).alias("a"), F.count_if(F.col("points2") > F.col("points1")).alias("b"))
    return g.select("match_id", F.when(F.col("a") > F.col("b"), 1).when(F.col("b") > F.col("a"), 2).alias("winner_side"))


def perspective_text(games: DataFrame) -> DataFrame:
    """match_id, side_no, score: '1: 11-7, 2: 9-11' as each side sees it."""
    own = lambda s: F.concat(F.col("game_no").cast("string"), F.lit(": "), F.col(f"points{s}").cast("string"), F.lit("-"), F.col(f"points{3 - s}").cast("string"))
    per = games.groupBy("match_id").agg(R.ordered_list(own(1), [F.col("game_no")], ", ").alias("s1"), R.ordered_list(own(2), [F.col("game_no")], ", ").alias("s2"))
    return per.select("match_id", F.explode(F.array(F.struct(F.lit(1).alias("side_no"), F.col("s1").alias("score")), F.struct(F.lit(2).alias("side_no"), F.col("s2").alias("score")))).alias("x")).select("match_id", "x.*")


def match_rows(sides: DataFrame, matches: DataFrame, games: DataFrame, salt: str) -> DataFrame:
    """public_id, match_id, opponents, result, score: a row for each player of each match.

    sides: match_id, side_no, player_id, name. matches: match_id, winner_side, walkover_side. The stored winner counts, else
    the one told by the games; a walkover is shown as WO."""
    opp = sides.groupBy("match_id", (3 - F.col("side_no")).alias("side_no")).agg(R.ordered_list(F.col("name"), [F.col("name")], " / ").alias("opponents"))
    m = matches.join(winner_from_games(games).withColumnRenamed("winner_side", "_w"), "match_id", "left").withColumn("win", F.coalesce("winner_side", "_w", 3 - F.col("walkover_side")))
    out = sides.join(m, "match_id").join(opp, ["match_id", "side_no"], "left").join(perspective_text(games), ["match_id", "side_no"], "left")
    result = F.when(F.col("win") == F.col("side_no"), "W").when(F.col("win") == 3 - F.col("side_no"), "L")
    return out.select(S.opaque_id(salt, F.col("player_id")).alias("public_id"), "match_id", "side_no", "opponents", result.alias("result"), F.when(F.col("walkover_side").isNotNull(), "WO").otherwise(F.col("score")).alias("score"))


def results_summary(players: DataFrame, sides: DataFrame, matches: DataFrame, games: DataFrame) -> DataFrame:
    """player_id with matches, sets, deuce sets and points won and lost, their shares, averages and extremes, for every player.

    Only completed matches without walkover count. A set goes to deuce if either side has more than 11. Who has played none has
    nulls. sides: match_id, side_no, player_id; matches: match_id, status, winner_side, walkover_side; games: match_id, game_no,
    points_side1, points_side2."""
    m = matches.filter("status = 'completed' and walkover_side is null").select("match_id", "winner_side")
    per = sides.select("match_id", "side_no", "player_id").join(m, "match_id")
    total = per.groupBy("player_id").agg(F.countDistinct("match_id").alias("total_matches"), F.count_if(F.col("winner_side") == F.col("side_no")).alias("match_wins"))
    first = F.col("side_no") == 1
    own, other = F.when(first, F.col("points_side1")).otherwise(F.col("points_side2")), F.when(first, F.col("points_side2")).otherwise(F.col("points_side1"))
    g = per.join(games, "match_id").select("player_id", own.alias("o"), other.alias("l"))
    won, deuce = F.col("o") > F.col("l"), F.greatest("o", "l") > 11
    sets = g.groupBy("player_id").agg(
        F.count(F.lit(1)).alias("total_sets"), F.count_if(won).alias("sets_won"), F.count_if(deuce).alias("total_deuce_sets"), F.count_if(deuce & won).alias("deuce_sets_won"), F.sum("o").alias("total_points_scored"), F.sum("l").alias("total_points_lost"),
        F.round(F.avg("o"), 2).alias("avg_points_scored_per_set"), F.round(F.avg("l"), 2).alias("avg_points_lost_per_set"), *[f(c).alias(f"{n}_points_{w}_in_set") for c, w in (("o", "scored"), ("l", "lost")) for f, n in ((F.max, "max"), (F.min, "min"))],
    )
    share = lambda part, whole: F.round(F.lit(100.0).cast("double") * part / F.nullif(whole, F.lit(0)), 2)
    out = players.select("player_id").join(total, "player_id", "left").join(sets, "player_id", "left")
    return out.withColumns(
        {
            "match_losses": F.col("total_matches") - F.col("match_wins"), "sets_lost": F.col("total_sets") - F.col("sets_won"), "deuce_sets_lost": F.col("total_deuce_sets") - F.col("deuce_sets_won"), "match_win_percentage": share(F.col("match_wins"), F.col("total_matches")),
            "set_win_percentage": share(F.col("sets_won"), F.col("total_sets")), "deuce_win_percentage": share(F.col("deuce_sets_won"), F.col("total_deuce_sets")), "points_win_percentage": share(F.col("total_points_scored"), F.col("total_points_scored") + F.col("total_points_lost")),
        }
    )


def term_index(df: DataFrame, key: str, text: Column) -> DataFrame:
    """term, key: the words of a text in folded letters."""
    words = F.regexp_extract_all(S.ascii_key(text), F.lit("[a-z0-9]+"), F.lit(0))
    return df.select(key, F.explode(words).alias("term")).distinct().select("term", key)


def search(index: DataFrame, key: str, query: str) -> DataFrame:
    """Keys that hold every word of the query, the last one as a beginning."""
    import re
    import unicodedata

    terms = re.findall("[a-z0-9]+", "".join(c for c in unicodedata.normalize("NFKD", query.lower()) if not unicodedata.combining(c)))
    if not terms:
        return index.select(key).filter(F.lit(False))
    hit = F.coalesce(*[F.when(F.col("term") == t, i) for i, t in enumerate(terms[:-1])], F.when(F.startswith("term", F.lit(terms[-1])), len(terms) - 1))
    return index.withColumn("_i", hit).filter("_i is not null").groupBy(key).agg(F.countDistinct("_i").alias("n")).filter(F.col("n") == len(set(terms[:-1])) + 1).select(key)


def publish(spark: SparkSession, tables: dict[str, DataFrame], unique: dict[str, str], target: str) -> dict:
    """Writes the tables beside the target, checks that each key named in unique is never null and never repeated, and swaps the
    folder in. If a check fails the old publication stays and the reason is raised. Gives rows and seconds by table."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    path = lambda p: jvm.org.apache.hadoop.fs.Path(p)
    fs = path(target).getFileSystem(conf)
    tmp, old = f"{target}.tmp-{uuid.uuid4().hex}", f"{target}.old-{uuid.uuid4().hex}"
    report: dict = {}
    try:
        for name, df in tables.items():
            began = time.perf_counter()
            df.write.parquet(f"{tmp}/{name}")
            report[name] = {"rows": spark.read.parquet(f"{tmp}/{name}").count(), "seconds": round(time.perf_counter() - began, 3)}
        for name, key in unique.items():
            made = spark.read.parquet(f"{tmp}/{name}")
            if not made.filter(F.col(key).isNull()).isEmpty() or not made.groupBy(key).count().filter("count > 1").isEmpty():
                raise ValueError(f"{name}.{key} is null or repeated")
        there = fs.exists(path(target))
        if there and not fs.rename(path(target), path(old)):
            raise OSError(f"{target} can't be moved aside")
        if not fs.rename(path(tmp), path(target)):
            if there:
                fs.rename(path(old), path(target))
            raise OSError(f"{tmp} can't be moved to {target}")
        fs.delete(path(old), True)
    finally:
        fs.delete(path(tmp), True)
    return report
