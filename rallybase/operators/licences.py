"""Licence rows with their ids, seasons and years read, however written."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as X
from ..session import stash


def _majority(df: DataFrame, keys: list[str], value: str, out: str, unique: bool = False) -> DataFrame:
    """The most frequent value for each key (ties: the smallest), or with unique the only value."""
    counts = df.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n"))
    best = counts.groupBy(*keys).agg(F.max_by(value, F.struct(F.col("_n"), F.hash(value))).alias(out), F.count(F.lit(1)).alias("_k"))
    return (best.filter("_k = 1") if unique else best).drop("_k")


def parse_licences(raw: DataFrame) -> DataFrame:
    """Licence rows with what each one says by itself: _person, _club and _season are null where they are missing or unreadable."""
    return raw.select(
        "row_id", X.digits_id("player_id_ext").alias("_person"), X.digits_id("club_id_ext").alias("_club"), X.season_start(F.col("season_label")).alias("_season"), "season_id_ext",
        X.year_of(F.col("year_born")).alias("year"), "firstname", "lastname", "club_name", "license_info_raw", "content_hash", "last_seen_at",
        F.to_date("last_seen_at").alias("seen"), X.token_key(F.concat_ws(" ", "firstname", "lastname")).alias("name_key"), X.skeleton(F.col("club_name")).alias("club_key"),
    )


def read_licences(raw: DataFrame) -> DataFrame:
    """row_id, person, season, club, year, firstname, lastname, club_name, license_info_raw, seen (date), name_key, club_key.

    person and club are the external numbers as plain digits. A missing club number is taken from the rows with the same
    folded club name; a missing person number from the only person with the same folded name and year, else with that name
    and club; a season that can't be read from the one its number stands for in other rows. What stays unknown is null. No
    row is dropped, repeated rows stay.
    """
    base = stash(parse_licences(raw), "parsed")
    seasons = _majority(base.filter(F.col("season_id_ext").isNotNull()), ["season_id_ext"], "_season", "_season2")
    clubs = _majority(base.filter(F.col("club_key").isNotNull() & (F.col("club_key") != "")), ["club_key"], "_club", "_club2")
    out = base.join(seasons, "season_id_ext", "left").join(clubs, "club_key", "left")
    out = out.withColumn("season", F.coalesce("_season", "_season2")).withColumn("club", F.coalesce("_club", "_club2")).drop("_season", "_season2", "_club", "_club2", "season_id_ext")
    out = stash(out, "coded")
    named = out.filter(F.col("_person").isNotNull())
    by_year = _majority(named, ["name_key", "year"], "_person", "_p1", unique=True).filter(F.col("year").isNotNull())
    by_club = _majority(named, ["name_key", "club"], "_person", "_p2", unique=True).filter(F.col("club").isNotNull())
    lost = out.filter(F.col("_person").isNull()).join(by_year, ["name_key", "year"], "left").join(by_club, ["name_key", "club"], "left")
    known = named.withColumn("_p1", F.lit(None).cast("string")).withColumn("_p2", F.lit(None).cast("string"))
    return known.unionByName(lost).withColumn("person", F.coalesce("_person", "_p1", "_p2")).drop("_person", "_p1", "_p2")
