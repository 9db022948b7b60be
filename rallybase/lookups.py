"""Lookup tables of the domain."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values, which results refer to by number.
STATUSES = [(1, "Upcoming"), (2, "Ongoing"), (3, "Ended"), (4, "Cancelled"), (5, "Postponed"), (6, "Unknown")]
LEVELS = [(1, "National"), (2, "International")]
STAGES = [
    (1, "GROUP", "Group", 0, None),
    (2, "R128", "Round of 128", 1, 128),
    (3, "R64", "Round of 64", 1, 64),
    (4, "R32", "Round of 32", 1, 32),
    (5, "R16", "Round of 16", 1, 16),
    (6, "QF", "Quarterfinal", 1, 8),
    (7, "SF", "Semifinal", 1, 4),
    (8, "F", "Final", 1, 2),
    (9, "SWISS", "Swiss System", 0, None),
    (10, "KO_QAL", "Knockout Qualification", 1, None),
    (11, "GROUP_STG2", "Group Stage 2", 0, None),
]
CLASS_TYPES = [(1, "Singles"), (2, "Doubles"), (3, "Mixed doubles"), (4, "Team"), (9, "Unknown")]
STRUCTURES = [(1, "Groups and knockout"), (2, "Groups only"), (3, "Knockout only"), (4, "Groups and groups"), (9, "Unknown")]
LICENCE_KINDS = [("D-licens", ""), ("A-licens", "Barn"), ("A-licens", "Senior"), ("A-licens", "Pensionär"), ("A-licens", "Ungdom"), ("48-timmarslicens", ""), ("Paralicens", "")]
RANKING_GROUPS = [
    ("H", 2250, 100000, "HE"),
    ("H", 2000, 2249, "H1"),
    ("H", 1750, 1999, "H2"),
    ("H", 1500, 1749, "H3"),
    ("H", 1250, 1499, "H4"),
    ("H", 1000, 1249, "H5"),
    ("H", 750, 999, "H6"),
    ("H", 0, 749, "H7"),
    ("D", 1750, 100000, "DE"),
    ("D", 1500, 1749, "D1"),
    ("D", 1250, 1499, "D2"),
    ("D", 1000, 1249, "D3"),
    ("D", 750, 999, "D4"),
    ("D", 0, 749, "D5"),
    *[("HD", 0, n - 1, f"u{n}") for n in range(300, 1001, 100)],
]
UNKNOWN_PLAYER, UNKNOWN_CLUB = 99999, 9999


def seasons(spark: SparkSession, first: int = 2010, last: int = 2030) -> DataFrame:
    """season (first year), starts, ends (30 June, closed), label: made by rule."""
    y = F.col("id").cast("int")
    return spark.range(first, last + 1).select(y.alias("season"), F.make_date(y, F.lit(7), F.lit(1)).alias("starts"), F.make_date(y + 1, F.lit(6), F.lit(30)).alias("ends"), F.concat(y.cast("string"), F.lit("-"), F.lpad(((y + 1) % 100).cast("string"), 2, "0")).alias("label"))


def stages(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(STAGES, "stage_id int, shortname string, description string, is_knockout int, round_order int")


def ranking_groups(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(i, *g) for i, g in enumerate(RANKING_GROUPS, 1)], "group_id int, gender string, min_points int, max_points int, short string")
