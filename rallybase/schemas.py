"""Schemas and constraints of the record tables. Constraints are checked by queries that give the violating rows."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_T = {"long": T.LongType(), "int": T.IntegerType(), "string": T.StringType(), "date": T.DateType(), "ts": T.TimestampType(), "bool": T.BooleanType(), "double": T.DoubleType()}


def schema(text: str) -> T.StructType:
    return T.StructType([T.StructField(n, _T[t]) for n, t in (c.split(":") for c in text.split())])


_STAGED = " data_source_id:int content_hash:string row_created:ts row_updated:ts"
TABLES: dict[str, T.StructType] = {
    "tournament_raw": schema("row_id:long tournament_id_ext:string shortname:string longname:string startdate:string enddate:string city:string arena:string country_code:string url:string" + _STAGED),
    "tournament_class_raw": schema("row_id:long tournament_id_ext:string tournament_class_id_ext:string startdate:string shortname:string longname:string gender:string max_rank:int max_age:int url:string raw_stages:string raw_stage_hrefs:string ko_tree_size:int" + _STAGED),
    "player_license_raw": schema("row_id:long season_label:string season_id_ext:string club_name:string club_id_ext:string player_id_ext:string firstname:string lastname:string gender:string year_born:string license_info_raw:string ranking_group_raw:string last_seen_at:ts" + _STAGED),
    "player_ranking_raw": schema("row_id:long run_id_ext:string run_date:date player_id_ext:string firstname:string lastname:string year_born:int club_name:string points:int points_change_since_last:int position:int" + _STAGED),
    "player_transition_raw": schema("row_id:long season_id_ext:string season_label:string firstname:string lastname:string date_born:date year_born:string club_from:string club_to:string transition_date:date last_seen_at:ts" + _STAGED),
    "tournament_class_match_raw": schema("row_id:long tournament_id_ext:string tournament_class_id_ext:string group_id_ext:string match_id_ext:string s1_player_id_ext:string s2_player_id_ext:string s1_fullname_raw:string s2_fullname_raw:string s1_clubname_raw:string s2_clubname_raw:string game_point_tokens:string best_of:int raw_line_text:string tournament_class_stage_id:int" + _STAGED),
    "player": schema("player_id:long firstname:string lastname:string year_born:int date_born:string fullname_raw:string is_verified:bool row_created:ts row_updated:ts"),
    "club": schema("club_id:long shortname:string longname:string club_type:int city:string country_code:string remarks:string homepage:string active:int district_id:int row_created:ts"),
    "tournament_class_entry_new": schema("tournament_class_entry_id:long tournament_class_entry_id_ext:string tournament_class_entry_group_id_int:int tournament_class_id:long seed:int final_position:int row_created:ts row_updated:ts"),
    "tournament_class_player_new": schema("tournament_class_entry_id:long tournament_player_id_ext:string player_id:long club_id:long row_created:ts row_updated:ts"),
    "match_side_new": schema("match_id:long side_no:int represented_entry_id:long represented_league_team_id:long row_created:ts row_updated:ts"),
}


@dataclass(frozen=True)
class Reference:
    child: str
    column: str
    parent: str
    key: str


UNIQUE = {"player": ("player_id",), "club": ("club_id",), "tournament_class_entry_new": ("tournament_class_entry_id",), "player_license_raw": ("row_id",)}
REFERENCES = (
    Reference("tournament_class_player_new", "player_id", "player", "player_id"),
    Reference("tournament_class_player_new", "club_id", "club", "club_id"),
    Reference("tournament_class_player_new", "tournament_class_entry_id", "tournament_class_entry_new", "tournament_class_entry_id"),
    Reference("match_side_new", "represented_entry_id", "tournament_class_entry_new", "tournament_class_entry_id"),
)
CHECKS = {"player": {"date_born": r"date_born is null or date_born rlike '^\\d{4}-\\d{2}-\\d{2}$'"}, "match_side_new": {"side_no": "side_no in (1, 2)"}}


def references(spark: SparkSession) -> DataFrame:
    """The registry of references as a table."""
    return spark.createDataFrame([(r.child, r.column, r.parent, r.key) for r in REFERENCES], "child string, column string, parent string, key string")


def dictionary(spark: SparkSession) -> DataFrame:
    """table, position, column, type, unique."""
    rows = [(t, i, f.name, f.dataType.simpleString(), f.name in UNIQUE.get(t, ())) for t, s in TABLES.items() for i, f in enumerate(s, 1)]
    return spark.createDataFrame(rows, "table string, position int, column string, type string, is_unique boolean")


def violations(name: str, df: DataFrame) -> DataFrame:
    """rule and n of every check and unique key that rows of a table break."""
    found = df.sparkSession.createDataFrame([], "rule string, n long")
    for rule, cond in CHECKS.get(name, {}).items():
        bad = df.filter(~F.coalesce(F.expr(cond), F.lit(True))).agg(F.count(F.lit(1)).alias("n"))
        found = found.unionByName(bad.select(F.lit(f"check {rule}").alias("rule"), "n"))
    if name in UNIQUE:
        keys = list(UNIQUE[name])
        twice = df.groupBy(*keys).count().filter("count > 1").agg(F.count(F.lit(1)).alias("n"))
        found = found.unionByName(twice.select(F.lit("unique " + ", ".join(keys)).alias("rule"), "n"))
    return found.filter("n > 0")
