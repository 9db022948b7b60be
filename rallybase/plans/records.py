"""Queries of the record-keeping operators: orphan references (p1), club histories (p5), packed fields (p6)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import history, orphans, segment
from ..session import table


def _references(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    players, sides = table(spark, d, "tournament_class_player_new"), table(spark, d, "match_side_new")

    def ref(df: DataFrame, relation: str, name: str, field: str, k1: str, k2: str) -> DataFrame:
        return df.select(F.lit(relation).alias("relation"), F.col(field).cast("long").alias("key"), F.col("row_created").alias("referred_at"), F.lit(name).alias("table_name"), F.lit(field).alias("field_name"), F.col(k1).cast("long").alias("key1"), F.col(k2).cast("long").alias("key2"))

    refs = (
        ref(players, "player", "tournament_class_player_new", "player_id", "tournament_class_entry_id", "player_id")
        .unionByName(ref(players, "club", "tournament_class_player_new", "club_id", "tournament_class_entry_id", "player_id"))
        .unionByName(ref(sides, "tournament_class_entry_new", "match_side_new", "represented_entry_id", "match_id", "side_no"))
    )

    def parent(name: str, key: str) -> DataFrame:
        return table(spark, d, name).select(F.lit(name).alias("relation"), F.col(key).cast("long").alias("key"), F.col("row_created").alias("valid_from"))

    parents = parent("player", "player_id").unionByName(parent("club", "club_id")).unionByName(parent("tournament_class_entry_new", "tournament_class_entry_id"))
    gone = table(spark, d, "key_deletion").select(F.col("table_name").alias("relation"), F.col("key_id").cast("long").alias("key"), "deleted_at")
    return refs, parents, gone


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    found = orphans.resolve_references(*_references(spark, d))
    return found.filter(F.col("status").isNotNull()).select("table_name", "field_name", "key1", "key2").distinct()


def p1_orphan_report(spark: SparkSession, d: str) -> DataFrame:
    """Orphans per table, field, month and status."""
    return orphans.orphan_counts(orphans.resolve_references(*_references(spark, d)))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    versions = history.club_history(table(spark, d, "player_license_raw"), table(spark, d, "player_transition_raw"))
    return versions.select(F.col("person").alias("player_id_ext"), F.col("club").alias("club_id_ext"), F.date_format("valid_from", "yyyy-MM-dd").alias("valid_from")).distinct()


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    def part(name: str, field: str, lexicon: segment.Lexicon) -> DataFrame:
        return segment.split_packed(table(spark, d, name).select("row_id", field), ["row_id"], field, lexicon).select(F.lit(name).alias("table_name"), "row_id", "pos", "val")

    return part("tournament_class_match_raw", "game_point_tokens", segment.SCORES).unionByName(part("player_license_raw", "license_info_raw", segment.LICENCES)).distinct()


def queries() -> dict:
    return {f.__name__: f for f in (p1_found, p1_orphan_report, p5_found, p6_found)}


_BROKEN = """
WITH r AS (
  SELECT 'tournament_class_player_new' AS table_name, 'player_id' AS field_name, tournament_class_entry_id AS key1, player_id AS key2, player_id AS k, row_created, 'player' AS rel FROM tournament_class_player_new
  UNION ALL SELECT 'tournament_class_player_new', 'club_id', tournament_class_entry_id, player_id, club_id, row_created, 'club' FROM tournament_class_player_new
  UNION ALL SELECT 'match_side_new', 'represented_entry_id', match_id, side_no, represented_entry_id, row_created, 'tournament_class_entry_new' FROM match_side_new),
p AS (
  SELECT 'player' AS rel, player_id AS k, min(row_created) AS f FROM player GROUP BY player_id
  UNION ALL SELECT 'club', club_id, min(row_created) FROM club GROUP BY club_id
  UNION ALL SELECT 'tournament_class_entry_new', tournament_class_entry_id, min(row_created) FROM tournament_class_entry_new GROUP BY 2),
g AS (SELECT table_name AS rel, key_id AS k, max(deleted_at) AS gone FROM key_deletion GROUP BY 1, 2),
s AS (
  SELECT r.*, CASE WHEN p.f IS NULL AND g.gone IS NULL THEN 'missing' WHEN p.f IS NULL THEN 'deleted' WHEN p.f > r.row_created THEN 'late' END AS status
  FROM r LEFT JOIN p ON r.rel = p.rel AND r.k = p.k LEFT JOIN g ON r.rel = g.rel AND r.k = g.k WHERE r.k IS NOT NULL)
"""


def oracle_sql() -> dict[str, str]:
    return {
        "p1_found": _BROKEN + "SELECT DISTINCT table_name, field_name, CAST(key1 AS BIGINT) AS key1, CAST(key2 AS BIGINT) AS key2 FROM s WHERE status IS NOT NULL",
        "p1_orphan_report": _BROKEN + "SELECT table_name, field_name, strftime(row_created, '%Y-%m') AS period, status, count(*) AS n_references, count(DISTINCT k) AS n_keys FROM s WHERE status IS NOT NULL GROUP BY 1, 2, 3, 4",
        "p6_found": r"""
WITH v AS (
  SELECT 'tournament_class_match_raw' AS table_name, row_id, regexp_extract_all(game_point_tokens, 'WO(?::S[12])?|[+-]?[0-9]+') AS vals FROM tournament_class_match_raw
  UNION ALL SELECT 'player_license_raw', row_id, list_transform(regexp_extract_all(license_info_raw, '"[^"]*"|[^\s,;|/+"(][^,;|/+"(\n]*\([^)]*\)'), lambda x: trim(replace(x, '"', ''))) FROM player_license_raw)
SELECT DISTINCT table_name, row_id, CAST(i AS INTEGER) AS pos, vals[i] AS val FROM v, unnest(range(1, len(vals) + 1)) AS t(i)""",
    }
