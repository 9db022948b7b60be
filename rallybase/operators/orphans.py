"""References to records that do not exist.

References and parent keys form two streams that are hash-partitioned alike and sorted by key, parents first; one pass over
the merged stream gives each reference what is known of its parent: the interval in which it is valid. A key that holds a
large share of the references is spread over slices, with the (one-row) parent repeated in each.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import skew

STATUSES = ("missing", "deleted", "late")


def resolve_references(refs: DataFrame, parents: DataFrame, deletions: DataFrame | None = None, share: float = 0.002) -> DataFrame:
    """Status of every non-null reference.

    refs: relation, key, referred_at and any other columns, one row per reference. parents: relation, key, valid_from.
    deletions: relation, key, deleted_at. Gives refs plus status, one of null (the parent was valid), missing (no parent,
    no deletion known), deleted (no parent, a deletion is known) and late (the parent begins after the reference), and
    parent_from, deleted_at.

    Null keys are no references and give no row. Parents with a null key are ignored; of several parents with one key the
    earliest counts, one with unknown valid_from counts as always valid. A null referred_at can't be late. Repeated
    references stay repeated. Empty inputs give empty or all-missing results.
    """
    own = [c for c in refs.columns if c not in ("relation", "key", "referred_at")]
    refs = refs.filter(F.col("key").isNotNull()).select("relation", "key", F.col("referred_at"), F.struct(*[F.col(c) for c in own]).alias("_own") if own else F.lit(None).cast("struct<x:int>").alias("_own"))
    hot = skew.hot_keys(refs.select("relation", "key"), ["relation", "key"], share)
    kind = dict(refs.dtypes)["_own"]
    stream = skew.add_salt(refs, hot, ["relation", "key"], [F.col("_own"), F.col("referred_at")]).select(
        "relation", "key", "_salt", F.lit(1).alias("_kind"), F.col("referred_at").alias("_at"), F.lit(None).cast("timestamp_ntz" if dict(refs.dtypes)["referred_at"] == "timestamp_ntz" else "timestamp").alias("_deleted"), "_own"
    )
    at_type, del_type = stream.schema["_at"].dataType, stream.schema["_deleted"].dataType
    known = parents.filter(F.col("key").isNotNull()).select("relation", "key", F.lit(0).alias("_kind"), F.coalesce(F.col("valid_from"), F.lit("1000-01-01").cast("timestamp")).cast(at_type).alias("_at"), F.lit(None).cast(del_type).alias("_deleted"))
    if deletions is not None:
        known = known.unionByName(deletions.filter(F.col("key").isNotNull()).select("relation", "key", F.lit(0).alias("_kind"), F.lit(None).cast(at_type).alias("_at"), F.col("deleted_at").cast(del_type).alias("_deleted")))
    known = skew.replicate(known, hot, ["relation", "key"]).withColumn("_own", F.lit(None).cast(kind))
    merged = stream.unionByName(known)
    w = Window.partitionBy("relation", "key", "_salt").orderBy("_kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    merged = merged.withColumn("parent_from", F.min(F.when(F.col("_kind") == 0, F.col("_at"))).over(w)).withColumn("deleted_at", F.max("_deleted").over(w))
    status = (
        F.when(F.col("parent_from").isNull() & F.col("deleted_at").isNull(), "missing")
        .when(F.col("parent_from").isNull(), "deleted")
        .when(F.col("parent_from") > F.col("_at"), "late")
    )
    return merged.filter(F.col("_kind") == 1).select("relation", "key", F.col("_at").alias("referred_at"), *[F.col(f"_own.{c}").alias(c) for c in own], status.alias("status"), "parent_from", "deleted_at")


def orphan_counts(resolved: DataFrame) -> DataFrame:
    """Orphans per table, field, month of the reference and status."""
    bad = resolved.filter(F.col("status").isNotNull())
    return bad.groupBy("table_name", "field_name", F.date_format("referred_at", "yyyy-MM").alias("period"), "status").agg(F.count(F.lit(1)).alias("n_references"), F.countDistinct("key").alias("n_keys"))
