"""Incremental staging: content hashes, upserts with outcomes, replace, merge, cascade; all as joins on whole tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as S
from .relational import latest_per_group


def content_hash(df: DataFrame, columns: list[str]) -> Column:
    """SHA-256 of a row's values joined by a bar: texts by their normal key, so that case, spacing and accents are no change,
    dates in ISO form, booleans as 0 and 1, null as nothing."""
    kinds = dict(df.dtypes)

    def part(c: str) -> Column:
        value = S.normalize_key(F.col(c)) if kinds[c] == "string" else F.col(c).cast("int") if kinds[c] == "boolean" else F.col(c)
        return F.coalesce(value.cast("string"), F.lit(""))

    return F.sha2(F.concat_ws("|", *map(part, columns)), 256)


def changed(a: Column, b: Column) -> Column:
    return ~a.eqNullSafe(b)


def upsert(target: DataFrame, source: DataFrame, keys: list[str], compare: list[str]) -> DataFrame:
    """The new table with an outcome for every row: inserted, updated, unchanged, or kept (not in the source).

    Null-safe on both keys and values; source keys have to be unique. Columns that only one side has are null on the other."""
    values = [c for c in dict.fromkeys(target.columns + source.columns) if c not in keys]
    t = target.select(*[F.col(k).alias(f"_k_{k}") for k in keys], *[F.col(c).alias(f"_t_{c}") for c in target.columns if c not in keys], F.lit(True).alias("_in_t"))
    s = source.select(*keys, *[F.col(c).alias(f"_s_{c}") for c in source.columns if c not in keys], F.lit(True).alias("_in_s"))
    cond = None
    for k in keys:
        c = F.col(f"_k_{k}").eqNullSafe(F.col(k))
        cond = c if cond is None else cond & c
    both = t.join(s, cond, "full_outer")
    differs = F.lit(False)
    for c in compare:
        differs = differs | changed(F.col(f"_t_{c}"), F.col(f"_s_{c}"))
    outcome = F.when(F.col("_in_t").isNull(), "inserted").when(F.col("_in_s").isNull(), "kept").when(differs, "updated").otherwise("unchanged")
    take = F.col("_in_s").isNotNull()

    def value(c: str) -> Column:
        if c not in source.columns:
            return F.col(f"_t_{c}")
        if c not in target.columns:
            return F.col(f"_s_{c}")
        return F.when(take, F.col(f"_s_{c}")).otherwise(F.col(f"_t_{c}"))

    return both.select(*[F.when(take, F.col(k)).otherwise(F.col(f"_k_{k}")).alias(k) for k in keys], *[value(c).alias(c) for c in values], outcome.alias("outcome"))


def two_key_match(source: DataFrame, target: DataFrame, first: list[str], second: list[str], target_id: str) -> DataFrame:
    """source with the target's id found by the first key, else by the second (matched_by: 1, 2 or null)."""
    by_first = target.groupBy(*first).agg(F.min(target_id).alias("_id1"))
    by_second = target.groupBy(*second).agg(F.min(target_id).alias("_id2"))
    out = source.join(by_first, first, "left").join(by_second, second, "left")
    return out.withColumn(target_id, F.coalesce("_id1", "_id2")).withColumn("matched_by", F.when(F.col("_id1").isNotNull(), 1).when(F.col("_id2").isNotNull(), 2)).drop("_id1", "_id2")


def insert_ignore(target: DataFrame, source: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """target and those first rows of source whose key it lacks."""
    new = latest_per_group(source, keys, order).join(target.select(*keys), keys, "left_anti")
    return target.unionByName(new.select(*target.columns))


def delete_and_replace(target: DataFrame, source: DataFrame, scope: list[str]) -> DataFrame:
    """All rows of the scopes that source has are replaced by source's rows."""
    return target.join(source.select(*scope).distinct(), scope, "left_anti").select(*target.columns).unionByName(source.select(*target.columns))


def cascade_delete(deleted: DataFrame, key: str, children: list[tuple[DataFrame, str]]) -> list[DataFrame]:
    """The children's rows that don't refer to a deleted key; null references stay."""
    gone = deleted.select(F.col(key).alias("_k")).distinct()
    return [child.join(gone, child[ref] == gone["_k"], "left_anti") for child, ref in children]


def set_null_on_delete(deleted: DataFrame, key: str, child: DataFrame, ref: str) -> DataFrame:
    gone = deleted.select(F.col(key).alias("_k")).distinct()
    return child.join(gone, child[ref] == gone["_k"], "left").withColumn(ref, F.when(F.col("_k").isNull(), F.col(ref))).drop("_k")


def survivor_map(rows: DataFrame, group: list[str], key: str) -> DataFrame:
    """loser, survivor: the smallest key of each group survives."""
    best = rows.groupBy(*group).agg(F.min(key).alias("survivor"))
    return rows.join(best, group).filter(F.col(key) != F.col("survivor")).select(F.col(key).alias("loser"), "survivor").distinct()


def repoint(child: DataFrame, ref: str, mapping: DataFrame) -> DataFrame:
    """References to losers become references to their survivors."""
    m = mapping.select(F.col("loser").alias("_l"), F.col("survivor").alias("_s"))
    return child.join(m, child[ref] == m["_l"], "left").withColumn(ref, F.coalesce("_s", ref)).drop("_l", "_s")


def purge_orphans(parents: DataFrame, key: str, removable: Column, dependents: list[tuple[DataFrame, str]]) -> DataFrame:
    """Parents without the removable rows that no dependent refers to."""
    used = None
    for child, ref in dependents:
        part = child.select(F.col(ref).alias(key)).filter(F.col(key).isNotNull())
        used = part if used is None else used.union(part)
    unused = parents.filter(removable).join(used.distinct(), key, "left_anti").select(key)
    return parents.join(unused, key, "left_anti")


def update_from(target: DataFrame, source: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """target with source's non-null values of the columns where the key is found (source keys unique)."""
    s = source.select(*keys, *[F.col(c).alias(f"_s_{c}") for c in columns])
    return target.join(s, keys, "left").select(*[F.coalesce(f"_s_{c}", c).alias(c) if c in columns else F.col(c) for c in target.columns])


def check_rows(df: DataFrame, rules: list[tuple[str, Column]]) -> DataFrame:
    """df with reasons: the names of the rules a row breaks, joined by a semicolon; null if it breaks none. A rule that
    can't be told (null) is broken."""
    reasons = F.array_compact(F.array(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in rules]))
    return df.withColumn("reasons", F.when(F.size(reasons) > 0, F.array_join(reasons, ";")))


def run_summary(outcomes: DataFrame, status: str = "status", reason: str = "reason") -> DataFrame:
    """status, reason, n of a run: processed is the sum of all n."""
    return outcomes.groupBy(status, reason).agg(F.count(F.lit(1)).alias("n"))
