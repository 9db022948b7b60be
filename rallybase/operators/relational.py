"""Relational building blocks: top-1 and top-k per group, interval and as-of joins, gap scans, carried headers, clusters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _cols(names: list[str | Column]) -> list[Column]:
    return [F.col(n) if isinstance(n, str) else n for n in names]


def latest_per_group(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each group in the given order. The order has to be total for a defined result. Null keys are a group."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def top_k_per_group(df: DataFrame, keys: list[str], order: list[Column], k: int, rank: str = "rank") -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w)).filter(F.col(rank) <= k)


def dedupe_first(df: DataFrame, keys: list[str], order: list[Column]) -> tuple[DataFrame, DataFrame]:
    """Kept and skipped rows: of rows with one key the first in order is kept. Rows with a null in the key are all kept, as
    nulls are distinct in a unique key."""
    w = Window.partitionBy(*keys).orderBy(*order)
    whole = F.lit(True)
    for k in keys:
        whole = whole & F.col(k).isNotNull()
    numbered = df.filter(whole).withColumn("_rn", F.row_number().over(w))  # rows without a key never meet in a task
    return numbered.filter("_rn = 1").drop("_rn").unionByName(df.filter(~whole)), numbered.filter("_rn > 1").drop("_rn")


def ordered_list(value: Column, order: list[Column], sep: str = ",", distinct: bool = False) -> Column:
    """Text of a group's values in a defined order; nulls are left out; null if none is left."""
    items = F.array_sort(F.collect_list(F.when(value.isNotNull(), F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)], value.cast("string").alias("v")))))
    texts = F.transform(items, lambda x: x["v"])
    if distinct:
        texts = F.array_distinct(texts)
    return F.when(F.size(texts) > 0, F.array_join(texts, sep))


def interval_join(points: DataFrame, intervals: DataFrame, at: str, start: str, end: str, keys: list[str] | None = None, how: str = "inner") -> DataFrame:
    """Points with the intervals (closed at both ends) that hold them, for equal keys.

    Without keys both sides are cut to calendar years, so that the join stays an equi-join: an interval is repeated for each
    year it touches. A null bound or point matches nothing."""
    if keys:
        cond = (F.col(at) >= F.col(start)) & (F.col(at) <= F.col(end))
        for k in keys:
            cond = cond & (points[k] == intervals[k])
        return points.join(intervals, cond, how)
    by_year = intervals.withColumn("_year", F.explode(F.sequence(F.year(start), F.year(end))))
    p = points.withColumn("_point_year", F.year(at))
    inside = (F.col("_point_year") == F.col("_year")) & F.col(at).between(F.col(start), F.col(end))
    return p.join(by_year, inside, how).drop("_year", "_point_year")


def overlaps(a: DataFrame, b: DataFrame, keys: list[str], a_from: str, a_to: str, b_from: str, b_to: str) -> DataFrame:
    """Pairs of rows with equal keys whose closed intervals share a point. a and b have no other column names in common."""
    return a.join(b, keys).filter((F.col(a_from) <= F.col(b_to)) & (F.col(b_from) <= F.col(a_to)))


def asof_before(left: DataFrame, right: DataFrame, keys: list[str], at: str, right_at: str, values: list[str], tie: str) -> DataFrame:
    """left with the values of the last right row at or before its time, by key: one merged pass, no pairs.

    Of right rows at one time the one with the greatest tie counts. Left rows without an earlier right row get nulls; null
    times match nothing. Both streams share one shuffle by key."""
    r = right.filter(F.col(right_at).isNotNull()).select(*keys, F.col(right_at).alias("_at"), F.lit(0).alias("_side"), F.struct(*values).alias("_v"), F.col(tie).cast("string").alias("_tie"), F.lit(None).cast(left.select(F.struct("*")).schema[0].dataType).alias("_row"))
    rows = left.select(*keys, F.col(at).alias("_at"), F.lit(1).alias("_side"), F.lit(None).cast(r.schema["_v"].dataType).alias("_v"), F.lit("").alias("_tie"), F.struct("*").alias("_row"))
    w = Window.partitionBy(*keys).orderBy("_at", "_side", "_tie").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    merged = r.unionByName(rows).withColumn("_last", F.last("_v", ignorenulls=True).over(w)).filter("_side = 1")
    return merged.select("_row.*", *[F.when(F.col("_at").isNotNull(), F.col(f"_last.{v}")).alias(v) for v in values])


def gap_scan(known: DataFrame, id_col: str, marked: DataFrame | None = None) -> DataFrame:
    """Numbers from 1 to the highest known one that aren't known, and those marked, highest first (column id)."""
    top = known.agg(F.max(F.col(id_col).cast("long"))).first()[0] or 0
    every = known.sparkSession.range(1, top + 1).toDF("id")
    gaps = every.join(known.select(F.col(id_col).cast("long").alias("id")), "id", "left_anti")
    if marked is not None:
        gaps = gaps.union(marked.select(F.col(id_col).cast("long"))).distinct()
    return gaps.orderBy(F.desc("id"))


def carry_forward(df: DataFrame, keys: list[str], order: list[str], header: Column, name: str) -> DataFrame:
    """The last header seen in order stands in every row until the next; rows before the first have null."""
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.withColumn(name, F.last(header, ignorenulls=True).over(w))


def gap_cluster(df: DataFrame, keys: list[str], position: Column, order: list[Column], gap: float, name: str = "cluster") -> DataFrame:
    """Numbers runs of rows from 0: a new run starts where the position is more than gap beyond the row before."""
    w = Window.partitionBy(*keys).orderBy(*order)
    jump = F.when(position - F.lag(position).over(w) > gap, 1).otherwise(0)
    marked = df.withColumn("_jump", jump)
    return marked.withColumn(name, F.sum("_jump").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)).cast("int")).drop("_jump")


def running_number(df: DataFrame, keys: list[str], order: list[Column], flag: Column, name: str) -> DataFrame:
    """Numbers the flagged rows of each group in order from 1; other rows have null."""
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.withColumn(name, F.when(flag, F.sum(flag.cast("int")).over(w)).cast("int"))


def pair_slots(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """Neighbours two by two: slot from 0 and place 1 or 2 in it."""
    n = F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) - 1
    return df.withColumn("slot", F.floor(n / 2).cast("int")).withColumn("place", (n % 2 + 1).cast("int"))


def upper_median(value: str) -> Column:
    """The element in the middle, the upper one for an even number, in groups of less than a thousand million rows; what is
    held for a group are its distinct values with their counts."""
    return F.expr(f"percentile_disc(0.5000000001) within group (order by {value})")


def share_of_total(df: DataFrame, count: str, name: str = "pct", digits: int = 1) -> DataFrame:
    """For an aggregated table of few rows: each row's count as a percentage of all."""
    return df.withColumn(name, F.round(F.lit(100.0).cast("double") * F.col(count) / F.sum(count).over(Window.partitionBy(F.lit(1))), digits))


def sole_candidate(df: DataFrame, row: list[str], candidate: str) -> DataFrame:
    """row and its only distinct non-null candidate; rows with none or several are left out."""
    return df.groupBy(*row).agg(F.min(candidate).alias("_lo"), F.max(candidate).alias("_hi")).filter("_lo = _hi").select(*row, F.col("_lo").alias(candidate))


def cascade(rows: DataFrame, row: list[str], strategies: list[tuple[str, DataFrame]], candidate: str) -> DataFrame:
    """The first strategy in order that leaves exactly one candidate wins: row, candidate, strategy, both null if none does.

    strategies: name and candidates (row, candidate; repeats allowed). All strategies run as one union and one aggregation,
    not one after the other."""
    tagged = None
    for i, (name, found) in enumerate(strategies):
        part = found.select(*row, F.lit(i).alias("_p"), F.lit(name).alias("strategy"), F.col(candidate))
        tagged = part if tagged is None else tagged.unionByName(part)
    sole = tagged.groupBy(*row, "_p", "strategy").agg(F.min(candidate).alias("_lo"), F.max(candidate).alias("_hi")).filter("_lo = _hi")
    best = sole.groupBy(*row).agg(F.min(F.struct("_p", "strategy", F.col("_lo").alias("c"))).alias("b"))
    return rows.select(*row).join(best, row, "left").select(*row, F.col("b.c").alias(candidate), F.col("b.strategy").alias("strategy"))


def name_keys(name: Column) -> Column:
    """All rotations of a name's parts: each split into beginning and end, ends first. One part stands for itself."""
    parts = F.filter(F.split(F.trim(name), r"\s+"), lambda p: p != "")
    n = F.size(parts)
    turned = F.transform(F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0))), lambda i: F.array_join(F.concat(F.slice(parts, i + 1, n), F.slice(parts, F.lit(1), i)), " "))
    return F.when(n > 0, F.array_distinct(turned)).otherwise(F.array().cast("array<string>"))


def common_prefix(a: Column, b: Column) -> Column:
    """Length of the common beginning of two texts."""
    n = F.least(F.length(a), F.length(b))
    grow = F.aggregate(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), F.lit(0), lambda acc, i: F.when((acc == i - 1) & (F.substring(a, F.lit(1), i) == F.substring(b, F.lit(1), i)), i).otherwise(acc))
    return F.when(n > 0, grow).otherwise(0)


def prefix_score(a: Column, b: Column) -> Column:
    """Mean of the shares that the common beginning has of both texts."""
    common = common_prefix(a, b).cast("double")
    return F.when((F.length(a) > 0) & (F.length(b) > 0), (common / F.length(a) + common / F.length(b)) / 2)


def prefix_match(queries: DataFrame, query: str, registry: DataFrame, key: str, entity: str, least: float = 0.8, head: int = 3) -> DataFrame:
    """query, entity, score: the entity with the highest prefix score of at least least; none if several entities tie.

    A score of 0.8 needs a common beginning, so the join is on the first letters. Several keys of one entity don't tie."""
    q = queries.select(query).filter(F.length(query) >= head).distinct().withColumn("_h", F.substring(query, 1, head))
    r = registry.select(entity, F.col(key).alias("_key")).withColumn("_h", F.substring("_key", 1, head))
    scored = q.join(r, "_h").withColumn("score", prefix_score(F.col(query), F.col("_key"))).filter(F.col("score") >= least)
    best = scored.groupBy(query, entity).agg(F.max("score").alias("score"))
    top = best.groupBy(query).agg(F.max("score").alias("score"))
    return sole_candidate(best.join(top, [query, "score"]), [query, "score"], entity).select(query, entity, "score")
