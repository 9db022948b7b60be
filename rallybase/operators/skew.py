"""Heavy keys: find them with a bounded answer, spread them over slices."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def hot_keys(df: DataFrame, keys: list[str], share: float = 0.002) -> DataFrame:
    """Keys holding more than `share` of all rows, with the number of slices each needs.

    At most 1/share rows by construction, so the result is a small literal table that may be broadcast at any scale.
    """
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    total = df.count()
    least = max(total * share, 1.0)
    found = counts.filter(F.col("_n") > least).collect() if total else []
    fields = [df.schema[k] for k in keys]
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in fields] + [T.StructField("_slices", T.IntegerType())])
    rows = [tuple(r[k] for k in keys) + (int(r["_n"] // least) + 1,) for r in found]
    return df.sparkSession.createDataFrame(rows, schema)


def add_salt(df: DataFrame, hot: DataFrame, keys: list[str], identity: list[Column], name: str = "_salt") -> DataFrame:
    """The many side: rows of a hot key get one of its slices by a hash of their identity, all others 0."""
    out = df.join(F.broadcast(hot), keys, "left")
    return out.withColumn(name, F.when(F.col("_slices").isNull(), 0).otherwise(F.pmod(F.xxhash64(*identity), F.col("_slices"))).cast("int")).drop("_slices")


def replicate(df: DataFrame, hot: DataFrame, keys: list[str], name: str = "_salt") -> DataFrame:
    """The one side: a row of a hot key appears once for each slice, all others once."""
    out = df.join(F.broadcast(hot), keys, "left")
    return out.withColumn(name, F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_slices"), F.lit(1)) - 1))).drop("_slices")
