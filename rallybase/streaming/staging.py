"""Incremental staging of landed files as a stream: each micro-batch is upserted by key and content hash.

The state is a folder with one version of the table per batch; the version a batch writes depends on its number only, so a
batch that is repeated after a failure gives the same version.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import relational as R
from ..operators import staging as G


def read_version(spark: SparkSession, path: str, batch: int) -> DataFrame | None:
    """The newest version below a batch number; null before the first."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(conf)
    if not fs.exists(root):
        return None
    done = [int(s.getPath().getName()[1:]) for s in fs.listStatus(root) if s.getPath().getName().startswith("v") and fs.exists(jvm.org.apache.hadoop.fs.Path(s.getPath(), "_SUCCESS"))]
    below = [n for n in done if n < batch]
    return spark.read.parquet(f"{path}/v{max(below)}") if below else None


def upsert_batch(target: DataFrame | None, rows: DataFrame, keys: list[str], values: list[str], order: list[Column]) -> DataFrame:
    """The table after a batch, with last_seen batch outcomes: of rows with one key the last in order counts."""
    hashed = rows.withColumn("content_hash", G.content_hash(rows, values))
    last = R.latest_per_group(hashed, keys, order).select(*keys, *values, "content_hash")
    if target is None:
        return last.withColumn("outcome", F.lit("inserted"))
    return G.upsert(target.drop("outcome"), last, keys, ["content_hash"])


def stage_stream(stream: DataFrame, path: str, checkpoint: str, keys: list[str], values: list[str], order: list[Column], once: bool = True) -> StreamingQuery:
    """Runs the stream into versions of the table under path."""

    def write(batch: DataFrame, number: int) -> None:
        state = read_version(batch.sparkSession, path, number)
        upsert_batch(state, batch, keys, values, order).write.mode("overwrite").parquet(f"{path}/v{number}")

    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


def windowed_counts(events: DataFrame, at: str, kind: str, size: str = "1 day", late: str = "2 days") -> DataFrame:
    """An extension: events per kind and time window, with a watermark for late ones; for streams and tables alike."""
    return events.withWatermark(at, late).groupBy(F.window(at, size).alias("w"), kind).agg(F.count(F.lit(1)).alias("n")).select("w.start", "w.end", kind, "n")
