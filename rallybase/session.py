"""Session helpers: where intermediate tables go, and how lineage is cut."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

_STASHED: list[str] = []
_SHIPPED: set[str] = set()


def shared_dir(spark: SparkSession) -> str:
    """Folder for intermediate tables: the cluster's spark.checkpoint.dir. Only a local session without one gets a temporary
    folder; on a cluster its absence is an error, as executors would write where nobody else can read."""
    sc = spark.sparkContext
    named = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not named:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="rallybase-"))
        named = sc.getCheckpointDir()
    return named.rstrip("/")


def _path(spark: SparkSession, path: str):  # noqa: ANN202
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(conf)


def stash(df: DataFrame, name: str = "t") -> DataFrame:
    """Write df once to the shared folder and read it back: cuts lineage, and survives the loss of any executor. The table is
    removed when the application ends, or before by drop_stashed."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _STASHED.append(path)
    p, fs = _path(spark, path)
    fs.deleteOnExit(p)
    return spark.read.schema(df.schema).parquet(path)


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers once per application, so that they need no path to it."""
    sc = spark.sparkContext
    if sc.applicationId not in _SHIPPED:
        here = os.path.dirname(os.path.abspath(__file__))
        made = os.path.join(tempfile.mkdtemp(prefix="rallybase-ship-"), "rallybase.zip")
        with zipfile.ZipFile(made, "w", zipfile.ZIP_DEFLATED) as z:
            for folder, _, files in os.walk(here):
                for f in files:
                    if f.endswith(".py"):
                        whole = os.path.join(folder, f)
                        z.write(whole, os.path.join("rallybase", os.path.relpath(whole, here)))
        sc.addPyFile(made)
        _SHIPPED.add(sc.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def parallelism(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def drop_stashed(spark: SparkSession) -> None:
    """Removes the intermediate tables of this application. DataFrames that still read them fail afterwards."""
    while _STASHED:
        p, fs = _path(spark, _STASHED.pop())
        fs.delete(p, True)
