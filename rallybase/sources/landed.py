"""Readers of landed files: HTML, documents, boxes, CSV; and writers. No network: what is read lies in folders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import relational as R

BOX = T.StructType([T.StructField("doc_id", T.StringType()), T.StructField("page", T.IntegerType()), T.StructField("page_width", T.DoubleType()), T.StructField("page_height", T.DoubleType()), T.StructField("text", T.StringType()), *[T.StructField(c, T.DoubleType()) for c in ("x0", "x1", "top", "bottom")], T.StructField("fontname", T.StringType()), T.StructField("size", T.DoubleType())])


def read_pages(spark: SparkSession, path: str, glob: str = "*.html", fresh_since: Column | None = None) -> DataFrame:
    """url (the file), html, modified: whole files; fresh_since leaves out files that changed before."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true").load(path)
    if fresh_since is not None:
        files = files.filter(F.col("modificationTime") >= fresh_since)
    return files.select(F.col("path").alias("url"), F.decode("content", "utf-8").alias("html"), F.col("modificationTime").alias("modified"))


def read_documents(spark: SparkSession, path: str, pattern: str = r"class(\d+)_stage(\d+)", signature: str = "%PDF-") -> DataFrame:
    """path, class_id, stage, length, valid: files whose first bytes are the signature, ids out of the path."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    n = len(signature)
    ids = [F.nullif(F.regexp_extract("path", pattern, i), F.lit("")).try_cast("long") for i in (1, 2)]
    return files.select("path", ids[0].alias("class_id"), ids[1].alias("stage"), "length", (F.substring("content", 1, n) == F.encode(F.lit(signature), "utf-8")).alias("valid"))


def read_boxes(spark: SparkSession, path: str) -> DataFrame:
    """Word or character boxes dumped as JSON lines; broken lines are left out."""
    return spark.read.schema(BOX).option("mode", "DROPMALFORMED").json(path)


def read_csv_keep_last(spark: SparkSession, path: str, schema: T.StructType, key: str) -> DataFrame:
    """A CSV file that was appended to: the last line of each key, sorted by it."""
    rows = spark.read.schema(schema).option("header", "true").csv(path).withColumn("_at", F.struct(F.input_file_name().alias("f"), F.monotonically_increasing_id().alias("i")))
    return R.latest_per_group(rows, [key], [F.desc("_at")]).drop("_at").orderBy(key)


def numeric_ids(df: DataFrame, column: str) -> DataFrame:
    """id: the values that begin with a digit and are whole numbers."""
    return df.filter(F.col(column).rlike("^[0-9]")).select(F.col(column).try_cast("long").alias("id")).filter("id is not null").distinct()


def unprocessed(work: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """What of the work has no processed row yet: the way a run is resumed."""
    return work.join(done.select(key).distinct(), key, "left_anti")


def keyword_search(texts: DataFrame, keyword: str, text: str = "text", limit: int | None = 10) -> DataFrame:
    """Texts that hold the keyword in any case; the scan ends at the limit (which is the feature)."""
    found = texts.filter(F.contains(F.lower(text), F.lit(keyword.lower())))
    return found.limit(limit) if limit else found


def write_by_status(log: DataFrame, path: str, context: str = "context_json") -> None:
    """A log as CSV, one folder per status, the context flattened to text columns of its keys."""
    flat = log.withColumn("context", F.to_json(F.from_json(F.coalesce(F.col(context), F.lit("{}")), T.MapType(T.StringType(), T.StringType())))).drop(context)
    flat.write.mode("overwrite").partitionBy("status").option("header", "true").csv(path)


def append(df: DataFrame, path: str, form: str = "json") -> None:
    df.write.mode("append").format(form).save(path)


def compact(spark: SparkSession, path: str, target: str, rows_per_file: int = 5_000_000) -> None:
    """Rewrites a Parquet table with files of a bounded number of rows."""
    spark.read.parquet(path).write.mode("overwrite").option("maxRecordsPerFile", rows_per_file).parquet(target)
