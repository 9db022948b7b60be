from datetime import datetime

from pyspark.sql import functions as F

from rallybase.operators import orphans, skew

AT = datetime(2020, 6, 1)


def refs(spark, rows):
    return spark.createDataFrame(rows, "relation string, key long, referred_at timestamp, tag string")


def parents(spark, rows):
    return spark.createDataFrame(rows, "relation string, key long, valid_from timestamp")


def gone(spark, rows):
    return spark.createDataFrame(rows, "relation string, key long, deleted_at timestamp")


def test_statuses(spark):
    r = refs(spark, [("p", 1, AT, "ok"), ("p", 2, AT, "late"), ("p", 3, AT, "deleted"), ("p", 4, AT, "missing"), ("p", None, AT, "null"), ("c", 1, AT, "other relation"), ("p", 4, AT, "missing")])
    p = parents(spark, [("p", 1, datetime(2019, 1, 1)), ("p", 1, datetime(2021, 1, 1)), ("p", 2, datetime(2020, 6, 2)), ("p", None, AT)])
    d = gone(spark, [("p", 3, datetime(2020, 1, 1)), ("p", 9, AT)])
    got = sorted((r["tag"], r["status"]) for r in orphans.resolve_references(r, p, d).collect())
    assert got == [("deleted", "deleted"), ("late", "late"), ("missing", "missing"), ("missing", "missing"), ("ok", None), ("other relation", "missing")]


def test_null_times(spark):
    r = refs(spark, [("p", 1, None, "no time"), ("p", 2, AT, "parent without time")])
    p = parents(spark, [("p", 1, AT), ("p", 2, None)])
    assert {x["tag"]: x["status"] for x in orphans.resolve_references(r, p).collect()} == {"no time": None, "parent without time": None}


def test_empty(spark):
    assert orphans.resolve_references(refs(spark, []), parents(spark, []), gone(spark, [])).count() == 0
    assert orphans.resolve_references(refs(spark, [("p", 1, AT, "x")]), parents(spark, [])).first()["status"] == "missing"


def test_hot_key_is_sliced_and_whole(spark):
    r = spark.range(3000).select(F.lit("p").alias("relation"), F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("key"), F.lit(AT).alias("referred_at"), F.col("id").cast("string").alias("tag"))
    hot = skew.hot_keys(r, ["relation", "key"], 0.01)
    assert [(x["key"], x["_slices"] > 10) for x in hot.collect()] == [(7, True)]
    got = orphans.resolve_references(r, parents(spark, [("p", 7, AT)]), share=0.01)
    assert got.count() == 3000
    assert got.filter("key = 7 and status is null").count() == 1001  # 1000 multiples of three and 7 itself


def test_counts(spark):
    r = orphans.resolve_references(refs(spark, [("p", 4, AT, "a"), ("p", 4, AT, "b"), ("p", 5, AT, "c")]), parents(spark, [])).withColumn("table_name", F.lit("t")).withColumn("field_name", F.lit("f"))
    assert [tuple(x) for x in orphans.orphan_counts(r).collect()] == [("t", "f", "2020-06", "missing", 3, 2)]
