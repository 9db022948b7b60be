from datetime import date, datetime

from pyspark.sql import functions as F

from rallybase.operators import relational as R


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_top_and_dedupe(spark):
    df = spark.createDataFrame([("a", 1, 5), ("a", 2, 5), (None, 3, 1), (None, 4, 2)], "k string, i int, v int")
    assert rows(R.latest_per_group(df, ["k"], [F.desc("v"), F.asc("i")])) == rows(df.filter("i in (1, 4)"))
    kept, skipped = R.dedupe_first(df, ["k"], [F.asc("i")])
    assert [r["i"] for r in kept.orderBy("i").collect()] == [1, 3, 4]
    assert [r["i"] for r in skipped.collect()] == [2]
    assert R.latest_per_group(df.limit(0), ["k"], [F.asc("i")]).count() == 0


def test_intervals(spark):
    p = spark.createDataFrame([(1, date(2025, 6, 30)), (2, date(2025, 7, 1)), (3, None), (4, date(1999, 1, 1))], "i int, day date")
    s = spark.createDataFrame([("2024-25", date(2024, 7, 1), date(2025, 6, 30)), ("2025-26", date(2025, 7, 1), date(2026, 6, 30))], "label string, a date, b date")
    assert rows(R.interval_join(p, s, "day", "a", "b").select("i", "label")) == [(1, "2024-25"), (2, "2025-26")]
    a = spark.createDataFrame([(1, "x", date(2024, 9, 1), date(2025, 6, 30))], "i int, k string, af date, at date")
    b = spark.createDataFrame([(1, "x", date(2024, 7, 1), date(2024, 9, 1)), (2, "x", date(2024, 7, 1), date(2024, 8, 31))], "j int, k string, bf date, bt date")
    assert [r["j"] for r in R.overlaps(a, b, ["k"], "af", "at", "bf", "bt").collect()] == [1]


def test_asof(spark):
    t = lambda h: datetime(2024, 1, 1, h)
    left = spark.createDataFrame([(1, "a", t(5)), (2, "a", t(1)), (3, "b", t(5)), (4, "a", None)], "i int, k string, at timestamp")
    right = spark.createDataFrame([("a", t(2), 10), ("a", t(5), 20), ("a", t(5), 30), ("a", t(6), 40), ("a", None, 50)], "k string, rat timestamp, v int")
    assert sorted((r["i"], r["v"]) for r in R.asof_before(left, right, ["k"], "at", "rat", ["v"], "v").collect()) == [(1, 30), (2, None), (3, None), (4, None)]


def test_gap_scan(spark):
    known = spark.createDataFrame([(1,), (2,), (5,)], "id long")
    marked = spark.createDataFrame([(2,)], "id long")
    assert [r["id"] for r in R.gap_scan(known, "id", marked).collect()] == [4, 3, 2]
    assert R.gap_scan(known.limit(0), "id").count() == 0


def test_windows(spark):
    df = spark.createDataFrame([(1, 1.0, "H1"), (2, 10.0, None), (3, 50.0, None), (4, 60.0, "H2"), (5, 61.0, None)], "i int, x double, h string").withColumn("d", F.lit(1))
    assert [r["cluster"] for r in R.gap_cluster(df, ["d"], F.col("x"), [F.col("x")], 25).orderBy("i").collect()] == [0, 0, 1, 1, 1]
    assert [r["s"] for r in R.carry_forward(df, ["d"], ["i"], F.col("h"), "s").orderBy("i").collect()] == ["H1", "H1", "H1", "H2", "H2"]
    assert [(r["slot"], r["place"]) for r in R.pair_slots(df, ["d"], [F.col("i")]).orderBy("i").collect()] == [(0, 1), (0, 2), (1, 1), (1, 2), (2, 1)]
    assert df.agg(R.upper_median("x")).first()[0] == 50.0
    assert df.filter("i < 5").agg(R.upper_median("x")).first()[0] == 50.0
    assert [r["n"] for r in R.running_number(df, ["d"], [F.col("i")], F.col("h").isNotNull(), "n").orderBy("i").collect()] == [1, None, None, 2, None]


def test_lists_and_shares(spark):
    df = spark.createDataFrame([("a", 2, "y"), ("a", 1, "x"), ("a", 3, None), ("b", 1, None)], "k string, i int, v string")
    assert rows(df.groupBy("k").agg(R.ordered_list(F.col("v"), [F.col("i")], "|"))) == [("a", "x|y"), ("b", None)]
    assert rows(R.share_of_total(df.groupBy("k").count(), "count")) == [("a", 3, 75.0), ("b", 1, 25.0)]


def test_cascade(spark):
    e = spark.createDataFrame([(i,) for i in (1, 2, 3, 4)], "row int")
    c = lambda *x: spark.createDataFrame(list(x), "row int, c int")
    got = R.cascade(e, ["row"], [("first", c((1, 10), (1, 11), (2, 20), (2, 20))), ("second", c((1, 12), (3, 30), (2, 21)))], "c")
    assert rows(got) == [(1, 12, "second"), (2, 20, "first"), (3, 30, "second"), (4, None, None)]


def test_prefix_match(spark):
    reg = spark.createDataFrame([(1, "vetenkulla"), (1, "vetenkulla btk"), (2, "abcdefghij"), (3, "abcdefghik")], "club int, k string")
    q = spark.createDataFrame([("vetenkul",), ("abcdefghi",), ("xyz",), ("ab",), (None,)], "q string")
    assert rows(R.prefix_match(q, "q", reg, "k", "club")) == [("vetenkul", 1, 0.9)]
