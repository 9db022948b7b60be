from pyspark.sql import functions as F

from rallybase.operators import staging as G


def rows(df, *cols):
    return sorted((tuple(r[c] for c in cols) if cols else tuple(r) for r in df.collect()), key=str)


def test_upsert_outcomes_and_idempotence(spark):
    t = spark.createDataFrame([(1, "a"), (2, "b"), (3, None), (None, "n")], "k int, v string")
    s = spark.createDataFrame([(1, "a"), (2, "c"), (3, "x"), (4, "d"), (None, "n")], "k int, v string")
    out = G.upsert(t, s, ["k"], ["v"])
    assert rows(out, "k", "v", "outcome") == [(1, "a", "unchanged"), (2, "c", "updated"), (3, "x", "updated"), (4, "d", "inserted"), (None, "n", "unchanged")]
    again = G.upsert(out.drop("outcome"), s, ["k"], ["v"])
    assert {r["outcome"] for r in again.collect()} == {"unchanged"}
    assert rows(G.upsert(t, s.limit(0), ["k"], ["v"]), "outcome") == [("kept",)] * 4
    assert rows(G.upsert(t.limit(0), s.filter("k = 1"), ["k"], ["v"]), "k", "outcome") == [(1, "inserted")]


def test_extra_columns(spark):
    t = spark.createDataFrame([(1, "a", "old")], "k int, v string, only_t string")
    s = spark.createDataFrame([(1, "b", 5), (2, "c", 6)], "k int, v string, only_s int")
    assert rows(G.upsert(t, s, ["k"], ["v"]), "k", "v", "only_t", "only_s", "outcome") == [(1, "b", "old", 5, "updated"), (2, "c", None, 6, "inserted")]


def test_other_writes(spark):
    t = spark.createDataFrame([(1, "x", 10), (2, "x", 20), (3, "y", 30)], "k int, g string, v int")
    s = spark.createDataFrame([(3, "x", 99), (4, "x", 40), (4, "x", 41)], "k int, g string, v int")
    assert rows(G.insert_ignore(t, s, ["k"], [F.asc("v")])) == [(1, "x", 10), (2, "x", 20), (3, "y", 30), (4, "x", 40)]
    assert rows(G.delete_and_replace(t, s, ["g"])) == [(3, "x", 99), (3, "y", 30), (4, "x", 40), (4, "x", 41)]
    assert rows(G.survivor_map(t, ["g"], "k")) == [(2, 1)]
    m = G.survivor_map(t, ["g"], "k")
    child = spark.createDataFrame([(2,), (3,), (None,)], "ref int")
    assert rows(G.repoint(child, "ref", m)) == [(1,), (3,), (None,)]
    assert rows(G.cascade_delete(t.filter("k = 2"), "k", [(child, "ref")])[0]) == [(3,), (None,)]
    assert rows(G.set_null_on_delete(t.filter("k = 2"), "k", child, "ref")) == [(3,), (None,), (None,)]
    assert rows(G.purge_orphans(t, "k", F.lit(True), [(child, "ref")]), "k") == [(2,), (3,)]
    new = spark.createDataFrame([(1, 11), (2, None)], "k int, v int")
    assert rows(G.update_from(t, new, ["k"], ["v"])) == [(1, "x", 11), (2, "x", 20), (3, "y", 30)]
    two = G.two_key_match(s.select("k", "g"), t.select("k", "g", F.col("v").alias("id")), ["k"], ["g"], "id")
    assert rows(two, "k", "id", "matched_by") == [(3, 30, 1), (4, 10, 2), (4, 10, 2)]


def test_hash_and_checks(spark):
    df = spark.createDataFrame([("a", None), (None, "a"), ("a", None)], "x string, y string")
    h = [r["h"] for r in df.select(G.content_hash(df, ["x", "y"]).alias("h")).collect()]
    assert h[0] == h[2] != h[1]
    checked = G.check_rows(df, [("x there", F.col("x").isNotNull()), ("y is a", F.col("y") == "a")])
    assert rows(checked, "reasons") == [("x there",), ("y is a",), ("y is a",)]
