from datetime import date, datetime, timezone

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rallybase import audit, schemas
from rallybase.operators import skew
from rallybase.plans import publication as P
from rallybase.session import drop_stashed, shared_dir, stash
from rallybase.sources import landed
from rallybase.streaming import staging


def test_landed_files(spark, tmp_path):
    (tmp_path / "a.html").write_text("<title>Å</title>", encoding="utf-8")
    (tmp_path / "cid_class12_stage5.pdf").write_bytes(b"%PDF-1.7 x")
    (tmp_path / "cid_class13_stage5.pdf").write_bytes(b"<html>")
    assert [r["html"] for r in landed.read_pages(spark, str(tmp_path)).collect()] == ["<title>Å</title>"]
    assert landed.read_pages(spark, str(tmp_path), fresh_since=F.lit(datetime(2999, 1, 1, tzinfo=timezone.utc))).count() == 0
    docs = landed.read_documents(spark, str(tmp_path)).filter("class_id is not null")
    assert sorted((r["class_id"], r["stage"], r["valid"]) for r in docs.collect()) == [(12, 5, True), (13, 5, False)]
    (tmp_path / "boxes.json").write_text('{"doc_id": "d", "page": 1, "text": "a", "x0": 1.5}\nbroken\n')
    assert [(r["doc_id"], r["x0"]) for r in landed.read_boxes(spark, str(tmp_path / "boxes.json")).collect()] == [("d", 1.5)]
    (tmp_path / "x.csv").write_text("id,v\n2,a\n1,b\n2,c\n")
    got = landed.read_csv_keep_last(spark, str(tmp_path / "x.csv"), T.StructType([T.StructField("id", T.IntegerType()), T.StructField("v", T.StringType())]), "id").collect()
    assert [tuple(r) for r in got] == [(1, "b"), (2, "c")]


def test_small_readers(spark, tmp_path):
    df = spark.createDataFrame([("12",), ("7x",), ("x7",), (None,), ("12",)], "v string")
    assert [r["id"] for r in landed.numeric_ids(df, "v").collect()] == [12]
    assert sorted(r["v"] for r in landed.unprocessed(df.filter("v is not null"), spark.createDataFrame([("12",)], "v string"), "v").collect()) == ["7x", "x7"]
    assert landed.keyword_search(df.withColumnRenamed("v", "text"), "X7").count() == 1
    log = spark.createDataFrame([("failed", '{"a": 1}'), ("success", None)], "status string, context_json string")
    landed.write_by_status(log, str(tmp_path / "log"))
    assert spark.read.option("header", "true").csv(str(tmp_path / "log")).filter("status = 'failed'").first()["context"] == '{"a":"1"}'
    landed.append(df, str(tmp_path / "j"))
    landed.append(df, str(tmp_path / "j"))
    assert spark.read.json(str(tmp_path / "j")).count() == 10
    df.write.parquet(str(tmp_path / "p"))
    landed.compact(spark, str(tmp_path / "p"), str(tmp_path / "q"))
    assert spark.read.parquet(str(tmp_path / "q")).count() == 5


def test_stream_is_idempotent(spark, tmp_path):
    schema = "k int, v string, at int"
    src = tmp_path / "in"
    spark.createDataFrame([(1, "a", 1), (2, "b", 1), (1, "c", 2)], schema).coalesce(1).write.json(str(src))
    run = lambda: staging.stage_stream(spark.readStream.schema(schema).json(str(src)), str(tmp_path / "t"), str(tmp_path / "cp"), ["k"], ["v"], [F.desc("at")]).awaitTermination()
    run()
    first = staging.read_version(spark, str(tmp_path / "t"), 99)
    assert sorted((r["k"], r["v"], r["outcome"]) for r in first.collect()) == [(1, "c", "inserted"), (2, "b", "inserted")]
    spark.createDataFrame([(1, "c", 3), (2, "x", 3), (3, "n", 3)], schema).coalesce(1).write.mode("append").json(str(src))
    run()
    second = staging.read_version(spark, str(tmp_path / "t"), 99)
    assert sorted((r["k"], r["v"], r["outcome"]) for r in second.collect()) == [(1, "c", "unchanged"), (2, "x", "updated"), (3, "n", "inserted")]
    again = staging.upsert_batch(second, spark.createDataFrame([(3, "n", 4)], schema), ["k"], ["v"], [F.desc("at")])
    assert {r["k"]: r["outcome"] for r in again.collect()} == {1: "kept", 2: "kept", 3: "unchanged"}


def test_windowed_counts(spark):
    ev = spark.createDataFrame([(datetime(2024, 1, 1, 5), "a"), (datetime(2024, 1, 1, 6), "a"), (datetime(2024, 1, 2, 5), "a")], "ts timestamp, kind string")
    assert sorted(r["n"] for r in staging.windowed_counts(ev, "ts", "kind").collect()) == [1, 2]


def test_publication(spark, tmp_path):
    players = spark.createDataFrame([(1, "Ann", "Ek", 1990, None, True), (2, None, None, None, "ALM Bo", False)], "player_id long, firstname string, lastname string, year_born int, fullname_raw string, is_verified boolean")
    d = lambda n: date(2024, 1, n)
    rank = spark.createDataFrame([(1, "7", 1, d(2), 100, 5, 0), (1, "7", 1, d(1), 90, 6, 10), (1, "8", 1, d(2), 80, 9, 5)], "player_id long, player_id_ext string, data_source_id int, run_date date, points int, position int, points_change_since_last int")
    lic = spark.createDataFrame([(1, 10, d(1)), (1, 11, d(3))], "player_id long, club_id long, valid_from date")
    clubs = spark.createDataFrame([(10, "Alby"), (11, "Berga")], "club_id long, shortname string")
    prof = P.profiles(players, rank, lic, clubs, "salt")
    got = {r["player_id"]: (r["name"], r["points"], r["club"]) for r in prof.collect()}
    assert got == {1: ("Ann Ek", 80, "Berga"), 2: ("Bo ALM", None, None)}  # the id whose points changed last
    sides = spark.createDataFrame([(1, 1, 1, "Ann Ek"), (1, 2, 2, "Bo Alm"), (2, 1, 1, "Ann Ek"), (2, 2, 2, "Bo Alm")], "match_id long, side_no int, player_id long, name string")
    matches = spark.createDataFrame([(1, None, None), (2, None, 1)], "match_id long, winner_side int, walkover_side int")
    games = spark.createDataFrame([(1, 1, 11, 7), (1, 2, 12, 10)], "match_id long, game_no int, points1 int, points2 int")
    rows = {(r["match_id"], r["side_no"]): (r["opponents"], r["result"], r["score"]) for r in P.match_rows(sides, matches, games, "salt").collect()}
    assert rows == {(1, 1): ("Bo Alm", "W", "1: 11-7, 2: 12-10"), (1, 2): ("Ann Ek", "L", "1: 7-11, 2: 10-12"), (2, 1): ("Bo Alm", "L", "WO"), (2, 2): ("Ann Ek", "W", "WO")}
    ended = matches.withColumn("status", F.lit("completed")).withColumn("winner_side", F.coalesce("winner_side", F.lit(1)))
    s = {r["player_id"]: r for r in P.results_summary(players, sides, ended, games.toDF("match_id", "game_no", "points_side1", "points_side2")).collect()}
    assert (s[1]["total_matches"], s[1]["match_wins"], s[1]["sets_won"], s[1]["total_deuce_sets"], s[2]["total_points_scored"], s[2]["match_win_percentage"], s[1]["max_points_scored_in_set"]) == (1, 1, 2, 1, 17, 0.0, 12)
    index = P.term_index(prof, "player_id", F.col("name"))
    assert [r[0] for r in P.search(index, "player_id", "ek an").collect()] == [1]
    assert P.search(index, "player_id", " ").count() == 0
    target = str(tmp_path / "pub")
    assert P.publish(spark, {"profile": prof}, {"profile": "public_id"}, target)["profile"]["rows"] == 2
    with pytest.raises(ValueError, match="repeated"):
        P.publish(spark, {"profile": prof.union(prof)}, {"profile": "public_id"}, target)
    assert spark.read.parquet(f"{target}/profile").count() == 2


def test_audit(spark):
    df = spark.createDataFrame([(1, "success", None), (2, "failed", "x"), (3, "skipped", "dup"), (4, "failed", "x")], "id int, status string, reason string")
    log = audit.log_rows(df, "r1", "p", F.col("status"), F.col("reason"), {"id": F.col("id")})
    s = audit.summary(log).first()
    assert (s["processed"], s["success"], s["failed"], s["skipped"], s["adds_up"]) == (4, 1, 2, 1, True)
    assert tuple(audit.reasons(log, 1).first())[1:] == ("failed", "x", 2)
    assert (audit.visible(log, 0).count(), audit.visible(log, 1).count(), audit.visible(log, 2).count()) == (2, 3, 4)
    two = log.withColumn("run_at", F.lit(1)).union(log.withColumn("run_id", F.lit("r2")).withColumn("run_at", F.lit(2)))
    assert {r["run_id"] for r in audit.latest_run(two).collect()} == {"r2"}
    assert spark.range(1).select(audit.context_map(F.lit("a: 1, b: x"))).first()[0] == {"a": "1", "b": "x"}


def test_schemas(spark):
    assert schemas.references(spark).count() == len(schemas.REFERENCES)
    assert schemas.dictionary(spark).filter("table = 'player' and is_unique").first()["column"] == "player_id"
    p = spark.createDataFrame([(1, "2000-01-01"), (1, "x"), (2, None)], "player_id long, date_born string")
    assert sorted(tuple(r) for r in schemas.violations("player", p).collect()) == [("check date_born", 1), ("unique player_id", 1)]


def test_session(spark):
    assert shared_dir(spark) == shared_dir(spark)
    assert stash(spark.range(3)).count() == 3
    assert stash(spark.range(0)).count() == 0
    assert skew.hot_keys(spark.range(0).withColumnRenamed("id", "k"), ["k"]).count() == 0


def test_drop_stashed(spark):
    import os

    kept = stash(spark.range(3), "kept")
    path = kept.inputFiles()[0].removeprefix("file://").removeprefix("file:")
    assert os.path.exists(path)
    drop_stashed(spark)
    assert not os.path.exists(path)
