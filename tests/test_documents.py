from pyspark.sql import functions as F

from rallybase.operators import bracket as B
from rallybase.operators import documents as D


def test_lines_and_columns(spark):
    boxes = spark.createDataFrame([("d", 1, "Ek", 60.0, 10.0), ("d", 1, "Ann", 10.0, 12.5), ("d", 1, "Bo", 10.0, 14.0), ("d", 1, "Alm", 50.0, 14.5), ("d", 1, None, 1.0, 1.0)], "doc_id string, page int, text string, x0 double, top double")
    got = D.lines_of_boxes(boxes).orderBy("line").collect()
    assert [(r["line"], r["text"]) for r in got] == [(0, "Ann Ek"), (1, "Bo Alm")]
    bands = spark.createDataFrame([("d", 1, "a", x, 0.0) for x in (1.0, 10.0, 50.0, 60.0)], "doc_id string, page int, text string, x0 double, top double")
    assert [(r["low"], r["high"]) for r in D.column_bands(bands).orderBy("low").collect()] == [(1.0, 10.0), (50.0, 60.0)]
    assert D.lines_of_boxes(boxes.limit(0)).count() == 0


def test_sections_entries_counts(spark):
    lines = spark.createDataFrame([("d", 1, "Pool 1 (2 spelare)"), ("d", 2, "12 Ann Ek,Alby BTK"), ("d", 3, "Bo Alm"), ("d", 4, "Pool 2"), ("d", 5, "7 Cia Dal , Berga")], "doc_id string, line int, text string")
    s = D.entries_of_lines(D.sections(lines, r"^(Pool \d+)")).orderBy("line").collect()
    assert [(r["section"], r["number"], r["name"], r["club"]) for r in s] == [("Pool 1", 12, "Ann Ek", "Alby BTK"), ("Pool 1", None, "Bo Alm", None), ("Pool 2", 7, "Cia Dal", "Berga")]
    assert tuple(D.expected_count(lines).first()) == ("d", 2, 2)


def test_match_lines(spark):
    lines = spark.createDataFrame([(1, "001 15 Kajsa Ek, Ulv PK - 20 Ida Alm, Djurbro BTK 8, -5, -7, -5"), (2, "004 3 Ann Ek - Bo Alm-Dal WO:S1"), (3, "029 16 Katå Ed, Vet BTF - 10 Elsa Ro, Draklunda GIF"), (4, "Pool 3")], "line int, text string")
    got = {r["line"]: r for r in D.matches_of_lines(lines).collect()}
    a = got[1]
    assert (a["match_no"], a["number1"], a["name1"], a["club1"], a["number2"], a["name2"], a["club2"], a["tokens"]) == (1, 15, "Kajsa Ek", "Ulv PK", 20, "Ida Alm", "Djurbro BTK", "8, -5, -7, -5")
    assert (got[2]["name2"], got[2]["number2"], got[2]["tokens"]) == ("Bo Alm-Dal", None, "WO:S1")
    assert (got[3]["name2"], got[3]["tokens"]) == ("Elsa Ro", None)
    assert got[4]["match_no"] is None
    both = D.matches_of_lines(lines.union(spark.createDataFrame([(9, "001 15 Kajsa Ek, Ulv PK - 20 Ida Alm, Djurbro BTK")], "line int, text string")))
    assert [r["line"] for r in D.best_duplicates(both.filter("match_no = 1"), ["match_no"]).collect()] == [1]


def test_walkover_upgrade(spark):
    m = spark.createDataFrame([(1, "P1", "Ann", "Bo", "WO"), (2, "P1", "Bo", "Cia", "9,9"), (3, "P2", "Ann", "Bo", "WO")], "id int, grp string, name1 string, name2 string, tokens string")
    out = D.upgrade_walkovers(m, spark.createDataFrame([("P1", "ANN")], "grp string, name string"))
    assert {r["id"]: r["tokens"] for r in out.collect()} == {1: "WO:S1", 2: "9,9", 3: "WO"}


def test_html(spark):
    html = "<html><title> Cup &amp; Co </title><table><tr><th>A</th></tr><tr class='x'><td>1</td><td><a href='k?stage=3&x=1'>Pool</a></td><td><a href='k?stage=5'>Slut</a></td></tr></table>"
    pages = spark.createDataFrame([("u", html), ("v", None), ("w", "no table")], "url string, html string")
    cells = D.html_cells(pages)
    assert sorted((r["row"], r["cell"], r["text"], r["href"]) for r in cells.collect()) == [(0, 0, "A", None), (1, 0, "1", None), (1, 1, "Pool", "k?stage=3&x=1"), (1, 2, "Slut", "k?stage=5")]
    assert [r[0] for r in pages.select(D.html_title(F.col("html"))).collect()] == ["Cup & Co", None, None]
    assert tuple(D.stage_links(cells, ["url"]).first()) == ("u", "3,5", '{"3":"k?stage=3&x=1","5":"k?stage=5"}')


def test_nearest_and_report(spark):
    w = spark.createDataFrame([("d", 1, 10.0), ("d", 2, 12.0)], "doc_id string, winner_id long, y double")
    s = spark.createDataFrame([("d", 7, 11.0), ("d", 8, 30.0), ("d", 9, 13.5)], "doc_id string, score_id long, y double")
    assert sorted(tuple(r) for r in D.nearest_scores(w, s).collect()) == [("d", 1, 7), ("d", 2, 9)]
    r = spark.createDataFrame([(1, ["x", "A.", "Ann Ek", "Bo Alm", "11-7", "11-9", "1-0", "B.", "Cia", "Dan", "Eva", "Fia", "9-11", "1-1"]), (2, None)], "report_id int, tokens array<string>")
    got = [tuple(x)[1:] for x in D.report_tokens(r).orderBy("match_no").collect()]
    assert got == [(1, "A", "Ann Ek", "Bo Alm", "11-7, 11-9", "1-0"), (2, "B", "Cia / Dan", "Eva / Fia", "9-11", "1-1")]


def test_bracket(spark):
    assert B.expected_matches(16) == [8, 4, 2, 1]
    entries = spark.createDataFrame([("c", i, e) for i, e in enumerate([10, 11, 12, None, 14, 15, 16, 17], 1) if e], "class_id string, position int, entry long")
    one = B.byes(B.first_round(entries, 8)).orderBy("slot").collect()
    assert [(r["side1"], r["side2"], r["winner"]) for r in one] == [(10, 11, None), (12, None, 12), (14, 15, None), (16, 17, None)]
    won = spark.createDataFrame([("c", 0, 10), ("c", 1, 12), ("c", 2, 15), ("c", 3, 16)], "class_id string, slot int, winner long")
    assert [(r["slot"], r["side1"], r["side2"]) for r in B.next_round(won).orderBy("slot").collect()] == [(0, 10, 12), (1, 15, 16)]


def test_bracket_checks(spark):
    sides = spark.createDataFrame([("c", 0, e) for e in (1, 2, 3, 4)] + [("c", 1, 1), ("c", 1, 4)], "class_id string, round int, entry long")
    winners = spark.createDataFrame([("c", 0, 1), ("c", 0, 3), ("c", 1, 1)], "class_id string, round int, winner long")
    assert sorted(tuple(r) for r in B.advancement_findings(sides, winners).collect()) == [("c", 1, "missing", 3), ("c", 1, "stray", 4)]
    m = spark.createDataFrame([("c", 0, 1), ("c", 0, 2), ("c", 0, 3), ("c", 1, 4)], "class_id string, round int, match_id int")
    sizes = spark.createDataFrame([("c", 8)], "class_id string, tree_size int")
    assert sorted(tuple(r) for r in B.round_size_findings(m, sizes).collect()) == [("c", 0, 3, 4), ("c", 1, 1, 2), ("c", 2, 0, 1)]
    assert [tuple(r) for r in B.repeated_appearances(sides.union(sides.filter("entry = 2"))).collect()] == [("c", 0, 2, 2)]
    res = spark.createDataFrame([("c", 1, 1, 2, 1, "9,9,9", None), ("c", 2, 1, 2, None, "9", None), ("c", 3, 1, 2, 1, None, 1), ("c", 4, 1, 2, 1, " ", None), ("c", 5, 1, 2, 9, "9", None), ("c", 6, 1, 2, 2, None, 1)], "class_id string, match_id int, side1 long, side2 long, winner long, score string, walkover_side int")
    assert sorted((r["match_id"], r["finding"]) for r in B.result_findings(res).collect()) == [(2, "no winner"), (3, "forfeiting side won"), (4, "no score"), (5, "winner is no side")]


def test_winner_labels(spark):
    labels = spark.createDataFrame([("c", 1, "12 Ek", 5.0), ("c", 2, "Alm", 9.0), ("c", 3, "Zed", 1.0), ("c", 4, "Ber", 50.0)], "class_id string, label_id int, text string, y double")
    players = spark.createDataFrame([("c", 12, "Ann Ek", 1.0), ("c", 13, "Bo Alm", 1.0), ("c", 14, "Cia Alm", 10.0), ("c", 15, "Dan Berg", 1.0)], "class_id string, player_id long, name string, y double")
    assert sorted(tuple(r) for r in B.label_winners(labels, players).collect()) == [("c", 1, 12), ("c", 2, 14), ("c", 4, 15)]
