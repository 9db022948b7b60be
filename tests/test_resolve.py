from datetime import date, datetime

from pyspark.sql import functions as F

from rallybase import lookups
from rallybase.operators import resolve as E


def by(df, key, *cols):
    return {r[key]: (r[cols[0]] if len(cols) == 1 else tuple(r[c] for c in cols)) for r in df.collect()}


def test_club_ladder(spark):
    clubs = spark.createDataFrame([(1, "Hilleröd GI", "Hilleröds Gymnastik"), (2, "Vetenkulla BTK", "Vetenkullas Bordtennisklubb"), (3, "Abcdefghij", None), (4, "Abcdefghik", None)], "club_id long, shortname string, longname string")
    alias = spark.createDataFrame([(2, "Vetenkulla-Valla Pingis")], "club_id long, alias string")
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(["hilleröd gi", "Hillerød  GI", "Vetenkulla BT", "Abcdefghi", "zz", None, "vetenkulla valla pingis"])], "i int, club string")
    got = by(E.resolve_clubs(rows, "club", E.club_keys(clubs, alias)), "i", "club_id", "club_message")
    assert got == {0: (1, "exact"), 1: (1, "relaxed"), 2: (2, "prefix"), 3: (9999, "unknown"), 4: (9999, "unknown"), 5: (9999, "unknown"), 6: (2, "exact")}
    assert by(E.resolve_clubs(rows, "club", E.club_keys(clubs), prefix=False, fallback=False), "i", "club_message")[2] == "none"


def test_player_cascade(spark):
    d = date(2024, 10, 1)
    players = spark.createDataFrame([(1, "Ann", "Ek", None, True), (2, "Ann", "Ek", None, True), (3, "Bo Karl", "Alm", None, True), (4, "Cia", "Dal", None, True), (5, None, None, "Eva Falk", False), (6, None, None, "Eva Falk", False)], "player_id long, firstname string, lastname string, fullname_raw string, is_verified boolean")
    lic = spark.createDataFrame([(1, 10, date(2024, 7, 1), date(2025, 6, 30)), (2, 10, date(2020, 7, 1), date(2021, 6, 30)), (3, 20, date(2024, 7, 1), date(2025, 6, 30)), (4, 30, date(2019, 7, 1), date(2020, 6, 30))], "player_id long, club_id long, valid_from date, valid_to date")
    tra = spark.createDataFrame([(4, 30, 40, date(2024, 8, 1))], "player_id long, from_club long, to_club long, day date")
    app = spark.createDataFrame([(6, 50)], "player_id long, club_id long")
    entries = spark.createDataFrame([(1, "Ek Ann", 10, d), (2, "Bo Alm", 20, d), (3, "Cia Dal", 30, d), (4, "Cia Dal", 40, d), (5, "Cia Dal", 99, d), (6, "Eva Falk", 50, d), (7, "Eva Falk", 51, d), (8, "Ny Person", 1, d), (9, "ny  person", 2, d), (10, None, 1, d), (11, "Ann Ek", 99, d)], "entry_id long, name string, club_id long, day date")
    got = by(E.resolve_players(entries, players, lic, tra, app), "entry_id", "player_id", "strategy")
    assert got[1] == (1, "licence")
    assert got[2] == (3, "licence, part of name")
    assert got[3] == (4, "licence, any season")
    assert got[4] == (4, "transition")
    assert got[5] == (4, "name")
    assert got[6] == (6, "unverified in club")
    assert got[7] == (5, "unverified")
    assert got[8] == got[9] and got[8][1] == "new unverified"
    assert 10 not in got and got[11][1] == "new unverified"


def test_sides(spark):
    entries = spark.createDataFrame([("c", 1, 5, "asa ek", "Alby", "P1"), ("c", 2, 6, "q w", None, None), ("p", 9, 1, "Bo Alm", None, None)], "class_id string, entry_id long, number int, name string, club string, grp string")
    sides = spark.createDataFrame([(1, "c", 6, "whoever", None, None), (2, "c", None, "ek asa", None, None), (3, "c", None, "x y", None, None), (4, "c", None, "ek asa", "alby", "P1"), (5, "k", None, "Alm Bo", None, None), (6, "c", None, None, None, None)], "side_id long, class_id string, number int, name string, club string, grp string")
    got = by(E.resolve_sides(sides, entries), "side_id", "entry_id", "score", "how")
    assert got == {1: (2, None, "number"), 2: (1, 17, "name"), 3: (None, None, "none"), 4: (1, 20, "name"), 5: (None, None, "none"), 6: (None, None, "none")}
    parent = spark.createDataFrame([("k", "p")], "class_id string, parent_class_id string")
    sib = E.sibling_sides(sides.filter("side_id = 5"), entries, parent).first()
    assert sib["parent_entry_id"] == 9 and sib["entry_id"] < 0


def test_walkovers_and_both_sides(spark):
    m = spark.createDataFrame([(1, "Vakant", "Bo", "WO"), (2, "A", "B", "WO:S2"), (3, "WO", "vakant", "WO"), (4, "A", "B", "9,9")], "id int, name1 string, name2 string, tokens string")
    assert by(E.walkover_from_placeholders(m), "id", "walkover_side", "garbage") == {1: (1, False), 2: (2, False), 3: (None, True), 4: (None, False)}
    p = spark.createDataFrame([(1, 1, 7), (1, 2, 7), (2, 1, 99999), (2, 2, 99999), (3, 1, 7)], "match_id int, side_no int, player_id long")
    assert [r[0] for r in E.same_player_on_both_sides(p).collect()] == [1]


def test_licences(spark):
    players = spark.createDataFrame([("100", 3, 1)], "player_id_ext string, data_source_id int, player_id long")
    clubs = spark.createDataFrame([("30", 10), ("31", 11)], "club_id_ext string, club_id long")
    raw = spark.createDataFrame([(1, "2024-25", "100", "30", "A-licens Senior (2024.09.01)", 3), (2, "2024-25", "100", "30", "A-licens Senior (2024.09.02)", 3), (3, "2024-25", "100", "30", "D-licens ()", 3), (4, "2024-25", "9", None, "x", 3), (5, "2024-25", "100", "31", "A-licens Senior (2024.10.01)", 3)], "row_id long, season_label string, player_id_ext string, club_id_ext string, license_info_raw string, data_source_id int")
    out = E.resolve_licences(raw, players, clubs, lookups.seasons(spark))
    assert by(out, "row_id", "status", "reason") == {1: ("success", None), 2: ("skipped", "duplicate"), 3: ("success", None), 4: ("failed", "licence;player;club;dates") if by(out, "row_id", "valid_from")[4] is None else ("failed", "licence;player;club"), 5: ("success", None)}
    assert by(out, "row_id", "valid_from")[3] == date(2024, 7, 1)
    assert [(r["a"], r["b"]) for r in E.licence_overlaps(out).collect()] == [(1, 5)]


def test_transitions_rankings_groups(spark):
    players = spark.createDataFrame([(1, "Ann", "Ek", 1990, True, "100", 3), (2, "Ann", "Ek", 1950, True, "101", 3)], "player_id long, firstname string, lastname string, year_born int, is_verified boolean, player_id_ext string, data_source_id int")
    lic = spark.createDataFrame([(1, 10, 2023), (2, 10, 2023)], "player_id long, club_id long, season int")
    raw = spark.createDataFrame([(1, "ANN", "Ek", 1950, 10, 2024), (2, "Ann", "Ek", None, 10, 2024), (3, "Ann", "Ek", 1990, 10, 2022)], "row_id long, firstname string, lastname string, year_born int, from_club long, season int")
    assert by(E.resolve_transitions(raw, players, lic), "row_id", "player_id", "status") == {1: (2, "success"), 2: (None, "failed"), 3: (None, "failed")}
    rank = spark.createDataFrame([("r1", "100", 3, None, None), ("bad", "100", 3, 5, 1), ("r1", "999", 3, 5, 1)], "run_id_ext string, player_id_ext string, data_source_id int, points int, points_change_since_last int")
    got = E.resolve_rankings(rank, players, spark.createDataFrame([("bad",)], "run_id_ext string")).collect()
    assert [(r["player_id"], r["points"]) for r in got] == [(1, 0)]
    t = lambda d: datetime(2024, 1, d)
    groups, unknown = E.ranking_groups(spark.createDataFrame([(1, "H1", t(1), 1), (1, "H3, H3, ZZ", t(2), 2), (1, " ", t(3), 3)], "player_id long, ranking_group_raw string, last_seen_at timestamp, row_id long"), lookups.ranking_groups(spark))
    assert [tuple(r) for r in groups.collect()] == [(1, 4)]
    assert [tuple(r) for r in unknown.collect()] == [("ZZ", 1)]
    cols = "player_id_ext string, data_source_id int, firstname string, lastname string, year_born int, row_id long"
    v = E.verified_players(spark.createDataFrame([("7", 3, "ann", "EK", 1990, 5)], cols), spark.createDataFrame([("7", 3, "x", "y", 1, 1), ("8", 3, "bo", "alm", 2, 2)], cols))
    assert sorted((r["player_id_ext"], r["firstname"], r["lastname"]) for r in v.collect()) == [("7", "Ann", "Ek"), ("8", "Bo", "Alm")]


def test_tournaments_and_classes(spark):
    raw = spark.createDataFrame([(1, "t", 1, "2024-01-01", "2024-01-02"), (2, "t", 1, "2024-01-01", "2024-01-02"), (3, None, 1, "2024.06.01", "2024.06.02"), (4, "u", 1, None, "x")], "row_id long, tournament_id_ext string, data_source_id int, startdate string, enddate string")
    out = E.resolve_tournaments(raw, F.lit(date(2024, 1, 2)))
    assert by(out, "row_id", "status", "status_id") == {1: ("success", 2), 2: ("skipped", 2), 3: ("success", 1), 4: ("failed", 6)}
    c = spark.createDataFrame([(1, 1, "P12", "Pojkar 12", "1,2,3,5"), (2, 1, "P12~B", "x", "5"), (3, 1, "P12 B", "x", None), (4, 2, "P12~B", "x", None)], "class_id long, tournament_id long, shortname string, longname string, raw_stages string")
    assert by(E.resolve_classes(c), "class_id", "parent_class_id", "structure_id") == {1: (None, 1), 2: (1, 3), 3: (1, 9), 4: (None, 9)}
    e = spark.createDataFrame([(1, c, p) for c in (1, 2) for p in range(5)] + [(1, 3, 0)], "tournament_id int, class_id int, player_id int")
    assert [tuple(r) for r in E.similar_entry_lists(e).collect()] == [(1, 2, 5)]
