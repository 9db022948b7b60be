import pathlib
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from rallybase.llm import incremental, linkage, people, survivor
from rallybase.llm import names as N
from rallybase.llm.labelmodel import with_confidence

LIC = "row_id long, season_label string, season_id_ext string, club_name string, club_id_ext string, player_id_ext string, firstname string, lastname string, year_born string, license_info_raw string, content_hash string, last_seen_at timestamp, name string"
CLUBS = [(1, "Porsbenning BTF", "Porsbennings Bordtennisförening", "tidigare Porsbenning-Tuna Pingis"), (2, "Fjärdalen GIF", "Fjärdalens Gymnastik- och Idrottsförening", None), (3, "Molsnäs BTF", "Molsnäss Bordtennisförening", None), (4, "Molsnäs BTS", "Molsnäss Bordtennissällskap", None), (9999, "Okänd klubb", "Okänd klubb", None)]


def clubs(spark):
    return spark.createDataFrame(CLUBS, "club_id long, shortname string, longname string, remarks string")


def lic(n, person, first, last, year="1990", club="Porsbenning BTF", cid="3002", season="2020-21", info="A-licens Senior (2020.08.01)", day=date(2020, 9, 1)):
    return (n, season, None, club, cid, person, first, last, year, info, f"h{n}", datetime(day.year, day.month, day.day, 5), "clash")


CASES = [("Porsbenning BTF", 1), ("BTF Porsbenning", 1), ("PORSBENNNINGBTF", 1), ("Porsbenn. BTF", 1), ("Porsbenning B.T.F. 2", 1), ("porsbenning", 1), ("Porsbenning BTF lag B", 1), ("Bordtennisföreningen Porsbenning", 1), ("Porsbennign-Tuna Pingis", 1),
     ("Fjrdalen Gymnastik- och Idrottzförening", 2), ("Fjærdalen GIF, Vet", 2), ("Molsnäs BTS", 4), ("Molsnaes BTF", 3), ("Molsnäs", None), ("Helt annan SK", None), ("", None), (None, None), ("Okänd klubb", None)]


def test_clubs(spark):
    got = {r["text"]: r["club_id"] for r in N.resolve_clubs(spark.createDataFrame([(t,) for t, _ in CASES], "text string"), clubs(spark)).collect()}
    assert got == {t: c for t, c in CASES if c}


@pytest.mark.parametrize("typed", ["Kristoffer Ektyvlund", "EKTYVLUND Kristoffer", "Kristoffer  Ektyvlund", "Kristofer Ektyvlund", "Kritsoffer Ektyvlund", "Stoffe Ektyvlund", "K. Ektyvlund", "Ektyvlund K", "Kristoffer R Ektyvlund", "Kristoffer Ektyvlund-Halm", "Kristoffer Ektyvl", "Kristoffer Ektivlund"])
def test_forms_meet(typed):
    reg = N.registered_forms("Kristoffer", "Ektyvlund")
    assert max((w for f, w in N.typed_forms(typed).items() if f in reg), default=0) >= 0.5


def test_forms_keep_apart():
    reg = N.registered_forms("Kristoffer", "Ektyvlund")
    for other in ["Anna Ektyvlund", "Kristoffer Mekubsten", "", None, "Ektyvlund", "x " * 50]:
        assert not set(N.typed_forms(other)) & reg


def test_links_names(spark):
    raw = spark.createDataFrame([lic(1, "100", "Ann", "Ektyvlund"), lic(2, "101", "Bo", "Mekubsten", club="Fjärdalen GIF", cid="3008"), lic(3, "102", "Ann", "Ektyvlund", year="1950", club="Fjärdalen GIF", cid="3008")], LIC)
    licences, persons, spellings, _ = people.registry(raw, clubs(spark))
    pc = licences.select("person", "club_id").distinct()
    rows = [(1, "Ann Ektyvlund", 1, None), (2, "Ektyvlund Ann", 2, None), (3, "A. Ektyvlund", 1, 7), (4, "Ann Ektyvlund", 1, 7), (5, "Bo Mkubsten", 2, None), (6, "Vakant", 1, None), (7, None, 1, None), (8, "Nils Okänd", 1, None), (9, "Ann Ektyvlund", None, None), (10, " ", 1, 7), (4, "Ann Ektyvlund", 1, 7)]
    df = spark.createDataFrame(rows, "row_id long, name string, club_id long, grp long")
    got = {(r["row_id"], r["person"]) for r in people.link_names(df, persons, spellings, pc).collect()}
    assert got == {(1, "100"), (2, "102"), (3, "100"), (4, "100"), (5, "101")}  # 9 could be either
    assert people.link_names(df.limit(0), persons, spellings, pc).count() == 0


def test_another_holders_name_can_be_an_error(spark):
    """A misspelling, or a name with a part more, that is another holder's own name still has its true holder as candidate."""
    raw = spark.createDataFrame([lic(1, "100", "Ann", "Ektyvlund"), lic(2, "101", "Ann", "Ektyvlud", club="Fjärdalen GIF", cid="3008"), lic(3, "102", "Bo", "Mekubsten"), lic(4, "103", "Bo Ola", "Mekubstn", club="Fjärdalen GIF", cid="3008")], LIC)
    licences, persons, spellings, _ = people.registry(raw, clubs(spark))
    pc = licences.select("person", "club_id").distinct()
    typed = spark.createDataFrame([(1, "Ann Ektyvlud", 1), (2, "Bo Ola Mekubstn", 1)], "name_id long, name string, club_id long")
    got = {(r["name_id"], r["person"]) for r in people.candidates(typed, people.registered_index(spellings), spellings).collect()}
    assert {(1, "100"), (1, "101"), (2, "102"), (2, "103")} <= got
    rows = spark.createDataFrame([(1, "Ann Ektyvlud", 1, None), (2, "Ann Ektyvlud", 2, None)], "row_id long, name string, club_id long, grp long")
    assert {(r["row_id"], r["person"]) for r in people.link_names(rows, persons, spellings, pc).collect()} == {(1, "100"), (2, "101")}


def test_links_transitions(spark):
    raw, tra = [], []
    for i in range(40):
        first, last = ["Ann", "Bo", "Cia", "Dan"][i % 4], f"{'Mekub Tomam Bokif Ektyv Sanot'.split()[i % 5]}{'lund sten vik'.split()[i % 3]}{'aeiou'[i % 5] if i > 19 else ''}"
        raw += [lic(2 * i, str(100 + i), first, last, str(1950 + i)), lic(2 * i + 1, str(100 + i), first, last, str(1950 + i), "Fjärdalen GIF", "3008", "2021-22", day=date(2021, 9, 1))]
        tra.append((i, "2021-22", [first, last][i % 2], [last, first][i % 2], None if i % 5 == 0 else date(1950 + i, 1, 2), str(1950 + i), "Porsbennnig BTF", "Fjärdalen GIF", date(2021, 8, 1)))
    tra += [(900, "2021-22", "Ingen", "Medlicens", date(1970, 1, 1), "1970", "Molsnäs BTF", "Molsnäs BTS", date(2021, 8, 1)), (901, None, None, None, None, None, None, None, None), tra[3]]
    t = spark.createDataFrame(tra, "row_id long, season_label string, firstname string, lastname string, date_born date, year_born string, club_from string, club_to string, transition_date date")
    got = {r["row_id"]: (r["person"], r["confidence"]) for r in linkage.link_transitions(t, spark.createDataFrame(raw, LIC), clubs(spark)).collect()}
    right = sum(got[i][0] == str(100 + i) for i in range(40))
    assert right >= 38
    assert got[900] == got[901] == (None, None)
    assert all(c >= 0.5 for p, c in got.values() if p)


def test_common_names(spark):
    """A name that 45 persons have gives all of them as candidates without a club; the year or the class number tells who it is."""
    raw = [lic(i, str(100 + i), "Ann", "Ektyvlund", str(1920 + 2 * i)) for i in range(45)] + [lic(50, "200", "Bo", "Mekubsten")]
    raw += [lic(60, "110", "Ann", "Ektyvlund", "1940", "Fjärdalen GIF", "3008")]
    df = spark.createDataFrame(raw, LIC)
    licences, persons, spellings, _ = people.registry(df, clubs(spark))
    typed = spark.createDataFrame([(1, "Ann Ektyvlund"), (2, "Bo Mekubsten")], "name_id long, name string")
    got = people.candidates(typed, people.registered_index(spellings), spellings).groupBy("name_id").count().collect()
    assert {r["name_id"]: r["count"] for r in got} == {1: 45, 2: 1}
    pc = licences.select("person", "club_id").distinct()
    rows = spark.createDataFrame([(1, "Ann Ektyvlund", None, 7), (2, "Ektyvlund Ann", 2, 7), (3, "Ann Ektyvlund", None, 8)], "row_id long, name string, club_id long, grp long")
    assert {(r["row_id"], r["person"]) for r in people.link_names(rows, persons, spellings, pc).collect()} == {(1, "110"), (2, "110")}


def test_common_names_move(spark):
    """Of 45 namesakes the year tells who moved, without any club."""
    raw, tra = [lic(1000 + i, str(500 + i), "Ann", "Gemensam", str(1920 + 2 * i)) for i in range(45)], []
    for i in range(40):
        first, last = ["Ann", "Bo", "Cia", "Dan"][i % 4], f"{'Mekub Tomam Bokif Ektyv Sanot'.split()[i % 5]}{'lund sten vik'.split()[i % 3]}{'aeiou'[i % 5] if i > 19 else ''}"
        raw += [lic(2 * i, str(100 + i), first, last, str(1950 + i)), lic(2 * i + 1, str(100 + i), first, last, str(1950 + i), "Fjärdalen GIF", "3008", "2021-22", day=date(2021, 9, 1))]
        tra.append((i, "2021-22", first, last, date(1950 + i, 1, 2), str(1950 + i), *([None, None] if i % 3 == 0 else ["Porsbenning BTF", "Fjärdalen GIF"]), date(2021, 8, 1)))
    tra += [(900 + i, "2021-22", "Ann", "Gemensam", None, str(1920 + 2 * i), None, None, date(2021, 8, 1)) for i in (3, 20)]
    t = spark.createDataFrame(tra, "row_id long, season_label string, firstname string, lastname string, date_born date, year_born string, club_from string, club_to string, transition_date date")
    got = {r["row_id"]: r["person"] for r in linkage.link_transitions(t, spark.createDataFrame(raw, LIC), clubs(spark)).collect()}
    assert (got[903], got[920]) == ("503", "520")


PLAYER = "player_id long, firstname string, lastname string, year_born long, date_born string, fullname_raw string, is_verified boolean, row_created timestamp, row_updated timestamp"


def player(n, first, last, year=None, born=None, raw=None, verified=True, day=1):
    return (n, first, last, year, born, raw, verified, datetime(2020, 1, day), datetime(2020, 2, day))


def test_survivors(spark):
    rows = [
        player(1, "Ann", "Ektyvlund", 1990, None, day=9), player(2, "Ann", "Ektyvlund", 1990, "1990-05-01", day=2), player(3, None, None, None, None, "EKTYVLUND Ann", False, 20),
        player(4, "Ann", "Ektyvlund", 1950, "1950-01-01"), player(5, "Bo", "Mekubsten", 1980, "1980-03-03"), player(6, None, None, 1980, None, "Bo Mekubstne", False), player(7, "Bo", "Mekubsten", 1980, "1980-01-01", day=3),
        player(8, None, None, None, None, None, False), player(9, None, None, None, None, "", False), player(10, "Cia", "Dal", 1999), player(11, None, None, 1980, None, "B Mekubsten", False),
    ]
    p = spark.createDataFrame(rows, PLAYER)
    g = survivor.group_players(p)
    groups: dict = {}
    for r in g.collect():
        groups.setdefault(r["group_id"], set()).add(r["player_id"])
    # 3 has no year and two namesakes, so it stays alone
    assert sorted(map(sorted, groups.values())) == [[1, 2], [3], [4], [5, 6, 7, 11], [8], [9], [10]]
    out = survivor.surviving_records(p.join(g, "player_id"), "player_id", ["year_born", "date_born"], "is_verified", "date_born", "row_updated")
    best = {r["player_id"]: (r["n_rows"], r["year_born"]) for r in out.collect()}
    assert best[2] == (2, 1990)  # verified and dated beats later
    assert best[7][0] == 4  # verified, dated, and later than 5
    assert survivor.group_players(p.limit(0)).count() == 0


def test_votes(spark):
    m = spark.createDataFrame([(1, 1, "Ann Ek", True, 5), (1, 2, "ann  EK", True, 6), (1, 3, "Anna Ek", True, 7), (1, 4, None, None, None), (2, 5, None, False, 1)], "group_id int, id long, name string, ok boolean, n int").selectExpr("*", "timestamp_seconds(1600000000 + 86400 * n) as upd")
    out = {r["group_id"]: (r["id"], r["n_rows"], r["name"]) for r in survivor.surviving_records(m, "id", ["name"], "ok", "name", "upd").collect()}
    assert out == {1: (3, 4, "ann  EK"), 2: (5, 1, None)}


def found(state):
    m = {r["row_id"]: (r["rec"], r["day"]) for r in state.mapping.collect()}
    return {(rec, i) for i, (rec, day) in m.items() if m[rec][1] < day}


def test_batches(spark):
    d = lambda n: date(2020, 9, n)
    rows = [
        lic(1, "100", "Ann", "Ektyvlund", day=d(1)),
        lic(2, "0100", "EKTYVLUND", "Ann", "90", "PORSBENNINGBTF", "3002", "Säsong 2020/2021", "A-licens Senior (2020-08-01) ,", d(2)),
        lic(3, "100", "Ann", "Ektyvlund", info="D-licens (2020.09.01)", day=d(2)),
        lic(4, None, "Ann", "Ektyvlund", "1990", info="A-licens Senior (20.08.01)", day=d(3)),
        lic(5, "101", "Bo", "Mekubsten", day=d(3)),
        lic(6, "100", "Ann", "Ektyvlund", club="Fjärdalen GIF", cid="3008", day=d(4)),
        lic(7, "101", "Bo", "Mekubsten", info='"A-licens Senior, förnyad (2020.08.01)"', day=d(4)),
        lic(8, "100", "Ann", "Ektyvlund", season="2021-22", day=d(5)),
        lic(9, "101", "Bo", "Mekubsten", day=d(3)),
        (10, None, None, None, None, None, None, None, None, None, None, None, "x"),
        (11, None, None, None, None, None, None, None, None, None, "h5", datetime(2020, 9, 6), "x"),
    ]
    want = {(1, 2), (1, 4), (5, 7)}
    for steps in (1, 3):  # the same however the history is cut into batches
        assert found(incremental.replay(spark, spark.createDataFrame(rows, LIC), steps)) == want
    assert incremental.replay(spark, spark.createDataFrame([], LIC)).mapping is None


def files(folder):
    return {p: p.stat().st_mtime_ns for p in pathlib.Path(folder).rglob("*") if p.is_file()}


def test_history_only_grows(spark, tmp_path):
    """A batch writes its own files and touches no other; the state is found again by its folder."""
    d = lambda n: date(2020, 9, n)
    whole = [lic(i, str(100 + i), f"Ann{'abcdefghij'[i]}", "Ektyvlund", day=d(1 + i % 2)) for i in range(10)]
    frame = lambda rows: spark.createDataFrame(rows, LIC)
    state = incremental.ingest(incremental.State(spark, str(tmp_path / "h")), frame(whole))
    before = files(tmp_path)
    # Two records without a number stand for one, the second becomes the link between them and the first rows.
    again = [lic(20, "0103", "ANND", "Ektyvlund", day=d(5)), lic(21, None, "Annd", "Ektyvlund", day=d(6)), lic(22, "900", "Ny", "Person", day=d(6))]
    state = incremental.ingest(incremental.State(spark, str(tmp_path / "h")), frame(again))
    after = files(tmp_path)
    assert {p: t for p, t in after.items() if p in before} == before
    assert all("batch000001" in str(p) for p in set(after) - set(before))
    assert state.batches == incremental.State(spark, str(tmp_path / "h")).batches == 2
    assert found(state) == {(3, 20), (3, 21)}
    state = incremental.ingest(state, frame([lic(30, "900", "Person", "Ny", "90", day=d(9)), lic(31, "103", "Annd", "Ektyvlund", "1991", day=d(9))]))
    assert found(state) == {(3, 20), (3, 21), (3, 31), (22, 30)}


def test_representatives_are_followed(spark):
    """A representative that joins an older one takes its records along, over batches."""
    state = incremental.State(spark)
    d = lambda n: date(2020, 9, n)
    frame = lambda rows: spark.createDataFrame(rows, LIC)
    # 1 and 2 state the same but nothing tells: another number each. 3 has 2's number; 4 has no number and 1's hash and name.
    incremental.ingest(state, frame([lic(1, "100", "Ann", "Ektyvlund", day=d(1))]))
    incremental.ingest(state, frame([(2, "2020-21", None, "Porsbenning BTF", "3002", None, "Ann", "Ektylund", "1990", "A-licens Senior (2020.08.01)", "hx", datetime(2020, 9, 2), "x")]))
    incremental.ingest(state, frame([(3, "2020-21", None, "Porsbenning BTF", "3002", None, "Ann", "Ektylund", "1990", "A-licens Senior, (2020-08-01)", "hx", datetime(2020, 9, 3), "x")]))
    got = found(state)
    assert {b for _, b in got} >= {3} and all(a == 1 for a, b in got if (1, 2) in got)


def test_learned_weights_decide(spark):
    """Season, club, licences and a part of the name are alike and no number is given: only the weights tell that it is another."""
    names = "Mekubsten Ektyvlund Tomamhage Bokifdal Sanotvik Relighult Glifibnas Hakonstad Pegerkvist Oddadman Laletstrom Fulalberg".split()
    rows = [lic(i, str(100 + i), "Ann", n, str(1950 + 3 * i), day=date(2020, 9, 1)) for i, n in enumerate(names)]
    rows += [lic(100 + i, None, "Ann", n[:3] + n[4:], str(1950 + 3 * i), day=date(2020, 9, 2)) for i, n in enumerate(names)]
    df = spark.createDataFrame(rows, LIC)
    assert found(incremental.replay(spark, df, 1)) == {(i, 100 + i) for i in range(len(names))}
    assert found(incremental.replay(spark, df, 1, least=0.0)) == {(0, 100 + i) for i in range(len(names))}


def weight(typed, first, last):
    reg = N.registered_forms(first, last)
    return max((w for f, w in N.typed_forms(typed).items() if f in reg), default=0)


def test_names_of_any_number_of_parts():
    assert weight("Madonna", None, "Madonna") == weight("MADONNA", "Madonna", None) == 1.0
    seven = "Ann Bea Cia Dan Eva Fia Gunnarsson"
    assert weight(seven, "Ann Bea Cia Dan Eva Fia", "Gunnarsson") == 1.0
    assert weight("Gunnarsson Ann Bea Cia Dan Eva Fia", "Ann Bea Cia Dan Eva Fia", "Gunnarsson") == 1.0
    assert weight("Ann Bea Cia Dan Eva Fia Gunnarson", "Ann Bea Cia Dan Eva Fia", "Gunarsson") == 1.0  # doubled letters are one
    assert weight("Ann Bea Cia Dan Eva Fia Gunnrsson", "Ann Bea Cia Dan Eva Fia", "Gunnarsson") == pytest.approx(0.8)
    parts = seven.split()
    for i in range(7):  # any one left out of the registered name
        left = parts[:i] + parts[i + 1 :]
        assert weight(seven, " ".join(left[:-1]), left[-1]) == pytest.approx(0.92)


def test_very_long_texts():
    long = "xyz" * 60_000
    assert weight(f"Ann {long}", "Ann", long) == 1.0
    assert weight(f"Ann {long[:500]}{long[501:]}", "Ann", long) == pytest.approx(0.8)  # an error in a long word
    assert len(N.typed_forms(f"Ann {long}")) < 4 * len(long)
    assert N.club_typed_forms(*N.club_name(long)) and N.club_registered_forms(*N.club_name("ab " * 100_000))
    assert 0 < len(N.typed_forms("a b " * 50_000)) < 1_000_000
    from rallybase.llm.leakage import Vocabulary

    assert Vocabulary(["handduken"]).find("h" * 300_000) == -1


def test_clubs_two_errors_apart(spark):
    """Two swaps anywhere in the name, as nothing else explains the text."""
    word = "tirnadhenbtf"
    for i in range(len(word) - 3):
        for j in range(i + 2, len(word) - 1):
            t = list(word)
            t[i], t[i + 1], t[j], t[j + 1] = t[i + 1], t[i], t[j + 1], t[j]
            assert set(N.moved_pieces("".join(t))) & set(N.whole_pieces(word)), (i, j)


def test_many_clubs(spark):
    """Clubs are joined, however many there are; of forms that many share, the rarer one tells more."""
    reg = [(i, f"Ort{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{chr(97 + i // 676)}by BTK", None, None) for i in range(6_000)]
    reg += [(9001, "Porsbenning BTK", None, None), (9002, "Porsbenning IF", None, None)]
    df = spark.createDataFrame(reg, "club_id long, shortname string, longname string, remarks string")
    texts = spark.createDataFrame([("Porsbening BTK",), ("BTK Porsbenning",), ("Porsbenning",), ("Prosbenningg IF",)], "text string")
    assert {r["text"]: r["club_id"] for r in N.resolve_clubs(texts, df).collect()} == {"Porsbening BTK": 9001, "BTK Porsbenning": 9001, "Prosbenningg IF": 9002}


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_forms_of_few_names_are_not_broadcast(spark):
    """Forms are some fifty times as large as their names, which the estimate of a broadcast doesn't know."""
    raw = spark.createDataFrame([lic(1, "100", "Ann", "Ektyvlund"), lic(2, "101", "Bo", "Mekubsten")], LIC)
    _, _, spellings, _ = people.registry(raw, clubs(spark))
    typed = spark.createDataFrame([(1, "Ann Ektyvlud")], "name_id long, name string")
    assert "SortMergeJoin [form#" in _plan(people.candidates(typed, people.registered_index(spellings), spellings))
    assert "SortMergeJoin [form#" in _plan(survivor._pair_names(spark.createDataFrame([(1, "ann ektyvlund"), (2, "ann ektyvlud")], "name_id long, name string")))


def test_votes_are_made_once(spark, monkeypatch):
    """What the label model counts and judges is a stored table, in which no pair is voted on again."""
    seen = []
    monkeypatch.setattr(linkage, "with_confidence", lambda pairs, *a, **k: (seen.append(pairs), with_confidence(pairs, *a, **k))[1])
    raw = spark.createDataFrame([lic(1, "100", "Ann", "Ektyvlund"), lic(2, "101", "Bo", "Mekubsten")], LIC)
    moves = spark.createDataFrame([(1, "2020-21", "Ann", "Ektyvlund", None, "1990", "Porsbenning BTF", "Fjärdalen GIF", date(2020, 8, 1))], "row_id long, season_label string, firstname string, lastname string, date_born date, year_born string, club_from string, club_to string, transition_date date")
    linkage.link_transitions(moves, raw, clubs(spark))
    assert "Join" not in _plan(seen[0]) and "levenshtein" not in _plan(seen[0])


def test_groups_are_told_by_a_short_plan(spark):
    """The last plan of grouping reads what was told before, and looks for no near name itself."""
    df = spark.createDataFrame([(1, "Ann", "Ektyvlund", "1990", None), (2, "Ann", "Ektyvlund", None, None), (3, "Bo", "Mekubsten", "1980", None)], "player_id long, firstname string, lastname string, year_born string, date_born string").withColumn("fullname_raw", F.lit(None).cast("string"))
    groups = survivor.group_players(df)
    assert "levenshtein" not in _plan(groups) and "Window" not in _plan(groups)
    assert {r["player_id"]: r["group_id"] for r in groups.collect()} == {1: 1, 2: 1, 3: 3}
