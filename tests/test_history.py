from datetime import date, datetime

from rallybase.operators import history

LIC = "row_id long, season_label string, season_id_ext string, club_name string, club_id_ext string, player_id_ext string, firstname string, lastname string, year_born string, license_info_raw string, content_hash string, last_seen_at timestamp"
TRA = "row_id long, season_label string, firstname string, lastname string, date_born date, year_born string, club_from string, club_to string, transition_date date"


def lic(n, season, club, person="1", first="Ann", last="Ek", year="1990", day="2015.08.01"):
    names = {"10": "Alby BTK", "20": "Berga IF", "30": "Cedra PK"}
    return (n, season, None, names.get(club, "?"), club, person, first, last, year, f"A-licens Senior ({day})", None, datetime(2015, 9, 1))


def versions(spark, licences, transitions=()):
    out = history.club_history(spark.createDataFrame(licences, LIC), spark.createDataFrame(list(transitions), TRA))
    return sorted((r["person"], r["club"], str(r["valid_from"]), r["version"]) for r in out.collect())


def test_versions(spark):
    rows = [lic(1, "2015-16", "10"), lic(2, "Säsong 2016/2017", "10"), lic(3, "18/19", "10"), lic(4, "2019-20", "20"), lic(5, "2020-21", "010"), lic(6, "2020-21", "010")]
    assert versions(spark, rows) == [("1", "10", "2015-07-01", 1), ("1", "10", "2020-07-01", 3), ("1", "20", "2019-07-01", 2)]


def test_two_clubs_in_a_season(spark):
    rows = [lic(1, "2015-16", "10"), lic(2, "2016-17", "20"), lic(3, "2016-17", "10"), lic(4, "2017-18", "20")]
    move = [(1, "2016-17", "Ann", "Ek", date(1990, 1, 2), "1990", "Alby BTK", "Berga IF", date(2016, 11, 3)), (2, "2016-17", "ANN", "EK", None, None, "Alby BTK", "Berga IF", date(2016, 12, 1))]
    assert versions(spark, rows, move) == [("1", "10", "2015-07-01", 1), ("1", "20", "2016-11-03", 2)]


def test_there_and_back_in_a_season(spark):
    rows = [lic(1, "2015-16", "10"), lic(2, "2016-17", "20"), lic(3, "2017-18", "10"), lic(4, "2017-18", "20")]
    assert [v[1] for v in sorted(versions(spark, rows), key=lambda v: v[3])] == ["10", "20", "10"]


def test_missing_values_and_empty(spark):
    rows = [lic(1, "2015-16", "10"), lic(2, "2016-17", None), (3, None, None, "x", "10", "1", None, None, None, None, None, None), lic(4, "2017-18", "20", person=None)]
    got = versions(spark, rows)
    assert ("1", "10", "2015-07-01", 1) in got
    assert ("1", "20", "2017-07-01", 2) in got  # the person was told by name and year
    assert versions(spark, []) == []


def test_namesakes_keep_their_own_transitions(spark):
    rows = [lic(1, "2015-16", "10"), lic(2, "2016-17", "20"), lic(3, "2015-16", "10", person="2", year="1950"), lic(4, "2016-17", "30", person="2", year="1950")]
    move = [(1, "2016-17", "Ann", "Ek", None, "1950", "Alby BTK", "Cedra PK", date(2016, 10, 1))]
    assert ("2", "30", "2016-10-01", 2) in versions(spark, rows, move)
    assert ("1", "20", "2016-07-01", 2) in versions(spark, rows, move)


def test_merkle_finds_exactly_the_changes(spark):
    rows = [(s, str(k), "b" if (k == 17 and s >= 2) or (k == 500 and s == 3) else "a") for s in (1, 2, 3) for k in range(1000)]
    snaps = spark.createDataFrame(rows, "snap int, key string, state string")
    nodes = history.merkle_nodes(snaps)
    assert nodes[0].count() == 3
    leaves = history.compare_down(nodes, history.FANOUT).filter("snap > 1").count()
    assert 1 <= leaves <= 3
    got = sorted((r["snap"], r["key"], r["state"], r["state_before"]) for r in history.diff_snapshots(snaps).filter("snap > 1").collect())
    assert got == [(2, "17", "b", "a"), (3, "500", "b", "a")]
    assert history.diff_snapshots(snaps.limit(0)).count() == 0


def test_random_histories_against_brute_force(spark):
    import random

    rng = random.Random(5)
    rows, want, n = [], set(), 0
    for p in range(150):
        held, seasons = None, sorted(rng.sample(range(2014, 2024), rng.randint(1, 7)))
        for s in seasons:
            clubs = rng.sample(["10", "20", "30"], 1 if rng.random() < 0.7 else 2)
            days = {c: f"{s}.0{rng.randint(7, 9)}.1{i}" for i, c in enumerate(clubs)}
            for c in clubs:
                for _ in range(rng.randint(1, 2)):
                    n += 1
                    rows.append(lic(n, f"{s}-{(s + 1) % 100:02d}", c, person=str(1000 + p), first=f"F{p}", last=f"L{p}", day=days[c]))
            order = sorted(clubs, key=lambda c: (c != held, days[c]))
            for c in order:
                if c != held:
                    want.add((str(1000 + p), c, f"{s}-07-01"))
                held = c
    rng.shuffle(rows)
    assert {v[:3] for v in versions(spark, rows)} == want


def test_depth_follows_the_keys():
    assert [history.tree_depth(n) for n in (0, 1_000, 1_025, 20_000, 10**6, 10**9, 10**15)] == [1, 1, 2, 3, 4, 6, 7]


def test_snapshots_are_appended(spark, tmp_path):
    """A new snapshot is compared with the digests kept of the one before; the result is that of the whole comparison."""
    snaps = [{f"k{i}": "a" for i in range(300)}]
    snaps.append({**snaps[0], "k7": "b", "k8": None, "new": "c"})
    snaps.append({k: v for k, v in snaps[1].items() if k != "k9"})
    frame = lambda s: spark.createDataFrame(list(s.items()), "key string, state string")
    got = [sorted(tuple(r) for r in history.append_snapshot(str(tmp_path), frame(s), n, depth=2).collect()) for n, s in enumerate(snaps)]
    assert len(got[0]) == 300
    assert got[1] == [("k7", "b", "a", False), ("k8", None, "a", False), ("new", "c", None, False)]
    assert got[2] == [("k9", None, "a", True)]
    whole = spark.createDataFrame([(n, k, v) for n, s in enumerate(snaps) for k, v in s.items()], "snap int, key string, state string")
    changed = {(r["snap"], r["key"], r["state"], r["state_before"]) for r in history.diff_snapshots(whole).filter("snap > 0").collect()}
    assert changed == {(1, k, s, b) for k, s, b, gone in got[1] if not gone}


def test_levels_are_tables(spark):
    """No plan spans two levels of the tree, so the driver's plans don't grow with its depth."""
    rows = spark.createDataFrame([(s, f"k{i}", f"{i}{s if i == 7 else ''}") for s in range(3) for i in range(40)], "snap int, key string, state string")
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    nodes = history.merkle_nodes(rows, fanout=2, depth=4)
    assert all("Aggregate" not in plan(level) for level in nodes)
    leaves = history.compare_down(nodes, 2)
    assert "Join" not in plan(leaves)
    assert {(r["snap"]) for r in leaves.collect()} == {0, 1, 2}
    changed = history.diff_snapshots(rows, fanout=2, depth=4).filter("snap > 0").collect()
    assert sorted((r["snap"], r["key"], r["state"], r["state_before"]) for r in changed) == [(1, "k7", "71", "70"), (2, "k7", "72", "71")]


def test_keys_of_few_changes_are_not_broadcast(spark):
    """A row has a dozen keys, which the estimate of a broadcast doesn't know."""
    changes = spark.createDataFrame([("1", 2016, "10", "20", "berga", "alby")], "person string, season int, club_before string, club string, place string, place_before string")
    persons = spark.createDataFrame([("1", "ann ek", 1990)], "person string, name_key string, year int")
    moves = spark.createDataFrame([(1, "2016-17", "Ann", "Ek", date(1990, 1, 2), "1990", "Alby BTK", "Berga IF", date(2016, 11, 3))], TRA)
    days = history.link_transitions(changes, persons, moves, spark.createDataFrame([("albybtk", "10"), ("bergaif", "20")], "club_key string, club string"))
    assert "SortMergeJoin [k#" in days._jdf.queryExecution().executedPlan().toString()
    assert [(r["person"], r["club"], str(r["day"])) for r in days.collect()] == [("1", "20", "2016-11-03")]
