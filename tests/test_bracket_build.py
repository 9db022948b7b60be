import random
from datetime import date

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rallybase.operators import bracket as B
from rallybase.operators import bracket_build as K
from rallybase.operators import documents as D


def drawing(n, seed, walkover=False):
    """players, labels, scores of a played draw with n players, and the matches it shows."""
    rng = random.Random(seed)
    players = [(i + 1, f"Ann{i} Ek{chr(97 + i % 26)}{i}", 20.0 * i) for i in range(n)]
    size = K.tree_size(n)
    side = [(p[0], p[2]) for p in players] + [(None, 20.0 * i) for i in range(n, size)]
    labels, scores, want, r = [], [], [], 0
    while len(side) > 1:
        nxt = []
        for k in range(0, len(side), 2):
            (a, ya), (b, yb) = side[k], side[k + 1]
            mid = (ya + yb) / 2
            w = rng.choice([a, b]) if a and b else a or b
            if a and b:
                labels.append((f"{w} {players[w - 1][1].split()[1]}" if rng.random() < 0.5 else players[w - 1][1], 100.0 + 80 * r, mid))
                wo = walkover and rng.random() < 0.2
                scores.append(("WO" if wo else f"{rng.randint(1, 9)}, {rng.randint(1, 9)}", 110.0 + 80 * r, mid + 3))
                want.append((r, k // 2, a, b, w, None if wo else scores[-1][0], (2 if w == a else 1) if wo else None))
            nxt.append((w, mid))
        side, r = nxt, r + 1
    rng.shuffle(labels)
    rng.shuffle(scores)
    return players, labels, scores, want


@settings(max_examples=40, deadline=None)
@given(st.integers(2, 40), st.integers(0, 10_000), st.booleans())
def test_reads_what_was_drawn(n, seed, walkover):
    players, labels, scores, want = drawing(n, seed, walkover)
    got = K.read_bracket(players, labels, scores)
    assert [(r, s, a, b, w, sc, wo) for r, _, s, a, b, w, sc, wo in got if a and b] == want


def test_frame(spark):
    rows = []
    for c in ("x", "y"):
        players, labels, scores, _ = drawing(6, ord(c))
        rows += [(c, "player", 1, n, t, 1.0, y) for n, t, y in players] + [(c, "label", 1, None, t, x, y) for t, x, y in labels] * 2 + [(c, "score", 1, None, t, x, y) for t, x, y in scores]
    rows += [("x", "label", 1, None, None, 1.0, 1.0), (None, "label", 1, None, "a", 1.0, 1.0), ("z", "label", 1, None, "a", 1.0, 1.0)]
    marks = spark.createDataFrame(rows, "class_id string, kind string, page int, number long, text string, x double, y double")
    out = K.with_stage(K.build_brackets(marks))
    assert sorted(r["class_id"] for r in out.filter("side1 is not null and side2 is not null").collect()) == ["x"] * 5 + ["y"] * 5
    assert sorted({(r["round"], r["stage_id"]) for r in out.collect()}) == [(0, 6), (1, 7), (2, 8)]
    sides = out.select("class_id", "round", F.explode(F.array("side1", "side2")).alias("entry"))
    assert B.advancement_findings(sides, out.select("class_id", "round", "winner")).count() == 0
    assert K.build_brackets(marks.limit(0)).count() == 0


def test_bands():
    assert K.bands([1, 10, 50, 60]) == [0, 0, 1, 1]


def test_small_readers(spark, tmp_path):
    mk = spark.createDataFrame
    d = lambda n: date(2024, 1, n)
    c = mk([("a", 1, None), ("a", 2, d(2)), ("a", 3, d(3)), ("a", 4, None), ("b", 1, None)], "k string, i int, day date")
    assert sorted(map(tuple, D.date_with_fallback(c, ["k"], "i", "day").collect())) == [("a", d(2), d(3)), ("b", None, None)]
    assert [r[0] for r in mk([("Schema-16",), ("x",)], "t string").select(D.knockout_size(F.col("t"))).collect()] == [16, None]
    boxes = mk([(1, "Ann", 10.0, 30.0), (1, "Ek", 35.0, 50.0), (1, "Alby", 120.0, 150.0), (1, "BTK", 155.0, 170.0)], "line int, text string, x0 double, x1 double")
    assert [(r["text"], r["part"]) for r in D.split_at_widest_gap(boxes, ["line"]).orderBy("x0").collect()] == [("Ann", 1), ("Ek", 1), ("Alby", 2), ("BTK", 2)]
    y = mk([(5, 9), (5, 3), (31, 2)], "d int, m int").select(D.missing_year(F.col("d"), F.col("m"), F.lit(2023)).alias("x")).collect()
    assert [r["x"] for r in y] == [date(2023, 9, 5), date(2024, 3, 5), None]
    p = D.placeholder_entries(mk([("c", "Vakant"), ("c", "WO"), ("d", "Ann Wolf")], "class_id string, name string")).collect()
    assert [(r["class_id"], r["player_id"]) for r in p] == [("c", 99999)]
    f = mk([(1, d(1)), (2, d(1)), (3, d(9)), (4, None)], "k int, day date")
    assert sorted(r["k"] for r in D.unseen(f, f.filter("k = 1"), "k", "day", F.lit(d(5))).collect()) == [2, 3, 4]
    assert D.copy_checked(f, str(tmp_path / "t")) == 4
