import os

import pytest
from hypothesis import given
from hypothesis import strategies as st

from rallybase.llm import mixing

needs = pytest.mark.skipif(not os.path.exists(mixing.TOKENIZER), reason="no tokenizer")


@given(st.floats(0, 1e6), st.lists(st.tuples(st.floats(0.01, 10), st.floats(0, 1e5)), min_size=1, max_size=8))
def test_water_fill(budget, leaves):
    w, c = [x for x, _ in leaves], [y for _, y in leaves]
    got = mixing.water_fill(budget, w, c)
    assert all(-1e-6 <= g <= k + 1e-6 for g, k in zip(got, c, strict=True))
    assert sum(got) == pytest.approx(min(budget, sum(c)), rel=1e-6, abs=1e-3)


def test_shortage_goes_to_siblings_first():
    leaf = lambda d, s, w, cap: {"key": (s, "sv"), "domain": d, "language": "sv", "source": s, "weight": w, "cap": cap}
    got = mixing.allocate([leaf("a", "a1", 0.25, 10), leaf("a", "a2", 0.25, 1000), leaf("b", "b1", 0.5, 1000)], 100)
    assert got == {("a1", "sv"): 10, ("a2", "sv"): 40, ("b1", "sv"): 50}
    got = mixing.allocate([leaf("a", "a1", 0.25, 10), leaf("a", "a2", 0.25, 20), leaf("b", "b1", 0.5, 1000)], 100)
    assert got == {("a1", "sv"): 10, ("a2", "sv"): 20, ("b1", "sv"): 70}


def frames(spark, docs, targets):
    return spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_tokens string"), spark.createDataFrame(targets, "source string, target_share double, max_repeats int")


@needs
def test_mix(spark):
    docs = [(i, "ett två tre fyra fem " * 4, ["sv", "SWE", "en", None][i % 4], ["big", "BIG ", "small"][i % 3] if i < 290 else None, "x") for i in range(300)]
    docs += [(1000, None, "sv", "big", "x"), (1001, "", "sv", "small", "x"), (7, "samma nummer igen", "sv", "big", "x")]
    d, t = frames(spark, docs, [("big", 0.5, 1), ("small", 0.5, 3), ("none", 0.0, 1)])
    chosen, shares = mixing.mix(d, t)
    rows = chosen.collect()
    assert all(1 <= r["repeats"] <= {"big": 1, "small": 3}[r["source"]] for r in rows)
    got = {r["source"]: r for r in shares.collect()}
    assert got["big"]["actual_share"] == pytest.approx(0.5, abs=0.02)
    assert got["small"]["most_repeats"] >= 2
    assert sum(r["n_tokens"] * r["repeats"] for r in rows) == got["big"]["tokens_chosen"] + got["small"]["tokens_chosen"]
    again = mixing.mix(d, t)[0].collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))


@needs
def test_more_than_there_is(spark):
    d, t = frames(spark, [(1, "a b c", "sv", "x", ""), (2, "a b c", "sv", "y", "")], [("x", 0.9, 2), ("y", 0.1, 1), ("z", 0.0, 5)])
    chosen, _ = mixing.mix(d, t, total=1e9)
    assert sorted((r["doc_id"], r["repeats"]) for r in chosen.collect()) == [(1, 2), (2, 1)]


@needs
def test_short_source_is_made_up_by_its_siblings(spark):
    docs = [(i, "ett två tre fyra", "sv", "a1" if i < 10 else "a2" if i < 60 else "b1", "x") for i in range(160)]
    d, t = frames(spark, docs, [("a1", 0.25, 1), ("a2", 0.25, 2), ("b1", 0.5, 1)])
    one = mixing.count_tokens(d.limit(1), "text").first()["n_tokens"]
    _, shares = mixing.mix(d, t, total=100.0 * one, domains={"a1": "a", "a2": "a"}, languages={"sv": "sv"})
    assert {r["source"]: r["tokens_chosen"] // one for r in shares.collect()} == {"a1": 10, "a2": 40, "b1": 50}
    _, shares = mixing.mix(d, t, total=100.0 * one)  # without a tree the shortage goes to all the others
    assert {r["source"]: r["tokens_chosen"] // one for r in shares.collect()} == {"a1": 10, "a2": 30, "b1": 60}


@needs
def test_every_epoch_has_its_order(spark):
    docs = [(i, "ett två tre fyra", "sv", "a", "x") for i in range(40)]
    d, t = frames(spark, docs, [("a", 1.0, 9)])
    one = mixing.count_tokens(d.limit(1), "text").first()["n_tokens"]
    more = [{r["doc_id"] for r in mixing.mix(d, t, total=(40.0 * e + 20) * one)[0].filter(f"repeats = {e + 1}").collect()} for e in (0, 1, 2)]
    assert all(len(m) == 20 for m in more)
    assert more[0] != more[1] != more[2] != more[0]


@needs
def test_many_targets(spark):
    d, t = frames(spark, [(1, "ett", "sv", "s7", ""), (2, "ett", "sv", "s12345", "")], [(f"s{i}", 1 / 12_500, 2) for i in range(12_500)])
    chosen, shares = mixing.mix(d, t, total=1e6)
    assert sorted((r["doc_id"], r["repeats"]) for r in chosen.collect()) == [(1, 2), (2, 2)]
    assert shares.count() == 12_500


@needs
def test_empty(spark):
    d, t = frames(spark, [(1, "a", "sv", "x", "")], [("x", 1.0, 1)])
    assert mixing.mix(d.limit(0), t)[0].count() == 0
    assert mixing.mix(d, t.limit(0))[0].count() == 0
    assert mixing.mix(d, spark.createDataFrame([("x", 1.0, None), ("y", None, 2)], t.schema))[0].count() == 0
