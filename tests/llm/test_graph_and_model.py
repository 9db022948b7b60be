import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from rallybase.llm.clusters import components
from rallybase.llm.labelmodel import LabelModel, with_confidence


def union_find(edges):
    up = {}

    def find(x):
        up.setdefault(x, x)
        while up[x] != x:
            x = up[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        if a != b:
            up[max(a, b)] = min(a, b)
    return {x: find(x) for x in up}


@pytest.mark.parametrize("edges", [[(1, 2), (2, 3), (5, 4), (9, 9), (1, 2)], [(i, i + 1) for i in range(60)], [(7, i) for i in range(50)], [(i, (i * 7) % 40) for i in range(40)]])
def test_components(spark, edges):
    got = components(spark.createDataFrame([*edges, (None, 3)], "a long, b long"))
    assert {r["node"]: r["root"] for r in got.collect()} == union_find(edges)


def test_no_edges(spark):
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_label_model_learns_accuracies():
    rng = np.random.default_rng(3)
    truth = rng.random(6000) < 0.3
    sure = [0.95, 0.9, 0.6, 0.75]
    votes = np.array([[(1 if t else -1) if rng.random() < a else (-1 if t else 1) for a in sure] for t in truth])
    votes = np.column_stack([votes, votes[:, 2]])  # a voter that repeats a poor one
    votes[rng.random(votes.shape) < 0.1] = 0
    pats, inv, counts = np.unique(votes, axis=0, return_inverse=True, return_counts=True)
    model = LabelModel().fit(pats, counts.astype(float))
    assert ((model.posterior(pats)[inv.ravel()] > 0.5) == truth).mean() > 0.94
    assert abs(model.pi - 0.3) < 0.05


@settings(deadline=None, max_examples=25)
@given(st.lists(st.tuples(*[st.sampled_from([-1, 0, 1])] * 3), min_size=1, max_size=27, unique=True))
def test_label_model_never_fails(rows):
    p = LabelModel().fit(np.array(rows), np.ones(len(rows))).posterior(np.array(rows))
    assert ((p >= 0) & (p <= 1)).all()


def test_with_confidence(spark):
    rows = [(i, 1, 1, 1) for i in range(30)] + [(100 + i, -1, -1, None) for i in range(60)] + [(500, 1, 0, 1)]
    df = spark.createDataFrame(rows, "i long, a int, b int, c int")
    got = {r["i"]: r["confidence"] for r in with_confidence(df, ["a", "b", "c"]).collect()}
    assert got[0] > 0.9 and got[500] > 0.8 and got[100] < 0.1
    assert with_confidence(df.limit(0), ["a", "b", "c"]).count() == 0
