import random

import numpy as np
from hypothesis import given
from hypothesis import strategies as st

from rallybase.llm import leakage as L

SYL = [a + b + c for a in "bdfgkl" for b in "aeiou" for c in ("rn", "st", "x", "mp")]


def item(seed, n=50):
    rng = random.Random(seed)
    return " ".join(rng.choice(SYL) + rng.choice(SYL) for _ in range(n))


def noise(seed, n=80):
    rng = random.Random(1000 + seed)
    return " ".join(rng.choice(["och", "i", "matchen", "serven", "klubben", "spelade", "vann", "på", "hallen"]) for _ in range(n))


def brute(a, b):
    t = np.zeros((len(a) + 1, len(b) + 1), int)
    for i, x in enumerate(a, 1):
        for j, y in enumerate(b, 1):
            t[i, j] = t[i - 1, j - 1] + 1 if x == y else max(t[i - 1, j], t[i, j - 1])
    return t[-1, -1]


@given(st.lists(st.integers(0, 5), max_size=30), st.lists(st.integers(0, 5), min_size=1, max_size=30))
def test_lcs(a, b):
    masks = {}
    for p, x in enumerate(b):
        masks[x] = masks.get(x, 0) | 1 << p
    assert L.lcs(a, masks, len(b))[0] == brute(a, b)


def test_words():
    assert L.words("Nätställ-\n> ningen <b>Åsa</b>&nbsp;X​y, Ærlig 12!") == ["natstallningen", "asa", "xy", "arlig", "12"]
    assert L.words(None) == L.words("") == []


def test_near_words():
    v = L.Vocabulary(["handduken", "abc", "500"])
    assert (v.find("handduken"), v.find("hamdduken"), v.find("hndduken"), v.find("abd"), v.find("501")) == (0, 0, 0, -1, -1)


def test_finds_what_brute_force_finds(spark):
    items = [(k, item(k)) for k in range(12)]
    w = {k: t.split() for k, t in items}
    docs, want = [], set()
    for i in range(60):
        k = i % 12
        form = i // 12
        if form == 0:  # whole, in capitals with broken lines
            text, leak = noise(i) + " " + "\n".join(w[k]).upper() + " " + noise(i + 500), True
        elif form == 1:  # the second half
            text, leak = noise(i) + ". " + " ".join(w[k][20:]) + noise(i + 500), True
        elif form == 2:  # two stretches with changed words
            text, leak = " ".join(w[k][:17]) + " " + noise(i) + " " + " ".join(x if j % 6 else "annat" for j, x in enumerate(w[k][25:45])), True
        elif form == 3:  # a quotation
            text, leak = noise(i) + " " + " ".join(w[k][10:20]) + " " + noise(i + 500), False
        else:
            text, leak = noise(i) + " " + item(100 + i), False
        docs.append((i, text, "tag"))
        if leak:
            want.add((i, k))
    docs += [(900, None, "t"), (901, "", "t"), (902, docs[0][1], "t"), (903, noise(7) * 400 + w[3][0] + " " + " ".join(w[3]), "t")]
    want |= {(902, 0), (903, 3)}
    d = spark.createDataFrame(docs, "doc_id long, text string, cosine string")
    b = spark.createDataFrame(items + [(99, None)], "item_id long, text string")
    out = L.find_leaks(d, b)
    assert {(r["doc_id"], r["item_id"]) for r in out.filter("leaked").collect()} == want


def test_same_pattern_other_names(spark):
    made = lambda a, b, n: f"when the lamps failed that evening {a} lost three long edge balls to {b} so that the silver cup was stored away and the night series recorded {n} points because {b} asked {a} who finally received the cup"
    names = [(SYL[i] + SYL[i + 40], SYL[i + 20] + SYL[i + 60], 100 + i) for i in range(30)]
    items = spark.createDataFrame([(i, made(*n)) for i, n in enumerate(names)], "item_id long, text string")
    docs = spark.createDataFrame([(1, noise(1) + made(*names[4]), ""), (2, made("xandor qvist", "zelmo hjukl", 999), "")] + [(10 + i, noise(i), "") for i in range(40)], "doc_id long, text string, x string")
    assert [(r["doc_id"], r["item_id"]) for r in L.find_leaks(docs, items).filter("leaked").collect()] == [(1, 4)]


def test_empty(spark):
    d = spark.createDataFrame([(1, item(1))], "doc_id long, text string")
    b = spark.createDataFrame([(1, item(1))], "item_id long, text string")
    assert L.find_leaks(d.limit(0), b).count() == 0
    assert L.find_leaks(d, b.limit(0)).count() == 0


def test_items_of_common_words():
    """An item of which all words are among the commonest is judged by them all."""
    items = L.Items([1, 2], ["a", "b", "c", "d", "e"], [[0, 1, 2, 3], [4, 0]], [set(), set()])
    judge = L.Judge(items, {0, 1, 2, 3, 4})
    assert judge.score(0, np.arange(4), np.array([0, 1, 2, 3]))[0] == 1.0
    assert judge.score(1, np.arange(2), np.array([4, 0]))[0] == 1.0
    assert judge.score(0, np.arange(0), np.array([], dtype=int))[0] == 0.0
