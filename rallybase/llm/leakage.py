"""Evaluation texts leaking into training text, by latent semantic retrieval.

The words of the test items are the vocabulary (other words can't match any item). Every document is encoded once as the
item words it holds with their positions. TF-IDF rows of all passages of all documents (overlapping windows) and of the items
form a matrix that is never held in one place: a randomised SVD needs only sums of small products over it. Items and
passages are compared by cosine in the space found; each candidate is then checked by the longest common subsequence of
words in one or two stretches, and by the item's own names and numbers, which tell a leak from a text made after the same pattern.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import stash

MAX_ITEM_WORDS = 2_000_000  # all items together have to fit in each worker; more are to be searched in blocks
WINDOW, STRIDE = 48, 24
LEAST_WORDS = 3  # different words a stretch has to have beside the commonest, or all of a shorter item's
_FOLD = str.maketrans("àáâãäåæçèéêëìíîïñòóôõöøùúûüýÿšž", "aaaaaaaceeeeiiiinoooooouuuuyysz", "​‌‍﻿­")
_TAG, _BREAK, _DOUBLE = re.compile(r"</?[a-z][^<>\n]{0,40}>|&[a-z]+;|&#[0-9]+;"), re.compile(r"[-‐]\s*\n[>\s]*"), re.compile(r"ae|aa")
_WORDS = re.compile(r"[a-z0-9]+")


def words(text: str | None) -> list[str]:
    """Folded words: case, accents, markup, punctuation, spacing and broken lines don't matter."""
    if not text:
        return []
    t = _BREAK.sub("", _TAG.sub(" ", text.lower())).translate(_FOLD)
    return _WORDS.findall(_DOUBLE.sub("a", t).replace("oe", "o"))


def _shorter(w: str) -> list[str]:
    return [w[:i] + w[i + 1 :] for i in range(len(w))]


class Vocabulary:
    """Words of the items; a longer word one edit away from just one of them counts as it (reading errors)."""

    def __init__(self, vocab: list[str], fuzzy_from: int = 5):
        self.ids = {w: i for i, w in enumerate(vocab)}
        self.fuzzy_from, self.near, self.cache = fuzzy_from, {}, {}
        self.longest = 1 + max(map(len, vocab), default=0)  # a longer word is no item word with one error
        for w, i in self.ids.items():
            if len(w) >= fuzzy_from and not w.isdigit():
                for s in {w, *_shorter(w)}:
                    self.near.setdefault(s, set()).add(i)

    def find(self, w: str) -> int:
        i = self.ids.get(w, -1)
        if i >= 0 or not self.fuzzy_from <= len(w) <= self.longest or w.isdigit():
            return i
        if (i := self.cache.get(w, -2)) == -2:
            hits = set(self.near.get(w, ()))
            for s in _shorter(w):
                hits |= self.near.get(s, set())
            i = hits.pop() if len(hits) == 1 else -1
            if len(self.cache) > 300_000:
                self.cache.clear()
            self.cache[w] = i
        return i


@dataclass
class Items:
    ids: list[int]
    vocab: list[str]
    seqs: list[list[int]]
    own: list[set[int]]  # names and numbers that few other items have

    @classmethod
    def read(cls, items: DataFrame, id_col: str, text_col: str) -> Items:
        """Items are a stated query set: read whole, of a checked size."""
        size = items.agg(F.sum(F.length(text_col))).first()[0] or 0
        if size > MAX_ITEM_WORDS * 6:
            raise ValueError(f"{size} characters of items: search them in blocks")
        rows = sorted((r[0], words(r[1])) for r in items.filter(F.col(id_col).isNotNull()).select(id_col, text_col).collect())
        rows = [(i, w) for i, w in rows if w]
        vocab = sorted({x for _, w in rows for x in w})
        at = {w: i for i, w in enumerate(vocab)}
        seqs = [[at[x] for x in w] for _, w in rows]
        df = Counter(x for s in seqs for x in set(s))
        rare = max(3, 0.04 * len(seqs))
        return cls([i for i, _ in rows], vocab, seqs, [{x for x in s if df[x] <= rare} for s in seqs])


def lcs(seq: list[int], masks: dict[int, int], m: int) -> tuple[int, int]:
    """Length of the longest common subsequence with the item whose positions by word are masks; the row of bits."""
    full = (1 << m) - 1
    v = full
    for x in seq:
        if mask := masks.get(x, 0):
            u = v & mask
            v = ((v + u) | (v - u)) & full
    return m - v.bit_count(), v


class Judge:
    """The check of a candidate: LCS in at most two stretches, as a part of the item's words; the part of its own words met."""

    def __init__(self, items: Items, common: set[int], gap: int = 10):
        self.items, self.gap = items, gap
        self.masks, self.common = [], []
        for s in items.seqs:
            # An item made of common words only is judged by all its words.
            self.common.append(common if len(set(s) - common) >= LEAST_WORDS else frozenset())
            m: dict[int, int] = {}
            for p, x in enumerate(s):
                m[x] = m.get(x, 0) | 1 << p
            self.masks.append(m)

    def score(self, k: int, at: np.ndarray, ids: np.ndarray) -> tuple[float, float]:
        masks, own, m, common = self.masks[k], self.items.own[k], len(self.items.seqs[k]), self.common[k]
        stretches: list[list[int]] = []
        last = -(1 << 30)
        for p, x in zip(at.tolist(), ids.tolist(), strict=True):
            if x not in masks:
                continue
            if x not in common:
                if p - last > self.gap:
                    stretches.append([])
                last = p
            elif p - last > self.gap:
                continue
            stretches[-1].append(x)
        stretches = [s for s in stretches if sum(x not in common for x in set(s)) >= min(LEAST_WORDS, len(masks))]
        scored = sorted(range(len(stretches)), key=lambda i: -lcs(stretches[i], masks, m)[0])[:2]
        seq = [x for i in sorted(scored) for x in stretches[i]]
        if not seq:
            return 0.0, 0.0
        met = own & set(seq)
        return lcs(seq, masks, m)[0] / m, len(met) / max(1, len(own))


def encode(docs: DataFrame, items: Items, id_col: str, text_col: str) -> DataFrame:
    """doc, n (words in the text), at and ids: positions and numbers of the item words. Texts without any are left out."""
    vocab = items.vocab
    key = docs.schema[id_col].dataType
    schema = T.StructType([T.StructField("doc", key), T.StructField("n", T.IntegerType()), T.StructField("at", T.ArrayType(T.IntegerType())), T.StructField("ids", T.ArrayType(T.IntegerType()))])

    def run(batches: Iterator[pd.DataFrame]) -> Iterable[pd.DataFrame]:
        find = Vocabulary(vocab).find
        for pdf in batches:
            out = []
            for doc, text in zip(pdf["_id"], pdf["_text"], strict=True):
                ws = words(text)
                hits = [(p, i) for p, i in enumerate(map(find, ws)) if i >= 0]
                if hits:
                    out.append((doc, len(ws), [p for p, _ in hits], [i for _, i in hits]))
            yield pd.DataFrame(out, columns=schema.names)

    return docs.filter(docs[id_col].isNotNull() & docs[text_col].isNotNull()).select(docs[id_col].alias("_id"), docs[text_col].alias("_text")).mapInPandas(run, schema)


def passages(at: np.ndarray, ids: np.ndarray) -> list[np.ndarray]:
    """Item words of each window that holds any: a window of WINDOW words begins at every STRIDE-th word."""
    out = []
    first, last = max(0, (int(at[0]) - WINDOW) // STRIDE + 1), int(at[-1]) // STRIDE
    lo, hi = np.searchsorted(at, np.arange(first, last + 1) * STRIDE), np.searchsorted(at, np.arange(first, last + 1) * STRIDE + WINDOW)
    for a, b in zip(lo, hi, strict=True):
        if b > a:
            out.append(ids[a:b])
    return out


def tfidf(rows: list[np.ndarray], idf: np.ndarray) -> np.ndarray:
    """Dense rows of unit length (a few hundred at a time)."""
    x = np.zeros((len(rows), len(idf)), dtype=np.float32)
    for r, ids in enumerate(rows):
        np.add.at(x[r], ids, 1.0)
    np.log1p(x, out=x)
    x *= idf
    norm = np.linalg.norm(x, axis=1, keepdims=True)
    return x / np.where(norm == 0, 1, norm)


def _blocks(batches: Iterator[pd.DataFrame], size: int = 256) -> Iterator[tuple[list, list[np.ndarray]]]:
    docs, rows = [], []
    for pdf in batches:
        for doc, at, ids in zip(pdf["doc"], pdf["at"], pdf["ids"], strict=True):
            for p in passages(np.asarray(at), np.asarray(ids)):
                docs.append((doc, at, ids))
                rows.append(p)
                if len(rows) == size:
                    yield docs, rows
                    docs, rows = [], []
    if rows:
        yield docs, rows


def gram(encoded: DataFrame, idf: np.ndarray, q: np.ndarray, item_rows: np.ndarray) -> np.ndarray:
    """A'A q over the TF-IDF rows of all passages and of the items: each task sends one row per word, summed on the way."""
    k = q.shape[1]
    schema = T.StructType([T.StructField("w", T.IntegerType())] + [T.StructField(f"y{j}", T.DoubleType()) for j in range(k)])

    def run(batches: Iterator[pd.DataFrame]) -> Iterable[pd.DataFrame]:
        y = np.zeros(q.shape)
        for _, rows in _blocks(batches):
            x = tfidf(rows, idf)
            y += x.T @ (x @ q.astype(np.float32))
        some = np.flatnonzero(np.abs(y).sum(axis=1))
        out = pd.DataFrame(y[some], columns=schema.names[1:])
        out.insert(0, "w", some.astype(np.int32))
        yield out

    parts = encoded.mapInPandas(run, schema).groupBy("w").agg(*[F.sum(f"y{j}").alias(f"y{j}") for j in range(k)])
    got = parts.toPandas()  # at most one row per word of the vocabulary
    y = item_rows.T @ (item_rows @ q)
    y[got["w"].to_numpy()] += got.drop(columns="w").to_numpy()
    return y


def latent_space(encoded: DataFrame, idf: np.ndarray, item_rows: np.ndarray, rank: int, seed: int = 11) -> np.ndarray:
    """Right singular vectors (words x rank) of the passage matrix by randomised SVD with one power step."""
    k = min(len(idf), rank + 16)
    q = np.linalg.qr(np.random.default_rng(seed).standard_normal((len(idf), k)))[0]
    q = np.linalg.qr(gram(encoded, idf, q, item_rows))[0]
    b = q.T @ gram(encoded, idf, q, item_rows)
    values, vectors = np.linalg.eigh((b + b.T) / 2)
    return q @ vectors[:, np.argsort(-values)[:rank]]


def find_leaks(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", doc_text: str = "text", item_id: str = "item_id", item_text: str = "text", rank: int = 192, min_cosine: float = 0.45, min_part: float = 0.46, min_own: float = 0.5) -> DataFrame:
    """doc_id, item_id, cosine, part (of the item's words met in order), own (part of its own words met), leaked.

    One row for each document and item whose cosine reaches min_cosine in any passage; leaked if part and own reach their
    least values. Null or empty texts and ids give no row; texts are read whole at any length; copies count each; repeated
    ids are documents of their own. Without items or without documents the result is empty. Other columns are ignored.
    """
    spark = docs.sparkSession
    out_schema = T.StructType([T.StructField(doc_id, docs.schema[doc_id].dataType), T.StructField(item_id, items.schema[item_id].dataType), *[T.StructField(c, T.DoubleType()) for c in ("cosine", "part", "own")], T.StructField("leaked", T.BooleanType())])
    tests = Items.read(items, item_id, item_text)
    if not tests.ids:
        return spark.createDataFrame([], out_schema)
    encoded = stash(encode(docs, tests, doc_id, doc_text), "encoded")
    total = docs.count()
    df = np.zeros(len(tests.vocab))
    for r in encoded.select(F.explode(F.array_distinct("ids")).alias("w")).groupBy("w").count().collect():  # one row per word
        df[r["w"]] = r["count"]
    idf = (np.log((1 + total) / (1 + df)) + 0.1).astype(np.float32)
    common = {int(i) for i in np.flatnonzero(df > 0.08 * max(total, 1))}
    item_rows = tfidf([np.asarray(s) for s in tests.seqs], idf)
    basis = latent_space(encoded, idf, item_rows.astype(np.float64), rank).astype(np.float32)
    probe = item_rows @ basis
    probe /= np.maximum(np.linalg.norm(probe, axis=1, keepdims=True), 1e-9)

    def run(batches: Iterator[pd.DataFrame]) -> Iterable[pd.DataFrame]:
        judge = Judge(tests, common)
        for pdf in batches:
            pdf = pdf.reset_index(drop=True)
            pdf["doc"], real = range(len(pdf)), pdf["doc"]
            best: dict[tuple[int, int], float] = {}
            for owners, rows in _blocks(iter([pdf])):
                z = tfidf(rows, idf) @ basis
                full = np.linalg.norm(z, axis=1, keepdims=True)
                cos = (z / np.maximum(full, 1e-9)) @ probe.T
                for r, c in zip(*np.nonzero(cos >= min_cosine), strict=True):
                    key = (owners[r][0], int(c))
                    best[key] = max(best.get(key, 0.0), float(cos[r, c]))
            found = []
            for (d, k), c in best.items():
                part, own = judge.score(k, np.asarray(pdf["at"][d]), np.asarray(pdf["ids"][d]))
                found.append((real[d], tests.ids[k], c, part, own, part >= min_part and own >= min_own))
            yield pd.DataFrame(found, columns=out_schema.names)

    return encoded.mapInPandas(run, out_schema)
