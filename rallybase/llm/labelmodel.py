"""A generative label model: how far each of many noisy votes can be trusted, learned without labels.

Votes are -1, 0 (abstains) or 1. The data enter as counts of vote patterns, of which there are at most 3 to the number of
voters whatever the number of pairs. Expectation maximisation fits the share of matches and each voter's chances given the
truth; correlated voters are joined by a tree of the strongest conditional dependencies (each voter given the truth and one
other voter), so that two voters that see the same thing don't count twice.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_VOTERS = 10


class LabelModel:
    def __init__(self, rounds: int = 60, prior: float = 0.3, smooth: float = 1.0):
        self.rounds, self.prior, self.smooth = rounds, prior, smooth

    def fit(self, patterns: np.ndarray, counts: np.ndarray, start: np.ndarray | None = None) -> LabelModel:
        """patterns: rows of votes; counts: how often each occurs; start: first guess of each pattern's probability."""
        v = patterns.astype(int) + 1
        n = v.shape[1]
        post = start if start is not None else 1 / (1 + np.exp(-2.0 * patterns.sum(axis=1)))
        self.parent = [-1] * n
        for stage in range(2):
            for _ in range(self.rounds):
                self._maximise(v, counts, post)
                new = self.posterior(patterns)
                done = np.abs(new - post).max() < 1e-5
                post = new
                if done:
                    break
            if stage == 0:
                alone, share = post, self.pi
                self.parent = self._tree(v, counts, post)
        if self.pi < 0.1 * share or 1 - self.pi < 0.1 * (1 - share):
            # The tree explained all votes by one kind of pairs: the voters are taken as independent.
            self.parent, post = [-1] * n, alone
        self._maximise(v, counts, post)
        return self

    def _maximise(self, v: np.ndarray, counts: np.ndarray, post: np.ndarray) -> None:
        total = counts.sum()
        self.pi = float(np.clip((post * counts).sum() / max(total, 1), 1e-4, 1 - 1e-4))
        self.tables = []
        for j, p in enumerate(self.parent):
            t = np.full((2, 3, 3), self.smooth)  # truth, parent's vote, own vote
            for y, w in ((1, post * counts), (0, (1 - post) * counts)):
                np.add.at(t[y], (v[:, p] if p >= 0 else np.zeros(len(v), int), v[:, j]), w)
            self.tables.append(np.log(t / t.sum(axis=2, keepdims=True)))

    def _tree(self, v: np.ndarray, counts: np.ndarray, post: np.ndarray) -> list[int]:
        n = v.shape[1]
        weight = np.zeros((n, n))
        for a in range(n):
            for b in range(a + 1, n):
                for w in (post * counts, (1 - post) * counts):
                    t = np.full((3, 3), 0.1)
                    np.add.at(t, (v[:, a], v[:, b]), w)
                    mass, t = t.sum(), t / t.sum()
                    weight[a, b] += mass * (t * np.log(t / (t.sum(1, keepdims=True) * t.sum(0, keepdims=True)))).sum()
        weight += weight.T
        parent, inside = [-1] * n, {0}
        while len(inside) < n:
            a, b = max(((a, b) for a in inside for b in range(n) if b not in inside), key=lambda e: weight[e])
            parent[b] = a
            inside.add(b)
        return parent

    def posterior(self, patterns: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.odds(patterns), -50, 50)))

    def odds(self, patterns: np.ndarray) -> np.ndarray:
        """Logarithm of the odds of a match: tells near-certain candidates apart where the probability can't."""
        v = patterns.astype(int) + 1
        odds = np.full(len(v), np.log(self.pi / (1 - self.pi)))
        for j, p in enumerate(self.parent):
            seen = v[:, p] if p >= 0 else np.zeros(len(v), int)
            odds += self.tables[j][1][seen, v[:, j]] - self.tables[j][0][seen, v[:, j]]
        return odds


def with_confidence(pairs: DataFrame, voters: list[str], out: str = "confidence", start: dict[str, float] | None = None) -> DataFrame:
    """pairs with the posterior probability of a match and its log odds. Null votes abstain. start: weights of the voters for the first guess."""
    if len(voters) > MAX_VOTERS:
        raise ValueError(f"at most {MAX_VOTERS} voters")
    filled = pairs.withColumns({c: F.coalesce(F.col(c), F.lit(0)).cast("int") for c in voters})
    rows = filled.groupBy(*voters).agg(F.count(F.lit(1)).alias("_n")).collect()  # at most 3^voters rows
    if not rows:
        return filled.withColumn(out, F.lit(None).cast("double")).withColumn(f"{out}_odds", F.lit(None).cast("double"))
    patterns, counts = np.array([[r[c] for c in voters] for r in rows]), np.array([float(r["_n"]) for r in rows])
    first = None
    if start:
        first = 1 / (1 + np.exp(-(patterns @ np.array([start.get(c, 0.0) for c in voters]) - start.get("", 0.0))))
    model = LabelModel().fit(patterns, counts, first)
    table = pairs.sparkSession.createDataFrame([(*map(int, p), float(t), float(o)) for p, t, o in zip(patterns, model.posterior(patterns), model.odds(patterns), strict=True)], ", ".join(f"{c} int" for c in voters) + f", {out} double, {out}_odds double")
    return filled.join(F.broadcast(table), voters)  # at most 3^voters rows
