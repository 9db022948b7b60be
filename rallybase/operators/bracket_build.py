"""Knockout matches out of a drawn bracket: players, winner labels and scores with their places on the page.

Reading a drawing consumes labels and scores one after the other, so each class is one group; a class has a few hundred
marks at most. Everything before and after (reading boxes, stages, checks) is relational.
"""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BAND_GAP = 25.0
SCHEMA = "round int, n_rounds int, slot int, side1 long, side2 long, winner long, score string, walkover_side int"
_WALKOVER = re.compile(r"\b(wo|w\.o\.?|walkover)\b", re.I)


def tree_size(n: int) -> int:
    size = 2
    while size < n:
        size *= 2
    return size


def bands(xs: list[float], gap: float = BAND_GAP) -> list[int]:
    """Number of the column of each x, from the left."""
    out = {}
    last, band = None, -1
    for x in sorted(set(xs)):
        if last is None or x - last > gap:
            band += 1
        out[x] = band
        last = x
    return [out[x] for x in xs]


def means(text: str, number: int, name: str) -> int:
    """How well a label means a player: 3 by number, 2 by the whole name, 1 by the last name or a beginning, 0 not."""
    m = re.match(r"\s*(\d+)\b\s*(.*)", text or "")
    said = (m.group(2) if m else text or "").strip().lower()
    full = (name or "").strip().lower()
    if m and int(m.group(1)) == number:
        return 3
    if said and said == full:
        return 2
    last = full.split()[-1] if full else ""
    return int(bool(said) and len(said) >= 3 and (said == last or full.startswith(said) or last.startswith(said)))


def read_bracket(players: list[tuple], labels: list[tuple], scores: list[tuple], size: int | None = None) -> list[tuple]:
    """Rows of SCHEMA. players: number, name, y in the order of the draw (y None: by order); labels: text, x, y; scores: text, x, y.

    Free places of the tree are byes at the end. Each round's slots take the label of the round's column that means one of
    the two sides, nearest to the middle between them; a label that means neither isn't taken. A score is the nearest free
    one in the label's column below or beside it. A side whose opponent is missing advances without a game; a score that
    says walkover names the loser as the side that forfeits."""
    size = size or tree_size(len(players))
    named = {p[0]: p[1] for p in players}
    row = [(p[0], p[2] if p[2] is not None else i * 10.0) for i, p in enumerate(players)]
    step = (row[-1][1] - row[0][1]) / max(1, len(row) - 1) if row else 10.0
    side = [(n, y) for n, y in row] + [(None, (row[-1][1] if row else 0.0) + step * (i + 1)) for i in range(size - len(row))]
    rounds = size.bit_length() - 1
    columns = bands([x for _, x, _ in labels])
    free = {i: columns[i] for i in range(len(labels))}
    loose = set(range(len(scores)))
    out = []
    for r in range(rounds):
        nxt = []
        wanted = []
        for k in range(0, len(side), 2):
            (a, ya), (b, yb) = side[k], side[k + 1]
            mid = (ya + yb) / 2
            for i, c in free.items():
                if c == r:
                    text, _, y = labels[i]
                    fit = max((means(text, n, named.get(n, "")), j) for j, n in ((1, a), (2, b)) if n is not None) if a is not None or b is not None else (0, 0)
                    if fit[0]:
                        wanted.append((-fit[0], abs(y - mid), k, i, fit[1]))
        won: dict[int, tuple[int, int]] = {}
        for _, _, k, i, j in sorted(wanted):
            if k not in won and i in free:
                won[k] = (i, j)
                free.pop(i)
        for k in range(0, len(side), 2):
            (a, ya), (b, yb) = side[k], side[k + 1]
            winner, score, forfeits = None, None, None
            if k in won:
                i, j = won[k]
                winner = (a, b)[j - 1]
                _, x, y = labels[i]
                near = [(abs(scores[s][2] - y) + max(0.0, y - scores[s][2]), s) for s in loose if abs(scores[s][1] - x) <= 2 * BAND_GAP and abs(scores[s][2] - y) <= max(step, 8.0)]
                if near:
                    s = min(near)[1]
                    loose.discard(s)
                    score = scores[s][0]
                if score and _WALKOVER.search(score):
                    forfeits, score = 3 - j, None
            elif (a is None) != (b is None):
                winner = a if a is not None else b
            if a is not None or b is not None:
                out.append((r, rounds, k // 2, a, b, winner, score, forfeits))
            nxt.append((winner, (ya + yb) / 2))
        side = nxt
    return out


def build_brackets(marks: DataFrame, key: str = "class_id") -> DataFrame:
    """key and SCHEMA for every class.

    marks: key, kind (player, label, score), page, number, text, x, y. Pages follow each other from top to bottom, so a draw
    over two pages is one list; marks without a text or place are left out; a label or score that stands twice in one place
    counts once."""
    kind = dict(marks.dtypes)[key]

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.drop_duplicates(["kind", "page", "text", "x", "y"]).sort_values(["page", "y", "x"], kind="stable")
        tall = float(pdf["y"].max()) + 50.0
        pdf["y"] = pdf["y"] + (pdf["page"].fillna(1) - 1) * tall
        part = {k: g for k, g in pdf.groupby("kind")}
        empty = pdf.iloc[:0]
        players = [(int(p.number), p.text, float(p.y)) for p in part.get("player", empty).itertuples() if p.number == p.number and p.number is not None]
        labels = [(p.text, float(p.x), float(p.y)) for p in part.get("label", empty).itertuples()]
        scores = [(p.text, float(p.x), float(p.y)) for p in part.get("score", empty).itertuples()]
        rows = read_bracket(players, labels, scores) if players else []
        out = pd.DataFrame(rows, columns=["round", "n_rounds", "slot", "side1", "side2", "winner", "score", "walkover_side"])
        out.insert(0, key, pdf[key].iloc[0])
        return out.astype({c: "Int64" for c in ("side1", "side2", "winner")} | {"walkover_side": "Int32", "round": "int32", "n_rounds": "int32", "slot": "int32"})

    given = marks.filter(F.col(key).isNotNull() & F.col("text").isNotNull() & F.col("x").isNotNull() & F.col("y").isNotNull())
    return given.select(key, "kind", "page", "number", "text", F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y")).groupBy(key).applyInPandas(run, f"{key} {kind}, {SCHEMA}")


def with_stage(rounds: DataFrame) -> DataFrame:
    """rounds with stage_id: the final is 8, semifinals 7, and so on down to 2."""
    return rounds.withColumn("stage_id", F.greatest(F.lit(9) - (F.col("n_rounds") - F.col("round")), F.lit(2)))
