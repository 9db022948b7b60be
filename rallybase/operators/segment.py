"""Several values packed in one field: dictionary-guided segmentation.

A multi-pattern automaton marks the known whole values in a text, dynamic programming picks the cover of the text with the
least cost (known and quoted values are cheap, unknown runs dear, delimiters free), so that a delimiter inside a known or
quoted value stays inside it.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import types as T

_KNOWN, _QUOTED, _UNKNOWN, _PER_CHAR = 1.0, 1.0, 4.0, 0.01


@dataclass(frozen=True)
class Lexicon:
    """words: known whole values, or their heads when tail is set. tail: a pattern that has to follow a head.
    delimiters: the characters that part values. attached: delimiters that belong to a value right before such a pattern."""

    words: tuple[str, ...]
    tail: str = ""
    delimiters: str = ",;|/+ \t\r\n"
    quotes: str = "\"'"


SCORES = Lexicon(words=tuple(f"{s}{n}" for s in ("", "+", "-") for n in range(100)) + ("WO", "WO:S1", "WO:S2"))
#: The kinds of licence.
LICENCES = Lexicon(
    words=("A-licens Barn", "A-licens Ungdom", "A-licens Senior", "A-licens Pensionär", "A-licens", "D-licens", "B-licens", "C-licens", "48-timmarslicens", "Paralicens"),
    tail=r"\s*\([^()]*\)",
    delimiters=",;|/+\t\r\n",
)


class Segmenter:
    def __init__(self, lexicon: Lexicon):
        import ahocorasick

        self.lex = lexicon
        self.auto = ahocorasick.Automaton()
        for w in lexicon.words:
            self.auto.add_word(w.lower(), len(w))
        self.auto.make_automaton()
        self.tail = re.compile(lexicon.tail) if lexicon.tail else None
        self.parting = frozenset(lexicon.delimiters) | frozenset("  ")

    def known(self, text: str) -> dict[int, list[int]]:
        """Ends of the known values by start; a value stands between delimiters, quotes or the text's ends."""
        out: dict[int, list[int]] = {}
        low = text.lower()
        if len(low) != len(text):  # a letter whose lower case is longer
            low = text
        n = len(text)
        edge = self.parting | frozenset(self.lex.quotes)
        for last, size in self.auto.iter(low):
            start, end = last - size + 1, last + 1
            if start and text[start - 1] not in edge:
                continue
            if self.tail is not None:
                m = self.tail.match(text, end)
                if not m:
                    continue
                end = m.end()
            if end < n and text[end] not in edge:
                continue
            out.setdefault(start, []).append(end)
        return out

    def split(self, text: str | None) -> list[str]:
        """The values in order. Null, empty and all-delimiter texts give none; text that no dictionary word covers is cut at
        the delimiters; a quote that is never closed is an ordinary character."""
        if not text:
            return []
        n, lex = len(text), self.lex
        known = self.known(text)
        cost = [float("inf")] * (n + 1)
        back: list[tuple[int, int, int]] = [(0, 0, 0)] * (n + 1)
        cost[0] = 0.0
        close: dict[int, int] = {}
        for q in lex.quotes:  # a quote opens at the start or after a delimiter and closes before a delimiter or the end
            i = 0
            while (i := text.find(q, i)) >= 0:
                if i and text[i - 1] not in self.parting:
                    i += 1
                    continue
                j = text.find(q, i + 1)
                while 0 <= j < n - 1 and text[j + 1] not in self.parting:
                    j = text.find(q, j + 2 if text[j + 1] == q else j + 1)
                if j < 0:
                    break
                close[i] = j
                i = j + 1
        run_end, ends = n, [n] * (n + 1)
        for i in range(n - 1, -1, -1):
            if text[i] in lex.delimiters:
                run_end = i
            ends[i] = run_end
        for i in range(n):
            c = cost[i]
            if c == float("inf"):
                continue
            ch = text[i]
            if ch in self.parting:
                if c < cost[i + 1]:
                    cost[i + 1], back[i + 1] = c, (i, i, i)
            if i in close:
                j = close[i]
                if c + _QUOTED < cost[j + 1]:
                    cost[j + 1], back[j + 1] = c + _QUOTED, (i, i + 1, j)
            for j in known.get(i, ()):
                if c + _KNOWN < cost[j]:
                    cost[j], back[j] = c + _KNOWN, (i, i, j)
            if ch not in self.parting:
                j = ends[i]
                v = c + _UNKNOWN + _PER_CHAR * (j - i)
                if v < cost[j]:
                    cost[j], back[j] = v, (i, i, j)
        out, i = [], n
        while i > 0:
            start, a, b = back[i]
            if b > a and (piece := text[a:b].strip()):
                out.append(piece)
            i = start
        return out[::-1]


def split_packed(df: DataFrame, id_cols: list[str], text_col: str, lexicon: Lexicon, pos: str = "pos", val: str = "val") -> DataFrame:
    """One row per value of text_col: id_cols, the position from 1, the value as written. Rows whose text holds no value
    give no row; repeated rows each give theirs. A map over the rows: no shuffle, and rows of any size stay whole."""
    schema = T.StructType([df.schema[c] for c in id_cols] + [T.StructField(pos, T.IntegerType()), T.StructField(val, T.StringType())])

    def run(batches: Iterator[pd.DataFrame]) -> Iterable[pd.DataFrame]:
        seg = Segmenter(lexicon)
        for pdf in batches:
            seen: dict[str, list[str]] = {}
            at, places, values = [], [], []
            for k, text in enumerate(pdf["_text"]):
                if text is None:
                    continue
                if (parts := seen.get(text)) is None:
                    parts = seen[text] = seg.split(text)
                at.extend([k] * len(parts))
                places.extend(range(1, len(parts) + 1))
                values.extend(parts)
            out = pdf[id_cols].iloc[at].reset_index(drop=True)
            out[pos] = pd.Series(places, dtype="int32")
            out[val] = pd.Series(values, dtype=object)
            yield out

    picked = df.filter(df[text_col].isNotNull()).select(*[df[c] for c in id_cols], df[text_col].alias("_text"))
    return picked.mapInPandas(run, schema)
