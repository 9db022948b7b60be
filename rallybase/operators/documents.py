"""Rows out of landed documents: word boxes to lines and columns, lines to entries and matches, HTML to cells."""

from __future__ import annotations

from collections.abc import Iterable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as S
from . import relational as R


def lines_of_boxes(boxes: DataFrame, tolerance: float = 3.0, keys: tuple[str, ...] = ("doc_id", "page")) -> DataFrame:
    """keys, line, top, x0, text: the boxes of a page in lines, each anchored to the top of its first box.

    boxes: keys, text, x0, top. A box more than tolerance below the line's first box opens a line. Anchoring is sequential,
    so each page is one group; a page has a bounded number of boxes. Null tops or texts are left out."""
    k = list(keys)
    schema = ", ".join(f"{c} {t}" for c, t in boxes.dtypes if c in k) + ", line int, top double, x0 double, text string"

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["top", "x0", "text"], kind="stable").reset_index(drop=True)
        line, anchor, at = -1, None, []
        for top in pdf["top"]:
            if anchor is None or top - anchor > tolerance:
                line, anchor = line + 1, top
            at.append(line)
        pdf["line"] = at
        out = pdf.sort_values(["line", "x0", "text"], kind="stable").groupby("line", sort=True).agg(top=("top", "min"), x0=("x0", "min"), text=("text", " ".join)).reset_index()
        for c in k:
            out[c] = pdf[c].iloc[0]
        return out[[*k, "line", "top", "x0", "text"]].astype({"line": "int32"})

    return boxes.filter("text is not null and top is not null").groupBy(*k).applyInPandas(run, schema)


def columns_of_boxes(boxes: DataFrame, gap: float = 25.0, keys: tuple[str, ...] = ("doc_id", "page")) -> DataFrame:
    """boxes with band: columns parted where x0 jumps by more than gap to the next greater one; by windows, no Python."""
    return R.gap_cluster(boxes, list(keys), F.col("x0"), [F.col("x0"), F.col("top"), F.col("text")], gap, "band")


def column_bands(boxes: DataFrame, gap: float = 25.0, keys: tuple[str, ...] = ("doc_id", "page")) -> DataFrame:
    return columns_of_boxes(boxes, gap, keys).groupBy(*keys, "band").agg(F.min("x0").alias("low"), F.max("x0").alias("high"))


def sections(lines: DataFrame, header: str, keys: tuple[str, ...] = ("doc_id",), name: str = "section") -> DataFrame:
    """Lines with the last header before them (the first group of the pattern); header lines themselves are left out."""
    h = F.nullif(F.regexp_extract("text", header, 1), F.lit(""))
    return R.carry_forward(lines.withColumn("_h", h), list(keys), ["page", "line"] if "page" in lines.columns else ["line"], F.col("_h"), name).filter("_h is null").drop("_h")


def clean_line(c: Column) -> Column:
    """Single blanks, blanks around commas put right, letters and digits that ran together parted."""
    x = F.regexp_replace(F.trim(c), r"\s+", " ")
    x = F.regexp_replace(x, r"\s*,\s*", ", ")
    x = F.regexp_replace(x, r"(\p{Ll})(\d)", "$1 $2")
    return F.regexp_replace(x, r"(\d)(\p{Lu})", "$1 $2")


def entries_of_lines(lines: DataFrame) -> DataFrame:
    """lines with number, name, club: from '12 Name Surname, Club', 'Name Surname, Club' or 'Name Surname'; the first that fits."""
    t = clean_line(F.col("text"))
    number = F.nullif(F.regexp_extract(t, r"^(\d{1,4})\s+\D", 1), F.lit("")).cast("int")
    rest = F.regexp_replace(t, r"^\d{1,4}\s+", "")
    club = F.nullif(F.trim(F.regexp_extract(rest, r",\s*(.+)$", 1)), F.lit(""))
    name = F.nullif(F.trim(F.regexp_extract(rest, r"^([^,]+)", 1)), F.lit(""))
    return lines.withColumn("number", number).withColumn("name", name).withColumn("club", club)


def expected_count(lines: DataFrame, keys: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """keys, expected, found: the number that a header promises in brackets and the lines that look like entries."""
    said = F.nullif(F.regexp_extract("text", r"\((\d+)\s*(?:spelare|deltagare|players)?\)", 1), F.lit("")).cast("int")
    entry = F.col("text").rlike(r"^\s*\d{1,4}\s+\p{L}")
    return lines.groupBy(*keys).agg(F.max(said).alias("expected"), F.count_if(entry).alias("found"))


#: number, side 1 (with its number), side 2, and the score at the end of a line of a match list.
MATCH_LINE = r"^\s*(\d{1,4})\s+(\d{1,4})?\s*(.+?)\s+-\s+(\d{1,4})?\s*(\D.*?)\s*((?:WO(?::S[12])?|[+-]?\d{1,2})(?:[\s,;|/]+[+-]?\d{1,2})*)?\s*[,;]?\s*$"


def matches_of_lines(lines: DataFrame, text: str = "text") -> DataFrame:
    """lines with match_no, number1, name1, club1, number2, name2, club2, tokens; null where the line is no match."""
    g = lambda i: F.nullif(F.trim(F.regexp_extract(text, MATCH_LINE, i)), F.lit(""))
    name = lambda i: F.nullif(F.trim(F.regexp_extract(g(i), r"^([^,]+)", 1)), F.lit(""))
    club = lambda i: F.nullif(F.trim(F.regexp_extract(g(i), r",\s*(.+)$", 1)), F.lit(""))
    return lines.withColumns({"match_no": g(1).try_cast("int"), "number1": g(2).try_cast("int"), "name1": name(3), "club1": club(3), "number2": g(4).try_cast("int"), "name2": name(5), "club2": club(5), "tokens": g(6)})


def best_duplicates(matches: DataFrame, keys: list[str]) -> DataFrame:
    """Of rows of one match the most complete: with score, with both numbers, with the longer text; then the first line."""
    w = [F.desc(F.col("tokens").isNotNull().cast("int")), F.desc(F.col("number1").isNotNull().cast("int") + F.col("number2").isNotNull().cast("int")), F.desc(F.length("text")), F.asc("line")]
    return R.latest_per_group(matches, keys, w)


def upgrade_walkovers(matches: DataFrame, withdrawn: DataFrame) -> DataFrame:
    """A bare WO becomes WO:S1 or WO:S2 if just one side has withdrawn. matches: grp, name1, name2, tokens; withdrawn: grp, name."""
    gone = withdrawn.select("grp", S.normalize_key(F.col("name")).alias("_n")).distinct().withColumn("_out", F.lit(True))
    m = matches.withColumn("_n1", S.normalize_key(F.col("name1"))).withColumn("_n2", S.normalize_key(F.col("name2")))
    m = m.join(gone.withColumnRenamed("_n", "_n1").withColumnRenamed("_out", "_o1"), ["grp", "_n1"], "left").join(gone.withColumnRenamed("_n", "_n2").withColumnRenamed("_out", "_o2"), ["grp", "_n2"], "left")
    bare = F.upper(F.trim("tokens")) == "WO"
    new = F.when(bare & F.col("_o1").isNotNull() & F.col("_o2").isNull(), "WO:S1").when(bare & F.col("_o2").isNotNull() & F.col("_o1").isNull(), "WO:S2").otherwise(F.col("tokens"))
    return m.withColumn("tokens", new).drop("_n1", "_n2", "_o1", "_o2")


def html_cells(pages: DataFrame, html: str = "html") -> DataFrame:
    """pages with row, cell and text of every table cell: native expressions over the whole page."""
    rows = F.regexp_extract_all(html, F.lit(r"(?is)<tr\b[^>]*>(.*?)</tr>"), F.lit(1))
    r = pages.select(*[c for c in pages.columns if c != html], F.posexplode(rows).alias("row", "_r"))
    cells = F.regexp_extract_all("_r", F.lit(r"(?is)<t[dh]\b[^>]*>(.*?)</t[dh]>"), F.lit(1))
    c = r.select(*[c for c in r.columns if c != "_r"], F.posexplode(cells).alias("cell", "_c"))
    return c.withColumn("text", html_text(F.col("_c"))).withColumn("href", F.nullif(F.regexp_extract("_c", r'(?is)href\s*=\s*["\']([^"\']*)', 1), F.lit(""))).drop("_c")


def html_text(c: Column) -> Column:
    x = F.regexp_replace(c, r"(?is)<[^>]+>", " ")
    for code, char in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&amp;", "&")):
        x = F.replace(x, F.lit(code), F.lit(char))
    return F.trim(F.regexp_replace(x, r"\s+", " "))


def html_title(c: Column) -> Column:
    return F.nullif(html_text(F.regexp_extract(c, r"(?is)<title[^>]*>(.*?)</title>", 1)), F.lit(""))


def stage_links(cells: DataFrame, keys: list[str]) -> DataFrame:
    """keys, stages (comma-separated) and hrefs (JSON): the stage number of each link to its address."""
    s = cells.withColumn("stage", F.nullif(F.regexp_extract("href", r"[?&]stage=(\d+)", 1), F.lit(""))).filter("stage is not null")
    one = s.groupBy(*keys, "stage").agg(F.min("href").alias("href"))
    out = one.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("stage", "href"))).alias("x"))
    return out.select(*keys, F.array_join(F.transform("x", lambda v: v["stage"]), ",").alias("stages"), F.to_json(F.map_from_entries("x")).alias("hrefs"))


def nearest_scores(winners: DataFrame, scores: DataFrame, tolerance: float = 12.0) -> DataFrame:
    """doc_id, winner_id, score_id: each winner with the nearest free score in height, every score used once.

    winners: doc_id, winner_id, y; scores: doc_id, score_id, y. Pairs are taken nearest first (ties: upper score first, then
    the ids), which is sequential, so each bracket is one group of bounded size."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        w, s = pdf[pdf["kind"] == 0], pdf[pdf["kind"] == 1]
        pairs = sorted((abs(a.y - b.y), b.y, a.id, b.id) for a in w.itertuples() for b in s.itertuples() if abs(a.y - b.y) <= tolerance)
        seen_w, seen_s, out = set(), set(), []
        for _, _, a, b in pairs:
            if a not in seen_w and b not in seen_s:
                seen_w.add(a)
                seen_s.add(b)
                out.append((pdf["doc_id"].iloc[0], a, b))
        return pd.DataFrame(out, columns=["doc_id", "winner_id", "score_id"])

    both = winners.select("doc_id", F.lit(0).alias("kind"), F.col("winner_id").cast("long").alias("id"), "y").unionByName(scores.select("doc_id", F.lit(1).alias("kind"), F.col("score_id").cast("long").alias("id"), "y"))
    kind = dict(both.dtypes)["doc_id"]
    return both.groupBy("doc_id").applyInPandas(run, f"doc_id {kind}, winner_id long, score_id long")


def report_tokens(reports: DataFrame, schema_id: str = "report_id") -> DataFrame:
    """Matches of a league report: report_id, match_no, label, home, away, sets, standing from its token list.

    reports: report_id, tokens (array of texts in reading order). A match begins with a label of a letter or digit and a
    point, goes on with names of the home and the away side (two each in doubles, joined by a slash), sets as n-n, and a
    standing as n-n after the last set. Texts before the first label are skipped."""
    import re

    label, pair = re.compile(r"^[A-Z0-9]{1,2}\.$"), re.compile(r"^\d{1,2}-\d{1,2}$")

    def parse(tokens: Iterable[str]) -> list[tuple]:
        out, now = [], None
        for t in tokens:
            t = (t or "").strip()
            if label.match(t):
                if now:
                    out.append(now)
                now = {"label": t[:-1], "names": [], "sets": []}
            elif now is not None and pair.match(t):
                now["sets"].append(t)
            elif now is not None and t and not now["sets"]:
                now["names"].append(t)
        if now:
            out.append(now)
        rows = []
        for i, m in enumerate(out, 1):
            half = (len(m["names"]) + 1) // 2
            sets, standing = (m["sets"][:-1], m["sets"][-1]) if len(m["sets"]) > 1 else (m["sets"], None)
            rows.append((i, m["label"], " / ".join(m["names"][:half]) or None, " / ".join(m["names"][half:]) or None, ", ".join(sets), standing))
        return rows

    kind = dict(reports.dtypes)[schema_id]

    def run(batches):  # noqa: ANN001, ANN202
        for pdf in batches:
            rows = [(r, *m) for r, t in zip(pdf[schema_id], pdf["tokens"], strict=True) for m in parse(t if t is not None else [])]
            yield pd.DataFrame(rows, columns=[schema_id, "match_no", "label", "home", "away", "sets", "standing"])

    return reports.select(schema_id, "tokens").mapInPandas(run, f"{schema_id} {kind}, match_no int, label string, home string, away string, sets string, standing string")


def date_with_fallback(candidates: DataFrame, keys: list[str], rank: str, day: str, most: int = 3) -> DataFrame:
    """keys, first, last: the first readable day among the first rows by rank, and the last among the last rows, of which at
    most `most` from each end are looked at."""
    from pyspark.sql import Window

    up, down = Window.partitionBy(*keys).orderBy(F.asc(rank)), Window.partitionBy(*keys).orderBy(F.desc(rank))
    c = candidates.withColumn("_u", F.row_number().over(up)).withColumn("_d", F.row_number().over(down))
    first = F.min_by(day, F.when((F.col("_u") <= most) & F.col(day).isNotNull(), F.col("_u")))
    last = F.min_by(day, F.when((F.col("_d") <= most) & F.col(day).isNotNull(), F.col("_d")))
    return c.groupBy(*keys).agg(first.alias("first"), last.alias("last"))


def knockout_size(title: Column) -> Column:
    """The tree size in a title like Schema-16."""
    return F.nullif(F.regexp_extract(title, r"(?i)schema\s*-\s*(\d+)", 1), F.lit("")).try_cast("int")


def split_at_widest_gap(boxes: DataFrame, keys: list[str]) -> DataFrame:
    """boxes with part 1 or 2: left and right of the widest gap between neighbouring boxes of a line."""
    from pyspark.sql import Window

    w = Window.partitionBy(*keys).orderBy("x0", "text")
    gap = F.lead("x0").over(w) - F.col("x1")
    b = boxes.withColumn("_gap", gap)
    cut = b.groupBy(*keys).agg(F.max_by("x0", F.struct(F.col("_gap"), -F.col("x0"))).alias("_cut"))
    return b.join(cut, keys, "left").withColumn("part", F.when(F.col("x0") <= F.col("_cut"), 1).otherwise(2)).drop("_gap", "_cut")


def missing_year(day: Column, month: Column, season_start: Column) -> Column:
    """A date without its year: from July on in the first year of the season, before in the second."""
    year = F.when(month < 7, season_start + 1).otherwise(season_start)
    return F.try_make_timestamp(year, month, day, F.lit(0), F.lit(0), F.lit(0)).cast("date")


def placeholder_entries(sides: DataFrame, placeholder: str = r"(?i)\b(vakant|wo|vacant|reserve)\b") -> DataFrame:
    """class_id, entry_id, player_id: one entry of the unknown player for each class that has a placeholder among its sides."""
    from ..lookups import UNKNOWN_PLAYER

    held = sides.filter(F.col("name").rlike(placeholder)).select("class_id").distinct()
    return held.select("class_id", (-F.shiftrightunsigned(F.xxhash64("class_id", F.lit("placeholder")), 1)).alias("entry_id"), F.lit(UNKNOWN_PLAYER).cast("long").alias("player_id"))


def unseen(fixtures: DataFrame, seen: DataFrame, key: str, day: str, since: Column) -> DataFrame:
    """Fixtures to read: those on or after since, and older ones that were never read."""
    old = fixtures.filter(F.col(day) < since).join(seen.select(key).distinct(), key, "left_anti")
    return fixtures.filter((F.col(day) >= since) | F.col(day).isNull()).unionByName(old)


def copy_checked(df: DataFrame, path: str) -> int:
    """Writes a table and counts what was written; a difference is an error."""
    df.write.mode("errorifexists").parquet(path)
    wrote, had = df.sparkSession.read.parquet(path).count(), df.count()
    if wrote != had:
        raise ValueError(f"{had} rows became {wrote}")
    return wrote
