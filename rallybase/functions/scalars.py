"""Scalar functions of the domain as native column expressions."""

from __future__ import annotations

import difflib

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from . import text as X


def parse_date(c: Column) -> Column:
    """yyyy-MM-dd, yyyy.MM.dd or yyyyMMdd; anything else is null."""
    s = F.trim(c)
    return F.coalesce(*[F.when(s.rlike(p), F.try_to_timestamp(s, F.lit(f)).cast("date")) for p, f in ((r"^\d{4}-\d{2}-\d{2}$", "yyyy-MM-dd"), (r"^\d{4}\.\d{2}\.\d{2}$", "yyyy.MM.dd"), (r"^\d{8}$", "yyyyMMdd"))])


def parse_day_first(c: Column) -> Column:
    """d-M-yyyy or d.M.yyyy."""
    s = F.translate(F.trim(c), ".", "-")
    return F.when(s.rlike(r"^\d{1,2}-\d{1,2}-\d{4}$"), F.try_to_timestamp(s, F.lit("d-M-yyyy")).cast("date"))


def day_in_month(base: Column, day: Column) -> Column:
    """The date with that day in the month of base; null if there is no such day."""
    return F.try_make_timestamp(F.year(base), F.month(base), day, F.lit(0), F.lit(0), F.lit(0)).cast("date")


def season_year(c: Column) -> Column:
    """First year of the season (1 July to 30 June) that holds a date."""
    return F.year(c) - (F.month(c) < 7).cast("int")


def season_label(c: Column) -> Column:
    y = season_year(c)
    return F.concat(y.cast("string"), F.lit("-"), F.lpad(((y + 1) % 100).cast("string"), 2, "0"))


def event_status(start: Column, end: Column, today: Column) -> Column:
    """1 upcoming, 2 ongoing, 3 ended, 6 unknown (a date is missing); today is always given."""
    return F.when(start.isNull() | end.isNull(), 6).when(end < today, 3).when(start > today, 1).otherwise(2)


def first_int(c: Column) -> Column:
    return F.nullif(F.regexp_extract(c, r"\d+", 0), F.lit("")).try_cast("int")


def signed_tokens(c: Column) -> Column:
    """The signed whole numbers in a text, as written."""
    return F.regexp_extract_all(c, F.lit(r"[+-]?\d+"), F.lit(0))


def decode_games(tokens: Column) -> Column:
    """Array of (side1, side2) points. A number is the loser's points: without minus side 1 won, with minus (also -0) side 2;
    the winner has 11, or two more than the loser from 10 on."""

    def game(t: Column) -> Column:
        low = F.abs(t.cast("int"))
        high = F.when(low >= 10, low + 2).otherwise(11)
        second = F.startswith(t, F.lit("-"))
        return F.struct(F.when(second, low).otherwise(high).alias("side1"), F.when(second, high).otherwise(low).alias("side2"))

    return F.transform(tokens, game)


def games_won(tokens: Column, side: int) -> Column:
    minus = lambda t: F.startswith(t, F.lit("-"))
    return F.size(F.filter(tokens, (lambda t: ~minus(t)) if side == 1 else minus))


def best_of(tokens: Column) -> Column:
    """2 n - 1 for the n games of the side with more; null without games."""
    most = F.greatest(games_won(tokens, 1), games_won(tokens, 2))
    return F.when(F.size(tokens) > 0, 2 * most - 1)


def walkover_side(text: Column) -> Column:
    """The side that forfeits: from WO:S1 or WO:S2."""
    return F.nullif(F.regexp_extract(F.upper(text), r"WO:S([12])", 1), F.lit("")).cast("int")


def match_winner(text: Column, best: Column) -> Column:
    """1, 2 or null: the other side of a walkover, else the side with more than half of the games (of those played if best
    is unknown)."""
    tokens = signed_tokens(F.regexp_replace(F.upper(text), r"WO(:S[12])?", ""))
    need = F.floor(F.coalesce(best, F.size(tokens)) / 2) + 1
    wo = walkover_side(text)
    return F.when(wo.isNotNull(), 3 - wo).when(games_won(tokens, 1) >= need, 1).when(games_won(tokens, 2) >= need, 2).cast("int")


def flip_name(c: Column) -> Column:
    """'Last First Second' as 'First Second Last': the part before the first blank goes to the end."""
    s = F.trim(c)
    at = F.instr(s, " ")
    return F.when(at > 0, F.concat(F.trim(F.substring(s, at + 1, F.length(s))), F.lit(" "), F.substring(s, F.lit(1), at - 1))).otherwise(s)


def display_name(verified: Column, first: Column, last: Column, raw: Column) -> Column:
    return F.when(verified, F.concat_ws(" ", first, last)).otherwise(flip_name(raw))


def title_case(c: Column) -> Column:
    """Every run of letters begins with a capital and goes on in small letters (also after hyphens and apostrophes)."""
    low = F.lower(F.regexp_replace(F.trim(c), r"\s+", " "))
    letters = F.split(low, "")
    before = F.concat(F.array(F.lit(" ")), letters)
    return F.array_join(F.transform(letters, lambda x, i: F.when(F.element_at(before, i + 1).rlike(r"^\p{L}$"), x).otherwise(F.upper(x))), "")


def normalize_key(c: Column, keep_marks: bool = False) -> Column:
    """Lower case, hyphens and slashes as blanks, single blanks; accents go but for the Nordic letters, of which ö counts as ø.
    A Nordic letter written as a plain one with a mark after it loses the mark, as any other."""
    x = F.lower(F.trim(F.regexp_replace(F.regexp_replace(c, r"[-/]", " "), r"\s+", " ")))
    if keep_marks:
        return x
    return X.without_marks(F.translate(x, "ö", "ø"), keep="åäøæ")


def ascii_key(c: Column) -> Column:
    x = F.translate(X.without_marks(F.lower(c)), "æø", "ao")
    return F.trim(F.regexp_replace(F.regexp_replace(x, r"[^a-z0-9\s]", " "), r"\s+", " "))


def opaque_id(salt: str, c: Column) -> Column:
    """HMAC-SHA256 of the text under the salt, in hex. The salt is always the caller's."""
    import hashlib

    key = salt.encode()
    key = hashlib.sha256(key).digest() if len(key) > 64 else key
    key = key.ljust(64, b"\0")
    inner, outer = bytes(b ^ 0x36 for b in key), bytes(b ^ 0x5C for b in key)
    first = F.sha2(F.concat(F.unhex(F.lit(inner.hex())), F.encode(c.cast("string"), "utf-8")), 256)
    return F.sha2(F.concat(F.unhex(F.lit(outer.hex())), F.unhex(first)), 256)


#: Short names of doubles classes.
_DOUBLES = ("HD", "DD", "WD", "MD", "MXD", "FD", "PD", "HJD")


def class_type(short: Column, long: Column | None = None) -> Column:
    """1 singles, 2 doubles, 4 team, 9 unknown, from a class's short and long name.

    Team words and team abbreviations come first, then doubles words and abbreviations (mixed doubles are doubles, also a
    mixed class between other words unless its long name says singles), then names that begin like no class; all else,
    also without a name, is singles."""
    s, l = F.lower(F.coalesce(short, F.lit(""))), F.lower(F.coalesce(long if long is not None else F.lit(None).cast("string"), F.lit("")))  # noqa: E741
    both = F.concat(l, F.lit(" "), s)
    tokens = F.split(F.upper(s), "[^A-ZÅÄÖ]+")
    has = lambda names: F.arrays_overlap(tokens, F.array(*map(F.lit, names)))
    team = both.rlike("lag") | l.rlike("team") | s.rlike(r"\bteams?\b") | has(("HL", "DL", "TEAM")) | s.rlike(r"\b[hd]l\d+\b")
    mixed = both.rlike(r"\w mixed \w") & ~l.rlike("singel|single|enkelt")
    doubles = s.rlike("^(" + "|".join(_DOUBLES).lower() + ")") | both.rlike("dubbel|dubble|dobbel|double") | mixed | has(_DOUBLES)
    return F.when(team, 4).when(doubles, 2).when(s.rlike("^x[bg]"), 9).otherwise(1)


def class_structure(stages: Column) -> Column:
    """1 groups and knockout, 2 groups only, 3 knockout only, 9 unknown, from a comma-separated list of stages
    (3, 4: groups; 5: knockout)."""
    s = F.transform(F.split(F.coalesce(stages, F.lit("")), ","), lambda x: F.trim(x))
    has = lambda n: F.array_contains(s, str(n))
    groups, knockout = has(3) | has(4), has(5)
    return F.when(groups & knockout, 1).when(groups, 2).when(knockout, 3).otherwise(9)


def licence_parts(c: Column) -> Column:
    """Struct of kind, age and day of a licence text like 'A-licens Senior (2024.09.01)'; null if it is none."""
    p = r"^\s*(\S*licens)(?:\s+([^(\s][^(]*?))?\s*\(([^)]*)\)\s*$"
    kind = F.nullif(F.regexp_extract(c, p, 1), F.lit(""))
    return F.when(kind.isNotNull(), F.struct(kind.alias("kind"), F.nullif(F.regexp_extract(c, p, 2), F.lit("")).alias("age"), parse_date(F.regexp_extract(c, p, 3)).alias("day")))


def stage_of_matches(n: Column) -> Column:
    """Knockout stage by its number of matches: 1 final 8, 2 semifinals 7, 4 quarterfinals 6, 8 last sixteen 5, 16, 32, 64: 4, 3, 2."""
    return F.coalesce(*[F.when(n == F.lit(2**i), F.lit(8 - i)) for i in range(7)])


def human_size(n: Column) -> Column:
    return F.when(n < 1024, F.format_string("%d B", n)).when(n < 1024**2, F.format_string("%.1f KB", n / 1024)).when(n < 1024**3, F.format_string("%.1f MB", n / 1024**2)).otherwise(F.format_string("%.1f GB", n / 1024**3))


def jaccard(a: Column, b: Column) -> Column:
    """Shared words as a part of all words of two texts; 0 if both are empty."""
    x, y = F.array_distinct(F.split(a, r"\s+")), F.array_distinct(F.split(b, r"\s+"))
    return F.size(F.array_intersect(x, y)) / F.greatest(F.size(F.array_union(x, y)), F.lit(1))


def sequence_ratio(a: Column, b: Column) -> Column:
    """Ratio of matching blocks (2 m / total), as sequence matchers give it; in Arrow batches, as Spark has no such function."""
    @F.pandas_udf("double")
    def ratio(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series([None if p is None or q is None else difflib.SequenceMatcher(None, p, q).ratio() for p, q in zip(x, y, strict=True)], dtype="float64")

    return ratio(a, b)


def name_aliases(name: Column) -> Column:
    """Shorter forms under which a player may stand in a drawing: the whole name, first and last part, initial and last part,
    the last part alone, and the same with only the first half of parts joined by a hyphen."""
    clean = F.lower(F.trim(F.regexp_replace(name, r"\s+", " ")))

    def forms(c: Column) -> Column:
        parts = F.split(c, " ")
        first, last = F.element_at(parts, 1), F.element_at(parts, -1)
        many = F.size(parts) > 1
        return F.array(c, F.when(many, F.concat_ws(" ", first, last)), F.when(many, F.concat(F.substring(first, 1, 1), F.lit(" "), last)), F.when(many, F.concat(F.substring(first, 1, 1), F.lit(". "), last)), F.when(many, last))

    halved = F.regexp_replace(clean, r"-\S+", "")
    return F.when(clean != "", F.array_distinct(F.array_compact(F.concat(forms(clean), forms(halved))))).otherwise(F.array().cast("array<string>"))


def round_name(matches: Column) -> Column:
    """Name of a knockout round by its number of matches: Final, RO4/SF, RO8/QF, RO16 and so on; Round if it can't be told."""
    size = (matches * 2).cast("string")
    return F.when(matches == 1, "Final").when(matches == 2, "RO4/SF").when(matches == 4, "RO8/QF").when(matches > 4, F.concat(F.lit("RO"), size)).otherwise("Round")


def league_level(section: Column) -> Column:
    """National, regional, district or other, from the heading of a section."""
    s = F.lower(section)
    return F.when(s.isNull(), None).when(s.rlike("nationell|national|elit|superliga"), "National").when(s.rlike("region|zon"), "Regional").when(s.rlike("distrikt|district"), "District").otherwise("Other")


def structure_from_text(inferred: Column, text: Column) -> Column:
    """A structure corrected by its document: two group stages named make it 4, a knockout named in one of groups only makes it 1."""
    t = F.lower(F.coalesce(text, F.lit("")))
    pools = F.size(F.array_distinct(F.regexp_extract_all(t, F.lit(r"(?:gruppspel|pooler|group stage)\s*(\d)"), F.lit(1))))
    knockout = t.rlike("slutspel|utslagning|knockout|schema-")
    return F.when(pools >= 2, F.when(knockout, 1).otherwise(4)).when((inferred == 2) & knockout, 1).otherwise(inferred)
