"""Text keys as native column expressions."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F


def bare(letter: str) -> str:
    """A letter's compatibility form without its marks."""
    return "".join(x for x in unicodedata.normalize("NFKD", letter) if not unicodedata.combining(x))


_RANGES = ((0xAA, 0x250), (0x370, 0x530), (0x1E00, 0x2000), (0xFF01, 0xFF5F))  # Latin, Greek, Cyrillic, wide letters
#: What Unicode says of each small letter with marks: made by rule.
BARE = {c: bare(c) for a, b in _RANGES for c in map(chr, range(a, b)) if c == c.lower() and bare(c) not in ("", c)}


def without_marks(c: Column, keep: str = "") -> Column:
    """Small letters without their marks, whether a mark is part of the letter or follows it; letters in keep stay."""
    one = {k: v for k, v in BARE.items() if len(v) == 1 and k not in keep}
    x = F.translate(c, "".join(one), "".join(one.values()))
    for k, v in BARE.items():
        if len(v) > 1 and v.isalpha() and k not in keep:
            x = F.replace(x, F.lit(k), F.lit(v))
    return F.regexp_replace(x, r"\p{M}+", "")


def fold(c: Column) -> Column:
    """Lower case, marks removed, the digraphs ae, oe and aa as one letter, everything but letters and digits as one space."""
    x = F.translate(without_marks(F.lower(c)), "æø", "ao")
    x = F.regexp_replace(x, "ae|aa", "a")
    x = F.regexp_replace(x, "oe", "o")
    return F.trim(F.regexp_replace(x, "[^a-z0-9]+", " "))


def skeleton(c: Column) -> Column:
    """fold() with doubled letters as one and without spaces."""
    return F.regexp_replace(F.regexp_replace(fold(c), " ", ""), r"(.)\1+", "$1")


def tokens(c: Column) -> Column:
    return F.filter(F.split(fold(c), " "), lambda t: t != "")


def token_key(c: Column) -> Column:
    """The folded tokens in order of the alphabet: alike for any order of the parts."""
    return F.array_join(F.array_sort(tokens(c)), " ")


def deletions(c: Column) -> Column:
    """The text and all texts that lack one of its characters: two texts one edit apart share at least one."""
    n = F.length(c)
    return F.array_distinct(F.concat(F.array(c), F.when(n > 1, F.transform(F.sequence(F.lit(1), n), lambda i: F.concat(F.substring(c, F.lit(1), i - 1), F.substring(c, i + 1, n)))).otherwise(F.array().cast("array<string>"))))


def digits_id(c: Column) -> Column:
    """An external number as plain digits: without spaces, leading zeros and a trailing .0; null if it is none."""
    x = F.regexp_extract(c, r"^\s*0*([0-9]+)(?:\.0+)?\s*$", 1)
    return F.when(x != "", x)


def year_of(c: Column, pivot: int = 25) -> Column:
    """Year of birth from yyyy, yyyy-mm-dd or yy (up to pivot: this century); null if it is none."""
    s = F.trim(c.cast("string"))
    four = F.regexp_extract(s, r"^((?:18|19|20)[0-9]{2})(?:[-./].*|\.0)?$", 1)
    two = F.regexp_extract(s, r"^([0-9]{2})$", 1)
    two_no = F.nullif(two, F.lit("")).cast("int")
    return F.when(four != "", F.nullif(four, F.lit("")).cast("int")).when(two != "", F.when(two_no <= pivot, two_no + 2000).otherwise(two_no + 1900))


def season_start(label: Column) -> Column:
    """First year of a season written as 2014-15, 2014/2015, 14/15, with any words before; null if there is none."""
    y = F.regexp_extract(label, r"([0-9]{4}|[0-9]{2})\s*[-/–]\s*(?:[0-9]{4}|[0-9]{2})", 1)
    no = F.nullif(y, F.lit("")).cast("int")
    return F.when(F.length(y) == 4, no).when(F.length(y) == 2, no + 2000)


#: What clubs are called besides their place, in folded letters.
_FORMS = r"gymnastik och idrottsforening(en)?|allmanna idrottssallskap(et)?|idrottsforening(en)?|bordtennis(klubb|forening|sallskap)(en|et)?|pingisklubb(en)?|sportklubb(en)?|foreningen|\b(b ?t ?k|b ?t ?f|b ?t ?s|p ?k|g ?i ?f|a ?i ?s|i ?f|s ?k|ii|iii|iv|[0-9]|vet|ungdom|dam|herr)\b"


def club_place(c: Column) -> Column:
    """A club's name without its legal form, team number and final genitive s, folded."""
    x = F.regexp_replace(F.regexp_replace(fold(c), _FORMS, " "), " +", "")
    return F.regexp_replace(F.regexp_replace(x, "s$", ""), r"(.)\1+", "$1")


def nearness(a: Column, b: Column) -> Column:
    """1 less the edit distance as a part of the longer text; null if either is null or empty."""
    longer = F.greatest(F.length(a), F.length(b))
    return F.when((F.length(a) > 0) & (F.length(b) > 0), 1 - F.levenshtein(a, b) / longer)
