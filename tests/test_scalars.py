import hashlib
import hmac
from datetime import date

import pytest
from pyspark.sql import functions as F

from rallybase.functions import scalars as S
from rallybase.functions import text as X
from rallybase.operators import relational as R


def each(spark, expr, values, kind="string"):
    """expr over values, in order."""
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r["x"] for r in df.select("i", expr(F.col("v")).alias("x")).orderBy("i").collect()]


def test_dates(spark):
    assert each(spark, S.parse_date, ["2024-01-02", "2024.01.02", "20240102", "02/01/2024", "2024-02-31", "", None]) == [date(2024, 1, 2)] * 3 + [None] * 4
    assert each(spark, S.parse_day_first, ["2-1-2024", "02.01.2024", "x"]) == [date(2024, 1, 2), date(2024, 1, 2), None]
    assert each(spark, lambda c: S.day_in_month(c, F.lit(31)), [date(2024, 1, 5), date(2024, 2, 5)], "date") == [date(2024, 1, 31), None]
    assert each(spark, S.season_label, [date(2025, 6, 30), date(2025, 7, 1), None], "date") == ["2024-25", "2025-26", None]
    d = F.lit(date(2024, 5, 5))
    assert each(spark, lambda c: S.event_status(c, F.date_add(c, 1), d), [date(2024, 5, 1), date(2024, 5, 4), date(2024, 5, 6), None], "date") == [3, 2, 1, 6]


def test_seasons_ids_years(spark):
    assert each(spark, X.season_start, ["2014-15", "Säsong 2021/2022", "23/24", "Licens 2020-21", "x", None]) == [2014, 2021, 2023, 2020, None, None]
    assert each(spark, X.digits_id, ["100119", " 0100262", "100040.0", "x", "", None]) == ["100119", "100262", "100040", None, None, None]
    assert each(spark, X.year_of, ["1990", " 1955 ", "07", "48", "1957-12-14", "--", "3", None]) == [1990, 1955, 2007, 1948, 1957, None, None, None]


@pytest.mark.parametrize(
    ("tokens", "best", "games", "winner", "wo"),
    [
        ("9, 7, -3, 5", 5, [(11, 9), (11, 7), (3, 11), (11, 5)], 1, None),
        ("-10, -12, -9", 5, [(10, 12), (12, 14), (9, 11)], 2, None),
        ("8, -9", 5, [(11, 8), (9, 11)], None, None),
        ("8, 8", None, [(11, 8), (11, 8)], 1, None),
        ("0", 1, [(11, 0)], 1, None),
        ("-0", 1, [(0, 11)], 2, None),
        ("WO:S1", None, [], 2, 1),
        ("WO:S2", None, [], 1, 2),
        ("WO", None, [], None, None),
        ("", 5, [], None, None),
        ("abc", 5, [], None, None),
    ],
)
def test_scores(spark, tokens, best, games, winner, wo):
    df = spark.createDataFrame([(tokens, best)], "t string, b int")
    tok = S.signed_tokens(F.regexp_replace(F.upper("t"), r"WO(:S[12])?", ""))
    r = df.select(S.decode_games(tok).alias("g"), S.match_winner(F.col("t"), F.col("b")).alias("w"), S.walkover_side(F.col("t")).alias("o")).first()
    assert ([tuple(g) for g in r["g"]], r["w"], r["o"]) == (games, winner, wo)


def test_best_of(spark):
    assert each(spark, lambda c: S.best_of(S.signed_tokens(c)), ["9, 7, -3, 5", "-1 -2", "x"]) == [5, 3, None]


def test_names(spark):
    assert each(spark, S.normalize_key, ["  Virum-Sorgenfri   BTK ", "Hilleröd GI", "Hillerød GI", "Café", "Åsa Ek", "O'Neil"]) == ["virum sorgenfri btk", "hillerød gi", "hillerød gi", "cafe", "åsa ek", "o'neil"]
    assert each(spark, lambda c: S.normalize_key(c, True), ["Göran"]) == ["göran"]
    assert each(spark, S.title_case, ["anna-karin o'neil", "ÅSA  EK", "", None]) == ["Anna-Karin O'Neil", "Åsa Ek", "", None]
    assert each(spark, S.flip_name, ["EK Asa Maria", "Ek", " a b "]) == ["Asa Maria EK", "Ek", "b a"]
    assert each(spark, lambda c: F.array_sort(R.name_keys(c)), ["a b c", "a", " ", None]) == [["a b c", "b c a", "c a b"], ["a"], [], []]
    assert each(spark, X.token_key, ["Ek  ÅSA", "Asa Ek", "Aasa Ek"]) == ["asa ek"] * 3
    assert each(spark, X.club_place, ["Porsbennings Bordtennisförening", "BTF Porsbenning", "Porsbenning B.T.F. 2", "PORSBENNING"]) == ["porsbening"] * 4


def test_classifiers(spark):
    assert each(spark, S.class_type, ["HD1", "Herrlag", "Mixeddubbel", "XB2", "P12", "", None]) == [2, 4, 2, 9, 1, 1, 1]
    assert each(spark, S.class_structure, ["1,2,3,5", "1,3,4", "1,5,6", "1", None]) == [1, 2, 3, 9, 9]
    assert each(spark, S.stage_of_matches, [8, 3, 1, 64], "int") == [5, None, 8, 2]
    assert each(spark, S.licence_parts, ["A-licens Senior (2024.09.01)", "D-licens ()", "x"]) == [("A-licens", "Senior", date(2024, 9, 1)), ("D-licens", None, None), None]


def test_hmac(spark):
    for salt in ("s", "x" * 100):
        assert each(spark, lambda c, s=salt: S.opaque_id(s, c), ["12", "å"]) == [hmac.new(salt.encode(), v.encode(), hashlib.sha256).hexdigest() for v in ("12", "å")]


def test_likeness(spark):
    df = spark.createDataFrame([("abcdefgh", "abcdefghij"), ("ab", "xy"), (None, "a"), ("", "a")], "a string, b string")
    got = [r[0] for r in df.select(R.prefix_score(F.col("a"), F.col("b"))).collect()]
    assert got == [pytest.approx(0.9), 0.0, None, None]
    assert df.select(S.sequence_ratio(F.col("a"), F.col("b"))).first()[0] == pytest.approx(16 / 18)
    assert spark.range(1).select(S.jaccard(F.lit("a b c"), F.lit("b c d"))).first()[0] == 0.5
    assert each(spark, S.human_size, [10, 2048, 3 * 1024**2], "long") == ["10 B", "2.0 KB", "3.0 MB"]
    assert each(spark, S.first_int, ["pool 12 of 3", "x", None]) == [12, None, None]


def test_drawing_words(spark):
    assert each(spark, S.name_aliases, ["Anna-Karin  Berg Ek", "Ek", " ", None]) == [["anna-karin berg ek", "anna-karin ek", "a ek", "a. ek", "ek", "anna berg ek", "anna ek"], ["ek"], [], []]
    assert each(spark, S.round_name, [1, 2, 4, 8], "int") == ["Final", "RO4/SF", "RO8/QF", "RO16"]
    assert each(spark, S.league_level, ["Nationella serier", "Region Norr", "Distrikt 3", "Övrigt", None]) == ["National", "Regional", "District", "Other", None]
    assert each(spark, lambda c: S.structure_from_text(F.lit(2), c), ["Gruppspel 1 ... Gruppspel 2", "Pool, slutspel", "x", None]) == [4, 1, 2, 2]
