import re

import pytest
from hypothesis import given
from hypothesis import strategies as st

from rallybase.operators import segment

SCORES, LICENCES = segment.Segmenter(segment.SCORES), segment.Segmenter(segment.LICENCES)


@pytest.mark.parametrize(
    ("text", "want"),
    [
        (None, []), ("", []), (" , ;", []), ("9, 7, -3, 5", ["9", "7", "-3", "5"]), ("9;7 -3|5/+6", ["9", "7", "-3", "5", "+6"]), ("-1,,-8,1", ["-1", "-8", "1"]), ("WO:S1,", ["WO:S1"]), (" WO ", ["WO"]),
        ('"5", "-6"', ["5", "-6"]), ('"5";"-6"', ["5", "-6"]), ("8\t-9", ["8", "-9"]), ("11-9", ["11-9"]), ('"5', ['"5']),
    ],
)
def test_scores(text, want):
    assert SCORES.split(text) == want


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("A-licens Senior (2014.08.11)", ["A-licens Senior (2014.08.11)"]),
        ("A-licens Senior (2014.08.11),D-licens ()", ["A-licens Senior (2014.08.11)", "D-licens ()"]),
        ("A-licens Senior (2014.08.11) + D-licens (2014.07.01) / Paralicens (15.08.20)", ["A-licens Senior (2014.08.11)", "D-licens (2014.07.01)", "Paralicens (15.08.20)"]),
        ('"A-licens Barn, förnyad (2022.08.25)"', ["A-licens Barn, förnyad (2022.08.25)"]),
        ('"Paralicens; via klubb (2014.08.16)";"D-licens (2014.07.01)"', ["Paralicens; via klubb (2014.08.16)", "D-licens (2014.07.01)"]),
        ("A-licens Senior (2014.08.11)\nD-licens (2014.07.01) ,", ["A-licens Senior (2014.08.11)", "D-licens (2014.07.01)"]),
        ("Okänd sort (2014.08.11), D-licens (2014.07.01)", ["Okänd sort (2014.08.11)", "D-licens (2014.07.01)"]),
    ],
)
def test_licences(text, want):
    assert LICENCES.split(text) == want


def test_delimiter_inside_known_value():
    lex = segment.Lexicon(words=("Ek, Asa", "Bo"), delimiters=",;")
    assert segment.Segmenter(lex).split("Ek, Asa, Bo;x") == ["Ek, Asa", "Bo", "x"]


@given(st.lists(st.integers(-99, 99), min_size=0, max_size=12), st.sampled_from([", ", ",", ";", " ", "|", " / ", "\t"]))
def test_round_trip(values, sep):
    assert SCORES.split(sep.join(map(str, values))) == [str(v) for v in values]


@given(st.text(alphabet='0123456789-+,;|/ "WO:S', max_size=40))
def test_loses_no_digit(text):
    assert "".join(re.findall(r"\d", "".join(SCORES.split(text)))) == "".join(re.findall(r"\d", text))


def test_frame(spark):
    long = ", ".join(["9"] * 20_000)
    df = spark.createDataFrame([(1, "9, 7", "x"), (2, None, "x"), (3, "", "x"), (1, "9, 7", "x"), (4, long, "x")], "row_id long, tokens string, pos string")
    got = segment.split_packed(df.select("row_id", "tokens", "pos"), ["row_id"], "tokens", segment.SCORES)
    assert got.columns == ["row_id", "pos", "val"]
    assert got.filter("row_id = 4").count() == 20_000
    assert sorted(tuple(r) for r in got.filter("row_id < 4").collect()) == [(1, 1, "9"), (1, 1, "9"), (1, 2, "7"), (1, 2, "7")]
    assert segment.split_packed(df.limit(0), ["row_id"], "tokens", segment.SCORES).count() == 0
