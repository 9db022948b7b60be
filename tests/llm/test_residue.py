import pytest

from rallybase.llm import residue

MARKER = residue.ResidueMarker()
CASES = ["Hej {{namn}},", "Segrare blev ${ort}", "möter [[arena]] i kväll", "den <<datum>>", "i <%= ORT %>", "hos __klubb__ nu", "se #KLUBB# där", "till @kontakt@", "om %season% år", "XXXX-klubb", "blev {score} till", "i [klubb]", "[INSERT season] i", "[ange ort här]", "(fyll i klubb)", "{{ort|default}}",
         "Lorem ipsum dolo silta", "text. Crudis silta sento merit lorem varem.", "Dummytext. Brödtext här.", "HTTP 500 Internal Server Error", "Traceback (most recent call last):\n  File", "Denna sida kräver\nJavaScript.", "Din webbläsare är för gammal eller blockerar skript.", "null – null, publik: null", "[object Object] – 3", "Senast: Invalid Date", "404 – sidan /x kunde inte hittas."]
REAL = ["Ordet lorem står tryckt på den gamla fanan.", "Uppställningen skrevs {A, B, C} mot {X, Y, Z}.", "Siffrorna [11-7, 9-11, 11-5] står kvar.", "Vår webbplats fick ett fel 500 i går kväll, men nu fungerar allt igen.", "Ann skriver enkla skript i JavaScript för poängtavlan.", "Ungefär 40% av spelarna och 60% av ledarna svarade.",
        "Licensnummer 404 har delats ut två gånger.", "Mallen för inbjudan ska fyllas i av Ann före 2 maj.", "<b>Fet</b> text &amp; &nbsp; annat", "Resultat 3-1: Nancy vann.", "", "x" * 300_000]


MENTIONS = ["Ny hemsida: du måste enable javascript för att se resultaten, skriver klubbens webbmästare i veckans nyhetsbrev.", "Spelaren [Anna] sade att hon var nöjd med insatsen.", "Priserna sänks med 20%rea% i shopen.", "Han fick fel 404 i lördags när han sökte lokalen, men på söndagen gick det bra att anmäla sig."]
FOUND = "Fejl 404: siden /resultat/c19b4644 findes ikke længere."


def excluded(text):
    got = MARKER.judge(text)
    return bool(got) and got[2] >= residue.MIN_COVERAGE


@pytest.mark.parametrize("text", [*CASES, FOUND])
def test_excluded(text):
    assert excluded(text)
    assert excluded("En vanlig mening om en match som slutade 3-1. " * 50 + text + " Och så en till om en annan match. " * 50)


@pytest.mark.parametrize("text", [*REAL, *MENTIONS])
def test_kept(text):
    assert not excluded(text)
    assert not excluded("En vanlig mening om en match. " * 20 + text)


def by_hand(text):
    """Coverage by letters: every letter takes the weight of the earliest mark over it, part by part."""
    best = 0.0
    for unit in [text, *text.splitlines()]:
        flat = " ".join(unit.split())
        weight = [0.0] * len(flat)
        for a, b, kind in sorted(MARKER.marks(flat), key=lambda m: (m[0], -m[1])):
            for i in range(a, b):
                weight[i] = weight[i] or residue.WEIGHTS[kind]
        starts = [0] + [i + 1 for i in range(1, len(flat) - 1) if flat[i] == " " and flat[i - 1] in ".!?"] if unit is text else [0]
        for x, y in [(0, len(flat)), *zip(starts, [*starts[1:], len(flat)], strict=True)]:
            best = max(best, sum(weight[x:y]) / max(1, y - x))
    return best


def test_coverage_by_hand():
    for i, text in enumerate(CASES + REAL[:-1] + MENTIONS):
        mixed = "Första meningen är hel. " * (i % 3) + text + "\nNy rad med {{namn}} i en lång mening som fortsätter. Slut." * (i % 2)
        got = MARKER.judge(mixed)
        assert (got[2] if got else 0.0) == pytest.approx(by_hand(mixed))


def test_frame(spark):
    rows = [(1, CASES[0], "a"), (2, REAL[0], "b"), (3, None, "c"), (4, "", "d"), (1, CASES[0], "a"), (5, "ord " * 100_000 + ". Hej {{namn}}!", "e"), (6, MENTIONS[0], "f"), (7, "ord " * 100_000 + "{{namn}}", "g")]
    df = spark.createDataFrame(rows, "doc_id long, text string, coverage string")
    out = residue.mark_residue(df)
    assert sorted(r["doc_id"] for r in out.filter("excluded").collect()) == [1, 1, 5]  # 7 is one sentence of 400,000 letters
    assert residue.mark_residue(df.limit(0)).count() == 0
