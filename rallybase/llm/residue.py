"""Template residue, filler, failed values, error pages and script notices in texts.

A multi-pattern automaton marks phrases and the openings of placeholders in one pass over the whole text; placeholders are
confirmed by an anchored pattern at the place found, filler words by standing in a run. A mark counts for its length times
the weight of its kind. A text is excluded when the marks cover enough of it, or of one of its sentences or lines, as texts
are affected wholly or in part: an error page or a notice is a sentence of little else, a report that mentions a script
or an error is not.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import types as T

#: Weight of a mark's length by its kind. A placeholder spoils the sentence it stands in, however short it is; what real
#: texts write in brackets as well weighs little.
WEIGHTS = {"error": 1.0, "script": 1.0, "value": 1.0, "filler": 2.0, "placeholder": 5.0, "bracket": 0.3}
MIN_COVERAGE = 0.2
PHRASES: dict[str, tuple[str, ...]] = {
    "error": (
        "internal server error", "traceback (most recent call last)", "keyerror:", "valueerror:", "typeerror:", "nullpointerexception", "object reference not set", "the server met an unexpected condition",
        "too many requests from your", "service unavailable", "please retry in", "gateway timeout", "bad gateway", "upstream svarade inte", "was not found on this server", "the requested page /", "404 – sidan", "404 - sidan", "404 not found",
        "403 forbidden", "access denied", "åtkomst nekad", "adgang nægtet", "du saknar behörighet", "you do not have permission to", "logga in och försök igen", "your session has expired", "sessionen har gått ut", "sessionen er udløbet", "sign in again to continue",
        "logga in på nytt för att fortsätta", "log ind igen for at fortsætte", "sidan är stängd för underhåll", "siden er lukket for vedligeholdelse", "down for maintenance", "tjänsten är tillfälligt otillgänglig", "tjenesten er midlertidigt utilgængelig",
        "temporarily unavailable due to", "fel vid hämtning av sidan", "fejl ved hentning af siden", "error loading page", "could not load article", "kunde inte läsas in (felkod", "kunne ikke indlæses (fejlkode", "could not be loaded (error",
        "database connection failed", "warning: database", "warning: mysql", "fatal error:", "stack trace:", "sidan kunde inte visas", "sidan kunde inte hittas", "siden blev ikke fundet", "the page could not be found", "försök igen om ",
        *(f"{word} {code}" for word in ("error", "http", "fel", "fejl") for code in (400, 401, 403, 404, 408, 410, 429, 500, 502, 503, 504)), "bad request", "page not found", "no longer exists", "finns inte längre", "findes ikke længere",
        "vi hittar inte sidan", "vi kan ikke finde siden", "we cannot find the page", "we can't find the page", "kunde inte hittas", "kunne ikke findes", "could not be found", "länken kan vara gammal", "linket kan være forældet", "the link may be outdated", "the link may be old",
    ),
    "script": (
        "kräver javascript", "kräver att javascript är", "requires javascript", "kræver javascript", "aktivera javascript", "aktivér javascript", "enable javascript", "slå på javascript", "turn on javascript", "until javascript is switched on", "javascript is disabled",
        "javascript är avstängt", "javascript er slået fra", "kontrollera att skript är tillåtna", "slå på skript i webbläsaren", "slå skript til i browseren", "scripts are turned off", "needs scripts to run", "blockerar skript", "blokerer scripts", "blocks scripts",
        "webbläsare är för gammal", "browser er for gammel", "browser is too old", "your browser is not supported", "din webbläsare stöds inte", "uppdatera din webbläsare", "please update your browser", "byt webbläsare för att", "use another browser", "please allow scripts",
    ),
    "filler": (
        "lorem ipsum", "dummytext", "dummy text", "brödtext här", "brødtekst her", "body text here", "här kommer en rubrik", "her kommer en overskrift", "headline goes here", "skriv din text här", "skriv din tekst her", "write your text here", "your text here",
        "text text text", "tekst tekst tekst", "rubrik rubrik rubrik", "bla bla bla", "bild saknas – lägg in", "bild saknas - lägg in", "billede mangler – ind", "image missing – ", "todo: ", "fixme: ", "tbd: ", "[tbd]", "[todo]",
    ),
    "value": (
        "[object object]", "invalid date", "undefined undefined", "undefined – undefined", "undefined - undefined", "undefined-undefined", "null – null", "null - null", "null null", "nan – nan", "nan-nan", "nan - nan", "none – none", ": undefined", ": null", ": nan",
    ),
}
#: Made-up Latin of filler text; a run of them counts.
FILLER_WORDS = tuple("lorem ipsum dolor dolo sit amet consectetur adipiscing elit sed do eiusmod tempor quam sento tesque vexil fura silta porta dorme umbra viscu santo alte merit morem varem pelor nibel crudis lacti tandre olande".split())
FILLER_RUN = 4
_WORD = r"[A-Za-zÅÄÖåäöÆØæø][\w.]*"
#: Openings of placeholders, and what has to stand there.
PLACEHOLDERS: tuple[tuple[str, str], ...] = (
    ("{{", r"\{\{\s*[\w.]+\s*(\|[^{}\n]*)?\}\}"), ("${", r"\$\{\s*[\w.]+\s*\}"), ("[[", r"\[\[\s*[\w.]+\s*\]\]"), ("<<", r"<<\s*[\w.]+\s*>>"), ("<%", r"<%=?\s*[\w.]+\s*%>"),
    ("__", rf"__{_WORD}__"), ("#", rf"(?<!\w)#{_WORD}#"), ("@", rf"(?<!\w)@{_WORD}@"), ("%", rf"(?<!\w)%{_WORD}%"), ("xxxx", r"XXXX-[\w.]+"), ("{", r"\{[A-Za-z][\w.]+\}"), ("[", r"\[[A-Za-z][A-Za-z_.]+\]"),
    ("[", r"\[(ange|insert|infoga|fyll i|indsæt|angiv|enter|skriv)\s[^\[\]\n]+\]"), ("(", r"\((fyll i|ange|infoga|insert|udfyld|indsæt|fill in)\s[\w.]+\)"),
)


_NAME_IN_BRACKETS = re.compile(r"\[([A-ZÅÄÖÆØ][a-zåäöæø]+|sic|red|ref|citat|quote|note|not)\.?\]")
_SENTENCE_END = re.compile(r"[.!?][\s\"'”)]*\s")


class ResidueMarker:
    def __init__(self) -> None:
        import ahocorasick

        found: dict[str, list[tuple]] = {}
        for kind, phrases in PHRASES.items():
            for p in phrases:
                found.setdefault(p, []).append(("phrase", kind, len(p)))
        for w in FILLER_WORDS:
            found.setdefault(w, []).append(("word", "filler", len(w)))
        for opening, pattern in PLACEHOLDERS:
            found.setdefault(opening, []).append(("opening", re.compile(pattern, re.I), len(opening)))
        self.auto = ahocorasick.Automaton()
        for k, v in found.items():
            self.auto.add_word(k, v)
        self.auto.make_automaton()

    def marks(self, text: str) -> list[tuple[int, int, str]]:
        """start, end, kind of every mark, in any order, in a text whose white space is single spaces."""
        low = text.lower()
        if len(low) != len(text):
            text = low
        out, words = [], []
        for last, values in self.auto.iter(low):
            for what, x, size in values:
                a, b = last + 1 - size, last + 1
                if what == "opening":
                    if m := x.match(text, a):
                        out.append((a, m.end(), "bracket" if _NAME_IN_BRACKETS.match(text, a) else "placeholder"))
                elif (a and low[a - 1].isalnum() and low[a].isalnum()) or (b < len(low) and low[b].isalnum() and low[b - 1].isalnum()):
                    continue  # inside a longer word
                elif what == "phrase":
                    out.append((a, b, x))
                else:
                    words.append((a, b))
        run: list[tuple[int, int]] = []
        for a, b in [*sorted(words), (1 << 60, 1 << 60)]:
            if run and a - run[-1][1] > 2:
                if len(run) >= FILLER_RUN:
                    out.append((run[0][0], run[-1][1], "filler"))
                run = []
            run.append((a, b))
        return out

    def judge(self, text: str) -> tuple[int, float, float, str] | None:
        """Number of marks, plain coverage of the whole text, greatest weighted coverage of the text, a sentence or a line, and
        the kinds; None for a text without marks."""
        flat = re.sub(r"\s+", " ", text.strip())
        marks = self.marks(flat)
        if not marks:
            return None
        plain = sum(b - a for a, b, _ in _apart(marks)) / len(flat)
        top = max(_weighted(marks, 0, len(flat)), *_by_part(marks, [m.end() for m in _SENTENCE_END.finditer(flat)], len(flat)))
        for line in text.splitlines() if "\n" in text.strip() else ():
            line = re.sub(r"\s+", " ", line.strip())
            if line and (own := self.marks(line)):
                top = max(top, _weighted(own, 0, len(line)))
        return len(marks), plain, top, ",".join(sorted({k for _, _, k in marks}))


def _apart(marks: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """The marks without what an earlier one covers already; of those that begin together the longest comes first."""
    out, end = [], 0
    for a, b, kind in sorted(marks, key=lambda m: (m[0], -m[1])):
        if b > end:
            out.append((max(a, end), b, kind))
            end = b
    return out


def _weighted(marks: list[tuple[int, int, str]], start: int, stop: int) -> float:
    return sum((b - a) * WEIGHTS[kind] for a, b, kind in _apart(marks)) / max(1, stop - start)


def _by_part(marks: list[tuple[int, int, str]], ends: list[int], length: int) -> list[float]:
    """Weighted coverage of every part of the text that holds a mark; parts end at ends. A mark over a border is cut there."""
    bounds = [0, *[e for e in ends if 0 < e < length], length]
    covered: dict[int, float] = {}
    at = 0
    for a, b, kind in _apart(marks):
        while bounds[at + 1] <= a:
            at += 1
        i = at
        while a < b:
            upto = min(b, bounds[i + 1])
            covered[i] = covered.get(i, 0.0) + (upto - a) * WEIGHTS[kind]
            a, i = upto, i + 1
    return [c / (bounds[i + 1] - bounds[i]) for i, c in covered.items()]


def mark_residue(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_coverage: float = MIN_COVERAGE) -> DataFrame:
    """id, n_marks, coverage (share of the text's characters inside marks), part_coverage (greatest weighted coverage of the
    text or one of its sentences or lines), kinds, excluded: one row per text with a mark.

    A text is excluded when part_coverage reaches min_coverage. Null and empty texts have no marks; texts of any length are
    read whole, in time that grows with their length; repeated rows each give theirs. One pass over the rows, no shuffle.
    """
    schema = T.StructType([df.schema[id_col], T.StructField("n_marks", T.IntegerType()), T.StructField("coverage", T.DoubleType()), T.StructField("part_coverage", T.DoubleType()), T.StructField("kinds", T.StringType()), T.StructField("excluded", T.BooleanType())])

    def run(batches: Iterator[pd.DataFrame]) -> Iterable[pd.DataFrame]:
        marker = ResidueMarker()
        for pdf in batches:
            rows = []
            for key, text in zip(pdf["_id"], pdf["_text"], strict=True):
                if text and (got := marker.judge(text)):
                    rows.append((key, *got[:3], got[3], got[2] >= min_coverage))
            yield pd.DataFrame(rows, columns=schema.names).astype({"n_marks": "int32"})

    return df.filter(df[text_col].isNotNull()).select(df[id_col].alias("_id"), df[text_col].alias("_text")).mapInPandas(run, schema)
