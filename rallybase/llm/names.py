"""Variant spellings of typed names.

Every name is rewritten into all its canonical forms (order of the parts, nicknames, initials, dropped additions, cut ends,
legal forms of clubs, one letter missing on either side for typing errors); the forms of typed and registered names are
equi-joined. What two names share is scored by the rewriting that led there and by how few registered names have that form.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import stash

_FOLD = str.maketrans("àáâãäåæçèéêëìíîïñòóôõöøùúûüýÿšž", "aaaaaaaceeeeiiiinoooooouuuuyysz", ".'’`´")
_WORDS = re.compile(r"[a-z0-9]+")
_TWICE = re.compile(r"(.)\1+")
#: How much a shared form tells, by kind: exact, nickname, typing error, cut end, initial, same beginning of the first name.
WEIGHTS = {"x": 1.0, "n": 0.9, "e": 0.8, "p": 0.75, "i": 0.6, "h": 0.5}
DROPPED = 0.92
#: Swedish nicknames and the names they stand for.
NICKNAMES: dict[str, tuple[str, ...]] = {
    "abbe": ("albert", "albin"), "affe": ("alfred",), "alex": ("alexander", "alexandra"), "anki": ("annkristin", "annika", "annakarin", "ann"), "anna": ("annakarin",), "babben": ("barbro",), "basse": ("sebastian",), "bea": ("beatrice",), "benja": ("benjamin",), "benke": ("bengt",), "berra": ("bertil",), "bettan": ("elisabet",), "bibbi": ("birgitta",), "bobo": ("bo",), "bosse": ("bo",), "brittan": ("birgitta", "brittmarie"), "britta": ("birgitta", "brittmarie"),
    "cale": ("carl",), "calle": ("carl", "karljohan", "karl"), "charlie": ("charlotta",), "chrille": ("christer", "christian"), "cissi": ("cecilia",), "crille": ("christer", "christian"), "danne": ("daniel",), "ebban": ("ebba",), "edde": ("edvin", "edvard"), "ella": ("ellen", "elin"), "emmi": ("emilia", "emma"), "felle": ("felicia",), "fia": ("sofia",), "fille": ("filip",), "fippe": ("filip",), "fredde": ("fredrik",), "frippe": ("fredrik",), "gittan": ("birgitta",), "gurra": ("gustav", "gunnar", "goran"),
    "hampe": ("hampus",), "hanna": ("johanna",), "hasse": ("hans", "hannes"), "henke": ("henrik",), "jacke": ("jakob",), "janne": ("jan", "janerik"), "jocke": ("joakim", "jakob"), "johnny": ("john",), "jonte": ("jonas", "jonatan", "johan"), "kalle": ("karl", "karljohan", "carl"), "kattis": ("katarina",), "kenta": ("kenneth", "kent"), "kia": ("kristina",), "kicki": ("kristina", "kerstin"), "kim": ("joakim",), "klabbe": ("klas",), "kribbe": ("kristoffer", "krister"), "krille": ("kristoffer", "kristian"), "lasse": ("lars",), "leffe": ("leif",), "lelle": ("lennart",), "lillan": ("elisabet",), "linda": ("linnea",), "lisa": ("elisabet",), "lotta": ("charlotta",), "ludde": ("ludvig",),
    "maggan": ("margareta",), "greta": ("margareta",), "mange": ("magnus",), "mackan": ("marcus", "markus"), "maja": ("maria",), "mansan": ("mans",), "masse": ("mats", "martin"), "matte": ("mattias", "mats"), "mia": ("maria", "annamaria"), "micke": ("mikael",), "mimmi": ("maria",), "nalle": ("bjorn",), "nettan": ("anette", "jeanette"), "nicke": ("niklas",), "nille": ("pernilla",), "ninni": ("ingrid",), "nisse": ("nilsake", "nils"), "noppe": ("norbert",), "olle": ("olof", "oliver", "perolof"), "oskis": ("oskar",), "palle": ("paul", "patrik"), "pelle": ("per", "perolof"), "pernilla": ("nilla",), "nilla": ("pernilla",), "pia": ("maria",), "putte": ("patrik", "per"),
    "rasse": ("rasmus",), "rebban": ("rebecka",), "becka": ("rebecka",), "robban": ("robert",), "roffe": ("rolf",), "rolle": ("roland", "rolf"), "sandra": ("alexandra",), "samme": ("samuel",), "sam": ("samuel",), "sanna": ("susanne",), "sigge": ("signe", "sigvard"), "steffe": ("stefan",), "stoffe": ("kristoffer",), "sussi": ("susanne",), "svenne": ("sven",), "sonny": ("soren",), "tinna": ("kristina",), "tobbe": ("tobias",), "tompa": ("tomas",), "tony": ("anton", "antonia"), "totte": ("torsten", "anton"), "tilda": ("matilda",), "uffe": ("ulf",), "ulla": ("ulrika",), "ullis": ("ulrika",), "valle": ("valter",), "vicke": ("viktor",), "vickan": ("viktoria",), "ville": ("vilhelm", "wilhelm", "viktor", "vincent"), "wille": ("wilhelm",), "wilma": ("vilhelmina",), "ragge": ("ragnar",), "hugge": ("hugo",), "malle": ("malte",), "melle": ("melker",), "adde": ("adam", "andreas"), "andy": ("anders",), "acke": ("axel",), "augge": ("august",), "jompa": ("johan",), 
    "ale": ("alexander", "alexandra"), "ante": ("anders", "anton"), "ben": ("benjamin",), "bengan": ("bengt",), "josan": ("josefin",), "kj": ("karljohan",), "kricke": ("kristoffer",), "natis": ("nathalie",), "nina": ("katarina",), "oge": ("oskar",), "oli": ("oliver",), "pate": ("patrik",), "pippi": ("filippa",), "po": ("perolof",), "sebe": ("sebastian",), "stina": ("kristina",), "ube": ("urban",),
}
_FULL: dict[str, set[str]] = {}
for _nick, _names in NICKNAMES.items():
    for _name in _names:
        _FULL.setdefault(_nick, set()).add(_name)
        _FULL.setdefault(_name, set()).add(_nick)


def tokens(text: str | None) -> list[str]:
    """Folded parts of a name: marks and case gone, ae, oe and aa as one letter, doubled letters as one."""
    if not text:
        return []
    t = text.lower().translate(_FOLD).replace("ae", "a").replace("oe", "o")
    return [_TWICE.sub(r"\1", w) for w in _WORDS.findall(t)]


_PRIME, _BASE = (1 << 61) - 1, 1_000_003_579
_POWERS = [1]


class Rolled:
    """Polynomial hashes of a word, of its beginnings and of the word without a piece: each in constant time once the word is
    read, so that a text of any length gives forms in proportion to its length."""

    def __init__(self, word: str):
        while len(_POWERS) <= len(word):
            _POWERS.append(_POWERS[-1] * _BASE % _PRIME)
        pre, h = [0], 0
        for c in word:
            h = (h * _BASE + ord(c)) % _PRIME
            pre.append(h)
        self.word, self.pre, self.whole = word, pre, h

    def head(self, k: int) -> int:
        return self.pre[k]

    def piece(self, a: int, b: int) -> int:
        return (self.pre[b] - self.pre[a] * _POWERS[b - a]) % _PRIME

    def without(self, a: int, b: int) -> int:
        return (self.pre[a] * _POWERS[len(self.word) - b] + self.piece(b, len(self.word))) % _PRIME

    def shorter(self) -> list[int]:
        """The word, and the word without each of its letters."""
        n, pre, h = len(self.word), self.pre, self.whole
        return [h, *((h - pre[i + 1] * _POWERS[n - 1 - i] + pre[i] * _POWERS[n - 1 - i]) % _PRIME for i in range(n))]


def _form(kind: str, first: int, last: int) -> int:
    """A form as a number: its kind and the hashes of what stands for the first and the last name."""
    return ((ord(kind) * 0x9E3779B97F4A7C1 + first) * 0x5851F42D4C957F2 + last * 0x27D4EB2F165667C5) % _PRIME


@lru_cache(20_000)
def _hash(word: str) -> int:
    return Rolled(word).whole


_NICK = {"".join(tokens(k)): {"".join(tokens(v)) for v in vs} for k, vs in _FULL.items()}
MANY = 6  # in names of more parts than this, a left-out part isn't combined with another rewriting than order and nickname


def registered_forms(first: str | None, last: str | None) -> set[int]:
    """Canonical forms of a registered name."""
    f, l = "".join(tokens(first)), "".join(tokens(last))  # noqa: E741
    if not f or not l:
        return {_form("x", 0, _hash(f or l))} if f or l else set()
    rf, rl = Rolled(f), Rolled(l)
    out = {_form("x", rf.whole, rl.whole), _form("i", rf.head(1), rl.whole), _form("h", rf.head(min(2, len(f))), rl.whole)}
    out |= {_form("p", rf.whole, rl.head(k)) for k in range(4, len(l))}
    return out | {_form("e", rf.whole, d) for d in rl.shorter()} | {_form("g", d, rl.whole) for d in rf.shorter()}


def typed_forms(text: str | None) -> dict[int, float]:
    """All forms of a name as typed, with the weight of the rewriting: any order of the parts, any one part left out.

    The number of forms grows with the letters of the text, and with its letters times its parts up to MANY parts."""
    ts = tokens(text)
    out: dict[int, float] = {}
    if len(ts) < 2:
        return {_form("x", 0, _hash(ts[0])): WEIGHTS["x"]} if ts else out

    def put(form: int, weight: float) -> None:
        if weight > out.get(form, 0.0):
            out[form] = weight

    versions = [(ts, 1.0)]
    if 2 < len(ts) <= MANY:
        versions += [(ts[:i] + ts[i + 1 :], DROPPED) for i in range(len(ts))]
    for v, w in versions:
        for f, l in {("".join(v[:-1]), v[-1]), ("".join(v[1:]), v[0])}:  # noqa: E741
            rf, rl = Rolled(f), Rolled(l)
            put(_form("x", rf.whole, rl.whole), WEIGHTS["x"] * w)
            if len(f) == 1:
                put(_form("i", rf.whole, rl.whole), WEIGHTS["i"] * w)
                continue
            errors = rl.shorter()
            for full in _NICK.get(f, ()):
                put(_form("x", _hash(full), rl.whole), WEIGHTS["n"] * w)
                for d in errors if w == 1.0 else ():
                    put(_form("e", _hash(full), d), WEIGHTS["n"] * WEIGHTS["e"])
            put(_form("h", rf.head(2), rl.whole), WEIGHTS["h"] * w)
            if len(l) >= 4:
                put(_form("p", rf.whole, rl.whole), WEIGHTS["p"] * w)
            for d in errors:
                put(_form("e", rf.whole, d), WEIGHTS["e"] * w)
            for d in rf.shorter():
                put(_form("g", d, rl.whole), WEIGHTS["e"] * w)
    if len(ts) > MANY:
        for rest, last, more in ((ts[:-1], ts[-1], ts[-2]), (ts[1:], ts[0], ts[1])):
            joined, at = Rolled("".join(rest)), 0
            for t in rest:  # one part of the first name left out
                put(_form("x", joined.without(at, at + len(t)), _hash(last)), DROPPED)
                at += len(t)
            cut = joined.without(0, len(more)) if more is ts[1] else joined.head(at - len(more))
            put(_form("x", cut, _hash(more)), DROPPED)  # the last name left out
    return out


def _fifths(n: int) -> list[tuple[int, int]]:
    return [(i * n // 5, (i + 1) * n // 5) for i in range(5)]


def whole_pieces(word: str) -> list[int]:
    """The fifths of a registered word: two errors, also swaps over a border, leave one as it is, moved by two letters at most."""
    r, n = Rolled(word), len(word)
    return [_form("d", 4 * n + i, r.piece(a, b)) for i, (a, b) in enumerate(_fifths(n))] if n >= 7 else []


def moved_pieces(word: str) -> list[int]:
    """Where a fifth of a registered word that is two errors away can stand in the word as typed."""
    r, m = Rolled(word), len(word)
    return [_form("d", 4 * n + i, r.piece(a + shift, b + shift)) for n in range(max(7, m - 2), m + 3) if m >= 7 for i, (a, b) in enumerate(_fifths(n)) for shift in range(-2, 3) if 0 <= a + shift and b + shift <= m]


def _both_orders(text: str | None) -> set[str]:
    ts = tokens(text)
    return {"".join(ts), "".join(ts[-1:] + ts[:-1]), "".join(ts[1:] + ts[:1])}


def registered_pieces(text: str | None) -> set[int]:
    return {h for w in _both_orders(text) for h in whole_pieces(w)}


def typed_pieces(text: str | None) -> set[int]:
    return {h for w in _both_orders(text) for h in moved_pieces(w)}


#: Legal forms of clubs, in folded letters, with their short form.
LEGAL = {"bordtenisklub": "btk", "bordtenisforening": "btf", "bordtenissalskap": "bts", "pingisklub": "pk", "idrotsforening": "if", "gymnastikochidrotsforening": "gif", "almanaidrotssalskap": "ais", "sportklub": "sk"}
SHORT = tuple(LEGAL.values())
_TEAM = {"i", "ii", "iii", "iv", "vet", "veteran", "ungdom", "junior", "dam", "her", "damer", "herar", *"123456789", "och"}
_LONG_WORDS = ("bordtenisklub", "bordtenisforening", "bordtenissalskap", "pingisklub", "idrotsforening", "almana", "idrotssalskap", "sportklub", "gymnastik", "forening")


def distance(a: str, b: str, most: int) -> int:
    """Edit distance with swaps of neighbours; most + 1 if it is above most."""
    if abs(len(a) - len(b)) > most:
        return most + 1
    before: list[int] = []
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        now = [i]
        for j, y in enumerate(b, 1):
            v = min(row[j] + 1, now[j - 1] + 1, row[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                v = min(v, before[j - 2] + 1)
            now.append(v)
        if min(now) > most and (i < 2 or min(row) > most):
            return most + 1
        before, row = row, now
    return min(row[-1], most + 1)


@lru_cache(50_000)
def _legal_word(w: str) -> str | None:
    """The long word of a legal form that a part stands for, with its ending and up to two errors."""
    if len(w) < 5:
        return None
    for known in _LONG_WORDS:
        for ending in ("", "en", "et"):
            full = known + ending
            if distance(w, full, 2 if len(full) > 8 else 1) <= (2 if len(full) > 8 else 1):
                return known
    return None


@lru_cache(50_000)
def club_name(text: str | None) -> tuple[str, str]:
    """Place and short legal form ('' if there is none) of a club as typed, joined and folded."""
    place: list[str] = []
    words: list[str] = []
    short = ""
    ts = tokens(re.sub(r"(?i)\blag\s+\w\b", " ", text) if text else text)
    joined: list[tuple[str, bool]] = []
    for t in ts:  # B.T.F. and B T F
        if len(t) == 1 and joined and joined[-1][1]:
            joined[-1] = (joined[-1][0] + t, True)
        else:
            joined.append((t, len(t) == 1))
    for t, _ in joined:
        if t in SHORT and not short:
            short = t
        elif t in _TEAM and len(joined) > 1:
            continue
        elif known := _legal_word(t):
            words.append(known)
        else:
            place.append(t)
    if words and not short:
        long = "".join(w for w in words)
        long = "gymnastikochidrotsforening" if "gymnastik" in words else long
        short = LEGAL.get(long, "")
    p = "".join(place)
    if words and p.endswith("s"):
        p = p[:-1]
    return p, short


CLUB_WEIGHTS = {"x": 1.0, "e": 0.8, "o": 0.75, "p": 0.7, "d": 0.6}
CLUB_RARITY = 0.05  # how much a form tells less for each e-fold of clubs that have it


def club_registered_forms(place: str | None, short: str | None) -> dict[int, float]:
    """Forms of a registered club, read into place and legal form. The weights are there for the two-error forms only."""
    if not place:
        return {}
    short = short or ""
    p, whole = Rolled(place), Rolled(place + short)
    out = dict.fromkeys([_form("x", 0, whole.whole), _form("o", 0, p.whole)], 1.0)
    out |= dict.fromkeys((_form("e", 0, d) for d in whole.shorter()), 1.0)
    return out | dict.fromkeys((_form("p", p.head(k), _hash(short)) for k in range(3, len(place))), 1.0)


def _readings(place: str, short: str) -> set[tuple[str, str]]:
    out = {(place, short)}
    if short and place.endswith("s"):
        out.add((place[:-1], short))
    if not short:  # written as one word
        out |= {(place[: -len(s)], s) for s in SHORT if place.endswith(s) and len(place) > len(s) + 3}
    return {(p, s) for p, s in out if p}


def club_typed_forms(place: str | None, short: str | None) -> dict[int, float]:
    """Forms of a club as typed: with place and legal form, without, with a cut place, with a typing error."""
    out: dict[int, float] = {}
    for p, s in _readings(place or "", short or ""):
        whole = Rolled(p + s)
        new = {_form("x", 0, whole.whole): CLUB_WEIGHTS["x"]}
        if not s:
            new[_form("o", 0, Rolled(p).whole)] = CLUB_WEIGHTS["o"]
        if len(p) >= 3:
            new[_form("p", Rolled(p).whole, _hash(s))] = CLUB_WEIGHTS["p"]
        for d in whole.shorter():
            new.setdefault(_form("e", 0, d), CLUB_WEIGHTS["e"])
        for k, w in new.items():
            out[k] = max(out.get(k, 0.0), w)
    return out


def club_registered_pieces(place: str | None, short: str | None) -> dict[int, float]:
    return dict.fromkeys(whole_pieces(place + (short or "")) if place else [], 1.0)


def club_typed_pieces(place: str | None, short: str | None) -> dict[int, float]:
    return dict.fromkeys((h for p, s in _readings(place or "", short or "") for h in moved_pieces(p + s)), CLUB_WEIGHTS["d"])


def explode_forms(df: DataFrame, key: list[str], args: list[str], forms: Callable, weighted: bool) -> DataFrame:
    """key, form (a number, see _form) and weight: one row per form of each name. A map in Arrow batches.

    Spark takes the result to be as small as the names, so joins on form are merges by hint: else the forms of a small table
    of names, some fifty times as large, would be broadcast through the driver."""
    schema = T.StructType([df.schema[k] for k in key] + [T.StructField("form", T.LongType())] + ([T.StructField("weight", T.FloatType())] if weighted else []))

    def run(batches: Iterator[pd.DataFrame]) -> Iterable[pd.DataFrame]:
        for pdf in batches:
            for start in range(0, len(pdf), 500):
                part = pdf.iloc[start : start + 500]
                at, out, weights = [], [], []
                for i, values in enumerate(zip(*[part[a] for a in args], strict=True)):
                    got = forms(*[None if v is None or v != v else v for v in values])
                    at += [i] * len(got)
                    out += got
                    if weighted:
                        weights += got.values()
                res = part[key].iloc[at].reset_index(drop=True)
                res["form"] = np.array(out, dtype="int64")
                if weighted:
                    res["weight"] = np.array(weights, dtype="float32")
                yield res

    return df.select(*dict.fromkeys(key + args)).mapInPandas(run, schema)


def read_clubs(df: DataFrame, text: str) -> DataFrame:
    """df with place and short: the club's name read. A map in Arrow batches."""

    @F.pandas_udf("place string, short string")
    def read(c: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([club_name(x) for x in c], columns=["place", "short"])

    return df.withColumn("_read", read(text)).select(*df.columns, "_read.place", "_read.short")


def _swapped(typed: Column, registered: Column) -> Column:
    """Whether two names are at most two errors apart, swaps of neighbours counted as one: for names further by plain edits."""

    @F.pandas_udf("boolean")
    def near(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([distance(x, y, 2) <= 2 for x, y in zip(a, b, strict=True)], dtype=bool)

    return near(typed, registered)


def match_clubs(texts: DataFrame, registry: DataFrame) -> DataFrame:
    """text, club_id, score (weight of the best shared form, by its rarity), far (least edit distance to a name of the club):
    one row per club that shares a form with the text.

    Forms of typed and registered clubs are equi-joined, whatever the number of clubs. A text that shares none is searched
    with two errors: candidates share a fifth of the name, and are kept if they are two errors apart."""
    reg = stash(read_clubs(registry.select("club_id", "name").distinct(), "name"), "clubsread")
    typed = stash(read_clubs(texts.select("text").distinct(), "text"), "textsread")
    names = reg.select("club_id", F.col("place").alias("p"), F.col("short").alias("s")).filter("p <> ''").distinct()

    def met(of: DataFrame, typed_by: Callable, registered_by: Callable) -> DataFrame:
        index = explode_forms(reg, ["club_id"], ["place", "short"], registered_by, False).groupBy("form").agg(F.collect_set("club_id").alias("_clubs"))  # bounded: clubs
        hit = explode_forms(of, ["text"], ["place", "short"], typed_by, True).hint("merge").join(index, "form")
        told = F.col("weight").cast("double") / (1 + CLUB_RARITY * F.log(F.size("_clubs").cast("double")))
        hit = hit.select("text", told.alias("told"), F.explode("_clubs").alias("club_id"))
        return hit.groupBy("text", "club_id").agg(F.max("told").alias("score")).join(of, "text").join(names, "club_id")

    apart = F.levenshtein(F.concat("place", "short"), F.concat("p", "s"))
    far = F.when(F.col("short") == "", F.least(apart, F.levenshtein("place", "p"))).otherwise(apart)
    near = stash(met(typed, club_typed_forms, club_registered_forms).groupBy("text", "club_id").agg(F.max("score").alias("score"), F.min(far).alias("far")), "clubsnear")
    rest = typed.join(near.select("text").distinct(), "text", "left_anti")
    pairs = met(rest, club_typed_pieces, club_registered_pieces).withColumn("far", far)
    two = pairs.filter(F.col("far") <= 2).unionByName(pairs.filter(F.col("far").between(3, 4)).filter(_swapped(F.concat("place", "short"), F.concat("p", "s"))))
    two = two.groupBy("text", "club_id").agg(F.lit(CLUB_WEIGHTS["d"]).alias("score"), F.min("far").alias("far"))
    return near.unionByName(two)


def resolve_clubs(texts: DataFrame, clubs: DataFrame, unknown: int = 9999) -> DataFrame:
    """text, club_id, score for every distinct text in texts (column text) that can be told.

    clubs: club_id, shortname, longname, remarks (former names after "tidigare"). The best rewriting wins; among clubs that share
    it the text is told only if one is nearest, else it is left out. Null and empty texts and the unknown club give no row.
    """
    name = F.explode(F.array("shortname", "longname", F.nullif(F.trim(F.regexp_extract(F.coalesce("remarks", F.lit("")), r"(?i)tidigare\s+(.+)$", 1)), F.lit("")), F.col("shortname")))
    registry = clubs.filter(F.col("club_id") != unknown).select("club_id", name.alias("name")).filter("name is not null").distinct()
    exact = registry.select(F.col("name").alias("text"), "club_id").groupBy("text").agg(F.min("club_id").alias("club_id"), F.countDistinct("club_id").alias("n")).filter("n = 1").select("text", "club_id", F.lit(2.0).alias("score"))
    texts = stash(texts.filter("text is not null").select("text").distinct(), "clubtexts")
    near = stash(match_clubs(texts.join(exact, "text", "left_anti"), registry), "clubpairs")
    top = near.groupBy("text").agg(F.max(F.struct("score", -F.col("far"))).alias("m")).select("text", F.col("m.score").alias("score"), (-F.col("m.col2")).alias("far"))
    sole = near.join(top, ["text", "score", "far"]).groupBy("text").agg(F.min("club_id").alias("club_id"), F.max("score").alias("score"), F.count(F.lit(1)).alias("n")).filter("n = 1")
    return texts.join(exact, "text").unionByName(sole.select("text", "club_id", "score"))
