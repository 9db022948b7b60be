"""Queries of scalar functions: dates, names, scores, ids, JSON; and of the staging operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import scalars as S
from ..functions import text as X
from ..operators import relational as R
from ..operators import staging as G
from ..session import table

QUERIES: dict = {}
ORACLES: dict[str, str] = {}
#: For demonstration only; real salts are the caller's.
DEMO_SALT = "demo salt"


def query(sql: str | None):  # noqa: ANN201
    def add(f):  # noqa: ANN001, ANN202
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def queries() -> dict:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)


def _pads(salt: str) -> tuple[str, str]:
    key = salt.encode().ljust(64, b"\0")
    return bytes(b ^ 0x36 for b in key).hex(), bytes(b ^ 0x5C for b in key).hex()


@query(f"""SELECT c_custkey, sha256(unhex('{_pads(DEMO_SALT)[1]}') || unhex(sha256(unhex('{_pads(DEMO_SALT)[0]}') || encode(CAST(c_custkey AS VARCHAR))))) AS public_id FROM customer""")
def q_hmac_id(s: SparkSession, d: str) -> DataFrame:
    """Opaque public ids under a salt given by the caller."""
    return table(s, d, "customer").select("c_custkey", S.opaque_id(DEMO_SALT, F.col("c_custkey")).alias("public_id"))


def _key(c: str) -> str:
    """The normal key in SQL: the Nordic letters are put aside while marks are stripped."""
    plain = f"lower(trim(regexp_replace(regexp_replace({c}, '[-/]', ' ', 'g'), '\\s+', ' ', 'g')))"
    return f"translate(strip_accents(translate(replace({plain}, 'ö', 'ø'), 'åäøæ', '<>^=')), '<>^=', 'åäøæ')"


@query(f"""SELECT row_id, sha256(concat_ws('|', coalesce({_key("firstname")}, ''), coalesce({_key("lastname")}, ''), coalesce(CAST(date_born AS VARCHAR), ''), coalesce({_key("club_from")}, ''), coalesce(CAST(data_source_id AS VARCHAR), ''))) AS hash FROM player_transition_raw""")
def q_content_hash(s: SparkSession, d: str) -> DataFrame:
    """Hash of a row's values, texts by their normal key."""
    t = table(s, d, "player_transition_raw")
    return t.select("row_id", G.content_hash(t, ["firstname", "lastname", "date_born", "club_from", "data_source_id"]).alias("hash"))


#: Written by hand: letters as one sign and with the mark after it, separators, Nordic letters, apostrophes.
AWKWARD = ["  Virum-Sorgenfri   BTK ", "Hilleröd GI", "Hillerød GI", "Café", "Cafe\u0301", "Dvořák", "Dvor\u030ca\u0301k", "Åsa Ek", "A\u030asa Ek", "O'Neil", "anna-karin o'neil", "ÇELİK", "Škoda/Žižkov", "Ngũgĩ", "", " - "]


@query(f"""WITH n AS (SELECT shortname AS name FROM club UNION SELECT longname FROM club UNION SELECT club_from FROM player_transition_raw UNION SELECT firstname FROM player UNION SELECT * FROM (VALUES {', '.join("('" + a.replace("'", "''") + "')" for a in AWKWARD)}) v(name))
SELECT name, {_key("name")} AS key, trim(regexp_replace(regexp_replace(strip_accents(replace(replace(lower(name), 'ø', 'o'), 'æ', 'a')), '[^a-z0-9\\s]', ' ', 'g'), '\\s+', ' ', 'g')) AS ascii FROM n WHERE name IS NOT NULL""")
def q_text_keys(s: SparkSession, d: str) -> DataFrame:
    """Normal and plain keys of clubs, first names and names written by hand, however their marks are written."""
    t = lambda n, c: table(s, d, n).select(F.col(c).alias("name"))
    names = t("club", "shortname").union(t("club", "longname")).union(t("player_transition_raw", "club_from")).union(t("player", "firstname")).union(s.createDataFrame([(a,) for a in AWKWARD], "name string")).filter("name is not null").distinct()
    return names.select("name", S.normalize_key(F.col("name")).alias("key"), S.ascii_key(F.col("name")).alias("ascii"))


#: Class names written by hand with the type they have: short name, long name, type.
CLASS_NAMES = [
    ("HD1", None, 2), ("Herrlag", None, 4), ("Mixeddubbel", None, 2), ("XB2", None, 9), ("P12", "Pojkar 12", 1), ("HJD18", "Herrjuniordubbel", 2), ("MD21", None, 2), ("WD", None, 2), ("MXD A", None, 2), ("HL1", None, 4), ("DL2", None, 4), ("S21", None, 1), ("Klass 3", None, 1), ("Elit", None, 1),
    ("DS", "Damer singel", 1), ("Mixed", None, 1), ("A", "öppen mixed klass", 2), ("A", "singel mixed klass", 1), ("PD14", "Pojkdubbel", 2), ("F D 12", "Flickor", 1), ("U11 FD", None, 2), ("Teams", None, 4), ("X", "Team event", 4), ("xg 1", None, 9), ("", "", 1), (None, None, 1), ("Hv40", "Herrar veteran 40", 1), ("DLAG", None, 4), ("H3", "Familjedubbel", 2),
]


def _text(v: str | None) -> str:
    return "CAST(NULL AS VARCHAR)" if v is None else "'" + v.replace("'", "''") + "'"


@query("SELECT * FROM (VALUES " + ", ".join(f"({_text(a)}, {_text(b)}, {n})" for a, b, n in CLASS_NAMES) + ") v(shortname, longname, type)")
def q_class_types(s: SparkSession, d: str) -> DataFrame:
    """The type of classes by name, against types told by hand."""
    names = s.createDataFrame([(a, b) for a, b, _ in CLASS_NAMES], "shortname string, longname string")
    return names.select("shortname", "longname", S.class_type(F.col("shortname"), F.col("longname")).alias("type"))


@query("""WITH m AS (SELECT tournament_class_id_ext AS class_id, count(*) AS n FROM tournament_class_match_raw GROUP BY 1) SELECT class_id, CASE WHEN n = 1 THEN 'Final' WHEN n = 2 THEN 'RO4/SF' WHEN n = 4 THEN 'RO8/QF' WHEN n > 4 THEN 'RO' || (2 * n) ELSE 'Round' END AS round_name, CASE n WHEN 1 THEN 8 WHEN 2 THEN 7 WHEN 4 THEN 6 WHEN 8 THEN 5 WHEN 16 THEN 4 WHEN 32 THEN 3 WHEN 64 THEN 2 END AS stage_id FROM m""")
def q_round_names(s: SparkSession, d: str) -> DataFrame:
    """Names and stages of rounds of as many matches as each class has."""
    n = table(s, d, "tournament_class_match_raw").groupBy(F.col("tournament_class_id_ext").alias("class_id")).agg(F.count(F.lit(1)).alias("n"))
    return n.select("class_id", S.round_name(F.col("n")).alias("round_name"), S.stage_of_matches(F.col("n")).alias("stage_id"))


@query("""SELECT row_id, CASE WHEN season_label IS NULL THEN NULL ELSE CASE WHEN length(y) = 4 THEN CAST(y AS INTEGER) WHEN length(y) = 2 THEN 2000 + CAST(y AS INTEGER) END END AS season, CASE WHEN p = '' THEN NULL ELSE p END AS person,
CASE WHEN length(b) = 4 THEN CAST(b AS INTEGER) WHEN length(b) = 2 THEN CASE WHEN CAST(b AS INTEGER) <= 25 THEN 2000 ELSE 1900 END + CAST(b AS INTEGER) END AS born
FROM (SELECT row_id, season_label, regexp_extract(season_label, '([0-9]{4}|[0-9]{2})\\s*[-/–]\\s*(?:[0-9]{4}|[0-9]{2})', 1) AS y, regexp_extract(player_id_ext, '^\\s*0*([0-9]+)(?:\\.0+)?\\s*$', 1) AS p,
CASE WHEN regexp_matches(trim(year_born), '^(18|19|20)[0-9]{2}([-./].*|\\.0)?$') THEN left(trim(year_born), 4) WHEN regexp_matches(trim(year_born), '^[0-9]{2}$') THEN trim(year_born) END AS b FROM player_license_raw)""")
def q_dirty_values(s: SparkSession, d: str) -> DataFrame:
    """Seasons, numbers and years written in several ways, read without ever failing on a bad one."""
    lic = table(s, d, "player_license_raw")
    return lic.select("row_id", X.season_start(F.col("season_label")).alias("season"), X.digits_id("player_id_ext").alias("person"), X.year_of(F.col("year_born")).alias("born"))


@query("""SELECT o_orderkey, CAST(year(o_orderdate) - CASE WHEN month(o_orderdate) < 7 THEN 1 ELSE 0 END AS INTEGER) AS season,
(year(o_orderdate) - CASE WHEN month(o_orderdate) < 7 THEN 1 ELSE 0 END) || '-' || lpad(CAST((year(o_orderdate) - CASE WHEN month(o_orderdate) < 7 THEN 1 ELSE 0 END + 1) % 100 AS VARCHAR), 2, '0') AS label FROM orders""")
def q_season_label(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "orders").select("o_orderkey", S.season_year(F.col("o_orderdate")).alias("season"), S.season_label(F.col("o_orderdate")).alias("label"))


@query("""WITH x AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day FROM orders) SELECT o_orderkey, CAST(day AS VARCHAR) AS iso, CAST(day AS VARCHAR) AS dotted, CAST(day AS VARCHAR) AS packed, CAST(NULL AS VARCHAR) AS bad, CAST(CASE WHEN day(day) = 31 AND month(day) IN (1, 3, 5, 8, 10) THEN NULL ELSE make_date(CAST(year(day) AS INTEGER), CAST(month(day) AS INTEGER), CAST(day(day) AS INTEGER)) END AS VARCHAR) AS same_day FROM x""")
def q_dates(s: SparkSession, d: str) -> DataFrame:
    """Three written forms of a date, a bad one, and a day that its month may not have."""
    o = table(s, d, "orders").withColumn("day", F.to_date("o_orderdate"))
    own = S.day_in_month(F.col("day"), F.dayofmonth("day"))
    shorter = F.when((F.dayofmonth("day") == 31) & F.month("day").isin(1, 3, 5, 8, 10), S.day_in_month(F.make_date(F.year("day"), F.lit(6), F.lit(1)), F.dayofmonth("day"))).otherwise(own)
    return o.select("o_orderkey", *[S.parse_date(F.date_format("day", f)).cast("string").alias(n) for f, n in (("yyyy-MM-dd", "iso"), ("yyyy.MM.dd", "dotted"), ("yyyyMMdd", "packed"))], S.parse_date(F.date_format("day", "dd/MM")).cast("string").alias("bad"), shorter.cast("string").alias("same_day"))


@query("""SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 6 WHEN CAST(o_orderdate AS DATE) + 5 < DATE '1998-01-01' THEN 3 WHEN CAST(o_orderdate AS DATE) > DATE '1998-01-01' THEN 1 ELSE 2 END AS status FROM orders""")
def q_status_case(s: SparkSession, d: str) -> DataFrame:
    """Status from two dates against a given day; unknown if one is missing."""
    start = F.to_date("o_orderdate")
    end = F.when(F.col("o_orderstatus") != "P", F.date_add(start, 5))
    return table(s, d, "orders").select("o_orderkey", S.event_status(start, end, F.lit("1998-01-01").cast("date")).alias("status"))


_TOKENS = "regexp_extract_all(regexp_replace(upper(game_point_tokens), 'WO(:S[12])?', '', 'g'), '[+-]?[0-9]+')"


@query(f"""WITH t AS (SELECT row_id, game_point_tokens AS g, best_of, {_TOKENS} AS tok, regexp_extract(upper(game_point_tokens), 'WO:S([12])', 1) AS wo FROM tournament_class_match_raw),
c AS (SELECT *, len(list_filter(tok, lambda x: NOT starts_with(x, '-'))) AS w1, len(list_filter(tok, lambda x: starts_with(x, '-'))) AS w2 FROM t)
SELECT row_id, CASE WHEN g IS NULL THEN NULL ELSE array_to_string(list_transform(tok, lambda x: CASE WHEN starts_with(x, '-') THEN CAST(abs(CAST(x AS INTEGER)) AS VARCHAR) || '-' || CAST(CASE WHEN abs(CAST(x AS INTEGER)) >= 10 THEN abs(CAST(x AS INTEGER)) + 2 ELSE 11 END AS VARCHAR)
ELSE CAST(CASE WHEN abs(CAST(x AS INTEGER)) >= 10 THEN abs(CAST(x AS INTEGER)) + 2 ELSE 11 END AS VARCHAR) || '-' || CAST(abs(CAST(x AS INTEGER)) AS VARCHAR) END), ', ') END AS games,
CASE WHEN wo IN ('1', '2') THEN 3 - CAST(wo AS INTEGER) WHEN g IS NULL THEN NULL WHEN w1 >= coalesce(best_of, len(tok)) // 2 + 1 THEN 1 WHEN w2 >= coalesce(best_of, len(tok)) // 2 + 1 THEN 2 END AS winner,
CASE WHEN len(tok) > 0 THEN CAST(2 * greatest(w1, w2) - 1 AS INTEGER) END AS inferred_best_of FROM c""")
def q_token_decode(s: SparkSession, d: str) -> DataFrame:
    """Scores decoded: points of each game, winner, number of games the match was over."""
    m = table(s, d, "tournament_class_match_raw")
    tok = S.signed_tokens(F.regexp_replace(F.upper("game_point_tokens"), r"WO(:S[12])?", ""))
    games = F.array_join(F.transform(S.decode_games(tok), lambda g: F.concat(g["side1"].cast("string"), F.lit("-"), g["side2"].cast("string"))), ", ")
    return m.select("row_id", games.alias("games"), S.match_winner(F.col("game_point_tokens"), F.col("best_of")).alias("winner"), S.best_of(tok).alias("inferred_best_of"))


@query("""SELECT event_id, json_extract_string(props, '$.k') AS k, user_id || '/' || event_type AS path FROM events""")
def q_json_flatten(s: SparkSession, d: str) -> DataFrame:
    e = table(s, d, "events").withColumn("m", F.from_json("props", T.MapType(T.StringType(), T.StringType())))
    return e.select("event_id", F.col("m")["k"].alias("k"), F.concat(F.col("user_id").cast("string"), F.lit("/"), "event_type").alias("path"))


@query("""SELECT event_id, event_type AS class_id, 'stage' AS path FROM events""")
def q_url_parts(s: SparkSession, d: str) -> DataFrame:
    """Parts of URLs: here of made ones, so that the answer is known."""
    url = F.concat(F.lit("https://example.org/stage?classID="), F.col("event_type"), F.lit("&x=1"))
    e = table(s, d, "events").withColumn("u", url)
    return e.select("event_id", F.expr("parse_url(u, 'QUERY', 'classID')").alias("class_id"), F.expr("substr(parse_url(u, 'PATH'), 2)").alias("path"))


@query("""SELECT club_id, trim(regexp_replace(regexp_replace(translate(lower(shortname), 'åäöéü', 'aaoeu'), '[^a-z0-9\\s]', ' ', 'g'), '\\s+', ' ', 'g')) AS ascii, translate(trim(regexp_replace(regexp_replace(lower(shortname), '[-/]', ' ', 'g'), '\\s+', ' ', 'g')), 'öéü', 'øeu') AS nordic FROM club""")
def q_text_normalize(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "club").select("club_id", S.ascii_key(F.col("shortname")).alias("ascii"), S.normalize_key(F.col("shortname")).alias("nordic"))


@query("""SELECT player_id, array_to_string(list_transform(string_split(trim(regexp_replace(lower(firstname), '\\s+', ' ', 'g')), ' '), lambda w: array_to_string(list_transform(string_split(w, '-'), lambda x: array_to_string(list_transform(string_split(x, chr(39)), lambda y: upper(left(y, 1)) || substr(y, 2)), chr(39))), '-')), ' ') AS titled FROM player WHERE firstname IS NOT NULL""")
def q_title_case(s: SparkSession, d: str) -> DataFrame:
    """First names with capitals after blanks, hyphens and apostrophes."""
    return table(s, d, "player").filter("firstname is not null").select("player_id", S.title_case(F.col("firstname")).alias("titled"))


@query("""SELECT p_partkey, CASE WHEN p_type LIKE '%BRASS%' THEN 4 WHEN regexp_matches(p_type, '^(PROMO|STANDARD)') THEN 1 ELSE 9 END AS kind, CAST(regexp_extract(p_brand, '[0-9]+') AS INTEGER) AS brand_no FROM part""")
def q_regex_class_rules(s: SparkSession, d: str) -> DataFrame:
    """Ordered rules on text, first integer in a text."""
    t = F.col("p_type")
    return table(s, d, "part").select("p_partkey", F.when(t.contains("BRASS"), 4).when(t.rlike("^(PROMO|STANDARD)"), 1).otherwise(9).alias("kind"), S.first_int(F.col("p_brand")).alias("brand_no"))


@query("""WITH v AS (SELECT row_id, regexp_extract(license_info_raw, '^\\s*(\\S*licens)(?:\\s+([^(\\s][^(]*?))?\\s*\\(([^)]*)\\)\\s*$', 1) AS kind, regexp_extract(license_info_raw, '^\\s*(\\S*licens)(?:\\s+([^(\\s][^(]*?))?\\s*\\(([^)]*)\\)\\s*$', 2) AS age, regexp_extract(license_info_raw, '^\\s*(\\S*licens)(?:\\s+([^(\\s][^(]*?))?\\s*\\(([^)]*)\\)\\s*$', 3) AS day FROM player_license_raw)
SELECT row_id, nullif(kind, '') AS kind, CASE WHEN kind <> '' THEN nullif(age, '') END AS age, CASE WHEN kind <> '' AND regexp_matches(day, '^[0-9]{4}[.-][0-9]{2}[.-][0-9]{2}$') THEN CAST(try_cast(replace(day, '.', '-') AS DATE) AS VARCHAR) END AS day FROM v""")
def q_licence_parts(s: SparkSession, d: str) -> DataFrame:
    parts = S.licence_parts(F.col("license_info_raw"))
    return table(s, d, "player_license_raw").select("row_id", parts.alias("x")).select("row_id", "x.kind", "x.age", F.col("x.day").cast("string").alias("day"))


@query("""WITH v AS (SELECT row_id, concat_ws(';', CASE WHEN coalesce(trim(firstname), '') = '' OR coalesce(trim(lastname), '') = '' THEN 'name' END, CASE WHEN player_id_ext IS NULL THEN 'person' END, CASE WHEN NOT coalesce(regexp_matches(trim(year_born), '^(18|19|20)[0-9]{2}$'), false) THEN 'year' END, CASE WHEN club_id_ext IS NULL THEN 'club' END) AS r FROM player_license_raw)
SELECT CASE WHEN r = '' THEN 'success' ELSE 'failed' END AS status, nullif(r, '') AS reason, count(*) AS n FROM v GROUP BY 1, 2""")
def q_status_reason_tally(s: SparkSession, d: str) -> DataFrame:
    """Validation with all reasons of each row, counted by status and reason."""
    filled = lambda c: F.trim(c) != ""
    rules = [("name", filled("firstname") & filled("lastname")), ("person", F.col("player_id_ext").isNotNull()), ("year", F.trim("year_born").rlike("^(18|19|20)[0-9]{2}$")), ("club", F.col("club_id_ext").isNotNull())]
    checked = G.check_rows(table(s, d, "player_license_raw"), rules)
    return G.run_summary(checked.select(F.when(F.col("reasons").isNull(), "success").otherwise("failed").alias("status"), F.col("reasons").alias("reason")))


@query("""SELECT count(*) AS processed, count(*) FILTER (WHERE player_id_ext IS NOT NULL) AS ok, count(*) FILTER (WHERE player_id_ext IS NULL) AS failed, true AS adds_up FROM player_license_raw""")
def q_accounting(s: SparkSession, d: str) -> DataFrame:
    """Processed rows are those that went well and those that failed."""
    out = table(s, d, "player_license_raw").agg(F.count(F.lit(1)).alias("processed"), F.count("player_id_ext").alias("ok"), F.count_if(F.col("player_id_ext").isNull()).alias("failed"))
    return out.withColumn("adds_up", F.col("processed") == F.col("ok") + F.col("failed"))


def _versions(s: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """All orders, and all of them again as a later version: numbers moved by 96, other states for every fourth."""
    o = table(s, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", F.round("o_totalprice", 2).alias("price"))
    later = o.withColumn("o_orderkey", F.col("o_orderkey") + 96).withColumn("o_orderstatus", F.when(F.col("o_orderkey") % 4 == 0, "X").otherwise(F.col("o_orderstatus")))
    return o, later


_LATER = "t AS (SELECT o_orderkey, o_custkey, o_orderstatus, round(o_totalprice, 2) AS price FROM orders), s AS (SELECT o_orderkey + 96 AS o_orderkey, o_custkey, CASE WHEN (o_orderkey + 96) % 4 = 0 THEN 'X' ELSE o_orderstatus END AS o_orderstatus, round(o_totalprice, 2) AS price FROM orders)"


@query(f"""WITH {_LATER} SELECT coalesce(t.o_orderkey, s.o_orderkey) AS o_orderkey, CASE WHEN s.o_orderkey IS NULL THEN t.o_orderstatus ELSE s.o_orderstatus END AS o_orderstatus,
CASE WHEN t.o_orderkey IS NULL THEN 'inserted' WHEN s.o_orderkey IS NULL THEN 'kept' WHEN t.o_orderstatus IS DISTINCT FROM s.o_orderstatus OR t.o_custkey IS DISTINCT FROM s.o_custkey OR t.price IS DISTINCT FROM s.price THEN 'updated' ELSE 'unchanged' END AS outcome FROM t FULL JOIN s ON t.o_orderkey = s.o_orderkey""")
def q_upsert_outcome(s: SparkSession, d: str) -> DataFrame:
    """Upsert by key with the outcome of every row; outcomes come from the join."""
    t, src = _versions(s, d)
    return G.upsert(t, src, ["o_orderkey"], ["o_orderstatus", "o_custkey", "price"]).select("o_orderkey", "o_orderstatus", "outcome")


@query("""WITH t AS (SELECT o_orderkey + 96 AS k, o_orderkey AS id, o_custkey, o_orderpriority FROM orders), a AS (SELECT k, min(id) AS id1 FROM t GROUP BY 1), b AS (SELECT o_custkey, o_orderpriority, min(id) AS id2 FROM t GROUP BY 1, 2)
SELECT o.o_orderkey AS source_key, coalesce(a.id1, b.id2) AS target_key, CASE WHEN a.id1 IS NOT NULL THEN 1 WHEN b.id2 IS NOT NULL THEN 2 END AS matched_by FROM orders o LEFT JOIN a ON a.k = o.o_orderkey LEFT JOIN b ON b.o_custkey = o.o_custkey AND b.o_orderpriority = o.o_orderpriority""")
def q_two_key_upsert(s: SparkSession, d: str) -> DataFrame:
    """Every order with the one of the earlier version that has its number, else its customer and priority."""
    o = table(s, d, "orders").select(F.col("o_orderkey").alias("source_key"), "o_custkey", "o_orderpriority")
    t = table(s, d, "orders").select((F.col("o_orderkey") + 96).alias("source_key"), F.col("o_orderkey").alias("target_key"), "o_custkey", "o_orderpriority")
    return G.two_key_match(o, t, ["source_key"], ["o_custkey", "o_orderpriority"], "target_key").select("source_key", "target_key", "matched_by")


@query(f"""WITH {_LATER} SELECT o_orderkey, o_orderstatus FROM t UNION ALL SELECT o_orderkey, o_orderstatus FROM s WHERE o_orderkey NOT IN (SELECT o_orderkey FROM t)""")
def q_insert_ignore(s: SparkSession, d: str) -> DataFrame:
    """The earlier version and what only the later one has."""
    t, src = _versions(s, d)
    return G.insert_ignore(t, src, ["o_orderkey"], [F.asc("o_custkey")]).select("o_orderkey", "o_orderstatus")


@query(f"""WITH {_LATER} SELECT o_orderkey, o_custkey, o_orderstatus FROM t WHERE o_orderstatus NOT IN (SELECT o_orderstatus FROM s WHERE o_orderstatus = 'X') AND o_orderkey NOT IN (SELECT o_orderkey FROM s) UNION ALL SELECT o_orderkey, o_custkey, o_orderstatus FROM s""")
def q_delete_replace(s: SparkSession, d: str) -> DataFrame:
    """Orders the later version has again are replaced, the others stay."""
    t, src = _versions(s, d)
    return G.delete_and_replace(t, src, ["o_orderkey"]).select("o_custkey", "o_orderkey", "o_orderstatus")


@query("""WITH g AS (SELECT content_hash, min(row_id) AS survivor FROM player_license_raw GROUP BY 1) SELECT row_id AS loser, survivor FROM player_license_raw JOIN g USING (content_hash) WHERE row_id <> survivor""")
def q_survivor_map(s: SparkSession, d: str) -> DataFrame:
    return G.survivor_map(table(s, d, "player_license_raw"), ["content_hash"], "row_id")


@query("""WITH gone AS (SELECT DISTINCT key_id FROM key_deletion WHERE table_name = 'tournament_class_entry_new') SELECT tournament_class_entry_id, player_id, club_id FROM tournament_class_player_new WHERE tournament_class_entry_id NOT IN (SELECT key_id FROM gone)""")
def q_cascade_delete(s: SparkSession, d: str) -> DataFrame:
    gone = table(s, d, "key_deletion").filter("table_name = 'tournament_class_entry_new'")
    (kept,) = G.cascade_delete(gone, "key_id", [(table(s, d, "tournament_class_player_new"), "tournament_class_entry_id")])
    return kept.select("tournament_class_entry_id", "player_id", "club_id")


@query("""SELECT player_id FROM player WHERE is_verified OR player_id IN (SELECT player_id FROM tournament_class_player_new WHERE player_id IS NOT NULL)""")
def q_purge_orphans(s: SparkSession, d: str) -> DataFrame:
    """Players without the unverified ones that nothing refers to."""
    return G.purge_orphans(table(s, d, "player"), "player_id", ~F.coalesce(F.col("is_verified"), F.lit(False)), [(table(s, d, "tournament_class_player_new"), "player_id")]).select("player_id")


@query("""WITH m AS (SELECT tournament_class_entry_id, min(try_cast(tournament_player_id_ext AS INTEGER)) AS n FROM tournament_class_player_new GROUP BY 1) SELECT e.tournament_class_entry_id, coalesce(m.n, e.seed) AS seed FROM tournament_class_entry_new e LEFT JOIN m USING (tournament_class_entry_id)""")
def q_update_from(s: SparkSession, d: str) -> DataFrame:
    new = table(s, d, "tournament_class_player_new").groupBy("tournament_class_entry_id").agg(F.min(F.col("tournament_player_id_ext").try_cast("int")).alias("seed"))
    return G.update_from(table(s, d, "tournament_class_entry_new").select("tournament_class_entry_id", "seed"), new, ["tournament_class_entry_id"], ["seed"])


@query("""SELECT row_id, lower(trim(s1_fullname_raw)) IN ('wo', 'vakant', 'vacant', 'reserve') AS side1, lower(trim(s2_fullname_raw)) IN ('wo', 'vakant', 'vacant', 'reserve') AS side2 FROM tournament_class_match_raw WHERE lower(trim(s1_fullname_raw)) IN ('wo', 'vakant', 'vacant', 'reserve') OR lower(trim(s2_fullname_raw)) IN ('wo', 'vakant', 'vacant', 'reserve')""")
def q_placeholders(s: SparkSession, d: str) -> DataFrame:
    """Matches with a placeholder on a side."""
    hold = lambda c: F.col(c).rlike(r"(?i)^\s*(wo|vakant|vacant|reserve)\s*$")
    m = table(s, d, "tournament_class_match_raw").select("row_id", hold("s1_fullname_raw").alias("side1"), hold("s2_fullname_raw").alias("side2"))
    return m.filter("side1 or side2")


_PAIRS = """WITH n AS (SELECT DISTINCT shortname AS a FROM club), t AS (SELECT a, string_split(a, ' ') AS p FROM n),
k AS (SELECT DISTINCT a, array_to_string(list_concat(p[i + 1:], p[:i]), ' ') AS key FROM t, unnest(range(0, len(p))) u(i))
"""


@query(_PAIRS + "SELECT m.row_id, k.a AS club FROM tournament_class_match_raw m JOIN k ON m.s1_clubname_raw = k.key")
def q_multikey_names(s: SparkSession, d: str) -> DataFrame:
    """Clubs found under any order of the parts of their names: keys exploded on the small side, one equi-join."""
    k = table(s, d, "club").select(F.col("shortname").alias("club")).distinct().withColumn("key", F.explode(R.name_keys(F.col("club"))))
    m = table(s, d, "tournament_class_match_raw").select("row_id", "s1_clubname_raw")
    return m.join(k, F.col("s1_clubname_raw") == F.col("key")).select("row_id", "club").distinct()


@query("""WITH r AS (SELECT player_id, string_split(fullname_raw, ' ') AS p, year_born FROM player WHERE NOT is_verified AND year_born IS NOT NULL), k AS (SELECT player_id, year_born, lower(firstname) || ' ' || lower(lastname) AS key FROM player WHERE is_verified)
SELECT r.player_id AS unverified, k.player_id AS verified FROM r JOIN k USING (year_born) WHERE len(p) = 2 AND contains(key, lower(p[1])) AND contains(key, lower(p[2]))""")
def q_substring_join(s: SparkSession, d: str) -> DataFrame:
    """Two parts of a name inside another name, within the same year: an equi-join with what is left as a filter."""
    p = table(s, d, "player")
    r = p.filter("not is_verified and year_born is not null").select(F.col("player_id").alias("unverified"), F.split("fullname_raw", " ").alias("p"), "year_born").filter("size(p) = 2")
    k = p.filter("is_verified").select(F.col("player_id").alias("verified"), F.concat(F.lower("firstname"), F.lit(" "), F.lower("lastname")).alias("key"), "year_born")
    both = r.join(k, "year_born").filter(F.contains("key", F.lower(F.element_at("p", 1))) & F.contains("key", F.lower(F.element_at("p", 2))))
    return both.select("unverified", "verified")


@query("""WITH q AS (SELECT DISTINCT lower(club_from) AS q FROM player_transition_raw WHERE length(club_from) >= 3), r AS (SELECT club_id, lower(shortname) AS k FROM club),
c AS (SELECT q, club_id, k, (SELECT count(*) FROM range(1, least(length(q), length(k)) + 1) t(i) WHERE left(q, i) = left(k, i)) AS n FROM q JOIN r ON left(q, 3) = left(k, 3)),
s AS (SELECT q, club_id, max((n * 1.0 / length(q) + n * 1.0 / length(k)) / 2) AS score FROM c GROUP BY 1, 2 HAVING score >= 0.8), b AS (SELECT q, max(score) AS score FROM s GROUP BY 1)
SELECT s.q AS typed, min(club_id) AS club_id FROM s JOIN b ON s.q = b.q AND s.score = b.score GROUP BY 1 HAVING count(*) = 1""")
def q_prefix_match(s: SparkSession, d: str) -> DataFrame:
    """Typed clubs by the club whose name they begin like; a tie is no match."""
    typed = table(s, d, "player_transition_raw").select(F.lower("club_from").alias("typed"))
    clubs = table(s, d, "club").select("club_id", F.lower("shortname").alias("k"))
    return R.prefix_match(typed, "typed", clubs, "k", "club_id").select("typed", "club_id")


@query("""WITH a AS (SELECT player_id, fullname_raw AS n, year_born FROM player WHERE NOT is_verified AND year_born IS NOT NULL AND fullname_raw IS NOT NULL), b AS (SELECT player_id AS p, firstname || ' ' || lastname AS m, year_born FROM player WHERE is_verified AND firstname IS NOT NULL AND lastname IS NOT NULL),
c AS (SELECT player_id, p, CASE WHEN lower(n) = lower(m) THEN 8 ELSE 0 END + len(list_intersect(list_distinct(string_split(lower(n), ' ')), list_distinct(string_split(lower(m), ' ')))) AS score FROM a JOIN b USING (year_born)),
r AS (SELECT *, row_number() OVER (PARTITION BY player_id ORDER BY score DESC, p) AS rn FROM c WHERE score >= 1) SELECT player_id, p AS candidate, CAST(score AS INTEGER) AS score FROM r WHERE rn = 1""")
def q_scored_argmax(s: SparkSession, d: str) -> DataFrame:
    """The best-scored candidate of each row by max_by, within blocks of one year."""
    p = table(s, d, "player")
    a = p.filter("not is_verified and year_born is not null and fullname_raw is not null").select("player_id", F.lower("fullname_raw").alias("n"), "year_born")
    b = p.filter("is_verified and firstname is not null and lastname is not null").select(F.col("player_id").alias("candidate"), F.lower(F.concat_ws(" ", "firstname", "lastname")).alias("m"), "year_born")
    score = F.when(F.col("n") == F.col("m"), 8).otherwise(0) + F.size(F.array_intersect(F.split("n", " "), F.split("m", " ")))
    c = a.join(b, "year_born").withColumn("score", score).filter("score >= 1")
    return c.groupBy("player_id").agg(F.max_by(F.struct("candidate", "score"), F.struct("score", -F.col("candidate"))).alias("b")).select("player_id", "b.candidate", "b.score")


@query("""WITH a AS (SELECT player_id, lower(fullname_raw) AS n, year_born FROM player WHERE NOT is_verified), b AS (SELECT player_id AS p, lower(firstname || ' ' || lastname) AS m, lower(lastname || ' ' || firstname) AS t, year_born FROM player WHERE is_verified),
c AS (SELECT player_id, p, 0 AS k FROM a JOIN b ON n = m AND a.year_born = b.year_born UNION ALL SELECT player_id, p, 1 FROM a JOIN b ON n = m UNION ALL SELECT player_id, p, 2 FROM a JOIN b ON n = t),
u AS (SELECT player_id, k, min(p) AS p FROM c GROUP BY 1, 2 HAVING count(DISTINCT p) = 1), f AS (SELECT player_id, arg_min(p, k) AS p, min(k) AS k FROM u GROUP BY 1)
SELECT a.player_id, f.p AS candidate, CASE f.k WHEN 0 THEN 'name and year' WHEN 1 THEN 'name' WHEN 2 THEN 'turned name' END AS strategy FROM a LEFT JOIN f USING (player_id)""")
def q_cascade(s: SparkSession, d: str) -> DataFrame:
    """Strategies in order of trust, the first with exactly one candidate wins; all run at once."""
    p = table(s, d, "player")
    a = p.filter("not is_verified").select("player_id", F.lower("fullname_raw").alias("n"), "year_born")
    b = p.filter("is_verified").select(F.col("player_id").alias("candidate"), F.lower(F.concat(F.col("firstname"), F.lit(" "), F.col("lastname"))).alias("m"), F.lower(F.concat(F.col("lastname"), F.lit(" "), F.col("firstname"))).alias("t"), "year_born")
    exact = a.drop("year_born").join(b, F.col("n") == F.col("m"))
    dated = a.join(b, (F.col("n") == F.col("m")) & (a["year_born"] == b["year_born"]))
    turned = a.drop("year_born").join(b, F.col("n") == F.col("t"))
    return R.cascade(a, ["player_id"], [("name and year", dated), ("name", exact), ("turned name", turned)], "candidate")


@query("""WITH t AS (SELECT DISTINCT club_id, unnest(regexp_extract_all(translate(lower(shortname || ' ' || longname), 'åäöéü', 'aaoeu'), '[a-z0-9]+')) AS term FROM club) SELECT term, count(*) AS n_clubs FROM t GROUP BY 1""")
def q_fts_terms(s: SparkSession, d: str) -> DataFrame:
    """Full-text index of the clubs: term and the number of clubs under it."""
    words = F.regexp_extract_all(S.ascii_key(F.concat_ws(" ", "shortname", "longname")), F.lit("[a-z0-9]+"), F.lit(0))
    return table(s, d, "club").select("club_id", F.explode(words).alias("term")).distinct().groupBy("term").agg(F.count(F.lit(1)).alias("n_clubs"))


def _rounds(s: SparkSession, d: str) -> DataFrame:
    side: Column = F.col("represented_entry_id")
    m = table(s, d, "match_side_new").filter("match_id is not null and represented_entry_id is not null")
    return m.select((F.col("match_id") % 97).alias("class_id"), (F.col("match_id") % 4).cast("int").alias("round"), "match_id", "side_no", side.alias("entry"))


@query("""WITH r AS (SELECT match_id % 97 AS class_id, CAST(match_id % 4 AS INTEGER) AS round, match_id, represented_entry_id AS entry, side_no FROM match_side_new WHERE match_id IS NOT NULL AND represented_entry_id IS NOT NULL),
w AS (SELECT class_id, round, match_id, min(entry) AS winner FROM r GROUP BY 1, 2, 3), p AS (SELECT DISTINCT class_id, round, entry FROM r),
x AS (SELECT w.class_id, w.round + 1 AS round, 'missing' AS finding, w.winner AS entry FROM (SELECT DISTINCT class_id, round, winner FROM w) w LEFT JOIN p ON p.class_id = w.class_id AND p.round = w.round + 1 AND p.entry = w.winner WHERE p.entry IS NULL AND w.round < 3
UNION ALL SELECT p.class_id, p.round, 'stray', p.entry FROM p LEFT JOIN (SELECT DISTINCT class_id, round, winner FROM w) w ON w.class_id = p.class_id AND w.round = p.round - 1 AND w.winner = p.entry WHERE w.winner IS NULL AND p.round > 0) SELECT * FROM x""")
def q_bracket_checks(s: SparkSession, d: str) -> DataFrame:
    """Winners missing from the next round, and players who came from nowhere."""
    from ..operators.bracket import advancement_findings

    r = _rounds(s, d)
    w = r.groupBy("class_id", "round", "match_id").agg(F.min("entry").alias("winner"))
    return advancement_findings(r, w, last_round=3)
