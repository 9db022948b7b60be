"""Queries of the resolvers, parsers, registries and of the stream on the record tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import audit, lookups, schemas
from ..operators import documents as D
from ..operators import relational as R
from ..operators import resolve as E
from ..operators import staging as G
from ..session import table
from ..sources import landed
from ..streaming import staging as stream
from . import publication as P

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


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


def q_match_lines(s: SparkSession, d: str) -> DataFrame:
    """All lines of match lists read into numbers, names and scores; quoted scores and null lines included. No SQL can follow
    the quotes; tests read such lines by hand."""
    m = table(s, d, "tournament_class_match_raw").select("row_id", "raw_line_text")
    return D.matches_of_lines(m, "raw_line_text").select("row_id", "match_no", "number1", "name1", "number2", "name2", "tokens")


QUERIES["q_match_lines"] = q_match_lines


@query("""WITH l AS (SELECT player_id_ext, ranking_group_raw, row_number() OVER (PARTITION BY player_id_ext ORDER BY last_seen_at DESC, row_id DESC) AS rn FROM player_license_raw WHERE trim(coalesce(ranking_group_raw, '')) <> '' AND player_id_ext IS NOT NULL)
SELECT DISTINCT player_id_ext AS player_id, trim(x) AS short FROM l, unnest(string_split(ranking_group_raw, ',')) t(x) WHERE rn = 1 AND trim(x) <> ''""")
def q_ranking_groups(s: SparkSession, d: str) -> DataFrame:
    """Each player's groups in the latest list, one per row."""
    raw = table(s, d, "player_license_raw").filter("player_id_ext is not null").select(F.col("player_id_ext").alias("player_id"), "ranking_group_raw", "last_seen_at", "row_id")
    groups = lookups.ranking_groups(s)
    known, unknown = E.ranking_groups(raw, groups)
    return known.join(groups.select("group_id", "short"), "group_id").select("player_id", "short")


_FOLDED = "translate(trim(regexp_replace(regexp_replace(lower({}), '[-/]', ' ', 'g'), '\\s+', ' ', 'g')), 'öàáâãçèéêëìíîïñòóôõùúûüýÿšž', 'øaaaaceeeeiiiinoooouuuuyysz')"
_STRICT = "trim(regexp_replace(regexp_replace(lower({}), '[-/]', ' ', 'g'), '\\s+', ' ', 'g'))"


@query(f"""WITH k AS (SELECT club_id, {_STRICT.format('n')} AS s, {_FOLDED.format('n')} AS r FROM (SELECT club_id, shortname AS n FROM club UNION SELECT club_id, longname FROM club)), t AS (SELECT row_id, club_from, {_STRICT.format('club_from')} AS s, {_FOLDED.format('club_from')} AS r FROM player_transition_raw),
a AS (SELECT s, min(club_id) AS c FROM k GROUP BY 1 HAVING count(DISTINCT club_id) = 1), b AS (SELECT r, min(club_id) AS c FROM k GROUP BY 1 HAVING count(DISTINCT club_id) = 1)
SELECT row_id, coalesce(a.c, b.c, 9999) AS club_id, CASE WHEN a.c IS NOT NULL THEN 'exact' WHEN b.c IS NOT NULL THEN 'relaxed' ELSE 'unknown' END AS club_message FROM t LEFT JOIN a USING (s) LEFT JOIN b ON t.r = b.r""")
def q_club_ladder(s: SparkSession, d: str) -> DataFrame:
    """Typed clubs by the strict key, then the relaxed one, then the unknown club, with a message."""
    rows = table(s, d, "player_transition_raw").select("row_id", "club_from")
    return E.resolve_clubs(rows, "club_from", E.club_keys(table(s, d, "club")), prefix=False).select("row_id", "club_id", "club_message")


def q_club_ladder_with_prefix(s: SparkSession, d: str) -> DataFrame:
    """The same with the best common beginning as a third step."""
    rows = table(s, d, "player_transition_raw").select("row_id", "club_from")
    return E.resolve_clubs(rows, "club_from", E.club_keys(table(s, d, "club"))).select("row_id", "club_id", "club_message")


QUERIES["q_club_ladder_with_prefix"] = q_club_ladder_with_prefix


def _resolved(s: SparkSession, d: str) -> DataFrame:
    raw = table(s, d, "player_license_raw")
    players = raw.filter("player_id_ext is not null").select("player_id_ext", "data_source_id").distinct().withColumn("player_id", F.xxhash64("player_id_ext", "data_source_id"))
    clubs = raw.filter("club_id_ext is not null").select("club_id_ext").distinct().withColumn("club_id", F.xxhash64("club_id_ext"))
    return E.resolve_licences(raw, players, clubs, lookups.seasons(s))


_PARTS = r"'^\s*(\S*licens)(?:\s+([^(\s][^(]*?))?\s*\(([^)]*)\)\s*$'"


@query(f"""WITH p AS (SELECT *, nullif(regexp_extract(license_info_raw, {_PARTS}, 1), '') AS kind, nullif(regexp_extract(license_info_raw, {_PARTS}, 2), '') AS age, regexp_extract(license_info_raw, {_PARTS}, 3) AS b FROM player_license_raw),
d AS (SELECT *, CASE WHEN kind IS NOT NULL AND regexp_matches(b, '^[0-9]{{4}}[.-][0-9]{{2}}[.-][0-9]{{2}}$') THEN try_cast(replace(b, '.', '-') AS DATE) END AS day, CASE WHEN regexp_matches(season_label, '^20[0-9][0-9]-[0-9][0-9]$') THEN CAST(left(season_label, 4) AS INTEGER) END AS ls FROM p),
y AS (SELECT *, CASE WHEN day IS NOT NULL AND year(day) - CASE WHEN month(day) < 7 THEN 1 ELSE 0 END BETWEEN 2010 AND 2030 THEN year(day) - CASE WHEN month(day) < 7 THEN 1 ELSE 0 END END AS ds FROM d),
l AS (SELECT *, CASE WHEN ls BETWEEN 2010 AND 2030 AND season_label = ls || '-' || lpad(CAST((ls + 1) % 100 AS VARCHAR), 2, '0') THEN ls END AS ok_ls FROM y),
r AS (SELECT *, coalesce(ds, ok_ls) AS season, concat_ws(';', CASE WHEN kind IS NULL THEN 'licence' END, CASE WHEN coalesce(ds, ok_ls) IS NULL THEN 'season' END, CASE WHEN player_id_ext IS NULL OR data_source_id IS NULL THEN 'player' END, CASE WHEN club_id_ext IS NULL THEN 'club' END, CASE WHEN coalesce(day, CASE WHEN ok_ls IS NOT NULL THEN make_date(ok_ls, 7, 1) END) IS NULL OR coalesce(ds, ok_ls) IS NULL OR coalesce(day, make_date(ok_ls, 7, 1)) > make_date(coalesce(ds, ok_ls) + 1, 6, 30) THEN 'dates' END) AS missing FROM l),
n AS (SELECT *, row_number() OVER (PARTITION BY player_id_ext, data_source_id, club_id_ext, season, kind, age ORDER BY row_id) AS k FROM r)
SELECT CASE WHEN missing <> '' THEN 'failed' WHEN k > 1 THEN 'skipped' ELSE 'success' END AS status, CASE WHEN missing <> '' THEN missing WHEN k > 1 THEN 'duplicate' END AS reason, count(*) AS n FROM n GROUP BY 1, 2""")
def q_licence_resolution(s: SparkSession, d: str) -> DataFrame:
    """Outcomes of the licence resolver by status and reason."""
    return G.run_summary(_resolved(s, d))


@query("""SELECT count(*) AS processed, true AS adds_up FROM player_license_raw""")
def q_run_summary(s: SparkSession, d: str) -> DataFrame:
    """The accounting of a resolver run: success, failed and skipped add up to processed."""
    r = _resolved(s, d)
    log = audit.log_rows(r, "run", "licences", F.col("status"), F.col("reason"), {"row_id": F.col("row_id")})
    return audit.summary(log).select("processed", "adds_up")


@query("""SELECT row_id, CASE WHEN regexp_matches(upper(game_point_tokens), 'WO:S[12]') THEN CAST(regexp_extract(upper(game_point_tokens), 'WO:S([12])', 1) AS INTEGER) WHEN regexp_matches(upper(trim(game_point_tokens)), '^WO\\W*$') AND h1 AND NOT h2 THEN 1 WHEN regexp_matches(upper(trim(game_point_tokens)), '^WO\\W*$') AND h2 AND NOT h1 THEN 2 END AS walkover_side, h1 AND h2 AS garbage
FROM (SELECT *, coalesce(regexp_matches(s1_fullname_raw, '(?i)\\b(vakant|wo|vacant|reserve)\\b'), false) AS h1, coalesce(regexp_matches(s2_fullname_raw, '(?i)\\b(vakant|wo|vacant|reserve)\\b'), false) AS h2 FROM tournament_class_match_raw)""")
def q_walkovers(s: SparkSession, d: str) -> DataFrame:
    """The side that forfeits, from the score or from the one placeholder; matches of two placeholders are garbage."""
    m = table(s, d, "tournament_class_match_raw").select("row_id", F.col("s1_fullname_raw").alias("name1"), F.col("s2_fullname_raw").alias("name2"), F.col("game_point_tokens").alias("tokens"))
    return E.walkover_from_placeholders(m).select("row_id", "walkover_side", "garbage")


@query("SELECT * FROM (VALUES ('tournament_class_player_new', 'player_id', 'player', 'player_id'), ('tournament_class_player_new', 'club_id', 'club', 'club_id'), ('tournament_class_player_new', 'tournament_class_entry_id', 'tournament_class_entry_new', 'tournament_class_entry_id'), ('match_side_new', 'represented_entry_id', 'tournament_class_entry_new', 'tournament_class_entry_id')) t(child, \"column\", parent, key)")
def q_foreign_keys(s: SparkSession, d: str) -> DataFrame:
    return schemas.references(s)


@query("SELECT 'check date_born' AS rule, count(*) AS n FROM player WHERE date_born IS NOT NULL AND NOT regexp_matches(date_born, '^[0-9]{4}-[0-9]{2}-[0-9]{2}$') HAVING count(*) > 0 UNION ALL SELECT 'unique player_id', count(*) FROM (SELECT player_id FROM player GROUP BY 1 HAVING count(*) > 1) HAVING count(*) > 0")
def q_violations(s: SparkSession, d: str) -> DataFrame:
    """Rows of the players that break a check or the key; none in clean data."""
    return schemas.violations("player", table(s, d, "player"))


@query("SELECT doc_id FROM documents WHERE contains(lower(text), 'javascript')")
def q_keyword_search(s: SparkSession, d: str) -> DataFrame:
    return landed.keyword_search(table(s, d, "documents"), "JavaScript", limit=None).select("doc_id")


@query("SELECT club_id FROM club WHERE regexp_matches(translate(lower(shortname || ' ' || longname), 'åäöéü', 'aaoeu'), '(^|[^a-z0-9])bordtennisklubb($|[^a-z0-9])') AND regexp_matches(translate(lower(shortname || ' ' || longname), 'åäöéü', 'aaoeu'), '(^|[^a-z0-9])por')")
def q_term_search(s: SparkSession, d: str) -> DataFrame:
    """Clubs with a word and another that begins like the last one asked for."""
    index = P.term_index(table(s, d, "club"), "club_id", F.concat_ws(" ", "shortname", "longname"))
    return P.search(index, "club_id", "bordtennisklubb por")


_SPLIT = "2019-07-01"  # days before are one batch of the stream, the others and rows without a day the next


@query(f"""WITH h AS (SELECT CASE WHEN last_seen_at < TIMESTAMP '{_SPLIT}' THEN 0 ELSE 1 END AS batch, player_id_ext AS k, season_label AS v, row_id FROM player_license_raw), r AS (SELECT *, row_number() OVER (PARTITION BY batch, k ORDER BY row_id DESC) AS rn FROM h),
b0 AS (SELECT k, v FROM r WHERE batch = 0 AND rn = 1), b1 AS (SELECT k, v FROM r WHERE batch = 1 AND rn = 1)
SELECT coalesce(b0.k, b1.k) AS player_id_ext, CASE WHEN b1.h THEN b1.v ELSE b0.v END AS season_label, CASE WHEN b0.h IS NULL THEN 'inserted' WHEN b1.h IS NULL THEN 'kept' WHEN lower(translate(b0.v, '-/', '  ')) IS DISTINCT FROM lower(translate(b1.v, '-/', '  ')) THEN 'updated' ELSE 'unchanged' END AS outcome FROM (SELECT *, true AS h FROM b0) b0 FULL JOIN (SELECT *, true AS h FROM b1) b1 ON b0.k IS NOT DISTINCT FROM b1.k""")
def q_micro_batches(s: SparkSession, d: str) -> DataFrame:
    """All rows in two micro-batches of the staging stream by day, one upon the other; rows without a number are one key."""
    raw = table(s, d, "player_license_raw").select("player_id_ext", "season_label", "row_id", F.coalesce(F.col("last_seen_at") < F.lit(_SPLIT).cast("timestamp"), F.lit(False)).alias("early"))
    one = stream.upsert_batch(None, raw.filter("early").drop("early"), ["player_id_ext"], ["season_label"], [F.desc("row_id")])
    two = stream.upsert_batch(one, raw.filter("not early").drop("early"), ["player_id_ext"], ["season_label"], [F.desc("row_id")])
    return two.select("player_id_ext", "season_label", "outcome")


@query("""SELECT date_trunc('day', ts) AS day, event_type, count(*) AS n FROM events GROUP BY 1, 2""")
def q_event_windows(s: SparkSession, d: str) -> DataFrame:
    """An extension: events per kind and day, as the stream counts them."""
    return stream.windowed_counts(table(s, d, "events").withColumn("ts", F.col("ts").cast("timestamp")), "ts", "event_type").select(F.col("start").alias("day"), "event_type", "n")


@query("""WITH e AS (SELECT DISTINCT tournament_class_entry_id % 50 AS c, player_id AS p FROM tournament_class_player_new WHERE player_id IS NOT NULL), n AS (SELECT c, count(*) AS n FROM e GROUP BY 1), x AS (SELECT a.c AS a, b.c AS b, count(*) AS shared FROM e a JOIN e b ON a.p = b.p AND a.c < b.c GROUP BY 1, 2)
SELECT x.a, x.b, shared FROM x JOIN n na ON na.c = x.a JOIN n nb ON nb.c = x.b WHERE shared >= greatest(4, 0.2 * least(na.n, nb.n))""")
def q_similar_lists(s: SparkSession, d: str) -> DataFrame:
    """Groups of entries that share many players."""
    e = table(s, d, "tournament_class_player_new").select(F.lit(1).alias("tournament_id"), (F.col("tournament_class_entry_id") % 50).alias("class_id"), "player_id")
    return E.similar_entry_lists(e, 0.2)


@query("""SELECT row_id, player_id_ext FROM (SELECT row_id, player_id_ext, row_number() OVER (PARTITION BY player_id_ext, season_label ORDER BY row_id) AS rn FROM player_license_raw) WHERE rn = 1 OR player_id_ext IS NULL""")
def q_first_wins(s: SparkSession, d: str) -> DataFrame:
    """Of rows with one key the first is kept; nulls in the key are distinct."""
    raw = table(s, d, "player_license_raw").select("row_id", "player_id_ext", "season_label")
    return R.dedupe_first(raw, ["player_id_ext", "season_label"], [F.asc("row_id")])[0].select("row_id", "player_id_ext")
