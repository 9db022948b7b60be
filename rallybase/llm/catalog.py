"""Queries of the training-data operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import stash, table
from . import incremental, leakage, linkage, mixing, people, residue, survivor


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return p2_links(spark, d).filter("player_id_ext is not null").select("transition_row_id", "player_id_ext").distinct()


def p2_links(spark: SparkSession, d: str) -> DataFrame:
    """Every transition with its person and the confidence, or without one."""
    linked = linkage.link_transitions(table(spark, d, "player_transition_raw"), table(spark, d, "player_license_raw"), table(spark, d, "club"))
    return linked.select(F.col("row_id").alias("transition_row_id"), F.col("person").alias("player_id_ext"), F.round("confidence", 6).alias("confidence"), *linkage.VOTERS)


def _members(spark: SparkSession, d: str) -> DataFrame:
    players = table(spark, d, "player")
    return stash(players.join(survivor.group_players(players), "player_id"), "members")


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    members = _members(spark, d)
    best = survivor.surviving_records(members, "player_id", [], "is_verified", "date_born", "row_updated").select("group_id", F.col("player_id").alias("survivor_player_id"))
    return members.join(best, "group_id").filter("player_id <> survivor_player_id").select("player_id", "survivor_player_id").distinct()


def p3_records(spark: SparkSession, d: str) -> DataFrame:
    """One surviving record per person, with the best known values."""
    spaced = F.coalesce(F.when(F.col("firstname").isNotNull() & F.col("lastname").isNotNull(), F.concat_ws(" ", "firstname", "lastname")), F.col("fullname_raw"))
    day = F.when(~F.col("date_born").rlike("-01-01$"), F.col("date_born"))
    members = _members(spark, d).withColumn("name", spaced).withColumn("born", F.col("date_born")).withColumn("date_born", day)
    return survivor.surviving_records(members, "player_id", ["name", "year_born", "date_born", "is_verified"], "is_verified", "born", "row_updated").drop("group_id")


def p3_records_of_given(spark: SparkSession, d: str) -> DataFrame:
    """Surviving records of groups that are given: the players of one last name and year."""
    members = table(spark, d, "player").filter("lastname is not null and year_born is not null").withColumn("group_id", F.concat_ws("/", F.lower("lastname"), "year_born")).withColumn("born", F.col("date_born"))
    return survivor.surviving_records(members, "player_id", ["firstname", "date_born", "is_verified"], "is_verified", "born", "row_updated")


def _spellings(spark: SparkSession, d: str) -> DataFrame:
    """table_name, field_name, row_id, entity_key, typed, registered spellings of every linked text."""
    matches, moves, clubs = table(spark, d, "tournament_class_match_raw"), table(spark, d, "player_transition_raw"), table(spark, d, "club")
    texts = matches.select(F.col("s1_clubname_raw").alias("text")).unionByName(moves.select(F.col("club_from").alias("text")))
    lic, persons, spellings, club_of = people.registry(table(spark, d, "player_license_raw"), clubs, texts)
    in_line = F.nullif(F.regexp_extract("raw_line_text", r"^\s*[0-9]+\s+([0-9]+)\s", 1), F.lit(""))
    number = F.coalesce(F.nullif(F.trim("s1_player_id_ext"), F.lit("")), in_line)
    grp = F.when(number.isNotNull(), F.xxhash64("data_source_id", "tournament_id_ext", "tournament_class_id_ext", number))
    rows = matches.select("row_id", F.col("s1_fullname_raw").alias("name"), F.col("s1_clubname_raw").alias("text"), grp.alias("grp")).join(club_of, "text", "left")
    rows = stash(rows, "rows")
    person_clubs = stash(lic.filter("person is not null and club_id is not null").select("person", "club_id").distinct(), "personclubs")
    linked = people.link_names(rows, persons, spellings, person_clubs)
    names = rows.select("row_id", F.col("name").alias("typed")).join(linked, "row_id").join(persons.select("person", F.array("registered").alias("registered")), "person")
    out = names.select(F.lit("tournament_class_match_raw").alias("table_name"), F.lit("s1_fullname_raw").alias("field_name"), "row_id", F.col("person").alias("entity_key"), "typed", "registered")
    reg = clubs.select("club_id", F.array("shortname", "longname").alias("registered"))
    moved = moves.select("row_id", F.col("club_from").alias("text")).join(club_of, "text")
    for df, name, field in ((rows.filter("club_id is not null"), "tournament_class_match_raw", "s1_clubname_raw"), (moved, "player_transition_raw", "club_from")):
        told = df.select("row_id", "text", "club_id").join(reg, "club_id")
        out = out.unionByName(told.select(F.lit(name).alias("table_name"), F.lit(field).alias("field_name"), "row_id", F.col("club_id").cast("string").alias("entity_key"), F.col("text").alias("typed"), "registered"))
    return out


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    other = ~F.exists("registered", lambda r: F.coalesce(r == F.col("typed"), F.lit(False)))
    return _spellings(spark, d).filter(other).select("table_name", "field_name", "row_id", "entity_key").distinct()


def p4_links(spark: SparkSession, d: str) -> DataFrame:
    """Every linked text, registered spellings included."""
    return _spellings(spark, d)


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    mapping = incremental.replay(spark, table(spark, d, "player_license_raw")).mapping
    first = mapping.select(F.col("row_id").alias("rec"), F.col("day").alias("first_day"))
    return mapping.join(first, "rec").filter("day > first_day").select(F.col("rec").alias("row_id_a"), F.col("row_id").alias("row_id_b")).distinct()


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    return leakage.find_leaks(table(spark, d, "documents"), table(spark, d, "bench_item")).filter("leaked").select("doc_id", "item_id").distinct()


def p8_candidates(spark: SparkSession, d: str) -> DataFrame:
    """All candidates with their figures."""
    return leakage.find_leaks(table(spark, d, "documents"), table(spark, d, "bench_item"))


#: The tree of these documents: domains of the sources, and what the language codes stand for.
DOMAINS = {"match_report": "competition", "tournament_invite": "competition", "ranking_bulletin": "competition", "club_news": "club", "junior_camp": "club", "forum_post": "club", "licence_notice": "office", "archive_scan": "archive"}
LANGUAGES = {"sv": "sv", "swe": "sv", "en": "en", "eng": "en", "da": "da", "dan": "da", "no": "no", "nor": "no", "nb": "no"}


def _mixed(spark: SparkSession, d: str, **more: float) -> tuple[DataFrame, DataFrame]:
    return mixing.mix(table(spark, d, "documents"), table(spark, d, "mix_target"), domains=DOMAINS, languages=LANGUAGES, **more)


def p9_mix(spark: SparkSession, d: str) -> DataFrame:
    """The chosen records with their repeats."""
    return _mixed(spark, d)[0]


def p9_shares(spark: SparkSession, d: str) -> DataFrame:
    """The actual shares."""
    return _mixed(spark, d)[1]


def p9_mix_short(spark: SparkSession, d: str) -> DataFrame:
    """The chosen records when a half more is wanted than the scarcest source can give its share of: siblings take it over."""
    return _mixed(spark, d, stretch=1.5)[0]


def p9_shares_short(spark: SparkSession, d: str) -> DataFrame:
    return _mixed(spark, d, stretch=1.5)[1]


def p9_shares_of_all(spark: SparkSession, d: str) -> DataFrame:
    """The shares when more is wanted than there is: every source at its limit."""
    return _mixed(spark, d, total=1e12)[1]


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    return residue.mark_residue(table(spark, d, "documents")).filter("excluded").select("doc_id").distinct()


def p10_residue_report(spark: SparkSession, d: str) -> DataFrame:
    """Marks and coverage of every text that has any."""
    return residue.mark_residue(table(spark, d, "documents")).select("doc_id", "n_marks", F.round("coverage", 6).alias("coverage"), F.round("part_coverage", 6).alias("part_coverage"), "kinds", "excluded")


_GIVEN = """
WITH m AS (SELECT lower(lastname) || '/' || year_born AS group_id, * FROM player WHERE lastname IS NOT NULL AND year_born IS NOT NULL),
w AS (SELECT *, CASE WHEN is_verified THEN 1.0 ELSE 0.4 END * pow(0.5, coalesce((epoch_us((SELECT max(row_updated) FROM m)) - epoch_us(row_updated)) / 86400e6, 1e18 / 86400e6) / 1095.0) AS vote FROM m),
f AS (
  SELECT group_id, 'firstname' AS field, firstname AS value, vote FROM w UNION ALL SELECT group_id, 'date_born', date_born, vote FROM w
  UNION ALL SELECT group_id, 'is_verified', CAST(is_verified AS VARCHAR), vote FROM w),
n AS (
  SELECT *, CASE WHEN field = 'is_verified' THEN lpad(value, 24, '0') ELSE coalesce(nullif(array_to_string(list_sort(list_filter(string_split(regexp_replace(replace(regexp_replace(translate(lower(value),
    'àáâãäåæçèéêëìíîïñòóôõöøùúûüýÿšž', 'aaaaaaaceeeeiiiinoooooouuuuyysz'), 'ae|aa', 'a', 'g'), 'oe', 'o'), '[^a-z0-9]+', ' ', 'g'), ' '), lambda x: x <> '')), ' '), ''), value) END AS norm
  FROM f WHERE value IS NOT NULL AND trim(value) <> ''),
s AS (SELECT group_id, field, norm, value, sum(vote) AS v FROM n GROUP BY ALL),
t AS (SELECT group_id, field, norm, round(sum(v), 9) AS votes, arg_max(value, (round(v, 9), value)) AS value FROM s GROUP BY ALL),
b AS (SELECT group_id, field, arg_max(value, (votes, norm)) AS value FROM t GROUP BY ALL),
i AS (SELECT group_id, arg_max(player_id, (CASE WHEN is_verified THEN 2 ELSE 0 END + CASE WHEN date_born IS NULL THEN 0 ELSE 1 END, coalesce(epoch_us(row_updated), -(1::BIGINT << 62)), player_id)) AS player_id, count(DISTINCT player_id) AS n_rows FROM m GROUP BY 1)
SELECT i.group_id, i.player_id, i.n_rows, x.value AS firstname, y.value AS date_born, CAST(z.value AS BOOLEAN) AS is_verified
FROM i LEFT JOIN b x ON x.group_id = i.group_id AND x.field = 'firstname' LEFT JOIN b y ON y.group_id = i.group_id AND y.field = 'date_born' LEFT JOIN b z ON z.group_id = i.group_id AND z.field = 'is_verified'
"""


def queries() -> dict:
    return {f.__name__: f for f in (p2_found, p2_links, p3_found, p3_records, p3_records_of_given, p4_found, p4_links, p7_found, p8_found, p8_candidates, p9_mix, p9_shares, p9_mix_short, p9_shares_short, p9_shares_of_all, p10_found, p10_residue_report)}


def oracle_sql() -> dict[str, str]:
    return {"p3_records_of_given": _GIVEN}
