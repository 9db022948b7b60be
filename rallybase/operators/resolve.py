"""From staged rows to known entities: clubs, players, licences, transitions, rankings, tournaments, classes, match sides.

Every resolver takes DataFrames and gives rows with an id and a message; nothing is resolved one row after the other, so
entities that a run creates get ids that depend only on their natural key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import lookups
from ..functions import scalars as S
from . import relational as R


def surrogate(*natural: Column) -> Column:
    """A stable positive id of a natural key, the same in every run."""
    return F.shiftrightunsigned(F.xxhash64(*natural), 1)


# --- clubs ---------------------------------------------------------------------------------------------------------


def club_keys(clubs: DataFrame, aliases: DataFrame | None = None) -> DataFrame:
    """club_id, strict, relaxed: the keys of every short, long and alias name. A key of several clubs is theirs all; the
    ladder treats it as no match."""
    names = clubs.select("club_id", F.explode(F.array("shortname", "longname")).alias("name"))
    if aliases is not None:
        names = names.unionByName(aliases.select("club_id", F.col("alias").alias("name")))
    named = names.filter("name is not null and trim(name) <> ''")
    return named.select("club_id", S.normalize_key(F.col("name"), keep_marks=True).alias("strict"), S.normalize_key(F.col("name")).alias("relaxed")).distinct()


def resolve_clubs(rows: DataFrame, text: str, keys: DataFrame, prefix: bool = True, fallback: bool = True, least: float = 0.8) -> DataFrame:
    """rows with club_id and club_message: exact, relaxed, prefix, unknown (the fallback club) or none.

    Steps in order: the key with its marks, the key without, the best common beginning of at least the least score; a step
    with several clubs is no match. Distinct texts are resolved once and joined back."""
    t = rows.select(text).filter(F.col(text).isNotNull()).distinct()
    t = t.withColumn("_s", S.normalize_key(F.col(text), keep_marks=True)).withColumn("_r", S.normalize_key(F.col(text)))
    exact = R.sole_candidate(t.join(keys, F.col("_s") == F.col("strict")), [text], "club_id").withColumnRenamed("club_id", "_c1")
    relaxed = R.sole_candidate(t.join(keys, F.col("_r") == F.col("relaxed")), [text], "club_id").withColumnRenamed("club_id", "_c2")
    out = t.join(exact, text, "left").join(relaxed, text, "left")
    if prefix:
        near = R.prefix_match(t.filter(F.length("_r") >= 3), "_r", keys.select("club_id", "relaxed"), "relaxed", "club_id", least).select("_r", F.col("club_id").alias("_c3"))
        out = out.join(near, "_r", "left")
    else:
        out = out.withColumn("_c3", F.lit(None).cast("long"))
    last = F.lit(lookups.UNKNOWN_CLUB if fallback else None).cast("long")
    message = F.when(F.col("_c1").isNotNull(), "exact").when(F.col("_c2").isNotNull(), "relaxed").when(F.col("_c3").isNotNull(), "prefix").otherwise("unknown" if fallback else "none")
    told = out.select(text, F.coalesce("_c1", "_c2", "_c3", last).alias("club_id"), message.alias("club_message"))
    none = F.lit("unknown" if fallback else "none")
    return rows.join(told, text, "left").withColumn("club_id", F.coalesce("club_id", last)).withColumn("club_message", F.coalesce("club_message", none))


# --- players -------------------------------------------------------------------------------------------------------


def _keyed(df: DataFrame, name: Column) -> DataFrame:
    return df.withColumn("_key", F.explode(R.name_keys(S.normalize_key(name))))


def _inside(entries: DataFrame, known: DataFrame, on: list[str]) -> DataFrame:
    """Entries of at most two parts whose first and last part stand in a key of three or more parts, for equal on columns."""
    e = entries.withColumn("_parts", F.split(S.normalize_key(F.col("name")), " ")).filter("size(_parts) <= 2")
    k = known.withColumn("_whole", S.normalize_key(F.concat_ws(" ", "firstname", "lastname"))).filter("size(split(_whole, ' ')) >= 3")
    return e.join(k, on).filter(F.contains("_whole", F.element_at("_parts", 1)) & F.contains("_whole", F.element_at("_parts", -1)))


def resolve_players(entries: DataFrame, players: DataFrame, licences: DataFrame, transitions: DataFrame, appearances: DataFrame) -> DataFrame:
    """entry_id, player_id, strategy: a known player for every entry, or a new unverified one.

    entries: entry_id, name, club_id, day. players: player_id, firstname, lastname, fullname_raw, is_verified. licences: player_id,
    club_id, valid_from, valid_to. transitions: player_id, from_club, to_club, day. appearances: player_id, club_id.
    Strategies in order, each needs exactly one player: a licence in the club on the day by any turn of the name, or with both parts
    inside it; the same in any season; a transition from or to the club on or before the day, likewise; a verified player by
    name alone; an unverified one seen in the club; an unverified one with the name. Else a new id is made from the name, the
    same for all entries with that name. Entries without a name get no row."""
    e = entries.filter("name is not null and trim(name) <> ''").select("entry_id", "name", "club_id", "day")
    verified = players.filter("is_verified").select("player_id", "firstname", "lastname")
    by_key = _keyed(verified, F.concat_ws(" ", "firstname", "lastname")).select("player_id", "_key")
    typed = e.withColumn("_key", S.normalize_key(F.col("name")))
    held = licences.select(F.col("player_id"), "club_id", "valid_from", "valid_to")
    named = held.join(verified, "player_id")
    on_day = F.col("day").between(F.col("valid_from"), F.col("valid_to"))
    exact = typed.join(by_key, "_key").join(held, ["player_id", "club_id"])
    inside = _inside(e, named, ["club_id"])
    moved = transitions.select("player_id", F.explode(F.array_distinct(F.array("from_club", "to_club"))).alias("club_id"), F.col("day").alias("moved")).filter("club_id is not null")
    gone = F.col("moved") <= F.col("day")
    moved_exact = typed.join(by_key, "_key").join(moved, ["player_id", "club_id"]).filter(gone)
    moved_inside = _inside(e, moved.join(verified, "player_id"), ["club_id"]).filter(gone)
    by_name = typed.join(by_key, "_key")
    loose = players.filter("not is_verified").select("player_id", S.normalize_key(F.coalesce("fullname_raw", F.concat_ws(" ", "firstname", "lastname"))).alias("_key"))
    seen = typed.join(loose, "_key").join(appearances.select("player_id", "club_id").distinct(), ["player_id", "club_id"])
    reuse = typed.join(loose, "_key").groupBy("entry_id").agg(F.min("player_id").alias("player_id"))
    steps = [("licence", exact.filter(on_day)), ("licence, part of name", inside.filter(on_day)), ("licence, any season", exact), ("licence, any season, part of name", inside), ("transition", moved_exact), ("transition, part of name", moved_inside), ("name", by_name), ("unverified in club", seen), ("unverified", reuse)]
    told = R.cascade(e, ["entry_id"], steps, "player_id")
    new = surrogate(S.normalize_key(F.col("name")))
    out = told.join(e.select("entry_id", "name"), "entry_id")
    return out.select("entry_id", F.coalesce("player_id", new).alias("player_id"), F.coalesce("strategy", F.lit("new unverified")).alias("strategy"))


def resolve_sides(sides: DataFrame, entries: DataFrame, least: int = 4) -> DataFrame:
    """side_id, entry_id, score, how: the entry of its class that each side of a match means.

    sides: side_id, class_id, number, name, club, grp. entries: class_id, entry_id, number, name, club, grp. A number that
    one entry has decides. Else points: 8 for the same name or its parts in reverse, 6 for the same parts in any order, up to 4 for
    shared parts, 3 for an initial that fits the other's part at its place (for either side), 2 for the group, 1 for the club, 1
    if a name of one part stands in the other, 1 if any part holds one of the other's; at least least, the best by points, group, club, length and the lowest entry."""
    clean = lambda c: S.normalize_key(F.col(c))
    s = sides.select("side_id", "class_id", F.col("number").alias("s_number"), clean("name").alias("s_name"), clean("club").alias("s_club"), F.col("grp").alias("s_grp"))
    c = entries.select("class_id", "entry_id", F.col("number").alias("e_number"), clean("name").alias("e_name"), clean("club").alias("e_club"), F.col("grp").alias("e_grp"))
    numbered = R.sole_candidate(s.join(c, (s["class_id"] == c["class_id"]) & (s["s_number"] == c["e_number"])).select("side_id", "entry_id"), ["side_id"], "entry_id").withColumn("how", F.lit("number")).withColumn("score", F.lit(None).cast("int"))
    rest = s.join(numbered.select("side_id"), "side_id", "left_anti")
    both = rest.join(c, "class_id").filter("s_name is not null and e_name is not null")
    sp, ep = F.split("s_name", " "), F.split("e_name", " ")
    shared = F.size(F.array_intersect(sp, ep))
    turned = (F.col("e_name") == F.col("s_name")) | (F.col("e_name") == F.array_join(F.reverse(sp), " "))
    bit = lambda cond, n: F.when(F.coalesce(cond, F.lit(False)), n).otherwise(0)
    fits = lambda a, b: F.exists(F.zip_with(a, b, lambda x, y: (F.length(x) == 1) & F.startswith(y, x)), lambda x: F.coalesce(x, F.lit(False)))
    lone = (F.size(sp) == 1) & F.array_contains(ep, F.element_at(sp, 1)) | (F.size(ep) == 1) & F.array_contains(sp, F.element_at(ep, 1))
    holds = F.exists(sp, lambda x: F.exists(ep, lambda y: F.contains(y, x) | F.contains(x, y)))
    group, club = bit(F.col("s_grp") == F.col("e_grp"), 2), bit(F.col("s_club") == F.col("e_club"), 1)
    score = bit(turned, 8) + bit(F.array_sort(sp) == F.array_sort(ep), 6) + F.least(shared, F.lit(4)) + bit(fits(sp, ep), 3) + bit(fits(ep, sp), 3) + group + club + bit(lone, 1) + bit(holds, 1)
    scored = both.withColumn("score", score).withColumn("_g", group).withColumn("_c", club).filter((F.col("score") - F.col("_g") - F.col("_c") > 0) & (F.col("score") >= least))
    best = scored.groupBy("side_id").agg(F.max_by(F.struct("entry_id", "score"), F.struct("score", "_g", "_c", -F.abs(F.length("s_name") - F.length("e_name")), -F.length("e_name"), -F.col("entry_id"))).alias("b"))
    named = best.select("side_id", F.col("b.entry_id").alias("entry_id"), F.lit("name").alias("how"), F.col("b.score").alias("score"))
    return s.select("side_id").join(numbered.select("side_id", "entry_id", "how", "score").unionByName(named), "side_id", "left").select("side_id", "entry_id", "score", F.coalesce("how", F.lit("none")).alias("how"))


def sibling_sides(unresolved: DataFrame, entries: DataFrame, parent_of: DataFrame, least: int = 4) -> DataFrame:
    """Sides that found no entry in their class, looked for in the parent class: side_id, parent_entry_id, entry_id (a new
    negative one in the own class, the same for all sides with that parent entry)."""
    up = unresolved.join(parent_of.select("class_id", "parent_class_id"), "class_id")
    found = resolve_sides(up.drop("class_id").withColumnRenamed("parent_class_id", "class_id"), entries, least).filter("entry_id is not null")
    own = up.select("side_id", F.col("class_id").alias("_own"))
    return found.join(own, "side_id").select("side_id", F.col("entry_id").alias("parent_entry_id"), (-surrogate(F.col("_own"), F.col("entry_id"))).alias("entry_id"))


PLACEHOLDER = r"(?i)\b(vakant|wo|vacant|reserve)\b"


def walkover_from_placeholders(matches: DataFrame) -> DataFrame:
    """matches with walkover_side: told by the score, else the one side that is a placeholder when the score is a bare WO;
    and garbage: both sides are placeholders. Columns: name1, name2, tokens."""
    hold = lambda c: F.coalesce(F.col(c).rlike(PLACEHOLDER), F.lit(False))
    bare = F.upper(F.trim("tokens")).rlike(r"^WO\W*$")
    side = F.when(bare & hold("name1") & ~hold("name2"), 1).when(bare & hold("name2") & ~hold("name1"), 2)
    return matches.withColumn("walkover_side", F.coalesce(S.walkover_side(F.col("tokens")), side)).withColumn("garbage", hold("name1") & hold("name2"))


def same_player_on_both_sides(match_players: DataFrame) -> DataFrame:
    """match_id of matches with a player on both sides. Columns: match_id, side_no, player_id."""
    known = match_players.filter((F.col("player_id").isNotNull()) & (F.col("player_id") != lookups.UNKNOWN_PLAYER))
    return known.groupBy("match_id", "player_id").agg(F.countDistinct("side_no").alias("n")).filter("n > 1").select("match_id").distinct()


# --- licences, transitions, rankings ---------------------------------------------------------------------------------


def resolve_licences(raw: DataFrame, players: DataFrame, clubs: DataFrame, seasons: DataFrame) -> DataFrame:
    """raw licence rows (one licence each) with player_id, club_id, season, kind, age, valid_from, valid_to, status, reason.

    players: external id, source and player_id; clubs: external id and club_id; seasons: season, starts, ends, label. The
    season is the label's, or the one that holds the bracketed day; without a day a licence begins with its season. The
    first row of a player, club, season and kind counts, later ones are skipped; rows that lack something fail with all
    reasons."""
    parts = S.licence_parts(F.col("license_info_raw"))
    r = raw.withColumn("_p", parts).withColumn("_day", F.col("_p.day"))
    by_label = seasons.select(F.col("label").alias("season_label"), F.col("season").alias("_s1"), F.col("starts").alias("_st1"), F.col("ends").alias("_e1"))
    by_day = seasons.select(F.col("season").alias("_s2"), F.col("starts").alias("_st2"), F.col("ends").alias("_e2"))
    r = r.join(by_label, "season_label", "left").withColumn("_y", S.season_year(F.col("_day"))).join(by_day, F.col("_y") == F.col("_s2"), "left")
    r = r.withColumn("season", F.coalesce("_s2", "_s1")).withColumn("valid_to", F.coalesce("_e2", "_e1")).withColumn("valid_from", F.coalesce("_day", "_st1"))
    r = r.join(players.select("player_id_ext", "data_source_id", "player_id"), ["player_id_ext", "data_source_id"], "left").join(clubs.select("club_id_ext", "club_id"), "club_id_ext", "left")
    r = r.withColumn("kind", F.col("_p.kind")).withColumn("age", F.col("_p.age"))
    rules = [("licence", F.col("kind").isNotNull()), ("season", F.col("season").isNotNull()), ("player", F.col("player_id").isNotNull()), ("club", F.col("club_id").isNotNull()), ("dates", F.col("valid_from") <= F.col("valid_to"))]
    missing = F.array_compact(F.array(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(n)) for n, ok in rules]))
    r = r.withColumn("reason", F.when(F.size(missing) > 0, F.array_join(missing, ";")))
    w = Window.partitionBy("player_id", "club_id", "season", "kind", "age").orderBy("row_id")
    again = F.col("reason").isNull() & (F.row_number().over(w) > 1)
    status = F.when(F.col("reason").isNotNull(), "failed").when(again, "skipped").otherwise("success")
    return r.withColumn("status", status).select("row_id", "player_id", "club_id", "season", "kind", "age", "valid_from", "valid_to", "status", F.when(F.col("status") == "skipped", "duplicate").otherwise(F.col("reason")).alias("reason"))


def licence_overlaps(licences: DataFrame) -> DataFrame:
    """Pairs of one player's licences of one kind in different clubs whose days overlap. Columns as resolve_licences gives."""
    one = licences.filter("status = 'success'").select("player_id", "kind", F.col("row_id").alias("a"), F.col("club_id").alias("_ca"), F.col("valid_from").alias("_fa"), F.col("valid_to").alias("_ta"))
    two = one.select("player_id", "kind", F.col("a").alias("b"), F.col("_ca").alias("_cb"), F.col("_fa").alias("_fb"), F.col("_ta").alias("_tb"))
    return R.overlaps(one, two, ["player_id", "kind"], "_fa", "_ta", "_fb", "_tb").filter("a < b and _ca <> _cb").select("player_id", "kind", "a", "b")


def resolve_transitions(raw: DataFrame, players: DataFrame, licences: DataFrame) -> DataFrame:
    """row_id, player_id, status: the one player with the name and year (or the name alone if verified) who held a licence in
    the club left in that season or before. raw: row_id, firstname, lastname, year_born, from_club, season."""
    key = lambda f, l: S.normalize_key(F.concat_ws(" ", f, l))  # noqa: E731, E741
    t = raw.select("row_id", key("firstname", "lastname").alias("_k"), "year_born", F.col("from_club").alias("club_id"), F.col("season").alias("_s"))
    p = players.select("player_id", key("firstname", "lastname").alias("_k"), F.col("year_born").alias("_y"), "is_verified")
    both = t.join(p, "_k").join(licences.select("player_id", "club_id", "season").distinct(), ["player_id", "club_id"]).filter("season <= _s")
    told = R.cascade(t, ["row_id"], [("name and year", both.filter("year_born = _y")), ("name", both.filter("is_verified"))], "player_id")
    return told.select("row_id", "player_id", F.when(F.col("player_id").isNotNull(), "success").otherwise("failed").alias("status"))


def resolve_rankings(raw: DataFrame, players: DataFrame, bad_runs: DataFrame | None = None) -> DataFrame:
    """Ranking rows of known players: null points are 0; runs known to be bad are left out."""
    r = raw if bad_runs is None else raw.join(bad_runs, bad_runs.columns, "left_anti")
    return r.join(players.select("player_id_ext", "data_source_id", "player_id"), ["player_id_ext", "data_source_id"]).withColumn("points", F.coalesce("points", F.lit(0))).withColumn("points_change_since_last", F.coalesce("points_change_since_last", F.lit(0)))


def ranking_groups(raw: DataFrame, groups: DataFrame) -> tuple[DataFrame, DataFrame]:
    """player_id and group_id from the latest non-empty comma-separated list of each player, without repeats; and the texts
    that are no group with their number. raw: player_id, ranking_group_raw, last_seen_at, row_id; groups: group_id, short."""
    last = R.latest_per_group(raw.filter("trim(coalesce(ranking_group_raw, '')) <> ''"), ["player_id"], [F.desc("last_seen_at"), F.desc("row_id")])
    each = last.select("player_id", F.explode(F.split("ranking_group_raw", ",")).alias("_t")).select("player_id", F.trim("_t").alias("short")).filter("short <> ''").distinct()
    known = each.join(groups.select("group_id", "short"), "short", "left")
    return known.filter("group_id is not null").select("player_id", "group_id"), known.filter("group_id is null").groupBy("short").agg(F.count(F.lit(1)).alias("n"))


def verified_players(licences: DataFrame, rankings: DataFrame) -> DataFrame:
    """One verified player for each external id and source: the first licence row, else the first ranking row."""
    cols = ["player_id_ext", "data_source_id", "firstname", "lastname", "year_born", "row_id"]
    both = licences.select(*cols, F.lit(0).alias("_p")).unionByName(rankings.select(*cols, F.lit(1).alias("_p"))).filter("player_id_ext is not null")
    best = R.latest_per_group(both, ["player_id_ext", "data_source_id"], [F.asc("_p"), F.asc("row_id")])
    name = lambda c: S.title_case(F.col(c))
    return best.select(surrogate(F.col("player_id_ext"), F.col("data_source_id")).alias("player_id"), "player_id_ext", "data_source_id", name("firstname").alias("firstname"), name("lastname").alias("lastname"), "year_born", F.lit(True).alias("is_verified"))


# --- tournaments and classes -----------------------------------------------------------------------------------------


def resolve_tournaments(raw: DataFrame, today: Column) -> DataFrame:
    """raw with starts, ends, status_id, status, reason: rows without a readable date fail, the second row of one external id
    and source is skipped."""
    r = raw.withColumn("starts", S.parse_date(F.col("startdate"))).withColumn("ends", S.parse_date(F.col("enddate")))
    bad = F.col("starts").isNull() | F.col("ends").isNull() | (F.col("ends") < F.col("starts"))
    w = Window.partitionBy("tournament_id_ext", "data_source_id").orderBy("row_id")
    again = F.col("tournament_id_ext").isNotNull() & (F.row_number().over(w) > 1)
    status = F.when(bad, "failed").when(again, "skipped").otherwise("success")
    return r.withColumn("status_id", S.event_status(F.col("starts"), F.col("ends"), today)).withColumn("status", status).withColumn("reason", F.when(bad, "dates").when(again, "duplicate"))


def resolve_classes(raw: DataFrame) -> DataFrame:
    """raw with type_id, structure_id and parent_class_id: the class of the same tournament whose short name is this one's
    without a final ~B or B. raw: class_id, tournament_id, shortname, longname, raw_stages."""
    r = raw.withColumn("type_id", S.class_type(F.col("shortname"), F.col("longname"))).withColumn("structure_id", S.class_structure(F.col("raw_stages")))
    base = F.nullif(F.regexp_extract("shortname", r"^(.*\S)\s*(?:~|\s)B$", 1), F.lit(""))
    up = raw.groupBy("tournament_id", F.col("shortname").alias("_base")).agg(F.min("class_id").alias("parent_class_id"))
    return r.withColumn("_base", base).join(up, ["tournament_id", "_base"], "left").drop("_base")


def similar_entry_lists(entries: DataFrame, part: float = 0.7, least: int = 4) -> DataFrame:
    """a, b: classes of one tournament that share at least max(least, part of the smaller class) of their players.
    entries: tournament_id, class_id, player_id. Shared players are counted by an equi-join on the player."""
    e = entries.filter("player_id is not null").select("tournament_id", "class_id", "player_id").distinct()
    n = e.groupBy("class_id").agg(F.count(F.lit(1)).alias("n"))
    pairs = e.withColumnRenamed("class_id", "a").join(e.withColumnRenamed("class_id", "b"), ["tournament_id", "player_id"]).filter("a < b").groupBy("a", "b").agg(F.count(F.lit(1)).alias("shared"))
    sized = pairs.join(n.select(F.col("class_id").alias("a"), F.col("n").alias("_na")), "a").join(n.select(F.col("class_id").alias("b"), F.col("n").alias("_nb")), "b")
    return sized.filter(F.col("shared") >= F.greatest(F.lit(float(least)), F.least("_na", "_nb") * part)).select("a", "b", "shared")
