"""The warehouse's views: lazy DataFrames over a mapping of table names to DataFrames.

Lists are aggregated before they are joined, so that no join multiplies rows, and are in a defined order. Joins on external ids
also use the data source where both sides have one.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..lookups import UNKNOWN_CLUB, UNKNOWN_PLAYER
from ..operators import relational as R

Tables = Mapping[str, DataFrame]


def _pct(part: Column, whole: Column, digits: int = 1) -> Column:
    return F.round(F.lit(100.0).cast("double") * part / F.nullif(whole, F.lit(0)), digits)


def _flag(c: Column) -> Column:
    return F.coalesce(c.cast("int"), F.lit(0))


def _players(t: Tables, verified_flips: bool = True) -> DataFrame:
    """player_id, player_name, is_verified (0, 1) and the columns of player."""
    sure = _flag(F.col("is_verified")) == 1
    first = F.trim(F.concat_ws(" ", "firstname", "lastname"))
    raw = S.flip_name(F.col("fullname_raw")) if verified_flips else F.col("fullname_raw")
    return t["player"].withColumn("player_name", F.when(sure, first).otherwise(raw)).withColumn("is_verified", _flag(F.col("is_verified")))


def _clubs(t: Tables, prefix: str) -> DataFrame:
    return t["club"].select(F.col("club_id").alias(f"{prefix}club_id"), F.col("shortname").alias(f"{prefix}club"))


def _classes(t: Tables) -> DataFrame:
    """Classes with their tournaments: tc columns, and those of the tournament with t_ before them."""
    up = t["tournament"]
    return t["tournament_class"].join(up.select(*[F.col(c).alias(f"t_{c}") for c in up.columns]), F.col("tournament_id") == F.col("t_tournament_id"))


def _same_source(left: str, right: str, a: DataFrame, b: DataFrame) -> list[tuple[str, str]]:
    both = "data_source_id" in a.columns and "data_source_id" in b.columns
    return [(left, right), *([("data_source_id", "data_source_id")] if both else [])]


def class_overview(t: Tables) -> DataFrame:
    out = _classes(t)
    for table, key, name, on in (("tournament_class_type", "tournament_class_type_id", "tournament_class_type", "tournament_class_type_id"), ("tournament_class_structure", "tournament_class_structure_id", "tournament_class_structure", "tournament_class_structure_id"), ("tournament_status", "tournament_status_id", "tournament_status", "t_tournament_status_id")):
        look = t[table].select(F.col(key).alias(f"_{key}"), F.col("description").alias(name))
        out = out.join(look, F.col(on) == F.col(f"_{key}"), "left")
    return out.select(
        "tournament_class_id", "tournament_class_id_ext", "tournament_id", F.col("t_tournament_id_ext").alias("tournament_id_ext"), F.col("t_shortname").alias("tournament_shortname"), F.col("longname").alias("class_longname"), F.col("shortname").alias("class_shortname"),
        "tournament_class_type", "tournament_class_structure", "tournament_status", "ko_tree_size", F.col("startdate").alias("class_date"), F.col("t_country_code").alias("country_code"), F.col("t_url").alias("tournament_url"), "is_valid",
    ).orderBy("tournament_id", F.desc("tournament_class_id"))


def club_overview(t: Tables) -> DataFrame:
    listed = lambda name, text, out: t[name].withColumn("_x", text).groupBy("club_id").agg(R.ordered_list(F.col("_x"), [F.col("_x")], distinct=True).alias(out))
    ids = listed("club_id_ext", F.concat(F.col("club_id_ext").cast("string"), F.lit(":"), F.col("data_source_id").cast("string")), "ext_ids")
    aliases = listed("club_name_alias", F.concat(F.col("alias"), F.lit(" ("), F.col("alias_type"), F.lit(")")), "aliases")
    kinds = t["club_type"].select(F.col("club_type_id").alias("_k"), F.col("description").alias("_kind"))
    areas = t["district"].select("district_id", F.col("name").alias("district_shortname"))
    out = t["club"].join(kinds, F.col("club_type") == F.col("_k"), "left").join(areas, "district_id", "left").join(ids, "club_id", "left").join(aliases, "club_id", "left")
    return out.select("club_id", F.col("shortname").alias("club_shortname"), F.col("longname").alias("club_longname"), "city", "country_code", "active", F.col("_kind").alias("club_type"), "district_id", "district_shortname", "ext_ids", "aliases").orderBy("club_id")


def _entries(t: Tables) -> DataFrame:
    c = _classes(t).select("tournament_class_id", "tournament_class_id_ext", F.col("shortname").alias("class_shortname"), F.col("longname").alias("class_longname"), F.col("startdate").alias("class_date"), "tournament_id", F.col("t_tournament_id_ext").alias("tournament_id_ext"), F.col("t_shortname").alias("tournament_shortname"), F.col("t_startdate").alias("_t_start"))
    e = t["tournament_class_entry"].select("tournament_class_entry_id", "tournament_class_id", "seed", "final_position", F.col("tournament_class_entry_group_id_int").alias("entry_group_id"))
    p = _players(t).select("player_id", "player_name", "firstname", "lastname", F.col("fullname_raw").alias("player_fullname_raw"), "is_verified")
    club = t["club"].select("club_id", F.col("shortname").alias("club_shortname"))
    seats = t["tournament_class_player"].select("tournament_class_entry_id", "player_id", "club_id", "tournament_player_id_ext")
    return e.join(seats, "tournament_class_entry_id").join(c, "tournament_class_id").join(p, "player_id").join(club, "club_id")


def entry_detail(t: Tables) -> DataFrame:
    cols = ["tournament_shortname", "class_shortname", "class_longname", "class_date", "firstname", "lastname", "player_fullname_raw", "is_verified", "club_shortname", "seed", "final_position", "tournament_player_id_ext", "tournament_id", "tournament_id_ext", "tournament_class_id", "tournament_class_id_ext", "tournament_class_entry_id", "entry_group_id", "player_id", "club_id"]
    return _entries(t).orderBy("_t_start", "class_date", "seed", "tournament_class_entry_id").select(*cols)


def entry_grouped(t: Tables) -> DataFrame:
    """Entries with their pools; an entry in several pools stands once for each."""
    m = t["tournament_class_group_member"].select("tournament_class_entry_id", "tournament_class_group_id", F.col("seed_in_group").alias("group_seed"))
    g = t["tournament_class_group"].select("tournament_class_group_id", F.col("description").alias("group_name"), "sort_order")
    cols = ["tournament_shortname", "class_shortname", "class_longname", "class_date", "player_name", "player_id", "club_shortname", "club_id", F.col("seed").alias("class_seed"), "final_position", "tournament_player_id_ext", "group_name", "group_seed", "tournament_id", "tournament_id_ext", "tournament_class_id", "tournament_class_id_ext", "tournament_class_entry_id", "entry_group_id", "tournament_class_group_id"]
    out = _entries(t).join(m, "tournament_class_entry_id", "left").join(g, "tournament_class_group_id", "left")
    return out.orderBy("_t_start", "class_date", "sort_order", "seed", "group_seed", "tournament_class_entry_id").select(*cols)


def class_roster(t: Tables) -> DataFrame:
    """Entries of each class with a name, the club and the first pool by description."""
    pools = t["tournament_class_group_member"].join(t["tournament_class_group"].select("tournament_class_group_id", "description"), "tournament_class_group_id").groupBy("tournament_class_entry_id").agg(F.min("description").alias("group_name"))
    named = F.coalesce(F.nullif(F.trim("player_name"), F.lit("")), F.trim("player_fullname_raw"))
    return _entries(t).join(pools, "tournament_class_entry_id", "left").select("tournament_class_id", "tournament_class_entry_id", "tournament_player_id_ext", named.alias("name"), "club_shortname", "seed", "group_name")


def player_profile(t: Tables) -> DataFrame:
    seasons = t["season"].select("season_id", F.col("label").alias("_label"), F.col("start_date").alias("_start"))
    lic = R.latest_per_group(t["player_license"].join(seasons, "season_id").join(_clubs(t, "_"), F.col("club_id") == F.col("_club_id")), ["player_id"], [F.desc("_start"), F.desc("club_id")])
    lic = lic.select("player_id", F.concat(F.col("_club"), F.lit(" ("), F.col("_label"), F.lit(")")).alias("recent_club"))
    played = t["tournament_class_player"].join(t["tournament_class_entry"].select("tournament_class_entry_id", "tournament_class_id"), "tournament_class_entry_id").join(_classes(t).select("tournament_class_id", "shortname", "startdate", "t_shortname"), "tournament_class_id")
    last = R.latest_per_group(played, ["player_id"], [F.desc("startdate"), F.desc("tournament_class_id")])
    last = last.select("player_id", F.concat(F.col("t_shortname"), F.lit(" - "), F.col("shortname"), F.lit(" ("), F.col("startdate").cast("string"), F.lit(")")).alias("recent_tournament_class"))
    move = t["player_transition"].join(seasons, "season_id").join(_clubs(t, "_f_"), F.col("club_id_from") == F.col("_f_club_id")).join(_clubs(t, "_t_"), F.col("club_id_to") == F.col("_t_club_id"))
    move = R.latest_per_group(move, ["player_id"], [F.desc("_start"), F.desc("club_id_to")]).select("player_id", F.concat(F.col("_f_club"), F.lit(" → "), F.col("_t_club"), F.lit(" ("), F.col("_label"), F.lit(")")).alias("recent_transition"))
    ext = t["player_id_ext"]
    ids = ext.groupBy("player_id").agg(R.ordered_list(F.col("player_id_ext").cast("string"), [F.col("player_id_ext").cast("string")]).alias("id_exts"), F.count(F.lit(1)).alias("id_ext_count"))
    groups = t["player_ranking_group"].join(t["ranking_group"], "ranking_group_id").groupBy("player_id").agg(R.ordered_list(F.col("class_short"), [F.col("class_short")], ", ").alias("ranking_groups"))
    keys = [a for a, _ in _same_source("player_id_ext", "player_id_ext", ext, t["player_ranking"])]
    points = R.latest_per_group(ext.select(*keys, "player_id").join(t["player_ranking"].select(*keys, "points", "run_date"), keys), ["player_id"], [F.desc("run_date"), F.desc("points")])
    points = points.select("player_id", F.concat(F.col("points").cast("string"), F.lit(" ("), F.col("run_date").cast("string"), F.lit(")")).alias("ranking_points"))
    out = _players(t, verified_flips=False).select("player_id", "player_name", "year_born", "is_verified")
    for part in (ids, lic, last, groups, points, move):
        out = out.join(part, "player_id", "left")
    empty = lambda c: F.coalesce(c, F.lit("")).alias(c)
    return out.select("player_id", "player_name", "year_born", "is_verified", empty("id_exts"), F.coalesce("id_ext_count", F.lit(0)).alias("id_ext_count"), "recent_club", "recent_tournament_class", empty("ranking_groups"), empty("ranking_points"), "recent_transition")


def game_totals(t: Tables) -> DataFrame:
    g = t["game"]
    score = F.concat(F.col("points_side1").cast("string"), F.lit("-"), F.col("points_side2").cast("string"))
    return g.groupBy("match_id").agg(R.ordered_list(score, [F.col("game_no")], ", ").alias("games_score"), F.count_if(F.col("points_side1") > F.col("points_side2")).alias("games_won_side1"), F.count_if(F.col("points_side2") > F.col("points_side1")).alias("games_won_side2"))


def _score(one: str = "games_won_side1", two: str = "games_won_side2") -> Column:
    return F.concat(F.col(one).cast("string"), F.lit("-"), F.col(two).cast("string"))


def _match_context(t: Tables) -> DataFrame:
    """Matches with their place in a class: one row for each class a match belongs to."""
    c = _classes(t).select("tournament_class_id", "tournament_class_id_ext", "tournament_id", F.col("t_tournament_id_ext").alias("tournament_id_ext"), F.col("t_shortname").alias("tournament_shortname"), F.col("t_startdate").alias("tournament_startdate"), F.col("t_city").alias("tournament_city"), F.col("t_url").alias("tournament_url"), F.col("shortname").alias("class_shortname"), F.col("longname").alias("class_longname"), F.col("startdate").alias("class_date"))
    stages = t["tournament_class_stage"].select("tournament_class_stage_id", F.col("shortname").alias("stage_shortname"), F.col("description").alias("stage_description"), "round_order")
    pools = t["tournament_class_group"].select("tournament_class_group_id", F.col("description").alias("group_name"))
    place = t["tournament_class_match"].select("match_id", "tournament_class_id", "tournament_class_stage_id", "tournament_class_group_id", "stage_round_no", F.col("draw_pos").alias("draw_position"))
    return place.join(c, "tournament_class_id").join(t["match"].select("match_id", "best_of", "date", "status", "winner_side", "walkover_side"), "match_id").join(stages, "tournament_class_stage_id", "left").join(pools, "tournament_class_group_id", "left")


def match_detail(t: Tables) -> DataFrame:
    seats = t["match_player"].join(t["match_side"].select("match_id", "side_no"), ["match_id", "side_no"]).join(_players(t).select("player_id", "player_name", "is_verified"), "player_id").join(_clubs(t, "_"), F.col("club_id") == F.col("_club_id"))
    by = [F.col("player_order"), F.col("player_id")]
    listed = lambda c, n, s: R.ordered_list(F.when(F.col("side_no") == s, F.col(c).cast("string")), by, ", ").alias(f"side{s}_{n}")
    parts = [("player_name", "player_name"), ("player_id", "player_id"), ("_club", "club_name"), ("club_id", "club_id"), ("is_verified", "player_is_verified")]
    sides = seats.filter("side_no in (1, 2)").groupBy("match_id").agg(*[listed(c, n, s) for s in (1, 2) for c, n in parts])
    out = _match_context(t).join(game_totals(t), "match_id", "left").join(sides, "match_id", "left")
    winner = F.when(F.col("winner_side") == 1, F.col("side1_player_name")).when(F.col("winner_side") == 2, F.col("side2_player_name"))
    return out.withColumn("match_score_summary", _score()).withColumn("winner_name", winner).orderBy("tournament_startdate", "class_date", "round_order", "stage_round_no", "match_id").drop("round_order")


def player_match_history(t: Tables) -> DataFrame:
    """Each match from the view of each of its players."""
    me = t["match_player"].select("match_id", "player_id", F.col("side_no").alias("player_side_no"), "club_id").join(_clubs(t, "_"), F.col("club_id") == F.col("_club_id"), "left").select("match_id", "player_id", "player_side_no", F.col("_club").alias("player_club"))
    them = t["match_player"].filter("player_order = 1").select("match_id", F.col("side_no").alias("_side"), F.col("player_id").alias("opponent_player_id"), F.col("club_id").alias("_oc"))
    named = _players(t).select(F.col("player_id").alias("opponent_player_id"), F.col("player_name").alias("opponent_name"))
    them = them.join(named, "opponent_player_id", "left").join(_clubs(t, "o_"), F.col("_oc") == F.col("o_club_id"), "left").select("match_id", "_side", "opponent_player_id", "opponent_name", F.col("o_club").alias("opponent_club"))
    a, b = me.alias("a"), them.alias("b")
    sides = a.join(b, (F.col("a.match_id") == F.col("b.match_id")) & (F.col("a.player_side_no") != F.col("b._side")), "left").select("a.*", "opponent_player_id", "opponent_name", "opponent_club")
    out = sides.join(_match_context(t), "match_id").join(game_totals(t), "match_id", "left")
    result = F.when(F.col("winner_side") == F.col("player_side_no"), "WIN").when(F.col("winner_side").isNotNull(), "LOSS")
    cols = ["player_id", "tournament_shortname", "class_longname", F.col("class_date").alias("date"), "result", "opponent_name", "opponent_player_id", "opponent_club", "match_score_summary", "games_score", "stage_description", "match_id", "best_of", F.col("date").alias("match_date"), F.col("status").alias("match_status"), "winner_side", "walkover_side", "player_side_no", "player_club", "games_won_side1", "games_won_side2", "tournament_id", "tournament_class_id"]
    return out.withColumn("result", result).withColumn("match_score_summary", _score()).orderBy(F.desc("tournament_startdate"), F.desc("class_date"), "match_id").select(*cols)


def dq_summary(t: Tables) -> DataFrame:
    """One row; every table is reduced to one row before they are joined on a constant."""
    one = F.lit(1).alias("_one")
    count = lambda name, out: t[name].agg(F.count(F.lit(1)).alias(out)).withColumn("_one", one)
    m = t["match"].agg(F.count(F.lit(1)).alias("matches_resolved"), F.count("winner_side").alias("matches_with_winner"), F.count("walkover_side").alias("matches_walkover")).withColumn("_one", one)
    p = t["match_player"].select("player_id", "club_id").join(t["player"].select("player_id", _flag(F.col("is_verified")).alias("_v")), "player_id", "left")
    unknown = F.col("player_id") == UNKNOWN_PLAYER
    p = p.agg(F.count(F.lit(1)).alias("match_players_total"), F.count_if(F.col("club_id") == UNKNOWN_CLUB).alias("match_clubs_unknown"), F.count_if(unknown).alias("match_players_unknown"), F.count_if(F.col("_v") == 1).alias("match_players_verified"), F.count_if((F.col("_v") == 0) & ~unknown).alias("match_players_unverified")).withColumn("_one", one)
    out = m.join(p, "_one")
    for name, raw, done in (("tournaments", "tournament_raw", "tournament"), ("classes", "tournament_class_raw", "tournament_class"), ("entries", "tournament_class_entry_raw", "tournament_class_entry")):
        out = out.join(count(raw, f"{name}_raw"), "_one").join(count(done, f"{name}_resolved"), "_one").withColumn(f"{name}_pct", _pct(F.col(f"{name}_resolved"), F.col(f"{name}_raw")))
    out = out.join(count("tournament_class_match_raw", "matches_raw"), "_one")
    known = F.col("match_players_total") - F.col("match_clubs_unknown")
    return out.withColumns({"matches_pct": _pct(F.col("matches_resolved"), F.col("matches_raw")), "matches_winner_pct": _pct(F.col("matches_with_winner"), F.col("matches_resolved")), "match_players_verified_pct": _pct(F.col("match_players_verified"), F.col("match_players_total")), "match_clubs_known": known, "match_clubs_known_pct": _pct(known, F.col("match_players_total"))}).drop("_one")


def _counted(df: DataFrame, key: str, out: str) -> DataFrame:
    return df.groupBy(key).agg(F.count(F.lit(1)).alias(out))


def dq_tournaments(t: Tables) -> DataFrame:
    raw, done = t["tournament_raw"], t["tournament"]
    keys = _same_source("tournament_id_ext", "tournament_id_ext", raw, done)
    d = done.select(*[F.col(b).alias(f"_{b}") for _, b in keys], "tournament_id", F.col("shortname").alias("resolved_shortname"))
    cond = None
    for a, b in keys:
        c = F.col(a) == F.col(f"_{b}")
        cond = c if cond is None else cond & c
    out = raw.select(*[a for a, _ in keys], F.col("shortname").alias("raw_shortname"), F.col("startdate").alias("raw_startdate")).join(d, cond, "left")
    out = out.join(_counted(t["tournament_class_raw"], "tournament_id_ext", "_raw"), "tournament_id_ext", "left").join(_counted(t["tournament_class"], "tournament_id", "_done"), "tournament_id", "left")
    return out.select("tournament_id_ext", "raw_shortname", "raw_startdate", F.col("tournament_id").isNotNull().cast("int").alias("is_resolved"), "tournament_id", "resolved_shortname", F.coalesce("_raw", F.lit(0)).alias("classes_raw_count"), F.coalesce("_done", F.lit(0)).alias("classes_resolved_count")).orderBy(F.desc("raw_startdate"))


def dq_classes(t: Tables) -> DataFrame:
    raw = t["tournament_class_raw"].select("tournament_id_ext", "tournament_class_id_ext", F.col("shortname").alias("raw_shortname"))
    done = t["tournament_class"].select("tournament_class_id_ext", "tournament_class_id")
    cup = t["tournament"].select("tournament_id_ext", F.col("shortname").alias("tournament_name"), F.col("startdate").alias("tournament_date"))
    out = raw.join(done, "tournament_class_id_ext", "left").join(cup, "tournament_id_ext", "left")
    for name, key, col in (("tournament_class_entry_raw", "tournament_class_id_ext", "entries_raw_count"), ("tournament_class_entry", "tournament_class_id", "entries_resolved_count"), ("tournament_class_match_raw", "tournament_class_id_ext", "matches_raw_count"), ("tournament_class_match", "tournament_class_id", "matches_resolved_count")):
        out = out.join(_counted(t[name], key, col), key, "left").withColumn(col, F.coalesce(col, F.lit(0)))
    return out.withColumn("is_resolved", F.col("tournament_class_id").isNotNull().cast("int")).orderBy(F.desc("tournament_date"), "raw_shortname")


def dq_classes_with_issues(t: Tables) -> DataFrame:
    entries, matches = F.col("entries_raw_count") > F.col("entries_resolved_count"), F.col("matches_raw_count") > F.col("matches_resolved_count")
    issue = F.when(F.col("is_resolved") == 0, "CLASS_NOT_RESOLVED").when(entries, "ENTRIES_MISSING").when(matches, "MATCHES_MISSING")
    out = dq_classes(t).withColumn("issue_type", issue).filter("issue_type is not null")
    return out.select("tournament_id_ext", "tournament_class_id_ext", F.col("raw_shortname").alias("class_shortname"), "tournament_name", "tournament_date", F.when(F.col("is_resolved") == 0, "Not resolved").otherwise("Resolved").alias("resolution_status"), F.col("entries_raw_count").alias("entries_raw"), F.col("entries_resolved_count").alias("entries_resolved"), F.col("matches_raw_count").alias("matches_raw"), F.col("matches_resolved_count").alias("matches_resolved"), "issue_type").orderBy(F.desc("tournament_date"), "issue_type", "class_shortname")


def dq_match_quality(t: Tables) -> DataFrame:
    """match_id with who stands on both sides and a score of 0 to 4: verified players and known clubs."""
    p = t["player"].select("player_id", _flag(F.col("is_verified")).alias("_v"))
    seats = t["match_player"].filter("player_order = 1 and side_no in (1, 2)").select("match_id", "side_no", "player_id", "club_id").join(p, "player_id", "left")
    at = lambda s, c: F.max(F.when(F.col("side_no") == s, F.col(c)))
    both = seats.groupBy("match_id").agg(*[at(s, c).alias(f"side{s}_{n}") for s in (1, 2) for c, n in (("player_id", "player_id"), ("_v", "is_verified"), ("club_id", "club_id"))])
    out = t["match"].join(both, "match_id", "left")
    is_unknown = lambda c, n: F.coalesce((F.col(c) == n).cast("int"), F.lit(0))
    for s in (1, 2):
        out = out.withColumn(f"side{s}_is_unknown_player", is_unknown(f"side{s}_player_id", UNKNOWN_PLAYER)).withColumn(f"side{s}_is_unknown_club", is_unknown(f"side{s}_club_id", UNKNOWN_CLUB)).withColumn(f"_k{s}", (F.coalesce(f"side{s}_club_id", F.lit(UNKNOWN_CLUB)) != UNKNOWN_CLUB).cast("int"))
    score = F.coalesce("side1_is_verified", F.lit(0)) + F.coalesce("side2_is_verified", F.lit(0)) + F.col("_k1") + F.col("_k2")
    return out.withColumn("quality_score", score)


def dq_matches(t: Tables) -> DataFrame:
    c = _classes(t).select("tournament_class_id", F.col("t_shortname").alias("tournament_name"), F.col("t_startdate").alias("tournament_date"), F.col("shortname").alias("class_shortname"))
    place = t["tournament_class_match"].select("match_id", "tournament_class_id").join(c, "tournament_class_id")
    games = _counted(t["game"], "match_id", "game_count")
    out = dq_match_quality(t).join(place, "match_id").join(games, "match_id", "left").withColumn("game_count", F.coalesce("game_count", F.lit(0)))
    sides = [f"side{s}_{n}" for s in (1, 2) for n in ("player_id", "is_verified", "is_unknown_player", "is_unknown_club")]
    return out.select("match_id", "tournament_name", "tournament_date", "class_shortname", "winner_side", "walkover_side", "status", *sides, "game_count", "quality_score", "_k1", "_k2")


def dq_quality_summary(t: Tables) -> DataFrame:
    n = dq_match_quality(t).groupBy("quality_score").agg(F.count(F.lit(1)).alias("match_count"))
    return R.share_of_total(n, "match_count").orderBy(F.desc("quality_score"))


def dq_matches_by_tournament(t: Tables) -> DataFrame:
    m = dq_matches(t)
    return m.groupBy("tournament_name", "tournament_date").agg(
        F.count(F.lit(1)).alias("total_matches"), F.count_if(F.col("quality_score") == 4).alias("perfect_matches"), F.count_if((F.col("side1_is_unknown_player") == 1) | (F.col("side2_is_unknown_player") == 1)).alias("matches_with_unknown_player"), F.count_if((F.col("_k1") == 0) | (F.col("_k2") == 0)).alias("matches_with_unknown_club"),
        _pct(F.count_if(F.col("quality_score") == 4), F.count(F.lit(1))).alias("perfect_pct"), F.round(F.avg("quality_score"), 2).alias("avg_quality_score"),
    ).orderBy(F.desc("tournament_date"))


def dq_players(t: Tables) -> DataFrame:
    v, one = _flag(F.col("is_verified")), F.lit(1).alias("_one")
    p = t["player"].agg(F.count_if(v == 1).alias("verified_players"), F.count_if((v == 0) & (F.col("player_id") != UNKNOWN_PLAYER)).alias("unverified_players"), F.count(F.lit(1)).alias("total_players")).withColumn("_one", one)
    a = t["match_player"].select("player_id").join(t["player"].select("player_id", "is_verified"), "player_id").agg(F.count_if(v == 1).alias("verified_match_appearances"), F.count_if(v == 0).alias("unverified_match_appearances"), F.count(F.lit(1)).alias("total_match_appearances")).withColumn("_one", one)
    return p.withColumn("verified_pct", _pct(F.col("verified_players"), F.col("total_players"))).join(a, "_one").drop("_one")


def dq_unverified_by_appearances(t: Tables) -> DataFrame:
    seen = t["match_player"].select("match_id", "player_id", "club_id").join(_clubs(t, "_"), F.col("club_id") == F.col("_club_id"), "left")
    n = seen.groupBy("player_id").agg(F.count("match_id").alias("match_count"), F.countDistinct("club_id").alias("clubs_count"), R.ordered_list(F.col("_club"), [F.col("_club")], distinct=True).alias("clubs"))
    p = t["player"].filter((_flag(F.col("is_verified")) == 0) & (F.col("player_id") != UNKNOWN_PLAYER)).select("player_id", "firstname", "lastname", "year_born")
    return p.join(n, "player_id").orderBy(F.desc("match_count"), "player_id")


VIEWS = {f.__name__: f for f in (class_overview, club_overview, entry_detail, entry_grouped, class_roster, player_profile, match_detail, player_match_history, dq_summary, dq_tournaments, dq_classes, dq_classes_with_issues, dq_matches, dq_quality_summary, dq_matches_by_tournament, dq_players, dq_unverified_by_appearances)}


def register(tables: Tables) -> None:
    """All views whose tables are there become temporary views, for SQL."""
    for name, view in VIEWS.items():
        try:
            view(tables).createOrReplaceTempView(f"v_{name}")
        except KeyError:
            continue


def search_players(t: Tables, name: str, year: int | None = None) -> DataFrame:
    """Players by name and year: exactly, else by a part of any of their names; an unknown year fits every year."""
    want = name.strip().lower()
    p = _players(t, verified_flips=False).withColumn("_n", F.lower("player_name"))
    exact, part = F.coalesce(F.col("_n") == want, F.lit(False)), F.coalesce(F.contains("_n", F.lit(want)) | F.contains(F.lower("fullname_raw"), F.lit(want)), F.lit(False))
    fits = F.lit(True) if year is None else F.col("year_born").isNull() | (F.col("year_born") == year)
    found = p.filter((exact | part) & fits).withColumn("match", F.when(exact, "exact").otherwise("part"))
    return found.select("player_id", "player_name", "year_born", "is_verified", "match").orderBy("match", "player_id")
