from datetime import date

import pytest

from rallybase import lookups
from rallybase.plans import views as V


@pytest.fixture(scope="module")
def t(spark):
    d = lambda m, n: date(2024, m, n)
    mk = spark.createDataFrame
    return {
        "tournament": mk([(1, "T1", "Cup", d(1, 1), 3, "SWE", "u", "Alby"), (2, "T2", "Open", d(2, 1), None, "SWE", None, None)], "tournament_id long, tournament_id_ext string, shortname string, startdate date, tournament_status_id int, country_code string, url string, city string"),
        "tournament_class": mk([(10, "C10", 1, "HS", "Herrsingel", d(1, 2), 1, 1, 8, True), (11, "C11", 2, "DS", "Damsingel", d(2, 2), 9, 9, None, True)], "tournament_class_id long, tournament_class_id_ext string, tournament_id long, shortname string, longname string, startdate date, tournament_class_type_id int, tournament_class_structure_id int, ko_tree_size int, is_valid boolean"),
        "tournament_class_type": mk(lookups.CLASS_TYPES, "tournament_class_type_id int, description string"),
        "tournament_class_structure": mk(lookups.STRUCTURES, "tournament_class_structure_id int, description string"),
        "tournament_status": mk(lookups.STATUSES, "tournament_status_id int, description string"),
        "tournament_class_stage": mk([(s[0], s[1], s[2], s[4]) for s in lookups.STAGES], "tournament_class_stage_id int, shortname string, description string, round_order int"),
        "player": mk([(1, "Ann", "Ek", None, 1990, True), (2, None, None, "ALM Bo Karl", None, False), (99999, "Okänd", "Spelare", "Okänd Spelare", None, False)], "player_id long, firstname string, lastname string, fullname_raw string, year_born int, is_verified boolean"),
        "club": mk([(100, "Alby", "Alby BTK", "Alby", "SWE", 1, 1, 7), (101, "Berga", None, None, None, 1, None, None), (9999, "Okänd klubb", None, None, None, 1, None, None)], "club_id long, shortname string, longname string, city string, country_code string, active int, club_type int, district_id int"),
        "club_type": mk([(1, "Club")], "club_type_id int, description string"),
        "district": mk([(7, "Norr")], "district_id int, name string"),
        "club_id_ext": mk([(100, "30", 3), (100, "12", 1)], "club_id long, club_id_ext string, data_source_id int"),
        "club_name_alias": mk([(100, "Albyn", "nick"), (100, "AB", "short")], "club_id long, alias string, alias_type string"),
        "tournament_class_entry": mk([(50, 10, 1, 2, 1), (51, 10, None, 1, 2)], "tournament_class_entry_id long, tournament_class_id long, seed int, final_position int, tournament_class_entry_group_id_int int"),
        "tournament_class_player": mk([(50, 1, 100, "7"), (51, 2, 101, None)], "tournament_class_entry_id long, player_id long, club_id long, tournament_player_id_ext string"),
        "tournament_class_group": mk([(60, "Pool 1", 1)], "tournament_class_group_id long, description string, sort_order int"),
        "tournament_class_group_member": mk([(60, 50, 1)], "tournament_class_group_id long, tournament_class_entry_id long, seed_in_group int"),
        "tournament_class_match": mk([(500, 10, 1, 60, None, None), (501, 10, 8, None, 1, 1)], "match_id long, tournament_class_id long, tournament_class_stage_id int, tournament_class_group_id long, stage_round_no int, draw_pos int"),
        "match": mk([(500, 5, d(1, 2), "completed", 1, None), (501, 5, d(1, 2), "completed", None, None)], "match_id long, best_of int, date date, status string, winner_side int, walkover_side int"),
        "match_side": mk([(m, s) for m in (500, 501) for s in (1, 2)], "match_id long, side_no int"),
        "match_player": mk([(500, 1, 1, 1, 100), (500, 2, 1, 2, 101), (501, 1, 1, 1, 100), (501, 2, 1, 99999, 9999)], "match_id long, side_no int, player_order int, player_id long, club_id long"),
        "game": mk([(500, 1, 11, 7), (500, 2, 9, 11), (500, 3, 12, 10)], "match_id long, game_no int, points_side1 int, points_side2 int"),
        "season": mk([(1, "2023-24", d(1, 1)), (2, "2024-25", d(7, 1))], "season_id int, label string, start_date date"),
        "player_license": mk([(1, 101, 1), (1, 100, 2)], "player_id long, club_id long, season_id int"),
        "player_transition": mk([(1, 101, 100, 2)], "player_id long, club_id_from long, club_id_to long, season_id int"),
        "player_id_ext": mk([(1, "9", 3), (1, "8", 1)], "player_id long, player_id_ext string, data_source_id int"),
        "player_ranking_group": mk([(1, 2), (1, 1)], "player_id long, ranking_group_id int"),
        "ranking_group": mk([(1, "HE"), (2, "H1")], "ranking_group_id int, class_short string"),
        "player_ranking": mk([("9", 3, d(1, 1), 10), ("9", 3, d(2, 1), 20), ("9", 1, d(3, 1), 99)], "player_id_ext string, data_source_id int, run_date date, points int"),
        "tournament_raw": mk([("T1", "Cup", "2024-01-01"), ("T9", "Lost", "2024-03-01")], "tournament_id_ext string, shortname string, startdate string"),
        "tournament_class_raw": mk([("T1", "C10", "HS"), ("T9", "C99", "X")], "tournament_id_ext string, tournament_class_id_ext string, shortname string"),
        "tournament_class_entry_raw": mk([("C10",)] * 3, "tournament_class_id_ext string"),
        "tournament_class_match_raw": mk([("C10",)] * 4, "tournament_class_id_ext string"),
    }


def rows(df, *cols):
    return [tuple(r[c] for c in cols) for r in df.collect()]


def test_overviews(t):
    assert rows(V.class_overview(t), "tournament_class_id", "tournament_class_type", "tournament_status", "class_date") == [(10, "Singles", "Ended", date(2024, 1, 2)), (11, "Unknown", None, date(2024, 2, 2))]
    assert rows(V.club_overview(t), "club_id", "club_type", "district_shortname", "ext_ids", "aliases")[0] == (100, "Club", "Norr", "12:1,30:3", "AB (short),Albyn (nick)")
    assert rows(V.club_overview(t), "ext_ids")[1] == (None,)


def test_entries(t):
    assert rows(V.entry_detail(t), "tournament_class_entry_id", "club_shortname", "seed") == [(51, "Berga", None), (50, "Alby", 1)]
    assert rows(V.entry_grouped(t), "player_name", "group_name", "group_seed") == [("Bo Karl ALM", None, None), ("Ann Ek", "Pool 1", 1)]
    assert sorted(rows(V.class_roster(t), "name", "group_name")) == [("Ann Ek", "Pool 1"), ("Bo Karl ALM", None)]


def test_profile(t):
    got = {r["player_id"]: r for r in V.player_profile(t).collect()}
    a = got[1]
    assert (a["player_name"], a["id_exts"], a["id_ext_count"], a["recent_club"], a["recent_tournament_class"], a["ranking_groups"], a["ranking_points"], a["recent_transition"]) == ("Ann Ek", "8,9", 2, "Alby (2024-25)", "Cup - HS (2024-01-02)", "H1, HE", "20 (2024-02-01)", "Berga → Alby (2024-25)")
    assert (got[2]["player_name"], got[2]["id_exts"], got[2]["id_ext_count"], got[2]["ranking_points"], got[2]["recent_club"]) == ("ALM Bo Karl", "", 0, "", None)


def test_matches(t):
    m = {r["match_id"]: r for r in V.match_detail(t).collect()}
    assert (m[500]["games_score"], m[500]["match_score_summary"], m[500]["winner_name"], m[500]["side2_player_name"], m[500]["group_name"]) == ("11-7, 9-11, 12-10", "2-1", "Ann Ek", "Bo Karl ALM", "Pool 1")
    assert (m[501]["games_score"], m[501]["match_score_summary"], m[501]["winner_name"], m[501]["stage_shortname"]) == (None, None, None, "F")
    h = {(r["match_id"], r["player_id"]): (r["result"], r["opponent_name"], r["opponent_club"], r["player_club"]) for r in V.player_match_history(t).collect()}
    assert h[(500, 1)] == ("WIN", "Bo Karl ALM", "Berga", "Alby")
    assert h[(500, 2)] == ("LOSS", "Ann Ek", "Alby", "Berga")
    assert h[(501, 1)][0] is None


def test_quality(t):
    s = V.dq_summary(t).first()
    assert (s["tournaments_raw"], s["tournaments_resolved"], s["tournaments_pct"], s["entries_pct"], s["matches_pct"], s["matches_with_winner"], s["match_players_unknown"], s["match_players_verified_pct"], s["match_clubs_known_pct"]) == (2, 2, 100.0, 66.7, 50.0, 1, 1, 50.0, 75.0)
    assert rows(V.dq_tournaments(t), "tournament_id_ext", "is_resolved", "classes_raw_count", "classes_resolved_count") == [("T9", 0, 1, 0), ("T1", 1, 1, 1)]
    assert rows(V.dq_classes_with_issues(t), "tournament_class_id_ext", "issue_type") == [("C10", "ENTRIES_MISSING"), ("C99", "CLASS_NOT_RESOLVED")]
    assert {r["match_id"]: (r["quality_score"], r["game_count"], r["side2_is_unknown_player"]) for r in V.dq_matches(t).collect()} == {500: (3, 3, 0), 501: (2, 0, 1)}
    assert rows(V.dq_quality_summary(t), "quality_score", "match_count", "pct") == [(3, 1, 50.0), (2, 1, 50.0)]
    assert rows(V.dq_matches_by_tournament(t), "total_matches", "perfect_matches", "matches_with_unknown_player", "matches_with_unknown_club", "avg_quality_score") == [(2, 0, 1, 1, 2.5)]
    assert tuple(V.dq_players(t).select("verified_players", "unverified_players", "total_players", "verified_pct", "verified_match_appearances", "unverified_match_appearances", "total_match_appearances").first()) == (1, 1, 3, 33.3, 2, 2, 4)
    assert rows(V.dq_unverified_by_appearances(t), "player_id", "match_count", "clubs") == [(2, 1, "Berga")]


def test_register(spark, t):
    V.register(t)
    assert spark.sql("select count(*) from v_player_profile").first()[0] == 3


def test_search(t):
    assert rows(V.search_players(t, " ann EK ", 1990), "player_id", "match") == [(1, "exact")]
    assert rows(V.search_players(t, "bo"), "player_id", "match") == [(2, "part")]
    assert rows(V.search_players(t, "ann ek", 1950), "player_id") == []
