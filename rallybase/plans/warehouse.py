"""Queries of the views and of the publication over a warehouse.

The record tables hold no warehouse; its tables are derived from them by the rules in DERIVED, in SQL that both engines read.
What is checked is the views on them: their SQL is written apart.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import lookups
from ..session import table
from . import publication as P
from . import views as V

_BASE = ("club", "player", "tournament_class_entry_new", "tournament_class_player_new", "match_side_new")


def _values(rows: list[tuple], columns: str) -> str:
    text = lambda v: "NULL" if v is None else "'" + v.replace("'", "''") + "'" if isinstance(v, str) else str(v)
    return f"SELECT * FROM (VALUES {', '.join('(' + ', '.join(map(text, r)) + ')' for r in rows)}) AS v({columns})"


_SEASONS = [(i + 1, f"{2018 + i}-{19 + i}") for i in range(6)]
#: name of a table: how it is made, in order. Integer arithmetic on the ids only, so that every engine agrees.
DERIVED = {
    "w_club": "SELECT club_id, shortname, longname, city, country_code, active, club_type, district_id, remarks FROM club",
    "w_player": "SELECT player_id, firstname, lastname, fullname_raw, CAST(year_born AS INT) AS year_born, is_verified FROM player",
    "w_tournament_class": """SELECT id AS tournament_class_id, 'C' || CAST(id AS STRING) AS tournament_class_id_ext, CAST(FLOOR(id / 10.0) AS BIGINT) + 1 AS tournament_id,
      CASE id % 5 WHEN 0 THEN 'HS' WHEN 1 THEN 'DS' WHEN 2 THEN 'HD' WHEN 3 THEN 'P12' ELSE 'Lag' END AS shortname, 'Klass ' || CAST(id AS STRING) AS longname, DATE '2019-01-05' + CAST(id % 700 AS INT) AS startdate,
      CAST(CASE id % 6 WHEN 0 THEN 9 WHEN 5 THEN NULL ELSE id % 6 END AS INT) AS tournament_class_type_id, CAST(CASE id % 4 WHEN 0 THEN 9 ELSE id % 4 END AS INT) AS tournament_class_structure_id, CAST(CASE id % 3 WHEN 0 THEN NULL WHEN 1 THEN 8 ELSE 16 END AS INT) AS ko_tree_size, id % 7 <> 0 AS is_valid
      FROM (SELECT DISTINCT tournament_class_id AS id FROM tournament_class_entry_new WHERE tournament_class_id IS NOT NULL) AS c""",
    "w_tournament": """SELECT id AS tournament_id, 'T' || CAST(id AS STRING) AS tournament_id_ext, 'Cup ' || CAST(id AS STRING) AS shortname, DATE '2019-01-01' + CAST(id % 400 AS INT) AS startdate, CAST(CASE WHEN id % 6 = 0 THEN NULL ELSE id % 6 END AS INT) AS tournament_status_id,
      CASE WHEN id % 3 = 0 THEN 'DEN' ELSE 'SWE' END AS country_code, CASE WHEN id % 4 = 0 THEN NULL ELSE 'u/' || CAST(id AS STRING) END AS url, 'Ort ' || CAST(id % 20 AS STRING) AS city FROM (SELECT DISTINCT tournament_id AS id FROM w_tournament_class) AS t""",
    "w_tournament_class_type": _values(lookups.CLASS_TYPES, "tournament_class_type_id, description"),
    "w_tournament_class_structure": _values(lookups.STRUCTURES, "tournament_class_structure_id, description"),
    "w_tournament_status": _values(lookups.STATUSES, "tournament_status_id, description"),
    "w_tournament_class_stage": _values([(s[0], s[1], s[2], s[4]) for s in lookups.STAGES], "tournament_class_stage_id, shortname, description, round_order"),
    "w_club_type": _values([(1, "Club"), (2, "District"), (3, "Company")], "club_type_id, description"),
    "w_district": "SELECT DISTINCT district_id, 'District ' || CAST(district_id AS STRING) AS name FROM club WHERE district_id IS NOT NULL AND district_id % 5 <> 0",
    "w_club_id_ext": "SELECT club_id, CAST(club_id + 3000 AS STRING) AS club_id_ext, 3 AS data_source_id FROM club UNION ALL SELECT club_id, CAST(club_id + 70 AS STRING), 1 FROM club WHERE club_id % 3 = 0",
    "w_club_name_alias": "SELECT club_id, remarks AS alias, 'former' AS alias_type FROM club WHERE remarks IS NOT NULL UNION ALL SELECT club_id, longname, 'long' FROM club WHERE club_id % 2 = 0 AND longname IS NOT NULL",
    "w_tournament_class_entry": "SELECT tournament_class_entry_id, tournament_class_id, seed, final_position, tournament_class_entry_group_id_int FROM tournament_class_entry_new",
    "w_tournament_class_player": "SELECT DISTINCT tournament_class_entry_id, player_id, club_id, tournament_player_id_ext FROM tournament_class_player_new",
    "w_tournament_class_group": "SELECT DISTINCT tournament_class_id * 100 + tournament_class_entry_id % 3 AS tournament_class_group_id, tournament_class_id, 'Pool ' || CAST(tournament_class_entry_id % 3 AS STRING) AS description, CAST(tournament_class_entry_id % 3 AS INT) AS sort_order FROM tournament_class_entry_new WHERE tournament_class_id IS NOT NULL",
    "w_tournament_class_group_member": "SELECT tournament_class_id * 100 + tournament_class_entry_id % 3 AS tournament_class_group_id, tournament_class_entry_id, CAST(1 + tournament_class_entry_id % 4 AS INT) AS seed_in_group FROM tournament_class_entry_new WHERE tournament_class_id IS NOT NULL AND tournament_class_entry_id % 5 <> 0",
    "w_match": """SELECT match_id, CAST(CASE WHEN match_id % 4 = 0 THEN NULL ELSE 5 END AS INT) AS best_of, DATE '2020-01-01' + CAST(match_id % 1000 AS INT) AS date, CASE WHEN match_id % 13 = 0 THEN 'scheduled' ELSE 'completed' END AS status,
      CAST(CASE WHEN match_id % 9 = 0 THEN NULL ELSE 1 + match_id % 2 END AS INT) AS winner_side, CAST(CASE WHEN match_id % 23 = 0 THEN 1 + match_id % 2 END AS INT) AS walkover_side FROM (SELECT DISTINCT match_id FROM match_side_new) AS m""",
    "w_match_side": "SELECT DISTINCT match_id, side_no FROM match_side_new",
    "w_match_player": """SELECT match_id, side_no, CAST(ROW_NUMBER() OVER (PARTITION BY match_id, side_no ORDER BY player_id, club_id) AS INT) AS player_order, player_id, club_id
      FROM (SELECT DISTINCT s.match_id, s.side_no, p.player_id, p.club_id FROM match_side_new s JOIN tournament_class_player_new p ON s.represented_entry_id = p.tournament_class_entry_id WHERE p.player_id IS NOT NULL AND p.club_id IS NOT NULL) AS x""",
    "w_tournament_class_match": """SELECT s.match_id, MIN(e.tournament_class_id) AS tournament_class_id, CAST(1 + s.match_id % 8 AS INT) AS tournament_class_stage_id, CASE WHEN s.match_id % 8 = 0 THEN MIN(e.tournament_class_id) * 100 + s.match_id % 3 END AS tournament_class_group_id,
      CAST(CASE WHEN s.match_id % 8 > 0 THEN 1 + s.match_id % 4 END AS INT) AS stage_round_no, CAST(s.match_id % 16 AS INT) AS draw_pos FROM match_side_new s JOIN tournament_class_entry_new e ON s.represented_entry_id = e.tournament_class_entry_id WHERE s.side_no = 1 GROUP BY s.match_id""",
    "w_game": "SELECT match_id, game_no, CAST(CASE WHEN (match_id + game_no) % 7 = 0 THEN 13 WHEN (match_id + game_no) % 2 = 0 THEN 11 ELSE (match_id * game_no) % 10 END AS INT) AS points_side1, CAST(CASE WHEN (match_id + game_no) % 7 = 0 THEN 11 WHEN (match_id + game_no) % 2 = 0 THEN (match_id * game_no) % 10 ELSE 11 END AS INT) AS points_side2 FROM ("
    + " UNION ALL ".join(f"SELECT match_id, {n} AS game_no FROM w_match WHERE match_id % 23 <> 0 AND match_id % 11 <> 1" for n in (1, 2, 3)) + ") AS g",
    "w_season": "SELECT season_id, label, start_date FROM (" + " UNION ALL ".join(f"SELECT {i} AS season_id, '{label}' AS label, DATE '{label[:4]}-07-01' AS start_date" for i, label in _SEASONS) + ") AS s",
    "w_player_license": "SELECT DISTINCT player_id, club_id, CAST(1 + (player_id + club_id) % 6 AS INT) AS season_id FROM tournament_class_player_new WHERE player_id IS NOT NULL AND club_id IS NOT NULL",
    "w_player_transition": "SELECT player_id, MIN(club_id) AS club_id_from, MAX(club_id) AS club_id_to, CAST(1 + player_id % 6 AS INT) AS season_id FROM tournament_class_player_new WHERE player_id IS NOT NULL GROUP BY player_id HAVING MIN(club_id) <> MAX(club_id)",
    "w_player_id_ext": "SELECT player_id, CAST(player_id + 50000 AS STRING) AS player_id_ext, 3 AS data_source_id FROM player UNION ALL SELECT player_id, CAST(player_id + 900000 AS STRING), 1 FROM player WHERE player_id % 5 = 0",
    "w_ranking_group": _values([(i, g[3]) for i, g in enumerate(lookups.RANKING_GROUPS, 1)], "ranking_group_id, class_short"),
    "w_player_ranking_group": "SELECT player_id, CAST(1 + player_id % 22 AS INT) AS ranking_group_id FROM player WHERE player_id % 2 = 0 UNION SELECT player_id, CAST(1 + player_id % 7 AS INT) FROM player WHERE player_id % 3 = 0",
    "w_player_ranking": "SELECT player_id_ext, data_source_id, CAST(length(player_id_ext) * 3 + player_id % 900 AS INT) AS points, DATE '2024-01-01' AS run_date, CAST(player_id % 3 AS INT) AS points_change_since_last, CAST(player_id % 500 AS INT) AS position FROM w_player_id_ext WHERE player_id % 4 <> 1 UNION ALL SELECT player_id_ext, data_source_id, CAST(player_id % 700 AS INT), DATE '2024-02-01', CAST(player_id % 2 AS INT), CAST(player_id % 450 AS INT) FROM w_player_id_ext WHERE player_id % 3 <> 1",
    "w_tournament_raw": "SELECT tournament_id_ext, shortname, CAST(startdate AS STRING) AS startdate FROM w_tournament UNION ALL SELECT 'X' || tournament_id_ext, shortname || ' II', CAST(startdate AS STRING) FROM w_tournament WHERE tournament_id % 3 = 0",
    "w_tournament_class_raw": "SELECT 'T' || CAST(tournament_id AS STRING) AS tournament_id_ext, tournament_class_id_ext, shortname FROM w_tournament_class UNION ALL SELECT 'T' || CAST(tournament_id AS STRING), 'X' || tournament_class_id_ext, shortname FROM w_tournament_class WHERE tournament_class_id % 4 = 0",
    "w_tournament_class_entry_raw": "SELECT 'C' || CAST(tournament_class_id AS STRING) AS tournament_class_id_ext FROM tournament_class_entry_new UNION ALL SELECT 'C' || CAST(tournament_class_id AS STRING) FROM tournament_class_entry_new WHERE tournament_class_id % 9 = 0",
    "w_tournament_class_match_raw": "SELECT 'C' || CAST(tournament_class_id AS STRING) AS tournament_class_id_ext FROM w_tournament_class_match UNION ALL SELECT 'C' || CAST(tournament_class_id AS STRING) FROM w_tournament_class_match WHERE tournament_class_id % 8 = 0",
}


def tables(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    """The warehouse's tables, lazily."""
    for name in _BASE:
        table(spark, d, name).createOrReplaceTempView(name)
    out = {}
    for name, sql in DERIVED.items():
        out[name[2:]] = spark.sql(sql)
        out[name[2:]].createOrReplaceTempView(name)
    return out


_WITH = "WITH " + ",\n".join(f"{name} AS ({sql})" for name, sql in DERIVED.items())
_COMMON = """,
tc AS (SELECT c.*, t.tournament_id_ext AS t_ext, t.shortname AS t_short, t.startdate AS t_start, t.city AS t_city, t.url AS t_url, t.country_code AS t_country, t.tournament_status_id AS t_status FROM w_tournament_class c JOIN w_tournament t USING (tournament_id)),
pl0 AS (SELECT player_id, firstname, lastname, fullname_raw, year_born, coalesce(CAST(is_verified AS INT), 0) AS v, trim(fullname_raw) AS r FROM w_player),
pl AS (SELECT *, CASE WHEN v = 1 THEN trim(concat_ws(' ', firstname, lastname)) ELSE fullname_raw END AS plain_name, CASE WHEN v = 1 THEN trim(concat_ws(' ', firstname, lastname)) WHEN instr(r, ' ') > 0 THEN trim(substr(r, instr(r, ' ') + 1)) || ' ' || substr(r, 1, instr(r, ' ') - 1) ELSE r END AS name FROM pl0),
gt AS (SELECT match_id, string_agg(CAST(points_side1 AS VARCHAR) || '-' || CAST(points_side2 AS VARCHAR), ', ' ORDER BY game_no) AS games_score, count(*) FILTER (WHERE points_side1 > points_side2) AS games_won_side1, count(*) FILTER (WHERE points_side2 > points_side1) AS games_won_side2 FROM w_game GROUP BY match_id),
en AS (SELECT e.tournament_class_entry_id, e.tournament_class_id, e.seed, e.final_position, e.tournament_class_entry_group_id_int AS entry_group_id, s.player_id, s.club_id, s.tournament_player_id_ext, tc.tournament_class_id_ext, tc.shortname AS class_shortname, tc.longname AS class_longname, tc.startdate AS class_date, tc.tournament_id, tc.t_ext AS tournament_id_ext, tc.t_short AS tournament_shortname,
  p.name AS player_name, p.firstname, p.lastname, p.fullname_raw AS player_fullname_raw, p.v AS is_verified, k.shortname AS club_shortname
  FROM w_tournament_class_entry e JOIN w_tournament_class_player s USING (tournament_class_entry_id) JOIN tc ON tc.tournament_class_id = e.tournament_class_id JOIN pl p ON p.player_id = s.player_id JOIN w_club k ON k.club_id = s.club_id),
mc AS (SELECT m.match_id, m.tournament_class_id, m.tournament_class_stage_id, m.tournament_class_group_id, m.stage_round_no, m.draw_pos AS draw_position, tc.tournament_class_id_ext, tc.tournament_id, tc.t_ext AS tournament_id_ext, tc.t_short AS tournament_shortname, tc.t_start AS tournament_startdate, tc.t_city AS tournament_city, tc.t_url AS tournament_url, tc.shortname AS class_shortname, tc.longname AS class_longname, tc.startdate AS class_date,
  x.best_of, x.date, x.status, x.winner_side, x.walkover_side, st.shortname AS stage_shortname, st.description AS stage_description, g.description AS group_name
  FROM w_tournament_class_match m JOIN tc USING (tournament_class_id) JOIN w_match x USING (match_id) LEFT JOIN w_tournament_class_stage st ON st.tournament_class_stage_id = m.tournament_class_stage_id LEFT JOIN w_tournament_class_group g ON g.tournament_class_group_id = m.tournament_class_group_id),
dc AS (SELECT r.tournament_id_ext, r.tournament_class_id_ext, r.shortname AS raw_shortname, c.tournament_class_id, t.shortname AS tournament_name, t.startdate AS tournament_date, CASE WHEN c.tournament_class_id IS NULL THEN 0 ELSE 1 END AS is_resolved,
  (SELECT count(*) FROM w_tournament_class_entry_raw x WHERE x.tournament_class_id_ext = r.tournament_class_id_ext) AS entries_raw_count, (SELECT count(*) FROM w_tournament_class_entry x WHERE x.tournament_class_id = c.tournament_class_id) AS entries_resolved_count,
  (SELECT count(*) FROM w_tournament_class_match_raw x WHERE x.tournament_class_id_ext = r.tournament_class_id_ext) AS matches_raw_count, (SELECT count(*) FROM w_tournament_class_match x WHERE x.tournament_class_id = c.tournament_class_id) AS matches_resolved_count
  FROM w_tournament_class_raw r LEFT JOIN w_tournament_class c USING (tournament_class_id_ext) LEFT JOIN w_tournament t ON t.tournament_id_ext = r.tournament_id_ext),
sd AS (SELECT match_id, side_no, max(player_id) AS player_id, max(club_id) AS club_id FROM w_match_player WHERE player_order = 1 GROUP BY 1, 2),
mq0 AS (SELECT m.match_id, m.winner_side, m.walkover_side, m.status, a.player_id AS p1, b.player_id AS p2, a.club_id AS c1, b.club_id AS c2, pa.v AS v1, pb.v AS v2 FROM w_match m LEFT JOIN sd a ON a.match_id = m.match_id AND a.side_no = 1 LEFT JOIN sd b ON b.match_id = m.match_id AND b.side_no = 2 LEFT JOIN pl pa ON pa.player_id = a.player_id LEFT JOIN pl pb ON pb.player_id = b.player_id),
mq AS (SELECT *, CASE WHEN coalesce(c1, 9999) <> 9999 THEN 1 ELSE 0 END AS k1, CASE WHEN coalesce(c2, 9999) <> 9999 THEN 1 ELSE 0 END AS k2, CASE WHEN p1 = 99999 THEN 1 ELSE 0 END AS u1, CASE WHEN p2 = 99999 THEN 1 ELSE 0 END AS u2 FROM mq0),
ms AS (SELECT *, coalesce(v1, 0) + coalesce(v2, 0) + k1 + k2 AS quality_score FROM mq),
pt AS (SELECT mc.tournament_shortname AS tournament_name, mc.tournament_startdate AS tournament_date, mc.class_shortname, ms.* FROM ms JOIN mc USING (match_id))
"""

_PLAYERS_OF = lambda c, s: f"(SELECT string_agg({c}, ', ' ORDER BY mp.player_order, mp.player_id) FROM w_match_player mp JOIN w_match_side si ON si.match_id = mp.match_id AND si.side_no = mp.side_no JOIN pl ON pl.player_id = mp.player_id JOIN w_club k ON k.club_id = mp.club_id WHERE mp.match_id = mc.match_id AND mp.side_no = {s})"
_SIDE_LISTS = ", ".join(f"{_PLAYERS_OF(c, s)} AS side{s}_{n}" for s in (1, 2) for c, n in (("pl.name", "player_name"), ("CAST(mp.player_id AS VARCHAR)", "player_id"), ("k.shortname", "club_name"), ("CAST(mp.club_id AS VARCHAR)", "club_id"), ("CAST(pl.v AS VARCHAR)", "player_is_verified")))
_LATEST = "(SELECT {what} FROM {source} WHERE x.player_id = p.player_id ORDER BY {order} LIMIT 1)"

#: view: its SQL over the warehouse
SQL = {
    "class_overview": "SELECT tc.tournament_class_id, tc.tournament_class_id_ext, tc.tournament_id, t_ext AS tournament_id_ext, t_short AS tournament_shortname, tc.longname AS class_longname, tc.shortname AS class_shortname, a.description AS tournament_class_type, b.description AS tournament_class_structure, s.description AS tournament_status, tc.ko_tree_size, tc.startdate AS class_date, t_country AS country_code, t_url AS tournament_url, tc.is_valid FROM tc LEFT JOIN w_tournament_class_type a USING (tournament_class_type_id) LEFT JOIN w_tournament_class_structure b USING (tournament_class_structure_id) LEFT JOIN w_tournament_status s ON s.tournament_status_id = tc.t_status",
    "club_overview": "SELECT c.club_id, c.shortname AS club_shortname, c.longname AS club_longname, c.city, c.country_code, c.active, k.description AS club_type, c.district_id, d.name AS district_shortname, (SELECT string_agg(x, ',' ORDER BY x) FROM (SELECT DISTINCT e.club_id_ext || ':' || CAST(e.data_source_id AS VARCHAR) AS x FROM w_club_id_ext e WHERE e.club_id = c.club_id)) AS ext_ids, (SELECT string_agg(x, ',' ORDER BY x) FROM (SELECT DISTINCT a.alias || ' (' || a.alias_type || ')' AS x FROM w_club_name_alias a WHERE a.club_id = c.club_id)) AS aliases FROM w_club c LEFT JOIN w_club_type k ON k.club_type_id = c.club_type LEFT JOIN w_district d USING (district_id)",
    "entry_detail": "SELECT tournament_shortname, class_shortname, class_longname, class_date, firstname, lastname, player_fullname_raw, is_verified, club_shortname, seed, final_position, tournament_player_id_ext, tournament_id, tournament_id_ext, tournament_class_id, tournament_class_id_ext, tournament_class_entry_id, entry_group_id, player_id, club_id FROM en",
    "entry_grouped": "SELECT tournament_shortname, class_shortname, class_longname, class_date, player_name, player_id, club_shortname, club_id, seed AS class_seed, final_position, tournament_player_id_ext, g.description AS group_name, m.seed_in_group AS group_seed, tournament_id, tournament_id_ext, en.tournament_class_id, tournament_class_id_ext, en.tournament_class_entry_id, entry_group_id, m.tournament_class_group_id FROM en LEFT JOIN w_tournament_class_group_member m ON m.tournament_class_entry_id = en.tournament_class_entry_id LEFT JOIN w_tournament_class_group g ON g.tournament_class_group_id = m.tournament_class_group_id",
    "class_roster": "SELECT tournament_class_id, tournament_class_entry_id, tournament_player_id_ext, coalesce(nullif(trim(player_name), ''), trim(player_fullname_raw)) AS name, club_shortname, seed, (SELECT min(g.description) FROM w_tournament_class_group_member m JOIN w_tournament_class_group g USING (tournament_class_group_id) WHERE m.tournament_class_entry_id = en.tournament_class_entry_id) AS group_name FROM en",
    "player_profile": "SELECT p.player_id, p.plain_name AS player_name, p.year_born, p.v AS is_verified, coalesce((SELECT string_agg(x.player_id_ext, ',' ORDER BY x.player_id_ext) FROM w_player_id_ext x WHERE x.player_id = p.player_id), '') AS id_exts, (SELECT count(*) FROM w_player_id_ext x WHERE x.player_id = p.player_id) AS id_ext_count, "
    + _LATEST.format(what="c.shortname || ' (' || s.label || ')'", source="w_player_license x JOIN w_season s USING (season_id) JOIN w_club c USING (club_id)", order="s.start_date DESC, x.club_id DESC") + " AS recent_club, "
    + _LATEST.format(what="tc.t_short || ' - ' || tc.shortname || ' (' || CAST(tc.startdate AS VARCHAR) || ')'", source="w_tournament_class_player x JOIN w_tournament_class_entry e USING (tournament_class_entry_id) JOIN tc ON tc.tournament_class_id = e.tournament_class_id", order="tc.startdate DESC, tc.tournament_class_id DESC") + " AS recent_tournament_class, "
    + "coalesce((SELECT string_agg(g.class_short, ', ' ORDER BY g.class_short) FROM w_player_ranking_group x JOIN w_ranking_group g USING (ranking_group_id) WHERE x.player_id = p.player_id), '') AS ranking_groups, coalesce("
    + _LATEST.format(what="CAST(r.points AS VARCHAR) || ' (' || CAST(r.run_date AS VARCHAR) || ')'", source="w_player_id_ext x JOIN w_player_ranking r ON r.player_id_ext = x.player_id_ext AND r.data_source_id = x.data_source_id", order="r.run_date DESC, r.points DESC") + ", '') AS ranking_points, "
    + _LATEST.format(what="f.shortname || ' → ' || t.shortname || ' (' || s.label || ')'", source="w_player_transition x JOIN w_season s USING (season_id) JOIN w_club f ON f.club_id = x.club_id_from JOIN w_club t ON t.club_id = x.club_id_to", order="s.start_date DESC, x.club_id_to DESC") + " AS recent_transition FROM pl p",
    "match_detail": f"SELECT mc.*, gt.games_score, gt.games_won_side1, gt.games_won_side2, {_SIDE_LISTS}, CAST(games_won_side1 AS VARCHAR) || '-' || CAST(games_won_side2 AS VARCHAR) AS match_score_summary, CASE winner_side WHEN 1 THEN {_PLAYERS_OF('pl.name', 1)} WHEN 2 THEN {_PLAYERS_OF('pl.name', 2)} END AS winner_name FROM mc LEFT JOIN gt USING (match_id)",
    "player_match_history": "SELECT a.player_id, mc.tournament_shortname, mc.class_longname, mc.class_date AS date, CASE WHEN mc.winner_side = a.side_no THEN 'WIN' WHEN mc.winner_side IS NOT NULL THEN 'LOSS' END AS result, o.name AS opponent_name, b.player_id AS opponent_player_id, kb.shortname AS opponent_club, CAST(gt.games_won_side1 AS VARCHAR) || '-' || CAST(gt.games_won_side2 AS VARCHAR) AS match_score_summary, gt.games_score, mc.stage_description, mc.match_id, mc.best_of, mc.date AS match_date, mc.status AS match_status, mc.winner_side, mc.walkover_side, a.side_no AS player_side_no, ka.shortname AS player_club, gt.games_won_side1, gt.games_won_side2, mc.tournament_id, mc.tournament_class_id FROM w_match_player a JOIN mc USING (match_id) LEFT JOIN w_match_player b ON b.match_id = a.match_id AND b.side_no <> a.side_no AND b.player_order = 1 LEFT JOIN pl o ON o.player_id = b.player_id LEFT JOIN w_club kb ON kb.club_id = b.club_id LEFT JOIN w_club ka ON ka.club_id = a.club_id LEFT JOIN gt ON gt.match_id = a.match_id",
    "dq_summary": "SELECT m.*, p.*, r.*, round(100.0 * tournaments_resolved / nullif(tournaments_raw, 0), 1) AS tournaments_pct, round(100.0 * classes_resolved / nullif(classes_raw, 0), 1) AS classes_pct, round(100.0 * entries_resolved / nullif(entries_raw, 0), 1) AS entries_pct, round(100.0 * matches_resolved / nullif(matches_raw, 0), 1) AS matches_pct, round(100.0 * matches_with_winner / nullif(matches_resolved, 0), 1) AS matches_winner_pct, round(100.0 * match_players_verified / nullif(match_players_total, 0), 1) AS match_players_verified_pct, match_players_total - match_clubs_unknown AS match_clubs_known, round(100.0 * (match_players_total - match_clubs_unknown) / nullif(match_players_total, 0), 1) AS match_clubs_known_pct FROM (SELECT count(*) AS matches_resolved, count(winner_side) AS matches_with_winner, count(walkover_side) AS matches_walkover FROM w_match) m, (SELECT count(*) AS match_players_total, count(*) FILTER (WHERE club_id = 9999) AS match_clubs_unknown, count(*) FILTER (WHERE x.player_id = 99999) AS match_players_unknown, count(*) FILTER (WHERE v = 1) AS match_players_verified, count(*) FILTER (WHERE v = 0 AND x.player_id <> 99999) AS match_players_unverified FROM w_match_player x LEFT JOIN pl USING (player_id)) p, (SELECT (SELECT count(*) FROM w_tournament_raw) AS tournaments_raw, (SELECT count(*) FROM w_tournament) AS tournaments_resolved, (SELECT count(*) FROM w_tournament_class_raw) AS classes_raw, (SELECT count(*) FROM w_tournament_class) AS classes_resolved, (SELECT count(*) FROM w_tournament_class_entry_raw) AS entries_raw, (SELECT count(*) FROM w_tournament_class_entry) AS entries_resolved, (SELECT count(*) FROM w_tournament_class_match_raw) AS matches_raw) r",
    "dq_tournaments": "SELECT r.tournament_id_ext, r.shortname AS raw_shortname, r.startdate AS raw_startdate, CASE WHEN t.tournament_id IS NULL THEN 0 ELSE 1 END AS is_resolved, t.tournament_id, t.shortname AS resolved_shortname, (SELECT count(*) FROM w_tournament_class_raw x WHERE x.tournament_id_ext = r.tournament_id_ext) AS classes_raw_count, (SELECT count(*) FROM w_tournament_class x WHERE x.tournament_id = t.tournament_id) AS classes_resolved_count FROM w_tournament_raw r LEFT JOIN w_tournament t USING (tournament_id_ext)",
    "dq_classes": "SELECT * FROM dc",
    "dq_classes_with_issues": "SELECT * FROM (SELECT tournament_id_ext, tournament_class_id_ext, raw_shortname AS class_shortname, tournament_name, tournament_date, CASE is_resolved WHEN 0 THEN 'Not resolved' ELSE 'Resolved' END AS resolution_status, entries_raw_count AS entries_raw, entries_resolved_count AS entries_resolved, matches_raw_count AS matches_raw, matches_resolved_count AS matches_resolved, CASE WHEN is_resolved = 0 THEN 'CLASS_NOT_RESOLVED' WHEN entries_raw_count > entries_resolved_count THEN 'ENTRIES_MISSING' WHEN matches_raw_count > matches_resolved_count THEN 'MATCHES_MISSING' END AS issue_type FROM dc) WHERE issue_type IS NOT NULL",
    "dq_matches": "SELECT match_id, tournament_name, tournament_date, class_shortname, winner_side, walkover_side, status, p1 AS side1_player_id, v1 AS side1_is_verified, u1 AS side1_is_unknown_player, CASE WHEN c1 = 9999 THEN 1 ELSE 0 END AS side1_is_unknown_club, p2 AS side2_player_id, v2 AS side2_is_verified, u2 AS side2_is_unknown_player, CASE WHEN c2 = 9999 THEN 1 ELSE 0 END AS side2_is_unknown_club, (SELECT count(*) FROM w_game g WHERE g.match_id = pt.match_id) AS game_count, quality_score FROM pt",
    "dq_quality_summary": "SELECT quality_score, count(*) AS match_count, round(100.0 * count(*) / sum(count(*)) OVER (), 1) AS pct FROM ms GROUP BY 1",
    "dq_matches_by_tournament": "SELECT tournament_name, tournament_date, count(*) AS total_matches, count(*) FILTER (WHERE quality_score = 4) AS perfect_matches, count(*) FILTER (WHERE u1 = 1 OR u2 = 1) AS matches_with_unknown_player, count(*) FILTER (WHERE k1 = 0 OR k2 = 0) AS matches_with_unknown_club, round(100.0 * count(*) FILTER (WHERE quality_score = 4) / count(*), 1) AS perfect_pct, round(avg(quality_score), 2) AS avg_quality_score FROM pt GROUP BY 1, 2",
    "dq_players": "SELECT p.*, round(100.0 * verified_players / nullif(total_players, 0), 1) AS verified_pct, a.* FROM (SELECT count(*) FILTER (WHERE v = 1) AS verified_players, count(*) FILTER (WHERE v = 0 AND player_id <> 99999) AS unverified_players, count(*) AS total_players FROM pl) p, (SELECT count(*) FILTER (WHERE v = 1) AS verified_match_appearances, count(*) FILTER (WHERE v = 0) AS unverified_match_appearances, count(*) AS total_match_appearances FROM w_match_player JOIN pl USING (player_id)) a",
    "dq_unverified_by_appearances": "SELECT p.player_id, p.firstname, p.lastname, p.year_born, count(m.match_id) AS match_count, count(DISTINCT m.club_id) AS clubs_count, string_agg(DISTINCT k.shortname, ',' ORDER BY k.shortname) AS clubs FROM pl p JOIN w_match_player m USING (player_id) LEFT JOIN w_club k ON k.club_id = m.club_id WHERE p.v = 0 AND p.player_id <> 99999 GROUP BY ALL",
    "best_rankings": "SELECT p.player_id, p.name, p.year_born, b.points, b.position, b.run_date, (SELECT c.shortname FROM w_player_license l JOIN w_season s USING (season_id) LEFT JOIN w_club c USING (club_id) WHERE l.player_id = p.player_id ORDER BY s.start_date DESC, l.club_id DESC LIMIT 1) AS club FROM (SELECT player_id, year_born, CASE WHEN v = 1 THEN concat_ws(' ', firstname, lastname) ELSE name END AS name FROM pl) p LEFT JOIN LATERAL (SELECT z.points, z.position, z.run_date FROM (SELECT x.player_id_ext, x.data_source_id, r.points, r.position, r.run_date, row_number() OVER (PARTITION BY x.player_id_ext, x.data_source_id ORDER BY r.run_date DESC, r.points DESC) AS n, (SELECT max(q.run_date) FROM w_player_ranking q WHERE q.player_id_ext = x.player_id_ext AND q.data_source_id = x.data_source_id AND q.points_change_since_last <> 0) AS changed FROM w_player_id_ext x JOIN w_player_ranking r ON r.player_id_ext = x.player_id_ext AND r.data_source_id = x.data_source_id WHERE x.player_id = p.player_id) z WHERE z.n = 1 ORDER BY z.run_date DESC, CASE z.data_source_id WHEN 3 THEN 0 ELSE 1 END, z.changed DESC NULLS LAST, z.points DESC NULLS LAST, z.player_id_ext DESC LIMIT 1) b ON true",
    "player_results": "SELECT p.player_id, t.total_matches, t.match_wins, t.total_matches - t.match_wins AS match_losses, round(t.match_wins * 100.0 / nullif(t.total_matches, 0), 2) AS match_win_percentage, g.* EXCLUDE (pid), round(g.sets_won * 100.0 / nullif(g.total_sets, 0), 2) AS set_win_percentage, round(g.deuce_sets_won * 100.0 / nullif(g.total_deuce_sets, 0), 2) AS deuce_win_percentage, round(g.total_points_scored * 100.0 / nullif(g.total_points_scored + g.total_points_lost, 0), 2) AS points_win_percentage FROM w_player p LEFT JOIN (SELECT player_id, count(DISTINCT m.match_id) AS total_matches, count(*) FILTER (WHERE m.winner_side = x.side_no) AS match_wins FROM w_match_player x JOIN w_match m USING (match_id) WHERE m.status = 'completed' AND m.walkover_side IS NULL GROUP BY 1) t ON t.player_id = p.player_id LEFT JOIN (SELECT pid, count(*) AS total_sets, count(*) FILTER (WHERE o > l) AS sets_won, count(*) - count(*) FILTER (WHERE o > l) AS sets_lost, count(*) FILTER (WHERE greatest(o, l) > 11) AS total_deuce_sets, count(*) FILTER (WHERE greatest(o, l) > 11 AND o > l) AS deuce_sets_won, count(*) FILTER (WHERE greatest(o, l) > 11) - count(*) FILTER (WHERE greatest(o, l) > 11 AND o > l) AS deuce_sets_lost, sum(o)::BIGINT AS total_points_scored, sum(l)::BIGINT AS total_points_lost, round(avg(o), 2) AS avg_points_scored_per_set, round(avg(l), 2) AS avg_points_lost_per_set, max(o) AS max_points_scored_in_set, min(o) AS min_points_scored_in_set, max(l) AS max_points_lost_in_set, min(l) AS min_points_lost_in_set FROM (SELECT x.player_id AS pid, CASE x.side_no WHEN 1 THEN points_side1 ELSE points_side2 END AS o, CASE x.side_no WHEN 1 THEN points_side2 ELSE points_side1 END AS l FROM w_match_player x JOIN w_match m USING (match_id) JOIN w_game USING (match_id) WHERE m.status = 'completed' AND m.walkover_side IS NULL) GROUP BY pid) g ON g.pid = p.player_id",
    "player_matches": "SELECT a.match_id, a.side_no, (SELECT string_agg(o.name, ' / ' ORDER BY o.name) FROM w_match_player b JOIN pl o USING (player_id) WHERE b.match_id = a.match_id AND b.side_no = 3 - a.side_no) AS opponents, CASE w.win WHEN a.side_no THEN 'W' WHEN 3 - a.side_no THEN 'L' END AS result, CASE WHEN w.walkover_side IS NOT NULL THEN 'WO' ELSE (SELECT string_agg(CAST(game_no AS VARCHAR) || ': ' || CASE a.side_no WHEN 1 THEN CAST(points_side1 AS VARCHAR) || '-' || CAST(points_side2 AS VARCHAR) ELSE CAST(points_side2 AS VARCHAR) || '-' || CAST(points_side1 AS VARCHAR) END, ', ' ORDER BY game_no) FROM w_game g WHERE g.match_id = a.match_id) END AS score FROM w_match_player a JOIN pl p ON p.player_id = a.player_id JOIN (SELECT m.match_id, m.walkover_side, coalesce(m.winner_side, CASE WHEN games_won_side1 > games_won_side2 THEN 1 WHEN games_won_side2 > games_won_side1 THEN 2 END, 3 - m.walkover_side) AS win FROM w_match m LEFT JOIN gt USING (match_id)) w ON w.match_id = a.match_id",
    "players_named": "SELECT player_id, plain_name AS player_name, year_born, v AS is_verified, CASE WHEN lower(plain_name) = 'anna ek' THEN 'exact' ELSE 'part' END AS match FROM pl WHERE (contains(lower(plain_name), 'an') OR contains(lower(fullname_raw), 'an')) AND (year_born IS NULL OR year_born = 1980)",
}


def _numbered(t: dict[str, DataFrame]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Sides, matches and games as the publication reads them."""
    named = V._players(t).select("player_id", F.col("player_name").alias("name"))
    return t["match_player"].select("match_id", "side_no", "player_id").join(named, "player_id"), t["match"], t["game"].select("match_id", "game_no", F.col("points_side1").alias("points1"), F.col("points_side2").alias("points2"))


def best_rankings(t: dict[str, DataFrame]) -> DataFrame:
    """Every player with the best of the rankings under all external ids, and the latest club."""
    rankings = t["player_id_ext"].join(t["player_ranking"], ["player_id_ext", "data_source_id"])
    licences = t["player_license"].join(t["season"].select("season_id", F.col("start_date").alias("valid_from")), "season_id")
    return P.profiles(t["player"], rankings, licences, t["club"], "salt", 3).drop("public_id")


def player_results(t: dict[str, DataFrame]) -> DataFrame:
    return P.results_summary(t["player"], t["match_player"], t["match"], t["game"])


def player_matches(t: dict[str, DataFrame]) -> DataFrame:
    sides, matches, games = _numbered(t)
    return P.match_rows(sides, matches, games, "salt").drop("public_id")


def players_named(t: dict[str, DataFrame]) -> DataFrame:
    return V.search_players(t, " AN ", 1980)


def dq_matches(t: dict[str, DataFrame]) -> DataFrame:
    return V.dq_matches(t).drop("_k1", "_k2")


_MADE = {**V.VIEWS, "dq_matches": dq_matches, **{f.__name__: f for f in (best_rankings, player_results, player_matches, players_named)}}


def _query(name: str, make):  # noqa: ANN001, ANN202
    def run(spark: SparkSession, d: str) -> DataFrame:
        return make(tables(spark, d))

    run.__name__, run.__doc__ = f"q_view_{name}", make.__doc__
    return run


def queries() -> dict:
    return {f"q_view_{n}": _query(n, f) for n, f in _MADE.items()}


def oracle_sql() -> dict[str, str]:
    return {f"q_view_{n}": _WITH + _COMMON + SQL[n] for n in _MADE}
