"""Analytical queries: overviews, profiles, histories, data-quality views, on the star-schema and record tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import relational as R
from ..session import stash, table

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


@query("""SELECT o_orderkey, c_name, n_name, r_name, o_orderdate, o_totalprice FROM orders JOIN customer ON o_custkey = c_custkey
LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey""")
def q_overview_lookups(s: SparkSession, d: str) -> DataFrame:
    """Facts with their lookups, newest first."""
    out = table(s, d, "orders").join(table(s, d, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    out = out.join(F.broadcast(table(s, d, "nation")), F.col("c_nationkey") == F.col("n_nationkey"), "left").join(F.broadcast(table(s, d, "region")), F.col("n_regionkey") == F.col("r_regionkey"), "left")  # 25 and 5 rows by definition
    return out.select("o_orderkey", "c_name", "n_name", "r_name", "o_orderdate", "o_totalprice").orderBy(F.desc("o_orderdate"), "o_orderkey")


@query("""SELECT r_regionkey, r_name, count(DISTINCT n_name) AS n_nations, string_agg(DISTINCT n_name, ',' ORDER BY n_name) AS nations FROM region LEFT JOIN nation ON r_regionkey = n_regionkey GROUP BY 1, 2""")
def q_group_concat_distinct(s: SparkSession, d: str) -> DataFrame:
    n = table(s, d, "nation").groupBy("n_regionkey").agg(F.countDistinct("n_name").alias("n_nations"), R.ordered_list(F.col("n_name"), [F.col("n_name")], distinct=True).alias("nations"))
    return table(s, d, "region").join(n, F.col("r_regionkey") == F.col("n_regionkey"), "left").select("r_regionkey", "r_name", F.coalesce("n_nations", F.lit(0)).alias("n_nations"), "nations")


@query("""SELECT c.club_id, c.shortname, count(DISTINCT l.club_name) AS n_spellings, string_agg(DISTINCT l.data_source_id || ':' || trim(l.club_id_ext), ',' ORDER BY l.data_source_id || ':' || trim(l.club_id_ext)) AS external_ids
FROM club c LEFT JOIN player_license_raw l ON l.club_name = c.shortname GROUP BY 1, 2""")
def q_club_overview(s: SparkSession, d: str) -> DataFrame:
    """Clubs with the external ids under which licences name them; licences are aggregated before the join."""
    ids = table(s, d, "player_license_raw").withColumn("x", F.concat(F.col("data_source_id").cast("string"), F.lit(":"), F.trim("club_id_ext"))).groupBy("club_name").agg(R.ordered_list(F.col("x"), [F.col("x")], distinct=True).alias("external_ids"))
    return table(s, d, "club").join(ids, F.col("shortname") == F.col("club_name"), "left").select("club_id", "shortname", F.col("club_name").isNotNull().cast("long").alias("n_spellings"), "external_ids")


@query("""SELECT l_orderkey, l_linenumber, c_name, p_name, s_name, l_quantity FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey WHERE l_returnflag = 'R' AND l_quantity >= 40""")
def q_entry_detail(s: SparkSession, d: str) -> DataFrame:
    """Five-way inner join with a filter that reaches the scan."""
    li = table(s, d, "lineitem").filter((F.col("l_returnflag") == "R") & (F.col("l_quantity") >= 40))
    out = li.join(table(s, d, "orders"), F.col("l_orderkey") == F.col("o_orderkey")).join(table(s, d, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    out = out.join(table(s, d, "part"), F.col("l_partkey") == F.col("p_partkey")).join(table(s, d, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
    return out.select("l_orderkey", "l_linenumber", "c_name", "p_name", "s_name", "l_quantity").orderBy("l_orderkey", "l_linenumber")


@query("""WITH o AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders),
a AS (SELECT o_custkey, count(*) AS n_orders, string_agg(DISTINCT o_orderpriority, ',' ORDER BY o_orderpriority) AS priorities FROM orders GROUP BY 1),
e AS (SELECT user_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events)
SELECT c_custkey, c_name, n_name, o.o_orderkey AS last_order, o.o_orderstatus AS last_status, coalesce(n_orders, 0) AS n_orders, priorities, e.event_type AS last_event
FROM customer JOIN nation ON c_nationkey = n_nationkey LEFT JOIN o ON o.o_custkey = c_custkey AND o.rn = 1 LEFT JOIN a ON a.o_custkey = c_custkey LEFT JOIN e ON e.user_id = c_custkey AND e.rn = 1""")
def q_profile_latest(s: SparkSession, d: str) -> DataFrame:
    """Profile of every customer: latest order, latest event, pre-aggregated lists."""
    o = table(s, d, "orders")
    last = R.latest_per_group(o, ["o_custkey"], [F.desc("o_orderdate"), F.desc("o_orderkey")]).select("o_custkey", F.col("o_orderkey").alias("last_order"), F.col("o_orderstatus").alias("last_status"))
    agg = o.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n_orders"), R.ordered_list(F.col("o_orderpriority"), [F.col("o_orderpriority")], distinct=True).alias("priorities"))
    ev = R.latest_per_group(table(s, d, "events"), ["user_id"], [F.desc("ts"), F.desc("event_id")]).select("user_id", F.col("event_type").alias("last_event"))
    c = table(s, d, "customer").join(F.broadcast(table(s, d, "nation")), F.col("c_nationkey") == F.col("n_nationkey"))  # 25 rows by definition
    c = c.join(last, F.col("c_custkey") == last["o_custkey"], "left").drop("o_custkey").join(agg, F.col("c_custkey") == agg["o_custkey"], "left").drop("o_custkey").join(ev, F.col("c_custkey") == F.col("user_id"), "left")
    return c.select("c_custkey", "c_name", "n_name", "last_order", "last_status", F.coalesce("n_orders", F.lit(0)).alias("n_orders"), "priorities", "last_event")


@query("""SELECT p_partkey, CASE WHEN instr(trim(p_name), ' ') > 0 THEN trim(substr(trim(p_name), instr(trim(p_name), ' ') + 1)) || ' ' || substr(trim(p_name), 1, instr(trim(p_name), ' ') - 1) ELSE trim(p_name) END AS flipped FROM part""")
def q_name_flip(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "part").select("p_partkey", S.flip_name(F.col("p_name")).alias("flipped"))


@query("""SELECT player_id, CASE WHEN is_verified THEN concat_ws(' ', firstname, lastname) WHEN instr(trim(fullname_raw), ' ') > 0 THEN trim(substr(trim(fullname_raw), instr(trim(fullname_raw), ' ') + 1)) || ' ' || substr(trim(fullname_raw), 1, instr(trim(fullname_raw), ' ') - 1) ELSE trim(fullname_raw) END AS display_name FROM player""")
def q_display_name(s: SparkSession, d: str) -> DataFrame:
    """Verified players by first and last name, others with the part before the first blank at the end."""
    return table(s, d, "player").select("player_id", S.display_name(F.col("is_verified"), F.col("firstname"), F.col("lastname"), F.col("fullname_raw")).alias("display_name"))


@query("""SELECT l_orderkey, count(*) AS n_lines, string_agg(l_linenumber || ':' || CAST(CAST(l_quantity AS INTEGER) AS VARCHAR), ', ' ORDER BY l_linenumber, CAST(CAST(l_quantity AS INTEGER) AS VARCHAR)) AS score_text FROM lineitem GROUP BY 1""")
def q_order_score_text(s: SparkSession, d: str) -> DataFrame:
    li = table(s, d, "lineitem")
    text = F.concat(F.col("l_linenumber").cast("string"), F.lit(":"), F.col("l_quantity").cast("int").cast("string"))
    return li.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n_lines"), R.ordered_list(text, [F.col("l_linenumber")], ", ").alias("score_text"))


@query("""WITH l AS (SELECT l_orderkey, l_linenumber, l_suppkey, l_extendedprice FROM lineitem WHERE l_linenumber <= 2)
SELECT a.l_orderkey, a.l_linenumber AS side_no, a.l_suppkey AS player, b.l_suppkey AS opponent, CASE WHEN a.l_extendedprice > b.l_extendedprice THEN 'WIN' WHEN a.l_extendedprice < b.l_extendedprice THEN 'LOSS' END AS result
FROM l a LEFT JOIN l b ON a.l_orderkey = b.l_orderkey AND a.l_linenumber <> b.l_linenumber""")
def q_history_win_loss(s: SparkSession, d: str) -> DataFrame:
    """Each side of a match with its opponent and result: an equi-join with an inequality left over."""
    li = table(s, d, "lineitem").filter("l_linenumber <= 2").select("l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice")
    a, b = li.alias("a"), li.alias("b")
    both = a.join(b, (F.col("a.l_orderkey") == F.col("b.l_orderkey")) & (F.col("a.l_linenumber") != F.col("b.l_linenumber")), "left")
    result = F.when(F.col("a.l_extendedprice") > F.col("b.l_extendedprice"), "WIN").when(F.col("a.l_extendedprice") < F.col("b.l_extendedprice"), "LOSS")
    return both.select("a.l_orderkey", F.col("a.l_linenumber").alias("side_no"), F.col("a.l_suppkey").alias("player"), F.col("b.l_suppkey").alias("opponent"), result.alias("result"))


@query("""SELECT (SELECT count(*) FROM player) AS players, (SELECT count(*) FROM player WHERE is_verified) AS verified, (SELECT count(*) FROM club) AS clubs, (SELECT count(*) FROM player_license_raw) AS licences,
(SELECT count(DISTINCT content_hash) FROM player_license_raw) AS distinct_licences, (SELECT round(100.0 * count(player_id_ext) / nullif(count(*), 0), 1) FROM player_license_raw) AS pct_with_person,
(SELECT round(100.0 * count(*) FILTER (WHERE s1_player_id_ext IS NOT NULL AND s2_player_id_ext IS NOT NULL) / nullif(count(*), 0), 1) FROM tournament_class_match_raw) AS pct_matches_with_numbers""")
def q_dq_summary(s: SparkSession, d: str) -> DataFrame:
    """One row of counts and rates; each table is aggregated to one row, the rows are joined on a constant."""
    pct = lambda n: F.round(F.lit(100.0).cast("double") * n / F.nullif(F.count(F.lit(1)), F.lit(0)), 1)
    one = F.lit(1).alias("one")
    p = table(s, d, "player").agg(F.count(F.lit(1)).alias("players"), F.count_if(F.col("is_verified")).alias("verified")).withColumn("one", one)
    c = table(s, d, "club").agg(F.count(F.lit(1)).alias("clubs")).withColumn("one", one)
    lic = table(s, d, "player_license_raw").agg(F.count(F.lit(1)).alias("licences"), F.countDistinct("content_hash").alias("distinct_licences"), pct(F.count("player_id_ext")).alias("pct_with_person")).withColumn("one", one)
    m = table(s, d, "tournament_class_match_raw").agg(pct(F.count_if(F.col("s1_player_id_ext").isNotNull() & F.col("s2_player_id_ext").isNotNull())).alias("pct_matches_with_numbers")).withColumn("one", one)
    return p.join(c, "one").join(lic, "one").join(m, "one").drop("one")


@query("""WITH l AS (SELECT l_orderkey, count(*) AS n, count(*) FILTER (WHERE l_returnflag = 'R') AS r FROM lineitem GROUP BY 1)
SELECT o_orderkey, coalesce(n, 0) AS n_lines, coalesce(r, 0) AS n_returned, round(100.0 * coalesce(r, 0) / nullif(n, 0), 1) AS pct_returned FROM orders LEFT JOIN l ON o_orderkey = l_orderkey""")
def q_dq_rates(s: SparkSession, d: str) -> DataFrame:
    li = table(s, d, "lineitem").groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("l_returnflag") == "R").alias("r"))
    out = table(s, d, "orders").select("o_orderkey").join(li, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    return out.select("o_orderkey", F.coalesce("n", F.lit(0)).alias("n_lines"), F.coalesce("r", F.lit(0)).alias("n_returned"), F.round(F.lit(100.0).cast("double") * F.coalesce("r", F.lit(0)) / F.col("n"), 1).alias("pct_returned"))


_CLASSES = """WITH m AS (SELECT tournament_class_id_ext AS class_id, count(*) AS n_matches, count(*) FILTER (WHERE game_point_tokens IS NULL OR trim(game_point_tokens) = '') AS n_without_score FROM tournament_class_match_raw GROUP BY 1),
g AS (SELECT tournament_class_id_ext AS class_id, count(DISTINCT group_id_ext) AS n_groups FROM tournament_class_match_raw GROUP BY 1),
p AS (SELECT class_id, count(DISTINCT name) AS n_names FROM (SELECT tournament_class_id_ext AS class_id, s1_fullname_raw AS name FROM tournament_class_match_raw UNION ALL SELECT tournament_class_id_ext, s2_fullname_raw FROM tournament_class_match_raw) GROUP BY 1),
c AS (SELECT m.class_id, n_matches, n_without_score, coalesce(n_groups, 0) AS n_groups, coalesce(n_names, 0) AS n_names FROM m LEFT JOIN g USING (class_id) LEFT JOIN p USING (class_id))
"""


def _classes(s: SparkSession, d: str) -> DataFrame:
    m = table(s, d, "tournament_class_match_raw").withColumnRenamed("tournament_class_id_ext", "class_id")
    blank = F.col("game_point_tokens").isNull() | (F.trim("game_point_tokens") == "")
    counts = m.groupBy("class_id").agg(F.count(F.lit(1)).alias("n_matches"), F.count_if(blank).alias("n_without_score"), F.countDistinct("group_id_ext").alias("n_groups"))
    names = m.select("class_id", F.explode(F.array("s1_fullname_raw", "s2_fullname_raw")).alias("name")).groupBy("class_id").agg(F.countDistinct("name").alias("n_names"))
    return counts.join(names, "class_id", "left").withColumn("n_names", F.coalesce("n_names", F.lit(0)))


@query(_CLASSES + "SELECT * FROM c")
def q_dq_classes(s: SparkSession, d: str) -> DataFrame:
    return _classes(s, d)


@query(_CLASSES + "SELECT class_id, n_matches, n_without_score, CASE WHEN n_groups = 0 THEN 'no groups' WHEN n_without_score > 0 THEN 'matches without score' ELSE 'few names' END AS issue FROM c WHERE n_groups = 0 OR n_without_score > 0 OR n_names < 4")
def q_dq_issues(s: SparkSession, d: str) -> DataFrame:
    """Classes with an issue, the first that applies."""
    issue = F.when(F.col("n_groups") == 0, "no groups").when(F.col("n_without_score") > 0, "matches without score").otherwise("few names")
    return _classes(s, d).filter("n_groups = 0 or n_without_score > 0 or n_names < 4").select("class_id", "n_matches", "n_without_score", issue.alias("issue"))


_SCORE = "CAST(s1_player_id_ext IS NOT NULL AS INTEGER) + CAST(s2_player_id_ext IS NOT NULL AS INTEGER) + CAST(s1_clubname_raw IS NOT NULL AND s2_clubname_raw IS NOT NULL AS INTEGER) + CAST(best_of IS NOT NULL AS INTEGER)"


def _score() -> Column:
    has = lambda *c: sum((F.col(x).isNotNull().cast("int") for x in c[1:]), F.col(c[0]).isNotNull().cast("int"))
    clubs = (F.col("s1_clubname_raw").isNotNull() & F.col("s2_clubname_raw").isNotNull()).cast("int")
    return has("s1_player_id_ext", "s2_player_id_ext", "best_of") + clubs


@query(f"SELECT row_id, {_SCORE} AS quality FROM tournament_class_match_raw")
def q_quality_score(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "tournament_class_match_raw").select("row_id", _score().alias("quality"))


@query(f"WITH q AS (SELECT {_SCORE} AS quality FROM tournament_class_match_raw) SELECT quality, count(*) AS n, round(100.0 * count(*) / (SELECT count(*) FROM q), 1) AS pct FROM q GROUP BY 1")
def q_quality_hist(s: SparkSession, d: str) -> DataFrame:
    n = table(s, d, "tournament_class_match_raw").groupBy(_score().alias("quality")).agg(F.count(F.lit(1)).alias("n"))
    return R.share_of_total(n, "n")


@query(f"SELECT tournament_id_ext, count(*) AS n, CAST(sum(CASE WHEN q = 4 THEN 1 ELSE 0 END) AS BIGINT) AS n_best, round(avg(q), 3) AS avg_quality, round(100.0 * sum(CASE WHEN q < 2 THEN 1 ELSE 0 END) / count(*), 1) AS pct_poor FROM (SELECT tournament_id_ext, {_SCORE} AS q FROM tournament_class_match_raw) GROUP BY 1")
def q_quality_by_group(s: SparkSession, d: str) -> DataFrame:
    q = table(s, d, "tournament_class_match_raw").select("tournament_id_ext", _score().alias("q"))
    return q.groupBy("tournament_id_ext").agg(F.count(F.lit(1)).alias("n"), F.sum(F.when(F.col("q") == 4, 1).otherwise(0)).alias("n_best"), F.round(F.avg("q"), 3).alias("avg_quality"), F.round(F.lit(100.0).cast("double") * F.sum(F.when(F.col("q") < 2, 1).otherwise(0)) / F.count(F.lit(1)), 1).alias("pct_poor"))


@query("""SELECT count(*) AS orders, count(*) FILTER (WHERE o_orderstatus = 'F') AS finished, count(*) FILTER (WHERE o_orderstatus = 'O') AS open, count(*) FILTER (WHERE o_totalprice > 100000) AS large FROM orders""")
def q_count_filter(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "orders").agg(F.count(F.lit(1)).alias("orders"), F.count_if(F.col("o_orderstatus") == "F").alias("finished"), F.count_if(F.col("o_orderstatus") == "O").alias("open"), F.count_if(F.col("o_totalprice") > 100000).alias("large"))


@query("""SELECT p.player_id, p.fullname_raw, count(*) AS appearances, count(DISTINCT t.club_id) AS n_clubs, string_agg(DISTINCT CAST(t.club_id AS VARCHAR), ',' ORDER BY CAST(t.club_id AS VARCHAR)) AS clubs
FROM player p JOIN tournament_class_player_new t USING (player_id) WHERE NOT p.is_verified GROUP BY 1, 2""")
def q_rank_by_appearance(s: SparkSession, d: str) -> DataFrame:
    """Unverified players by appearances; appearances are aggregated before the join."""
    c = F.col("club_id").cast("string")
    t = table(s, d, "tournament_class_player_new").groupBy("player_id").agg(F.count(F.lit(1)).alias("appearances"), F.countDistinct("club_id").alias("n_clubs"), R.ordered_list(c, [c], distinct=True).alias("clubs"))
    return table(s, d, "player").filter("not is_verified").select("player_id", "fullname_raw").join(t, "player_id").orderBy(F.desc("appearances"), "player_id")


@query("""WITH a AS (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS rn FROM events),
c AS (SELECT user_id, event_type, max(CASE WHEN value > 0 THEN ts END) AS last_change FROM events GROUP BY 1, 2),
b AS (SELECT a.user_id, a.event_type, a.ts, a.value, a.event_id, c.last_change FROM a JOIN c USING (user_id, event_type) WHERE rn = 1),
r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, CASE WHEN event_type = 'purchase' THEN 0 ELSE 1 END, last_change DESC NULLS LAST, value DESC NULLS LAST, event_id DESC) AS rk FROM b)
SELECT user_id, event_type, event_id, ts, value FROM r WHERE rk = 1""")
def q_best_snapshot(s: SparkSession, d: str) -> DataFrame:
    """The best snapshot of each user: latest per kind, then by date, preferred kind, last change, value and number."""
    e = table(s, d, "events")
    latest = R.latest_per_group(e, ["user_id", "event_type"], [F.desc("ts"), F.desc("event_id")])
    change = e.groupBy("user_id", "event_type").agg(F.max(F.when(F.col("value") > 0, F.col("ts"))).alias("last_change"))
    order = [F.desc("ts"), F.when(F.col("event_type") == "purchase", 0).otherwise(1), F.desc_nulls_last("last_change"), F.desc_nulls_last("value"), F.desc("event_id")]
    return R.latest_per_group(latest.join(change, ["user_id", "event_type"]), ["user_id"], order).select("user_id", "event_type", "event_id", "ts", "value")


@query("""SELECT l_suppkey, count(DISTINCT l_orderkey) AS matches, CAST(sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS BIGINT) AS lost, CAST(sum(CASE WHEN CASE WHEN l_quantity IS NULL OR l_linenumber IS NULL THEN NULL ELSE greatest(l_quantity, l_linenumber) END > 25 THEN 1 ELSE 0 END) AS BIGINT) AS deuce,
round(avg(l_quantity), 3) AS avg_points, max(l_quantity) AS most, min(l_quantity) AS least, round(100.0 * sum(CASE WHEN l_returnflag = 'N' THEN 1 ELSE 0 END) / nullif(count(*), 0), 1) AS pct_kept
FROM lineitem WHERE l_linestatus <> 'X' GROUP BY 1""")
def q_results_summary(s: SparkSession, d: str) -> DataFrame:
    """Results per player in one aggregation; the greater of two values is null if either is."""
    li = table(s, d, "lineitem").filter("l_linestatus <> 'X'")
    top = F.when(F.col("l_quantity").isNotNull() & F.col("l_linenumber").isNotNull(), F.greatest(F.col("l_quantity"), F.col("l_linenumber").cast("double")))
    count = lambda c: F.sum(F.when(c, 1).otherwise(0))
    return li.groupBy("l_suppkey").agg(
        F.countDistinct("l_orderkey").alias("matches"), count(F.col("l_returnflag") == "R").alias("lost"), count(top > 25).alias("deuce"), F.round(F.avg("l_quantity"), 3).alias("avg_points"), F.max("l_quantity").alias("most"), F.min("l_quantity").alias("least"),
        F.round(F.lit(100.0).cast("double") * count(F.col("l_returnflag") == "N") / F.nullif(F.count(F.lit(1)), F.lit(0)), 1).alias("pct_kept"),
    )


@query("""WITH s AS (SELECT l_orderkey, l_linenumber AS side_no, l_suppkey, l_extendedprice FROM lineitem WHERE l_linenumber <= 2),
w AS (SELECT l_orderkey, arg_max(side_no, (l_extendedprice, -side_no)) AS winner_side FROM s GROUP BY 1)
SELECT s.l_orderkey, s.side_no, o.l_suppkey AS opponent, w.winner_side, CASE w.winner_side WHEN s.side_no THEN 'WON' WHEN 3 - s.side_no THEN 'LOST' END AS result
FROM s JOIN w USING (l_orderkey) LEFT JOIN (SELECT DISTINCT l_orderkey, side_no, l_suppkey FROM s) o ON o.l_orderkey = s.l_orderkey AND o.side_no = 3 - s.side_no""")
def q_matches_cache(s: SparkSession, d: str) -> DataFrame:
    """Matches from each side: opponent, computed winner, result as seen from the side."""
    li = table(s, d, "lineitem").filter("l_linenumber <= 2").select("l_orderkey", F.col("l_linenumber").alias("side_no"), "l_suppkey", "l_extendedprice")
    win = li.groupBy("l_orderkey").agg(F.max_by("side_no", F.struct("l_extendedprice", -F.col("side_no"))).alias("winner_side"))
    opp = li.select("l_orderkey", (3 - F.col("side_no")).alias("side_no"), F.col("l_suppkey").alias("opponent")).distinct()
    result = F.when(F.col("winner_side") == F.col("side_no"), "WON").when(F.col("winner_side") == 3 - F.col("side_no"), "LOST")
    return li.join(win, "l_orderkey").join(opp, ["l_orderkey", "side_no"], "left").select("l_orderkey", "side_no", "opponent", "winner_side", result.alias("result"))


@query("SELECT shortname, count(*) AS n FROM (SELECT lower(shortname) AS shortname FROM club UNION ALL SELECT lower(longname) FROM club) GROUP BY 1 HAVING count(*) > 1")
def q_having_dups(s: SparkSession, d: str) -> DataFrame:
    c = table(s, d, "club")
    return c.select(F.explode(F.array(F.lower("shortname"), F.lower("longname"))).alias("shortname")).groupBy("shortname").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


@query("SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE CAST(o_orderdate AS DATE) = (SELECT max(CAST(o_orderdate AS DATE)) FROM orders)")
def q_scalar_subquery(s: SparkSession, d: str) -> DataFrame:
    """Rows of the latest day: the day comes from a scalar subquery."""
    table(s, d, "orders").createOrReplaceTempView("_orders_latest")
    return s.sql("SELECT o_orderkey, o_custkey, o_totalprice FROM _orders_latest WHERE cast(o_orderdate AS date) = (SELECT max(cast(o_orderdate AS date)) FROM _orders_latest)")


@query("SELECT e.tournament_class_entry_id, coalesce(nullif(e.tournament_class_entry_id_ext, ''), '-') AS ext, (SELECT min(p.tournament_player_id_ext) FROM tournament_class_player_new p WHERE p.tournament_class_entry_id = e.tournament_class_entry_id) AS first_number FROM tournament_class_entry_new e")
def q_corr_lookup(s: SparkSession, d: str) -> DataFrame:
    """A correlated lookup as an aggregate and a left join."""
    first = table(s, d, "tournament_class_player_new").groupBy("tournament_class_entry_id").agg(F.min("tournament_player_id_ext").alias("first_number"))
    e = table(s, d, "tournament_class_entry_new").join(first, "tournament_class_entry_id", "left")
    return e.select("tournament_class_entry_id", F.coalesce(F.nullif("tournament_class_entry_id_ext", F.lit("")), F.lit("-")).alias("ext"), "first_number")


def filter_classes(df: DataFrame, ids: list[int] | None = None, ended_before: str | None = None, kinds: list[str] | None = None, since: str | None = None, newest_first: bool = True, limit: int | None = None) -> DataFrame:
    """Filters put together at run time: ids (then since is ignored), ended only, kinds, cutoff; ordered, optionally limited."""
    if ids:
        df = df.filter(F.col("o_custkey").isin(ids))
    elif since:
        df = df.filter(F.col("o_orderdate") >= F.lit(since).cast("timestamp"))
    if ended_before:
        df = df.filter(F.col("o_orderdate") < F.lit(ended_before).cast("timestamp"))
    if kinds:
        df = df.filter(F.col("o_orderpriority").isin(kinds))
    df = df.orderBy(F.desc("o_orderdate") if newest_first else F.asc("o_orderdate"), "o_orderkey")
    return df.limit(limit) if limit else df


@query("SELECT o_orderkey, o_orderdate, o_orderpriority FROM orders WHERE o_orderdate >= '1997-01-01' AND o_orderdate < '2000-01-01' AND o_orderpriority IN ('1-URGENT', '2-HIGH')")
def q_dynamic_filter(s: SparkSession, d: str) -> DataFrame:
    return filter_classes(table(s, d, "orders"), since="1997-01-01", ended_before="2000-01-01", kinds=["1-URGENT", "2-HIGH"]).select("o_orderkey", "o_orderdate", "o_orderpriority")


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 25")
def q_topk(s: SparkSession, d: str) -> DataFrame:
    """The 25 largest (the limit is the feature)."""
    return table(s, d, "orders").select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(25)


@query("SELECT o_custkey, o_orderkey, o_totalprice, rank FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rank FROM orders) WHERE rank <= 3")
def q_topk_per_group(s: SparkSession, d: str) -> DataFrame:
    return R.top_k_per_group(table(s, d, "orders"), ["o_custkey"], [F.desc("o_totalprice"), F.asc("o_orderkey")], 3).select("o_custkey", "o_orderkey", "o_totalprice", "rank")


@query("SELECT player_id, firstname, lastname, year_born FROM player WHERE (lower(firstname) = 'erik' OR lower(fullname_raw) LIKE '%erik%') AND (year_born IS NULL OR year_born >= 1980)")
def q_like_search(s: SparkSession, d: str) -> DataFrame:
    p = table(s, d, "player")
    named = F.coalesce(F.lower("firstname") == "erik", F.lit(False)) | F.coalesce(F.lower("fullname_raw").contains("erik"), F.lit(False))
    return p.filter(named & (F.col("year_born").isNull() | (F.col("year_born") >= 1980))).select("player_id", "firstname", "lastname", "year_born")


@query("SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')")
def q_semi_in(s: SparkSession, d: str) -> DataFrame:
    o = table(s, d, "orders").filter("o_orderpriority = '1-URGENT'")
    return table(s, d, "customer").join(o, F.col("c_custkey") == F.col("o_custkey"), "left_semi").select("c_custkey", "c_name")


@query("SELECT i AS id FROM range(1, (SELECT max(tournament_class_entry_id) FROM tournament_class_entry_new) + 1) t(i) WHERE i NOT IN (SELECT tournament_class_entry_id FROM tournament_class_entry_new)")
def q_anti_gap(s: SparkSession, d: str) -> DataFrame:
    """Missing numbers in a sequence, highest first."""
    return R.gap_scan(table(s, d, "tournament_class_entry_new"), "tournament_class_entry_id")


@query("SELECT c_custkey, c_name FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)")
def q_anti_orphan(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "customer").join(table(s, d, "orders"), F.col("c_custkey") == F.col("o_custkey"), "left_anti").select("c_custkey", "c_name")


@query("""WITH y AS (SELECT i AS season, make_date(i, 7, 1) AS starts, make_date(i + 1, 6, 30) AS ends FROM range(1990, 2011) t(i))
SELECT o_orderkey, CAST(season AS INTEGER) AS season FROM orders JOIN y ON CAST(o_orderdate AS DATE) BETWEEN starts AND ends""")
def q_interval_containment(s: SparkSession, d: str) -> DataFrame:
    """Each day with the closed season that holds it, as an equi-join on the calendar year."""
    from ..lookups import seasons

    o = table(s, d, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("day"))
    return R.interval_join(o, seasons(s, 1990, 2010), "day", "starts", "ends").select("o_orderkey", "season")


@query("""WITH x AS (SELECT l_orderkey, l_linenumber AS a, CAST(l_shipdate AS DATE) AS a_from, CAST(l_shipdate AS DATE) + 30 AS a_to FROM lineitem)
SELECT x.l_orderkey, x.a, y.a AS b FROM x JOIN x y ON x.l_orderkey = y.l_orderkey AND x.a < y.a AND x.a_from <= y.a_to AND y.a_from <= x.a_to""")
def q_interval_overlap(s: SparkSession, d: str) -> DataFrame:
    li = table(s, d, "lineitem").select("l_orderkey", F.col("l_linenumber").alias("a"), F.to_date("l_shipdate").alias("a_from"))
    a = li.withColumn("a_to", F.date_add("a_from", 30))
    b = a.select("l_orderkey", F.col("a").alias("b"), F.col("a_from").alias("b_from"), F.col("a_to").alias("b_to"))
    return R.overlaps(a, b, ["l_orderkey"], "a_from", "a_to", "b_from", "b_to").filter("a < b").select("l_orderkey", "a", "b")


@query("""WITH p AS (SELECT * FROM events WHERE event_type = 'purchase'), v AS (SELECT user_id, ts, arg_max(event_id, event_id) AS event_id FROM events WHERE event_type <> 'purchase' GROUP BY 1, 2)
SELECT p.event_id, p.user_id, v.event_id AS prior FROM p ASOF LEFT JOIN v ON p.user_id = v.user_id AND p.ts >= v.ts""")
def q_asof_prior(s: SparkSession, d: str) -> DataFrame:
    """Each purchase with the user's last other event at or before it."""
    e = table(s, d, "events")
    prior = e.filter("event_type <> 'purchase'").select("user_id", F.col("ts").alias("at"), F.col("event_id").alias("prior"), F.lpad(F.col("event_id").cast("string"), 20, "0").alias("tie"))
    left = e.filter("event_type = 'purchase'").select("event_id", "user_id", "ts")
    return R.asof_before(left, prior, ["user_id"], "ts", "at", ["prior"], "tie").select("event_id", "user_id", "prior")


@query("""SELECT 'nation' AS kind, CAST(n_nationkey AS BIGINT) AS key FROM nation WHERE n_nationkey IN (SELECT c_nationkey FROM customer INTERSECT SELECT s_nationkey FROM supplier)
UNION ALL SELECT 'only_customer', CAST(k AS BIGINT) FROM (SELECT c_nationkey AS k FROM customer EXCEPT SELECT s_nationkey FROM supplier)
UNION ALL SELECT 'any', CAST(k AS BIGINT) FROM (SELECT c_nationkey AS k FROM customer UNION SELECT s_nationkey FROM supplier)""")
def q_union_intersect_except(s: SparkSession, d: str) -> DataFrame:
    c, u = table(s, d, "customer").select(F.col("c_nationkey").cast("long").alias("key")), table(s, d, "supplier").select(F.col("s_nationkey").cast("long").alias("key"))
    named = lambda df, k: df.select(F.lit(k).alias("kind"), "key")
    return named(c.intersect(u), "nation").union(named(c.subtract(u), "only_customer")).union(named(c.union(u).distinct(), "any"))


@query("""SELECT event_id, user_id, CASE WHEN event_type = 'signup' THEN CAST(count(*) FILTER (WHERE event_type = 'signup') OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS INTEGER) END AS nth FROM events""")
def q_window_counter(s: SparkSession, d: str) -> DataFrame:
    """Numbers flagged rows within their group in order."""
    return R.running_number(table(s, d, "events"), ["user_id"], [F.col("ts"), F.col("event_id")], F.col("event_type") == "signup", "nth").select("event_id", "user_id", "nth")


@query("""WITH j AS (SELECT *, CASE WHEN epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts, event_id) > 86400000000 THEN 1 ELSE 0 END AS jump FROM events)
SELECT event_id, user_id, CAST(sum(jump) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS INTEGER) AS cluster FROM j""")
def q_gap_cluster(s: SparkSession, d: str) -> DataFrame:
    """Runs of events less than a day apart."""
    at = F.unix_micros(F.col("ts").cast("timestamp"))
    return R.gap_cluster(table(s, d, "events"), ["user_id"], at, [F.col("ts"), F.col("event_id")], 86400 * 10**6).select("event_id", "user_id", "cluster")


@query("""SELECT event_id, user_id, last_value(CASE WHEN event_type = 'signup' THEN event_id END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS section FROM events""")
def q_carry_forward(s: SparkSession, d: str) -> DataFrame:
    """Each row with the last header before it."""
    header = F.when(F.col("event_type") == "signup", F.col("event_id"))
    return R.carry_forward(table(s, d, "events"), ["user_id"], ["ts", "event_id"], header, "section").select("event_id", "user_id", "section")


@query("""SELECT l_orderkey, l_linenumber, CAST((row_number() OVER w - 1) // 2 AS INTEGER) AS slot, CAST((row_number() OVER w - 1) % 2 + 1 AS INTEGER) AS place FROM lineitem WINDOW w AS (PARTITION BY l_orderkey ORDER BY l_linenumber)""")
def q_pairing(s: SparkSession, d: str) -> DataFrame:
    return R.pair_slots(table(s, d, "lineitem"), ["l_orderkey"], [F.col("l_linenumber")]).select("l_orderkey", "l_linenumber", "slot", "place")


@query("""SELECT l_orderkey, list_sort(list(l_quantity))[len(list(l_quantity)) // 2 + 1] AS middle, mode(l_returnflag ORDER BY l_returnflag) AS usual FROM lineitem GROUP BY 1""")
def q_median_mode(s: SparkSession, d: str) -> DataFrame:
    """Upper median and most frequent value of each order (ties: the first)."""
    li = table(s, d, "lineitem")
    middle = li.groupBy("l_orderkey").agg(R.upper_median("l_quantity").alias("middle"))
    counts = li.groupBy("l_orderkey", "l_returnflag").agg(F.count(F.lit(1)).alias("n"))
    usual = R.latest_per_group(counts, ["l_orderkey"], [F.desc("n"), F.asc("l_returnflag")]).select("l_orderkey", F.col("l_returnflag").alias("usual"))
    return middle.join(usual, "l_orderkey")


@query("""SELECT c_nationkey, n_orders, count(*) AS n_customers FROM (SELECT c_custkey, c_nationkey, count(o_orderkey) AS n_orders FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY 1, 2) GROUP BY 1, 2""")
def q_agg_over_agg(s: SparkSession, d: str) -> DataFrame:
    n = table(s, d, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
    c = table(s, d, "customer").join(n, F.col("c_custkey") == F.col("o_custkey"), "left").withColumn("n_orders", F.coalesce("n", F.lit(0)))
    return c.groupBy("c_nationkey", "n_orders").agg(F.count(F.lit(1)).alias("n_customers"))


@query("""SELECT l_returnflag, l_linestatus, round(sum(l_quantity), 2) AS sum_qty, round(sum(l_extendedprice), 2) AS sum_base, round(sum(l_extendedprice * (1 - l_discount)), 2) AS sum_disc, round(avg(l_quantity), 4) AS avg_qty, count(*) AS n FROM lineitem WHERE l_shipdate <= '1998-09-02' GROUP BY 1, 2""")
def q_pricing_summary(s: SparkSession, d: str) -> DataFrame:
    li = table(s, d, "lineitem").filter(F.col("l_shipdate") <= F.lit("1998-09-02").cast("timestamp"))
    return li.groupBy("l_returnflag", "l_linestatus").agg(F.round(F.sum("l_quantity"), 2).alias("sum_qty"), F.round(F.sum("l_extendedprice"), 2).alias("sum_base"), F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("sum_disc"), F.round(F.avg("l_quantity"), 4).alias("avg_qty"), F.count(F.lit(1)).alias("n"))


@query("""SELECT a.match_id, a.represented_entry_id AS home, b.represented_entry_id AS away FROM (SELECT DISTINCT match_id, side_no, represented_entry_id FROM match_side_new) a
JOIN (SELECT DISTINCT match_id, side_no, represented_entry_id FROM match_side_new) b ON a.match_id = b.match_id AND a.side_no = 1 AND b.side_no = 2""")
def q_match_sides(s: SparkSession, d: str) -> DataFrame:
    """Both sides of each match in one row."""
    m = table(s, d, "match_side_new").select("match_id", "side_no", "represented_entry_id").distinct()
    home, away = m.filter("side_no = 1").select("match_id", F.col("represented_entry_id").alias("home")), m.filter("side_no = 2").select("match_id", F.col("represented_entry_id").alias("away"))
    return home.join(away, "match_id")


@query("""SELECT match_id FROM match_side_new GROUP BY 1 HAVING count(DISTINCT side_no) < 2""")
def q_side_missing(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "match_side_new").groupBy("match_id").agg(F.countDistinct("side_no").alias("n")).filter("n < 2").select("match_id")


@query("""SELECT tournament_class_id, tournament_class_entry_id, seed, CAST(row_number() OVER (PARTITION BY tournament_class_id ORDER BY seed NULLS LAST, tournament_class_entry_id) AS INTEGER) AS number_in_class FROM tournament_class_entry_new""")
def q_sort_then_number(s: SparkSession, d: str) -> DataFrame:
    """Entries of a class numbered by seed, unseeded ones last."""
    w = Window.partitionBy("tournament_class_id").orderBy(F.asc_nulls_last("seed"), "tournament_class_entry_id")
    return table(s, d, "tournament_class_entry_new").select("tournament_class_id", "tournament_class_entry_id", "seed", F.row_number().over(w).alias("number_in_class"))


@query("""WITH n AS (SELECT least(min(tournament_class_entry_id), 0) AS low FROM tournament_class_entry_new), m AS (SELECT DISTINCT represented_entry_id AS e FROM match_side_new WHERE represented_entry_id NOT IN (SELECT tournament_class_entry_id FROM tournament_class_entry_new))
SELECT e AS missing_entry, low - row_number() OVER (ORDER BY e) AS new_id FROM m, n""")
def q_negative_ids(s: SparkSession, d: str) -> DataFrame:
    """New negative ids for entries that matches name but that don't exist, counted down from the lowest one.

    The rows are numbered by sorted ranges: each range gets its offset from the counts of those before, so that no task holds all."""
    from ..session import parallelism

    e = table(s, d, "tournament_class_entry_new").select(F.col("tournament_class_entry_id").alias("missing_entry"))
    low = min(e.agg(F.min("missing_entry")).first()[0] or 0, 0)
    m = table(s, d, "match_side_new").select(F.col("represented_entry_id").alias("missing_entry")).filter("missing_entry is not null").distinct().join(e, "missing_entry", "left_anti")
    parts = parallelism(s)
    ranged = stash(m.repartitionByRange(parts, "missing_entry").withColumn("_part", F.spark_partition_id()), "ranged")  # ranges are drawn once
    sizes = {r["_part"]: r["count"] for r in ranged.groupBy("_part").count().collect()}  # one row per partition
    offset, offsets = 0, []
    for k in sorted(sizes):
        offsets.append((k, offset))
        offset += sizes[k]
    before = s.createDataFrame(offsets, "_part int, _before long")
    w = Window.partitionBy("_part").orderBy("missing_entry")
    return ranged.join(F.broadcast(before), "_part").select("missing_entry", (F.lit(low) - F.col("_before") - F.row_number().over(w)).alias("new_id"))
