"""History of changing attributes from periodic snapshots, by Merkle comparison.

Each snapshot's rows are hashed into leaf buckets, leaves into branches, branches into a root. Two neighbouring snapshots
are compared from the root down; only differing branches are descended, and only the rows of differing leaves are compared
one by one. What differs there becomes a new version.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as X
from ..session import stash
from .licences import _majority, read_licences

FANOUT = 16
PER_LEAF = 64  # keys a leaf should hold: the tree grows with the keys, so that a change touches as few rows at any size


def tree_depth(keys: int, fanout: int = FANOUT) -> int:
    """Levels below the root for a number of keys; at most seven, so that a leaf's number stays small."""
    depth = 1
    while depth < 7 and fanout**depth * PER_LEAF < keys:
        depth += 1
    return depth


def merkle_nodes(snapshots: DataFrame, key: str = "key", state: str = "state", fanout: int = FANOUT, depth: int = 3) -> list[DataFrame]:
    """Hashes of the nodes of every snapshot, from the root (level 0) to the leaves (level depth): snap, node, digest.

    Keys are unique in a snapshot; a node's digest doesn't depend on the order of its rows. At most snapshots x fanout^level
    rows a level, whatever the number of keys."""
    leaf = F.pmod(F.xxhash64(key), F.lit(fanout**depth)).cast("int")
    level = snapshots.groupBy("snap", leaf.alias("node")).agg(F.expr(f"bit_xor(xxhash64({key}, {state}))").alias("digest"), F.count(F.lit(1)).alias("n"))
    level = stash(level.select("snap", "node", F.xxhash64("digest", "n").alias("digest")), "leaves")  # rows are hashed once
    out = [level]
    for _ in range(depth):  # every level is a table of its own: a plan over all levels would grow with the square of the depth
        level = stash(level.groupBy("snap", F.floor(F.col("node") / fanout).cast("int").alias("node")).agg(F.expr("bit_xor(xxhash64(node, digest))").alias("digest")), "nodes")
        out.append(level)
    return out[::-1]


def diff_snapshots(snapshots: DataFrame, fanout: int = FANOUT, depth: int | None = None) -> DataFrame:
    """snap, key, state, state_before of every key whose state differs from the snapshot before.

    snapshots: snap (whole numbers, one step apart), key, state; keys unique in a snapshot. A key's first state has no state
    before. Rows with a null key or snap are ignored; a null state is a state. The tree's depth follows from the number of keys."""
    snapshots = snapshots.filter(F.col("snap").isNotNull() & F.col("key").isNotNull())
    if depth is None:
        depth = tree_depth(snapshots.groupBy("snap").count().agg(F.max("count")).first()[0] or 0, fanout)
    nodes = merkle_nodes(snapshots, fanout=fanout, depth=depth)
    leaf = F.pmod(F.xxhash64("key"), F.lit(fanout**depth)).cast("int")
    changed = compare_down(nodes, fanout)
    rows = snapshots.withColumn("node", leaf)
    new = rows.join(changed, ["snap", "node"], "left_semi")
    old = rows.withColumn("snap", F.col("snap") + 1).join(changed, ["snap", "node"], "left_semi").select("snap", "key", F.col("state").alias("state_before"), F.lit(True).alias("_had"))
    both = new.join(old, ["snap", "key"], "left")
    return both.filter(F.col("_had").isNull() | ~F.col("state").eqNullSafe(F.col("state_before"))).select("snap", "key", "state", "state_before")


def compare_down(nodes: list[DataFrame], fanout: int) -> DataFrame:
    """snap, node of the leaves that differ from the snapshot before, descending from the root only where digests differ."""
    suspects = None
    for level in nodes:
        now = level
        before = level.select((F.col("snap") + 1).alias("snap"), "node", F.col("digest").alias("_before"))
        if suspects is not None:
            up = F.floor(F.col("node") / fanout).cast("int")
            now = now.withColumn("_up", up).join(suspects, ["snap", "_up"], "left_semi").drop("_up")
        differing = stash(now.join(before, ["snap", "node"], "left").filter(~F.col("digest").eqNullSafe(F.col("_before"))).select("snap", "node"), "differing")
        suspects = differing.withColumnRenamed("node", "_up")
    return differing


def append_snapshot(folder: str, snapshot: DataFrame, number: int, depth: int = 4, fanout: int = FANOUT) -> DataFrame:
    """key, state, state_before of what a new snapshot (key, state) changes against the one before, number - 1.

    folder holds the digests of every snapshot's leaves and the rows of every snapshot in order of their leaf. The new
    snapshot's are added; of the one before only the digests and the rows of differing leaves are read. Rows without a key
    are ignored; keys that are gone have a null state and gone = true. Depth and fanout have to be the same for a folder."""
    spark = snapshot.sparkSession
    leaf = F.pmod(F.xxhash64("key"), F.lit(fanout**depth)).cast("int")
    rows = f"{folder}/rows/{number:06d}"
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    snapshot.filter("key is not null").select("key", "state", leaf.alias("node")).repartitionByRange(ranges, "node").sortWithinPartitions("node").write.mode("overwrite").parquet(rows)
    now = spark.read.parquet(rows)
    levels = merkle_nodes(now.select(F.lit(number).alias("snap"), "key", "state"), fanout=fanout, depth=depth)
    for i, level in enumerate(levels):
        level.select("node", "digest").write.mode("overwrite").parquet(f"{folder}/digests/{number:06d}/level{i}")
    read = lambda n, i: spark.read.schema("node int, digest bigint").parquet(f"{folder}/digests/{n:06d}/level{i}")
    first = number == 0
    suspects = None
    for i in range(len(levels)):
        old = read(number - 1, i).withColumnRenamed("digest", "_before") if not first else spark.createDataFrame([], "node int, _before bigint")
        both = read(number, i).join(old, "node", "full")
        if suspects is not None:
            both = both.withColumn("_up", F.floor(F.col("node") / fanout).cast("int")).join(suspects, "_up", "left_semi")
        differing = both.filter(~F.col("digest").eqNullSafe(F.col("_before"))).select("node")
        suspects = differing.withColumnRenamed("node", "_up")
    new = now.join(differing, "node", "left_semi").select("key", "state", F.lit(True).alias("_new"))
    if first:
        return new.select("key", "state", F.lit(None).cast("string").alias("state_before"), F.lit(False).alias("gone"))
    old = spark.read.parquet(f"{folder}/rows/{number - 1:06d}").join(differing, "node", "left_semi").select("key", F.col("state").alias("state_before"), F.lit(True).alias("_old"))
    both = new.join(old, "key", "full").filter(F.col("_new").isNull() | F.col("_old").isNull() | ~F.col("state").eqNullSafe(F.col("state_before")))
    return both.select("key", "state", "state_before", F.col("_new").isNull().alias("gone"))


def order_clubs(seasons: Column) -> Column:
    """Fold a person's seasons (array of season, clubs in order of their first licence) into seasons with the club held
    before in first place."""
    init = F.struct(F.lit(None).cast("string").alias("last"), F.array().cast("array<struct<season:int,clubs:array<string>>>").alias("done"))

    def step(acc: Column, s: Column) -> Column:
        held = F.filter(s["clubs"], lambda c: c == acc["last"])
        clubs = F.concat(held, F.filter(s["clubs"], lambda c: ~c.eqNullSafe(acc["last"])))
        return F.struct(F.element_at(clubs, -1).alias("last"), F.concat(acc["done"], F.array(F.struct(s["season"].alias("season"), clubs.alias("clubs")))).alias("done"))

    return F.aggregate(seasons, init, step, lambda acc: acc["done"])


def club_snapshots(licences: DataFrame) -> DataFrame:
    """snap (season), key (person), state (clubs held in the season in order, joined by >): a snapshot for each season of all
    persons licensed by then; a season without licence keeps the last club."""
    once = licences.filter(F.col("person").isNotNull() & F.col("season").isNotNull() & F.col("club").isNotNull()).groupBy("person", "season", "club").agg(F.min("licensed").alias("licensed"), F.min("row_id").alias("row_id"))
    by_season = once.groupBy("person", "season").agg(F.array_sort(F.collect_list(F.struct(F.coalesce("licensed", F.lit("9999")).alias("l"), "row_id", "club"))).alias("_c")).select("person", "season", F.transform("_c", lambda x: x["club"]).alias("clubs"))
    by_person = by_season.groupBy("person").agg(order_clubs(F.array_sort(F.collect_list(F.struct("season", "clubs")))).alias("s"))
    until = once.agg(F.max("season")).first()[0]  # one number
    w = Window.partitionBy("person").orderBy("season")
    rows = by_person.select("person", F.explode("s").alias("s")).select("person", "s.season", "s.clubs").withColumn("_next", F.lead("season").over(w))
    here = rows.select(F.col("season").alias("snap"), F.col("person").alias("key"), F.array_join("clubs", ">").alias("state"), "_next", F.element_at("clubs", -1).alias("_kept"))
    kept = here.withColumn("_to", F.coalesce(F.col("_next") - 1, F.lit(until).cast("int"))).filter(F.col("_to") > F.col("snap")).select(F.explode(F.sequence(F.col("snap") + 1, F.col("_to"))).alias("snap"), "key", F.col("_kept").alias("state"))
    return here.select("snap", "key", "state").unionByName(kept)


def licence_day(info: Column) -> Column:
    """The earliest bracketed date of a licence text, as yyyy-mm-dd."""
    days = F.regexp_extract_all(info, F.lit(r"\(([0-9]{2,4}[.-][0-9]{2}[.-][0-9]{2})\)"), F.lit(1))
    return F.array_min(F.transform(days, lambda d: F.when(F.length(d) == 8, F.concat(F.lit("20"), F.translate(d, ".", "-"))).otherwise(F.translate(d, ".", "-"))))


def link_transitions(changes: DataFrame, persons: DataFrame, transitions: DataFrame, clubs: DataFrame) -> DataFrame:
    """person, season, day: the transition that tells of a change of club.

    changes: person, season, club_before, club and the places in both clubs' names. Candidates share the season and all folded
    name parts, or both clubs, or a name part with a club or the year; they are scored by name, year and clubs. A transition
    belongs to its best candidate; of several transitions the earliest day counts."""
    t = transitions.select(
        F.col("row_id").alias("t"), F.coalesce(X.season_start(F.col("season_label")), F.year(F.add_months("transition_date", -6))).alias("season"), F.coalesce(F.year("date_born"), X.year_of(F.col("year_born"))).alias("t_year"),
        X.token_key(F.concat_ws(" ", "firstname", "lastname")).alias("t_name"), X.skeleton(F.col("club_from")).alias("_f"), X.skeleton(F.col("club_to")).alias("_t"), X.club_place(F.col("club_from")).alias("t_from_place"), X.club_place(F.col("club_to")).alias("t_to_place"), F.col("transition_date").alias("day"),
    )
    t = t.join(clubs.select(F.col("club_key").alias("_f"), F.col("club").alias("t_from")), "_f", "left").join(clubs.select(F.col("club_key").alias("_t"), F.col("club").alias("t_to")), "_t", "left")
    ev = changes.join(persons, "person")

    def keys(name: str, year: str, left: str, joined: str) -> Column:
        """All keys of a row; those that lack a part are null and go."""
        parts = F.split(name, " ")
        key = lambda kind, *cols: F.concat(F.lit(kind), *[F.concat(F.lit("|"), F.col(c) if isinstance(c, str) else c) for c in ("season", *cols)])
        by_part = lambda kind, c: F.transform(parts, lambda p: key(kind, c, p))
        whole = F.array(key("n", name), key("c", left, joined), key("to", year, joined), key("from", year, left))
        return F.explode(F.array_distinct(F.array_compact(F.concat(whole, by_part("p", left), by_part("p", joined), by_part("y", year)))))

    ev_keys = stash(ev, "changes").withColumn("k", keys("name_key", "year", "club_before", "club"))
    t_keys = stash(t, "transitions").withColumn("k", keys("t_name", "t_year", "t_from", "t_to"))
    pairs = ev_keys.hint("merge").join(t_keys.drop("season"), "k").dropDuplicates(["person", "season", "t", "club"])
    near = X.nearness(F.col("name_key"), F.col("t_name"))
    shared = F.least(F.size(F.array_intersect(F.split("name_key", " "), F.split("t_name", " "))), F.lit(2))
    year = F.when(F.abs(F.col("year") - F.col("t_year")) <= 1, 1).when(F.col("year").isNotNull() & F.col("t_year").isNotNull(), -1).otherwise(0)
    joined = F.when(F.col("t_to") == F.col("club"), 1).when(X.nearness(F.col("t_to_place"), F.col("place")) >= 0.7, 1).otherwise(-1)
    left = F.when(F.col("t_from") == F.col("club_before"), 1).when(X.nearness(F.col("t_from_place"), F.col("place_before")) >= 0.7, 1).otherwise(-1)
    pairs = pairs.withColumn("_year", year).withColumn("_clubs", F.coalesce(joined, F.lit(0)) + F.coalesce(left, F.lit(0))).withColumn("_shared", shared)
    good = pairs.withColumn("score", near * 3 + F.col("_shared") + F.col("_year") + F.col("_clubs"))
    told = F.col("_shared") + F.col("_year")
    good = good.filter(((F.col("_clubs") > 0) & ((told >= 2) | (told >= 1) & (near >= 0.5))) | ((F.col("_clubs") == 0) & ((told >= 3) | (near >= 0.8) & (F.col("_year") >= 0))))
    best_t = good.groupBy("t").agg(F.max_by(F.struct("person", "season", "club", "day", "score"), F.struct("score", "person")).alias("b"))
    return best_t.select("b.*").groupBy("person", "season", "club").agg(F.min("day").alias("day"))


def club_history(raw: DataFrame, transitions: DataFrame) -> DataFrame:
    """Club versions of every licence holder: person, club, valid_from, valid_to (null: still valid), version.

    Rows without a readable person, season or club can't show a version and are ignored. Repeated rows change nothing. In a
    season with several clubs the club held before comes first, then the clubs by their first licence."""
    lic = stash(read_licences(raw).withColumn("licensed", licence_day(F.col("license_info_raw"))), "licences")
    changed = diff_snapshots(stash(club_snapshots(lic), "snapshots"))
    last = F.element_at(F.split("state_before", ">"), -1)
    seq = changed.select("snap", "key", last.alias("_held"), F.split("state", ">").alias("clubs"))
    versions = seq.select(F.col("key").alias("person"), F.col("snap").alias("season"), F.posexplode(F.when(F.element_at("clubs", 1) == F.coalesce("_held", F.lit("")), F.slice("clubs", F.lit(2), F.size("clubs"))).otherwise(F.col("clubs"))).alias("_i", "club"))
    w = Window.partitionBy("person").orderBy("season", "_i")
    versions = stash(versions.withColumn("club_before", F.lag("club").over(w)), "versions")
    persons = _majority(lic, ["person"], "name_key", "name_key").join(_majority(lic, ["person"], "year", "year"), "person", "left")
    clubs = _majority(lic.filter("club_key <> ''"), ["club_key"], "club", "club")
    places = _majority(lic.withColumn("_place", X.club_place(F.col("club_name"))), ["club"], "_place", "place")
    changes = versions.filter("club_before is not null").join(places, "club", "left").join(places.select(F.col("club").alias("club_before"), F.col("place").alias("place_before")), "club_before", "left")
    days = link_transitions(changes.select("person", "season", "club_before", "club", "place", "place_before"), persons, transitions, clubs)
    out = versions.join(days, ["person", "season", "club"], "left")
    valid_from = F.when(F.col("club_before").isNotNull(), F.col("day"))
    out = out.withColumn("valid_from", F.coalesce(valid_from, F.make_date("season", F.lit(7), F.lit(1))))
    return out.select("person", "club", "valid_from", F.lead("valid_from").over(w).alias("valid_to"), F.row_number().over(w).alias("version"))
