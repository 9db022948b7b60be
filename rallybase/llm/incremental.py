"""Deduplicating new batches against all history.

What was accepted is kept in a folder, in tables that only grow: codes and holders (what missing numbers stand for), records
(one per distinct statement of a batch), blocks (blocking key to record, in order of the key), rows (row to record), moves
(record to representative) and votes (how often each pattern of votes was met). A batch writes its own part of each and
rewrites nothing. It is collapsed to its distinct statements; these probe the blocks; the candidates get votes field by
field; a label model fitted on the votes of all batches so far turns them into a confidence, which decides who is meant; an
exact check that season and licences are the same and club and number no others follows; union-find over representatives updates only the clusters that are touched.
"""

from __future__ import annotations

import uuid

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import text as X
from ..operators.licences import parse_licences
from ..session import _path, parallelism, shared_dir, stash
from .clusters import components
from .labelmodel import LabelModel

VOTERS = ["v_hash", "v_person", "v_name", "v_year", "v_club", "v_part"]
START = np.array([1.0, 2.0, 1.5, 0.7, 1.0, 0.7])
SAME = ["person", "name_key", "year", "season", "club", "place", "held"]
RECORD = ["rec", "first_day", *SAME, "hashes"]
TABLES = {
    "codes": "kind string, k bigint, value string, n bigint", "holders": "kind string, k bigint, value string, n bigint",
    "records": "rec bigint, first_day date, person string, name_key string, year int, season int, club string, place string, held string, hashes array<string>",
    "blocks": "key bigint, sort string, who bigint, rec bigint", "rows": "row_id bigint, day date, rec bigint", "moves": "rec bigint, to bigint, batch int",
    "votes": ", ".join(f"{v} int" for v in VOTERS) + ", n bigint",
}


class State:
    """Accepted history in a folder that all executors share; it outlives the session unless it is a temporary one.

    A batch is accepted with the part of votes it writes last; parts of a batch that failed before are written anew."""

    def __init__(self, spark: SparkSession, folder: str | None = None):
        self.spark, self.folder = spark, folder or f"{shared_dir(spark)}/history-{uuid.uuid4().hex}"
        p, fs = _path(spark, self.folder)
        if folder is None:
            fs.deleteOnExit(p)
        self.batches = 0
        while fs.exists(_path(spark, f"{self._part('votes', self.batches)}/_SUCCESS")[0]):
            self.batches += 1

    def _part(self, table: str, batch: int) -> str:
        return f"{self.folder}/{table}/batch{batch:06d}"

    def read(self, table: str) -> DataFrame:
        parts = [self._part(table, i) for i in range(self.batches)]
        return self.spark.read.schema(TABLES[table]).parquet(*parts) if parts else self.spark.createDataFrame([], TABLES[table])

    def write(self, table: str, df: DataFrame) -> DataFrame:
        """Adds this batch's part of a table, with the columns of the table; returns it as read."""
        names = [f.name for f in T._parse_datatype_string(TABLES[table]).fields]
        df.select(*[F.col(c) for c in names]).write.mode("overwrite").parquet(self._part(table, self.batches))
        return self.spark.read.schema(TABLES[table]).parquet(self._part(table, self.batches))

    @property
    def moved(self) -> DataFrame:
        """rec, to: the representative of every record that isn't its own."""
        return self.read("moves").groupBy("rec").agg(F.max_by("to", "batch").alias("to"))

    @property
    def mapping(self) -> DataFrame | None:
        """row_id, day, rec: every accepted row with the first row that states the same. None before the first batch."""
        if not self.batches:
            return None
        return self.read("rows").join(self.moved, "rec", "left").select("row_id", "day", F.coalesce("to", "rec").alias("rec")).distinct()


def held_licences(info: Column) -> Column:
    """The licences stated with their dates, sorted: kind and yyyymmdd, without notes, quotes, separators and order."""
    found = F.regexp_extract_all(info, F.lit(r"([^\s,;|/+\"'()][^,;|/+\"'()\n\t]*?)\s*(?:[,;][^()\"]*)?\(([^()]*)\)"), F.lit(0))
    kind = lambda x: F.regexp_replace(X.fold(F.regexp_extract(x, r"^([^,;(]*)", 1)), " ", "")
    day = lambda x: F.regexp_replace(F.regexp_extract(x, r"\(([^()]*)\)", 1), "[^0-9]", "")
    whole = lambda x: F.when(F.length(day(x)) == 6, F.concat(F.lit("20"), day(x))).otherwise(day(x))
    return F.array_join(F.array_sort(F.array_distinct(F.transform(found, lambda x: F.concat(kind(x), F.lit("@"), whole(x))))), ",")


def _counts(df: DataFrame, kind: str, keys: list[str], value: str) -> DataFrame:
    whole = df.dropna(subset=[*keys, value])
    return whole.groupBy(F.lit(kind).alias("kind"), F.xxhash64(*keys).alias("k"), F.col(value).cast("string").alias("value")).agg(F.count(F.lit(1)).alias("n"))


def _filled(df: DataFrame, kind: str, keys: list[str], known: DataFrame, out: str, unique: bool = False) -> DataFrame:
    """df with out: the most frequent value of its keys in known (ties: by hash), or with unique the only one."""
    mine = known.filter(F.col("kind") == kind)
    best = mine.groupBy("k", "value").agg(F.sum("n").alias("n")).groupBy("k").agg(F.max_by("value", F.struct("n", F.hash("value"))).alias(out), F.count(F.lit(1)).alias("_n"))
    best = (best.filter("_n = 1") if unique else best).select("k", out)
    return df.withColumn("k", F.when(F.greatest(*[F.col(c).isNull().cast("int") for c in keys], F.lit(0)) == 0, F.xxhash64(*keys))).join(best, "k", "left").drop("k")


def statements(state: State, licences: DataFrame) -> DataFrame:
    """Rows of a batch as statements: row_id, day, person, name_key, year, season, club, place, held, content_hash.

    What a missing number of a club, season or person stands for is told by the history accepted so far and the batch itself,
    never by later batches. The batch's part of codes and holders is written."""
    rows = stash(parse_licences(licences).filter("row_id is not null and seen is not null"), "batch")

    def with_history(table: str, new: DataFrame) -> DataFrame:
        fresh = state.write(table, new)
        return state.read(table).join(fresh.select("kind", "k").distinct(), ["kind", "k"], "left_semi").unionByName(fresh)

    asked = lambda df, kind, keys: df.dropna(subset=keys).select(F.lit(kind).alias("kind"), F.xxhash64(*keys).alias("k"), F.lit(None).cast("string").alias("value"), F.lit(0).cast("long").alias("n")).distinct()
    named = rows.withColumn("club_key", F.nullif("club_key", F.lit("")))
    new = _counts(named, "season", ["season_id_ext"], "_season").unionByName(_counts(named, "club", ["club_key"], "_club"))
    new = new.unionByName(asked(named.filter("_season is null"), "season", ["season_id_ext"])).unionByName(asked(named.filter("_club is null"), "club", ["club_key"]))
    known = with_history("codes", new).filter("value is not null")
    named = _filled(_filled(named, "season", ["season_id_ext"], known, "_s2"), "club", ["club_key"], known, "_c2")
    coded = stash(named.withColumn("season", F.coalesce("_season", F.col("_s2").cast("int"))).withColumn("club", F.coalesce("_club", "_c2")), "coded")
    new = _counts(coded, "year", ["name_key", "year"], "_person").unionByName(_counts(coded, "club", ["name_key", "club"], "_person"))
    lost = coded.filter("_person is null")
    new = new.unionByName(asked(lost, "year", ["name_key", "year"])).unionByName(asked(lost, "club", ["name_key", "club"]))
    known = with_history("holders", new).filter("value is not null")
    lost = _filled(_filled(lost, "year", ["name_key", "year"], known, "_p1", unique=True), "club", ["name_key", "club"], known, "_p2", unique=True)
    whole = coded.filter("_person is not null").withColumn("person", F.col("_person")).unionByName(lost.withColumn("person", F.coalesce("_p1", "_p2")).drop("_p1", "_p2"))
    return whole.select("row_id", F.col("seen").alias("day"), "person", "name_key", "year", "season", "club", X.club_place(F.col("club_name")).alias("place"), F.coalesce(held_licences(F.col("license_info_raw")), F.lit("")).alias("held"), "content_hash")


def _blocking(df: DataFrame) -> DataFrame:
    """key, sort, who, rec: the blocking keys of records; who tells records of the same person, name, year and club. Sort s: the licences and season with the person or the name, and
    the hash of the content. Sort c: licences, season, club and one part of the name, by which records without a person (v
    instead of c) find others and are found."""
    key = lambda kind, *c: F.when(F.greatest(*[F.col(x).isNull().cast("int") for x in c], F.lit(0)) == 0, F.xxhash64(F.lit(kind), *c))
    plain = F.array(key("p", "person", "season", "held"), key("n", "name_key", "season", "held"))
    sure = F.array_compact(F.concat(plain, F.transform(F.coalesce("hashes", F.array().cast("array<string>")), lambda h: F.xxhash64(F.lit("h"), h))))
    parts = F.transform(F.split(F.coalesce("name_key", F.lit("")), " "), lambda t: F.xxhash64(F.lit("c"), "season", "held", F.coalesce("club", "place"), t))
    who = F.xxhash64("person", "name_key", "year", "club", "place").alias("who")
    strict = df.select("rec", who, F.lit("s").alias("sort"), F.explode(F.array_distinct(sure)).alias("key"))
    loose = df.select("rec", who, F.when(F.col("person").isNull(), "v").otherwise("c").alias("sort"), F.explode(F.array_distinct(parts)).alias("key"))
    return strict.unionByName(loose)


def _votes(pairs: DataFrame) -> DataFrame:
    """Votes on pairs with fields of the record (plain) and of the accepted one (o_)."""
    same = lambda c: F.when(F.col(c).isNull() | F.col(f"o_{c}").isNull(), 0).when(F.col(c) == F.col(f"o_{c}"), 1).otherwise(-1)
    near = X.nearness(F.col("name_key"), F.col("o_name_key"))
    parts = F.size(F.array_intersect(F.split("name_key", " "), F.split("o_name_key", " ")))
    place = X.nearness(F.col("place"), F.col("o_place"))
    return pairs.withColumns(
        {
            "v_hash": F.when(F.arrays_overlap("hashes", "o_hashes"), 1).otherwise(0),
            "v_person": same("person"),
            "v_name": F.when(near >= 0.8, 1).when(near.isNull(), 0).when(near < 0.6, -1).otherwise(0),
            "v_year": F.when(F.col("year").isNull() | F.col("o_year").isNull(), 0).when(F.abs(F.col("year") - F.col("o_year")) <= 1, 1).otherwise(-1),
            "v_club": F.when((F.col("club") == F.col("o_club")) | (place >= 0.75), 1).when(F.col("club").isNotNull() & F.col("o_club").isNotNull(), -1).otherwise(0),
            "v_part": F.when(parts >= 1, 1).otherwise(-1),
        }
    )


def ingest(state: State, licences: DataFrame, least: float = 0.5) -> State:
    """Accept licence rows of one or more days, all later than what state holds.

    Afterwards state.mapping has every accepted row with the first row that states the same, by day and row_id; rows that
    state something new map to themselves. A null season or an empty licence text is a value like any other. Rows without
    person are compared by name, year and club; without name too they only repeat rows with the same content_hash. Rows
    without a row_id or a day are ignored, repeated row_ids are one row. An empty batch is a batch.
    """
    spark, batch = state.spark, state.batches
    rows = stash(statements(state, licences), "statements")
    order = F.struct("day", "row_id")
    firsts = rows.groupBy(*SAME).agg(F.min(order).alias("f"), F.collect_set("content_hash").alias("hashes"))
    fresh = state.write("records", firsts.select(F.col("f.row_id").alias("rec"), F.col("f.day").alias("first_day"), *SAME, "hashes"))
    ranges = max(1, parallelism(spark))
    new_blocks = state.write("blocks", _blocking(fresh).repartitionByRange(ranges, "key").sortWithinPartitions("key"))
    state.write("rows", rows.join(fresh.select("rec", *SAME), [rows[c].eqNullSafe(fresh[c]) for c in SAME]).select(rows["row_id"], rows["day"], fresh["rec"]).distinct())
    blocks = state.read("blocks").join(new_blocks.select("key").distinct(), "key", "left_semi").unionByName(new_blocks)
    # Of like records in a block only the first is met, so a block of n copies gives no n x n pairs.
    heads = blocks.groupBy("key", "sort", "who").agg(F.min("rec").alias("o_rec"))
    probe = new_blocks.select("key", "sort", "rec")
    met = probe.filter("sort = 's'").join(heads.filter("sort = 's'").drop("sort"), "key")
    met = met.select("rec", "o_rec").unionByName(probe.filter("sort = 'v'").join(heads.filter("sort <> 's'").drop("sort"), "key").select("rec", "o_rec"))
    met = met.unionByName(probe.filter("sort = 'c'").join(heads.filter("sort = 'v'").drop("sort"), "key").select("rec", "o_rec"))
    pairs = stash(met.filter("rec <> o_rec").distinct(), "pairs")
    others = state.read("records").join(pairs.select(F.col("o_rec").alias("rec")).distinct(), "rec", "left_semi").unionByName(fresh)
    o = others.select(F.col("rec").alias("o_rec"), *[F.col(c).alias(f"o_{c}") for c in RECORD if c != "rec"])
    voted = stash(_votes(pairs.join(fresh, "rec").join(o, "o_rec")), "voted")
    model, patterns = fit(state, voted)
    moves = spark.createDataFrame([], TABLES["moves"])
    if model is not None:
        told = spark.createDataFrame([(*map(int, p), float(c)) for p, c in zip(patterns, model.posterior(patterns), strict=True)], ", ".join(f"{c} int" for c in VOTERS) + ", confidence double")
        exact = F.col("season").eqNullSafe(F.col("o_season")) & (F.col("held") == F.col("o_held")) & (F.col("v_club") >= 0) & (F.col("v_person") >= 0)
        links = voted.join(F.broadcast(told), VOTERS).filter((F.col("confidence") >= least) & exact).select(F.col("rec").alias("a"), "o_rec")  # told: at most 3^6 rows
        touched = state.read("moves").join(links.select(F.col("o_rec").alias("rec")).distinct(), "rec", "left_semi").groupBy("rec").agg(F.max_by("to", "batch").alias("to"))
        links = links.join(touched.withColumnRenamed("rec", "o_rec"), "o_rec", "left").select("a", F.coalesce("to", "o_rec").alias("b"))
        comp = components(links)
        known = state.read("records").join(comp.select(F.col("node").alias("rec")), "rec", "left_semi").unionByName(fresh).select("rec", "first_day")
        best = comp.join(known, comp["node"] == known["rec"]).groupBy("root").agg(F.min(F.struct("first_day", "rec")).alias("f"))
        now = stash(comp.join(best, "root").select(F.col("node").alias("rec"), F.col("f.rec").alias("to")).filter("rec <> to"), "now")
        # Records that stood for by one that is moved now are moved with it.
        below = state.read("moves").join(now.select(F.col("rec").alias("to")), "to", "left_semi").select("rec").distinct()
        below = state.read("moves").join(below, "rec", "left_semi").groupBy("rec").agg(F.max_by("to", "batch").alias("old")).join(now.select(F.col("rec").alias("old"), "to"), "old").select("rec", "to")
        moves = now.unionByName(below).withColumn("batch", F.lit(batch))
    state.write("moves", moves)
    state.write("votes", voted.groupBy(*VOTERS).agg(F.count(F.lit(1)).alias("n")))
    state.batches += 1
    return state


def fit(state: State, voted: DataFrame) -> tuple[LabelModel | None, np.ndarray]:
    """The label model of the votes of all batches, this one included, and all patterns met so far: at most 3^6."""
    seen = state.read("votes").unionByName(voted.groupBy(*VOTERS).agg(F.count(F.lit(1)).alias("n"))).groupBy(*VOTERS).agg(F.sum("n").alias("n")).orderBy(*VOTERS).collect()
    if not seen:
        return None, np.zeros((0, len(VOTERS)))
    patterns, n = np.array([[r[c] for c in VOTERS] for r in seen]), np.array([float(r["n"]) for r in seen])
    return LabelModel(prior=0.7).fit(patterns, n, 1 / (1 + np.exp(-(patterns @ START - 1.0)))), patterns


def replay(spark: SparkSession, licences: DataFrame, steps: int = 3, least: float = 0.5, folder: str | None = None) -> State:
    """Ingest the days of a table in order, in as many steps as given (each of about as many days)."""
    day = F.to_date("last_seen_at")
    days = [r["day"] for r in licences.select(day.alias("day")).filter("day is not null").distinct().orderBy("day").collect()]  # one per calendar day
    state = State(spark, folder)
    for i in range(steps):
        part = days[len(days) * i // steps : len(days) * (i + 1) // steps]
        if part:
            ingest(state, licences.filter(day.between(part[0], part[-1])), least)
    return state
