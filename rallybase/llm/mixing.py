"""Mixing sources to target weights by hierarchical budgeting.

The weights go down a tree domain - language - source. A node never gets more than it can give (its tokens times the times a
record may be used); what it can't take goes to its siblings, and only what they can't take to the siblings of its parent.
Each leaf then gives whole epochs and the token prefix of one more, in an order seeded by the number of that epoch.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Mapping

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import stash

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.json"
SLICES = 4096
MAX_LEAVES = 1_000_000  # sources x languages the driver plans; more is an error, nothing is dropped


def count_tokens(df: DataFrame, text_col: str, tokenizer: str = TOKENIZER, out: str = "n_tokens") -> DataFrame:
    """df without its text, with the number of tokens of the whole text (0 for null and empty). A column named out is replaced."""
    rest = [f.name for f in df.schema if f.name not in (text_col, out)]
    schema = T.StructType([df.schema[c] for c in rest] + [T.StructField(out, T.LongType())])

    def run(batches: Iterator[pd.DataFrame]) -> Iterable[pd.DataFrame]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        t = Tokenizer.from_file(tokenizer)
        t.encode_special_tokens = True
        for pdf in batches:
            res = pdf[rest].copy()
            texts = [x or "" for x in pdf[text_col]]
            counts: list[int] = []
            for i in range(0, len(texts), 256):
                counts += [len(e) for e in t.encode_batch_fast(texts[i : i + 256], add_special_tokens=False)]
            res[out] = counts
            yield res

    return df.select(*rest, text_col).mapInPandas(run, schema)


def water_fill(budget: float, weights: list[float], caps: list[float]) -> list[float]:
    """Share a budget by weight, none above its cap; what a full one leaves goes to the others by weight."""
    got, open_ = [0.0] * len(weights), [i for i, w in enumerate(weights) if w > 0 and caps[i] > 0]
    left = budget
    while open_ and left > 1e-9:
        total = sum(weights[i] for i in open_)
        full = [i for i in open_ if caps[i] - got[i] <= left * weights[i] / total]
        if not full:
            for i in open_:
                got[i] += left * weights[i] / total
            break
        for i in full:
            left -= caps[i] - got[i]
            got[i] = caps[i]
        done = set(full)
        open_ = [i for i in open_ if i not in done]
    return got


def allocate(leaves: list[dict], budget: float, path: tuple[str, ...] = ("domain", "language", "source")) -> dict[tuple, float]:
    """Budget of every leaf. leaves: path columns, weight, cap."""
    if not path:
        return {tuple(leaf["key"]): min(budget, leaf["cap"]) for leaf in leaves}
    groups: dict[str, list[dict]] = {}
    for leaf in leaves:
        groups.setdefault(leaf[path[0]], []).append(leaf)
    names = sorted(groups)
    shares = water_fill(budget, [sum(x["weight"] for x in groups[n]) for n in names], [sum(x["cap"] for x in groups[n] if x["weight"] > 0) for n in names])
    return {k: v for n, s in zip(names, shares, strict=True) for k, v in allocate(groups[n], s, path[1:]).items()}


def mix(docs: DataFrame, targets: DataFrame, total: float | None = None, seed: int = 7, tokenizer: str = TOKENIZER, domains: Mapping[str, str] | None = None, languages: Mapping[str, str] | None = None, stretch: float = 1.0) -> tuple[DataFrame, DataFrame]:
    """chosen: doc_id, source, language, n_tokens, repeats; shares: source, target_share, actual_share and counts.

    docs: doc_id, text, lang, source. targets: source, target_share, max_repeats (one row per source, read by the driver).
    total: tokens wanted; by default stretch times the most at which every source reaches its share. domains: the domain of a
    source (by default each is its own); languages: what a code as written stands for (by default itself, in lower case).
    Sources are compared in lower case with _ for blanks and hyphens; records of other or no source aren't used, records
    without tokens neither. Records without a known language are one language. A record is used whole or not at all, so a
    leaf misses its budget by less than one record. Repeated doc_ids are records of their own; a source named twice in
    targets counts with its last share. Empty inputs give empty results and shares of 0. More than MAX_LEAVES sources and
    languages are an error.
    """
    spark = docs.sparkSession
    name = F.regexp_replace(F.lower(F.trim("source")), "[ -]+", "_")
    code = F.lower(F.trim("lang"))
    language = F.coalesce(*[F.when(code == k, v) for k, v in (languages or {}).items()], F.lit("other") if languages else code, F.lit("other"))
    want = {r["source"]: r for r in targets.filter("source is not null and target_share > 0").select(name.alias("source"), "target_share", "max_repeats").orderBy("source", "target_share").take(MAX_LEAVES + 1)}
    counted = stash(count_tokens(docs.select("doc_id", name.alias("source"), language.alias("language"), "text"), "text", tokenizer), "tokens")
    sources = spark.createDataFrame([(s,) for s in want], "source string")
    leaf_tokens = counted.filter("n_tokens > 0").groupBy("source", "language").agg(F.sum("n_tokens").alias("t")).join(sources, "source", "left_semi").take(MAX_LEAVES + 1)  # sources x languages
    if len(want) > MAX_LEAVES or len(leaf_tokens) > MAX_LEAVES:
        raise ValueError(f"more than {MAX_LEAVES} sources or leaves")
    by_source: dict[str, int] = {}
    for r in leaf_tokens:
        by_source[r["source"]] = by_source.get(r["source"], 0) + r["t"]
    most = {s: max(w["max_repeats"] or 0, 0) for s, w in want.items()}
    leaves = [{"key": (r["source"], r["language"]), "domain": (domains or {}).get(r["source"], r["source"]), "language": r["language"], "source": r["source"], "tokens": r["t"], "weight": want[r["source"]]["target_share"] * r["t"] / by_source[r["source"]], "cap": float(r["t"] * most[r["source"]])} for r in leaf_tokens]
    if total is None:
        total = stretch * min((by_source.get(s, 0) * most[s] / w["target_share"] for s, w in want.items()), default=0.0)
    tokens = {x["key"]: x["tokens"] for x in leaves}
    plan = [(k[0], k[1], int(b // tokens[k]), float(b - (b // tokens[k]) * tokens[k]), most[k[0]]) for k, b in allocate(leaves, total).items()]
    leaf_plan = spark.createDataFrame(plan, "source string, language string, epochs int, rest double, most int")  # sources x languages
    order = F.xxhash64("doc_id", F.lit(seed), "epochs")  # the epoch that is cut has an order of its own
    used = counted.filter("n_tokens > 0").join(leaf_plan, ["source", "language"]).withColumn("_order", order).withColumn("slice", F.pmod("_order", F.lit(SLICES)).cast("int"))
    slices = used.groupBy("source", "language", "slice").agg(F.sum("n_tokens").alias("t"))
    before = F.coalesce(F.sum("t").over(Window.partitionBy("source", "language").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    cut = slices.withColumn("before", before).join(leaf_plan.select("source", "language", "rest"), ["source", "language"])  # at most leaves x SLICES rows
    cut = cut.select("source", "language", "slice", "before", F.when(F.col("before") + F.col("t") <= F.col("rest"), 1).when(F.col("before") >= F.col("rest"), 0).otherwise(2).alias("in_prefix"))
    rows = used.join(cut, ["source", "language", "slice"])
    whole = rows.filter("in_prefix <> 2").withColumn("more", F.col("in_prefix"))
    w = Window.partitionBy("source", "language", "slice").orderBy("_order", "doc_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    edge = rows.filter("in_prefix = 2").withColumn("more", (F.col("before") + F.sum("n_tokens").over(w) <= F.col("rest")).cast("int"))
    repeats = F.least(F.col("epochs") + F.col("more"), F.col("most"))
    chosen = whole.select("doc_id", "source", "language", "n_tokens", repeats.alias("repeats")).unionByName(edge.select("doc_id", "source", "language", "n_tokens", repeats.alias("repeats"))).filter("repeats > 0")
    all_sources = spark.createDataFrame([(s, float(w_["target_share"]), most[s]) for s, w_ in want.items()], "source string, target_share double, max_repeats int")
    have = counted.groupBy("source").agg(F.count(F.lit(1)).alias("records_available"), F.sum("n_tokens").alias("tokens_available"))
    got = chosen.groupBy("source").agg(F.count(F.lit(1)).alias("records_chosen"), F.sum(F.col("n_tokens") * F.col("repeats")).alias("tokens_chosen"), F.max("repeats").alias("most_repeats"))
    shares = all_sources.join(have, "source", "left").join(got, "source", "left")
    every = F.sum(F.coalesce("tokens_chosen", F.lit(0))).over(Window.partitionBy(F.lit(1)))  # one row per source
    return chosen, shares.select("source", "target_share", F.round(F.coalesce(F.col("tokens_chosen") / F.nullif(every, F.lit(0)), F.lit(0.0)), 6).alias("actual_share"), "max_repeats", F.coalesce("most_repeats", F.lit(0)).alias("most_repeats"), *[F.coalesce(c, F.lit(0)).alias(c) for c in ("records_available", "tokens_available", "records_chosen", "tokens_chosen")])
