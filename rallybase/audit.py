"""Audit of runs: a log row for each record, summaries whose numbers have to add up, context as text or map."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def log_rows(df: DataFrame, run_id: str, process: str, status: Column, reason: Column, context: dict[str, Column]) -> DataFrame:
    """run_id, process, status, reason, context_json: one row per record."""
    ctx = F.to_json(F.struct(*[c.alias(k) for k, c in context.items()]))
    return df.select(F.lit(run_id).alias("run_id"), F.lit(process).alias("process"), status.alias("status"), reason.alias("reason"), ctx.alias("context_json"))


def summary(log: DataFrame) -> DataFrame:
    """process, processed, success, failed, skipped, adds_up."""
    n = lambda s: F.count_if(F.col("status") == s)
    out = log.groupBy("run_id", "process").agg(F.count(F.lit(1)).alias("processed"), n("success").alias("success"), n("failed").alias("failed"), n("skipped").alias("skipped"))
    return out.withColumn("adds_up", F.col("processed") == F.col("success") + F.col("failed") + F.col("skipped"))


def reasons(log: DataFrame, top: int | None = None) -> DataFrame:
    out = log.groupBy("process", "status", "reason").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "process", "status", "reason")
    return out.limit(top) if top else out


def visible(log: DataFrame, verbosity: int) -> DataFrame:
    """What of a log is shown: 0 failures only, 1 also skipped rows, 2 all."""
    return log if verbosity >= 2 else log.filter(F.col("status").isin(["failed", "skipped"][: verbosity + 1]))


def latest_run(log: DataFrame) -> DataFrame:
    """The rows of the run with the latest time. Columns: run_id, run_at."""
    last = log.agg(F.max_by("run_id", "run_at").alias("run_id"))
    return log.join(last, "run_id", "left_semi")


def context_map(c: Column) -> Column:
    """'a: 1, b: x' as a map."""
    return F.str_to_map(c, F.lit(r",\s*"), F.lit(r":\s*"))


def context_text(m: Column) -> Column:
    return F.array_join(F.transform(F.map_entries(m), lambda e: F.concat(e["key"], F.lit(": "), F.coalesce(e["value"], F.lit("")))), ", ")
