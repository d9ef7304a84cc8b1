"""The ledger of runs: start and end events paired to runs, the latest run of each stage, what was downloaded."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

ENDS = {"finished": "success", "failed": "failed"}


def runs(events: DataFrame) -> DataFrame:
    """(run_id, stage, started_at, ended_at, seconds, status, error) of (run_id, stage, event, at, error), one grouping.

    A run without an end is ``unfinished``; of several ends the last counts; an end without a start is a run that is ``unknown``
    until its start is found. Events may come in any order and more than once.
    """
    end = F.max(F.when(F.col("event").isin(*ENDS), F.struct("at", "event", "error")))
    paired = events.groupBy("run_id", "stage").agg(F.min(F.when(F.col("event") == "started", F.col("at"))).alias("started_at"), end.alias("end"))
    status = F.when(F.col("started_at").isNull(), "unknown").when(F.col("end").isNull(), "unfinished")
    for event, name in ENDS.items():
        status = status.when(F.col("end.event") == event, name)
    return paired.select(
        "run_id", "stage", "started_at", F.col("end.at").alias("ended_at"), (F.unix_timestamp("end.at") - F.unix_timestamp("started_at")).alias("seconds"),
        status.alias("status"), F.when(F.col("end.event") == "failed", F.col("end.error")).alias("error"))


def latest_runs(found: DataFrame) -> DataFrame:
    """The run of each stage that started last (ties: the greater id), by a grouped maximum: no stage's runs are sorted or gathered."""
    columns = [c for c in found.columns if c != "stage"]
    last = F.max(F.struct("started_at", "run_id", *[c for c in columns if c not in ("started_at", "run_id")])).alias("r")
    return found.where("started_at is not null").groupBy("stage").agg(last).select("stage", *[F.col(f"r.{c}").alias(c) for c in columns])


def since_success(found: DataFrame) -> DataFrame:
    """(stage, last_success, failed_since): when a stage last ended well, and how many runs have failed since."""
    order = Window.partitionBy("stage")
    at = found.withColumn("last_success", F.max(F.when(F.col("status") == "success", F.col("started_at"))).over(order))
    after = (F.col("status") == "failed") & (F.col("last_success").isNull() | (F.col("started_at") > F.col("last_success")))
    return at.groupBy("stage").agg(F.max("last_success").alias("last_success"), F.count_if(after).alias("failed_since"))


def download_totals(downloads: DataFrame) -> DataFrame:
    """(run_id, files, changed, failed, bytes, mb) of (run_id, url, bytes, changed, error)."""
    return downloads.groupBy("run_id").agg(
        F.count(F.lit(1)).alias("files"), F.count_if("changed").alias("changed"), F.count_if(F.col("error").isNotNull()).alias("failed"),
        F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes")).withColumn("mb", F.round(F.col("bytes") / 1e6, 1))
