"""The fact table: full build, incremental build by change set, and tombstones for removed readings.

Full and incremental builds agree: tombstones come from the whole change log in both. Keys carry the
date's text, so rows whose date doesn't parse are found again too.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.functions.values import USABLE, obs_day
from skyledger.operators.assess import assess
from skyledger.sources.shared import written

KEY = ["station_id", "obs_date_text", "element"]
COLUMNS = [*KEY, "obs_date", "raw_value", "value", "unit", "mflag", "qflag", "sflag", "is_trace", "quality_status", "is_usable", "policy_hash", "raw_changed_at", "raw_run_id", "is_deleted"]


def _facts(assessed: DataFrame) -> DataFrame:
    return assessed.withColumn("is_usable", F.col("quality_status").isin(USABLE)).withColumn("is_deleted", F.lit(False)).select(*COLUMNS)


def in_scope(rows: DataFrame, selected: DataFrame, elements: DataFrame) -> DataFrame:
    return rows.join(selected.select("station_id"), "station_id", "left_semi").join(F.broadcast(elements.select("element")), "element", "left_semi")


def removed_rows(log: DataFrame) -> DataFrame:
    """The last removal of each key in the change log: when, and in which run."""
    return log.where("change = 'delete'").groupBy("station_id", F.col("obs_date").alias("obs_date_text"), "element").agg(
        F.max("changed_at").alias("changed_at"), F.max_by("run_id", F.struct("changed_at", "run_id")).alias("run_id"))


def tombstones(log: DataFrame, present: DataFrame, shaped: DataFrame, selected: DataFrame, elements: DataFrame) -> DataFrame:
    """A deleted row for each removed key that hasn't come back (isn't in ``present``), with the columns of ``shaped``."""
    gone = in_scope(removed_rows(log), selected, elements).join(present.select(*KEY), KEY, "left_anti")
    types = dict(shaped.dtypes)
    given = {
        "obs_date": obs_day(F.col("obs_date_text")), "is_trace": F.lit(False), "quality_status": F.lit("removed_at_source"), "is_usable": F.lit(False),
        "raw_changed_at": F.col("changed_at"), "raw_run_id": F.col("run_id"), "is_deleted": F.lit(True),
    }
    return gone.select(*[(F.col(c) if c in KEY else given.get(c, F.lit(None).cast(types[c]))).alias(c) for c in COLUMNS])


def fct_full(assessed: DataFrame, log: DataFrame, selected: DataFrame, elements: DataFrame) -> DataFrame:
    rows = _facts(assessed)
    return rows.unionByName(tombstones(log, assessed, rows, selected, elements))


def new_pairs(assessed: DataFrame, current: DataFrame) -> DataFrame:
    """Station/element pairs that the fact table doesn't hold yet."""
    return assessed.select("station_id", "element").subtract(current.where("not is_deleted").select("station_id", "element"))


def changed_keys(current: DataFrame, assessed: DataFrame, log: DataFrame, elements: DataFrame) -> DataFrame:
    """Keys to rebuild: changed at the source, their pair of the day, under a changed policy, or new to the scope."""
    after = current.agg(F.coalesce(F.max("raw_changed_at"), F.lit("1900-01-01").cast("timestamp")).alias("after"))
    changes = log.crossJoin(F.broadcast(after)).where("changed_at > after").select("station_id", F.col("obs_date").alias("obs_date_text"), "element")
    partner = changes.where(F.col("element").isin("TMAX", "TMIN")).withColumn("element", F.when(F.col("element") == "TMAX", "TMIN").otherwise("TMAX"))
    policy = current.where("not is_deleted").select(*KEY, F.col("policy_hash").alias("was")).join(F.broadcast(elements.select("element", "policy_hash")), "element").where(
        ~F.col("was").eqNullSafe(F.col("policy_hash"))).select(*KEY)
    added = assessed.join(new_pairs(assessed, current), ["station_id", "element"], "left_semi").select(*KEY)
    return changes.unionByName(partner).unionByName(policy).unionByName(added).distinct()


def keyed_replace(old: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    """``old`` with the rows of ``new`` in place of those with their key."""
    return old.join(new.select(*key).distinct(), key, "left_anti").unionByName(new, allowMissingColumns=True)


def fct_incremental(current: DataFrame, observations: DataFrame, log: DataFrame, elements: DataFrame, selected: DataFrame) -> DataFrame:
    """The fact table after a build that touches only changed keys; equal to a full build.

    observations: typed, not assessed. Only days with a changed key are assessed, whole, as a day's pair is judged together.
    """
    present = in_scope(observations.select(*KEY), selected, elements)
    keys = written(changed_keys(current, present, log, elements), "changed-keys")
    days = keys.select("station_id", "obs_date_text").distinct()
    assessed = assess(observations.join(days, ["station_id", "obs_date_text"], "left_semi"), selected, elements)
    fresh = _facts(assessed.join(keys, KEY, "left_semi"))
    fresh = written(fresh.unionByName(tombstones(log, present, fresh, selected, elements)), "fresh-facts")
    # Rows that changed keys no longer have go as well.
    kept = in_scope(current, selected, elements).join(keys, KEY, "left_anti")
    return keyed_replace(kept.select(*COLUMNS), fresh, KEY)
