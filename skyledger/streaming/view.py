"""Facts kept up with arrivals: each build takes on what was committed since the last one.

A build reads the part of the change log that was added since the source commit the last build saw (its mark), the buckets of stored readings
that those changes, or a change of scope, lie in, and the same buckets of the facts; it replaces these buckets and moves the mark, in
one commit. Tombstones come from the removed keys that the readings keep. Nothing reads the whole log, and nothing reads
all readings unless an element's policy changed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.functions.values import obs_day
from skyledger.operators import assess, facts, staging
from skyledger.sources import commits
from skyledger.sources.shared import written
from skyledger.streaming.arrivals import BUCKETS, LOG, TABLE, bucket_of

FACTS = ("station_id string, obs_date_text string, element string, obs_date date, raw_value int, value decimal(12,1), unit string, mflag string, qflag string, sflag string, "
         "is_trace boolean, quality_status string, is_usable boolean, policy_hash string, raw_changed_at timestamp, raw_run_id string, is_deleted boolean")
#: What the last build had seen: log folders, and stations and elements (with their policy) in scope.
SEEN, STATIONS, ELEMENTS = "path string", "station_id string", "element string, policy_hash string"
ONE = [0]


def _whole(rows: DataFrame) -> commits.Change:
    return commits.Change(rows.withColumn("bucket", F.lit(0)), ONE)


def facts_of(table: DataFrame, selected: DataFrame, elements: DataFrame) -> DataFrame:
    """The facts of stored rows of whole station-days, removed keys included."""
    stamped = table.withColumnsRenamed({"last_changed_at": "raw_changed_at", "run_id": "raw_run_id"})
    live = facts._facts(assess.assess(staging.typed_observations(stamped.where("not removed").drop("removed", "first_loaded_at")), selected, elements))
    types = dict(live.dtypes)
    gone = facts.in_scope(stamped.where("removed").withColumnRenamed("obs_date", "obs_date_text"), selected, elements)
    given = {
        "obs_date": obs_day(F.col("obs_date_text")), "is_trace": F.lit(False), "quality_status": F.lit("removed_at_source"), "is_usable": F.lit(False),
        "raw_changed_at": F.col("raw_changed_at"), "raw_run_id": F.col("raw_run_id"), "is_deleted": F.lit(True)} | {c: F.col(c) for c in facts.KEY}
    return live.unionByName(gone.select(*[given.get(c, F.lit(None).cast(types[c])).alias(c) for c in facts.COLUMNS]))


def refresh(spark: SparkSession, source: str, root: str, selected: DataFrame, elements: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """The facts under ``root`` after a build from the arrivals under ``source``; equal to a full build.

    buckets: as the arrivals are kept in. Keys are rebuilt that changed at the source, or whose pair of the day did; all keys of a station or
    an element that came into scope, and of an element whose policy changed. What left the scope goes.
    """
    source_now = commits.latest(spark, source)

    def build(state: commits.State) -> dict[str, commits.Change]:
        seen = [r["path"] for r in state.read("seen", SEEN).collect()]
        new = sorted(set(source_now.paths("log")) - set(seen))
        log = spark.read.schema(LOG).parquet(*new) if new else spark.createDataFrame([], LOG)
        changes = log.select("station_id", F.col("obs_date").alias("obs_date_text"), "element")
        partner = changes.where(F.col("element").isin(*assess.PAIR)).withColumn("element", F.when(F.col("element") == assess.PAIR[0], assess.PAIR[1]).otherwise(assess.PAIR[0]))
        keys = written(changes.unionByName(partner).distinct(), "view-keys")
        stations, policies = selected.select("station_id").distinct(), elements.select("element", "policy_hash")
        stations_before, policies_before = state.read("stations", STATIONS), state.read("elements", ELEMENTS)
        came = written(stations.join(stations_before, "station_id", "left_anti"), "view-stations")
        left = stations_before.join(stations, "station_id", "left_anti")
        revised = policies.join(policies_before, ["element", "policy_hash"], "left_anti").select("element")
        revised = [r[0] for r in revised.union(policies_before.join(policies, "element", "left_anti").select("element")).collect()]  # configuration rows
        if revised:
            touched = list(range(buckets))
        else:
            at = keys.select(bucket_of("station_id", buckets)).union(came.select(bucket_of("station_id", buckets))).union(left.select(bucket_of("station_id", buckets)))
            touched = sorted(r[0] for r in at.distinct().collect())
        table = source_now.read("table", TABLE, touched)
        whole = table.select("station_id", F.col("obs_date").alias("obs_date_text"), "element").where(F.col("element").isin(revised)) if revised else keys.limit(0)
        whole = whole.unionByName(table.join(came, "station_id", "left_semi").select("station_id", F.col("obs_date").alias("obs_date_text"), "element"))
        again = written(keys.unionByName(whole).distinct(), "view-again")
        days = again.select("station_id", F.col("obs_date_text").alias("obs_date")).distinct()
        fresh = facts_of(table.join(days, ["station_id", "obs_date"], "left_semi"), selected, elements).join(again, facts.KEY, "left_semi")
        kept = facts.in_scope(state.read("facts", FACTS, touched), selected, elements).join(again, facts.KEY, "left_anti")
        rows = kept.select(*facts.COLUMNS).unionByName(fresh.select(*facts.COLUMNS)).withColumn("bucket", bucket_of("station_id", buckets))
        return {
            "facts": commits.Change(rows, touched), "seen": _whole(spark.createDataFrame([(p,) for p in source_now.paths("log")], SEEN)),
            "stations": _whole(stations), "elements": _whole(policies)}

    state = commits.commit(spark, root, f"build-of-{source_now.number}-{_scope_hash(selected, elements)}", build)
    return state.read("facts", FACTS)


def _scope_hash(selected: DataFrame, elements: DataFrame) -> int:
    """Changes whenever a station or an element's policy comes or goes: a build of one source commit and scope is made once."""
    count = lambda df, *c: df.agg(F.coalesce(F.sum(F.xxhash64(*c).cast("decimal(38,0)")), F.lit(0))).first()[0]
    return int(count(selected.select("station_id").distinct(), "station_id")) ^ int(count(elements, "element", "policy_hash"))
