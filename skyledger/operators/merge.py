"""Merging a new snapshot of all stations at once: dedup, diff, refusal of suspicious losses, change log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyledger.functions.values import flags, row_hash

KEY = ["station_id", "obs_date", "element"]
ORDER = ["value", "mflag", "qflag", "sflag", "obs_time"]


def ranked(incoming: DataFrame) -> DataFrame:
    """``incoming`` with copy 1 for the row that is kept of each key; always the same row for the same file."""
    order = Window.partitionBy(*KEY).orderBy(*[F.col(c).asc_nulls_last() for c in ORDER])
    return incoming.withColumn("copy", F.row_number().over(order))


def dedup(incoming: DataFrame) -> DataFrame:
    """Rows of their own file's station, one for each key, with their hash."""
    mine = incoming.where(F.col("station_id").eqNullSafe(F.col("file_station")))
    return ranked(mine).where("copy = 1").select(*KEY, *ORDER, row_hash().alias("row_hash"))


def foreign_reason() -> Column:
    return F.concat(F.lit("filed under another station's name: "), F.coalesce("station_id", F.lit("none")))


def double_reason() -> Column:
    return F.concat(F.lit("second row of "), F.coalesce("obs_date", F.lit("no date")), F.lit(", "), F.coalesce("element", F.lit("no element")), F.lit("; the first in order stays"))


def row_rejects(incoming: DataFrame) -> DataFrame:
    """Rows that were readable but not taken, with the reason."""
    line = F.concat_ws(",", *[F.coalesce(c, F.lit("")) for c in [*KEY, *ORDER]])
    foreign = ~F.col("station_id").eqNullSafe(F.col("file_station"))
    strange = incoming.where(foreign).select("file_station", line.alias("line"), foreign_reason().alias("reason"))
    double = ranked(incoming.where(~foreign)).where("copy > 1").select("file_station", line.alias("line"), double_reason().alias("reason"))
    return strange.unionByName(double)


def detect_changes(stored: DataFrame, incoming: DataFrame) -> DataFrame:
    """Inserts, updates and deletes between two deduplicated snapshots, by one full outer join on the key."""
    old, new = stored.select(*KEY, *ORDER, "row_hash").alias("o"), incoming.select(*KEY, *ORDER, "row_hash").alias("i")
    both = old.join(new, KEY, "full_outer").where(~F.col("o.row_hash").eqNullSafe(F.col("i.row_hash")))
    gone, came = F.col("i.row_hash").isNull(), F.col("o.row_hash").isNull()
    return both.select(
        *KEY, F.when(came, "insert").when(gone, "delete").otherwise("update").alias("change"), F.col("o.value").alias("old_value"),
        F.col("i.value").alias("new_value"), F.when(~came, flags("o.")).alias("old_flags"), F.when(~gone, flags("i.")).alias("new_flags"),
    )


def deletes_guard(changes: DataFrame, stored: DataFrame, most_pct: float) -> DataFrame:
    """(station_id, deleted, existing, refused): refused where strictly more than ``most_pct`` of the stored rows would go."""
    had = stored.groupBy("station_id").agg(F.count(F.lit(1)).alias("existing"))
    lost = changes.where("change = 'delete'").groupBy("station_id").agg(F.count(F.lit(1)).alias("deleted"))
    both = had.join(lost, "station_id", "left").withColumn("deleted", F.coalesce("deleted", F.lit(0)))
    return both.select("station_id", "deleted", "existing", (100 * F.col("deleted") / F.col("existing") > most_pct).alias("refused"))


def accepted(changes: DataFrame, guard: DataFrame) -> DataFrame:
    return changes.join(guard.where("refused").select("station_id"), "station_id", "left_anti")


def logged(changes: DataFrame, run_id: str, changed_at: str) -> DataFrame:
    return changes.select(F.lit(run_id).alias("run_id"), "*", F.lit(changed_at).cast("timestamp").alias("changed_at"))


def merge(stored: DataFrame, incoming: DataFrame, changes: DataFrame, log: DataFrame, run_id: str, changed_at: str) -> DataFrame:
    """The table after accepted ``changes``; ``log`` is the whole change log, these changes included.

    Unchanged rows keep their stamps. New and revised rows take the run's; their first load is the key's first insert.
    """
    kept = stored.join(changes.where("change <> 'insert'").select(*KEY), KEY, "left_anti")
    first = log.where("change = 'insert'").groupBy(*KEY).agg(F.min("changed_at").alias("first"))
    now = F.lit(changed_at).cast("timestamp")
    fresh = incoming.join(changes.where("change <> 'delete'").select(*KEY), KEY, "left_semi").join(first, KEY, "left").select(
        *KEY, *ORDER, "row_hash", F.coalesce("first", now).alias("first_loaded_at"), now.alias("last_changed_at"), F.lit(run_id).alias("run_id"))
    return kept.unionByName(fresh)


def first_load(incoming: DataFrame, run_id: str, loaded_at: str) -> DataFrame:
    now = F.lit(loaded_at).cast("timestamp")
    return incoming.select(*KEY, *ORDER, "row_hash", now.alias("first_loaded_at"), now.alias("last_changed_at"), F.lit(run_id).alias("run_id"))


def load_checks(incoming: DataFrame, rejected: DataFrame, guard: DataFrame, most_pct: float, of: tuple[str, ...] = ()) -> DataFrame:
    """(station_id, check_name, severity, passed, observed, expected): one row per file and check.

    incoming: the lines the reader took; rejected: (file_station, ..) one row for each line it couldn't. of: more columns that tell files apart.
    """
    mine, file = F.col("station_id").eqNullSafe(F.col("file_station")), ["file_station", *of]
    counts = incoming.groupBy(*file).agg(
        F.count_if(~mine).alias("foreign"),
        (F.count_if(mine) - F.count_distinct(F.when(mine, F.struct(*[F.coalesce(c, F.lit("")) for c in KEY])))).alias("duplicates"),
    ).join(rejected.groupBy(*file).agg(F.count(F.lit(1)).alias("unreadable")), file, "full_outer").na.fill(0, ["foreign", "duplicates", "unreadable"])
    check = lambda name, severity, n: F.struct(
        F.lit(name).alias("check_name"), F.lit(severity).alias("severity"), (F.col(n) == 0).alias("passed"), F.col(n).cast("double").alias("observed"), F.lit(0.0).alias("expected"))
    rows = counts.select(F.col("file_station").alias("station_id"), *of, F.explode(F.array(
        check("rows_belong_to_station", "error", "foreign"), check("unique_station_date_element", "error", "duplicates"), check("parseable_rows", "warn", "unreadable"))).alias("c"))
    deletes = guard.select("station_id", *of, F.lit("deletes_within_limit").alias("check_name"), F.lit("error").alias("severity"), (~F.col("refused")).alias("passed"),
                           F.round(100 * F.col("deleted") / F.col("existing"), 4).alias("observed"), F.lit(most_pct).alias("expected"))
    return rows.select("station_id", *of, "c.*").unionByName(deletes)
