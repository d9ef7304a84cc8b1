"""Quality, change and issue marts over the grid, the facts and the change log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyledger.functions.values import QUARANTINED, USABLE, compass, flag_text, obs_day

STATUSES = ["valid", "trace", "missing", "not_reported", "qc_failed", "out_of_bounds", "inconsistent", "unparseable"]


def data_quality(grid: DataFrame, selected: DataFrame, elements: DataFrame, scope: DataFrame) -> DataFrame:
    """Per station and element: days by status, completeness, days since the last usable reading, freshness. One aggregation."""
    usable = F.col("status").isin(USABLE)
    counts = grid.groupBy("station_id", "element").agg(
        F.count_if("is_expected").alias("expected_days"), *[F.count_if(F.col("status") == s).alias(f"{s}_days") for s in STATUSES],
        F.min(F.when(usable, F.col("obs_date"))).alias("first_usable_date"), F.max(F.when(usable, F.col("obs_date"))).alias("last_usable_date"),
    )
    behind = F.datediff("end_date", "last_usable_date")
    return (
        counts.join(selected.select("station_id", "city"), "station_id").join(F.broadcast(elements.select("element", "absent_means_zero")), "element")
        .crossJoin(F.broadcast(scope))
        .select(
            "city", *counts.columns,
            F.when(F.col("expected_days") > 0, F.round((F.col("valid_days") + F.col("trace_days") + F.col("not_reported_days")) / F.col("expected_days"), 4)).alias("completeness"),
            behind.alias("days_since_last"),
            F.when(F.col("expected_days") == 0, "not_expected").when(F.col("absent_means_zero"), "not_applicable")
            .when(F.col("last_usable_date").isNull() | (behind > F.col("freshness_error_days")), "stale").when(behind > F.col("freshness_warn_days"), "lagging").otherwise("fresh").alias("freshness"),
        )
    )


def source_changes(log: DataFrame, selected: DataFrame) -> DataFrame:
    """What a source changed, per run and station; historical: revised or removed more than a week after the day."""
    day, same = obs_day(F.col("obs_date")), F.col("old_value").eqNullSafe(F.col("new_value"))
    change = F.col("change")
    return log.join(selected.select("station_id", "city"), "station_id", "left").groupBy("run_id", "station_id", "city").agg(
        F.min("changed_at").alias("changed_at"), *[F.count_if(change == c).alias(n) for c, n in (("insert", "inserted"), ("update", "updated"), ("delete", "deleted"))],
        F.count_if((change == "update") & ~same).alias("value_revisions"), F.count_if((change == "update") & same).alias("flag_revisions"),
        F.count_if(change.isin("update", "delete") & (day < F.date_sub(F.to_date("changed_at"), 7))).alias("historical_changes"),
        F.min(day).alias("earliest_date_touched"), F.max(day).alias("latest_date_touched"),
    )


def fact_sheets(grid: DataFrame, elements: DataFrame, selected: DataFrame) -> DataFrame:
    """Per station and day the ordered facts, their JSON and its fingerprint; only elements that were expected."""
    usable = F.col("status").isin(USABLE)
    facts = grid.where("status <> 'not_expected'").drop("unit", "is_core").join(
        F.broadcast(elements.select("element", "label", F.col("unit").alias("raw_unit"), F.col("display_unit").alias("unit"), "display_factor", "is_core")), "element")
    shown = facts.withColumn("compass", F.when((F.col("raw_unit") == "degrees") & usable, compass(F.col("value")))).withColumn(
        "value", F.when(usable, F.round(F.col("value") * F.col("display_factor"), 1)))
    order = F.struct((~F.col("is_core")).alias("other"), "element", F.struct("element", "label", "value", "unit", "status", "compass").alias("fact"))
    sheets = shown.groupBy("station_id", "obs_date").agg(F.transform(F.array_sort(F.collect_list(order)), lambda x: x["fact"]).alias("fact_list"))
    text = F.to_json("fact_list", {"ignoreNullFields": "false"})
    return sheets.join(selected.select("station_id", "city", "province", "station_name"), "station_id").withColumn("facts", text).withColumn("input_hash", F.md5(text))


def daily_display(daily: DataFrame, factors: dict[str, float]) -> DataFrame:
    """The wide daily table in reader's units. An element without a factor, or out of scope, doesn't empty the result."""
    shown = [F.round(F.col(c) * f, 1).alias(f"{c}_shown") for c, f in factors.items() if c in daily.columns]
    return daily.select("station_id", "city", "obs_date", *shown)


def status_counts(grid: DataFrame) -> DataFrame:
    return grid.groupBy("element", "status").agg(F.count(F.lit(1)).alias("n")).orderBy("element", "status")


def data_issues(fct: DataFrame, rejects: DataFrame, log: DataFrame, failures: DataFrame, selected: DataFrame, rejected_at: Column) -> DataFrame:
    """Everything wrong with the data, one row per issue of four kinds, with the table it was found in and the time it came (unknown for tests)."""
    none, status = F.lit(None).cast("string"), F.col("quality_status")
    why = (
        F.when(status == "qc_failed", F.concat(F.lit("failed quality check "), "qflag", F.lit(": "), flag_text(F.col("qflag"))))
        .when(status == "out_of_bounds", "outside the physical bounds").when(status == "inconsistent", "maximum temperature below minimum that day: both set aside")
        .otherwise("value or date did not parse")
    )
    issue = lambda rows, kind, severity, **c: rows.select(F.lit(kind).alias("issue_type"), severity.alias("severity"), *[v.alias(k) for k, v in c.items()])
    revised = F.when(F.col("change") == "delete", F.concat(F.lit("removed at source (was "), "old_value", F.lit(")"))).when(
        ~F.col("old_value").eqNullSafe(F.col("new_value")), F.concat(F.lit("value revised: "), "old_value", F.lit(" -> "), "new_value")).otherwise(
        F.concat(F.lit("flags revised: "), "old_flags", F.lit(" -> "), "new_flags"))
    field = lambda name: F.get_json_object("failing_row", f"$.{name}")
    rows = [
        issue(fct.where(status.isin(QUARANTINED)), "quarantined", F.lit("info"), station_id=F.col("station_id"), obs_date=F.col("obs_date"), element=F.col("element"), value=F.col("raw_value").cast("string"), reason=why,
              found_in=F.lit("facts"), detected_at=F.col("raw_changed_at")),
        issue(rejects, "rejected_row", F.lit("warn"), station_id=F.col("file_station"), obs_date=F.lit(None).cast("date"), element=none, value=F.col("line"), reason=F.col("reason"),
              found_in=F.lit("rejects"), detected_at=rejected_at),
        issue(log.where("change in ('update', 'delete')"), "revised_at_source", F.lit("info"), station_id=F.col("station_id"), obs_date=obs_day(F.col("obs_date")), element=F.col("element"),
              value=F.coalesce("new_value", "old_value"), reason=revised, found_in=F.lit("change_log"), detected_at=F.col("changed_at")),
        issue(failures, "test_failure", F.col("severity"), station_id=field("station_id"), obs_date=F.when(field("obs_date").rlike(r"^\d{4}-\d{2}-\d{2}$"), F.try_to_date(field("obs_date"))), element=field("element"), value=F.col("failing_row"),
              reason=F.concat(F.lit("failed test "), "test_name", F.lit(" on "), "tested"), found_in=F.col("tested"), detected_at=F.lit(None).cast("timestamp")),
    ]
    every = rows[0]
    for r in rows[1:]:
        every = every.unionByName(r)
    return every.join(selected.select("station_id", "city"), "station_id", "left")


def latest_per_key(rows: DataFrame, key: list[str], order: list[Column]) -> DataFrame:
    return rows.withColumn("_n", F.row_number().over(Window.partitionBy(*key).orderBy(*order))).where("_n = 1").drop("_n")


def volume_swing(loads: DataFrame) -> DataFrame:
    """(file, loaded_at, rows_read) with the change in percent against the file's load before."""
    before = F.lag("rows_read").over(Window.partitionBy("file").orderBy("loaded_at"))
    rows = loads.withColumn("rows_before", before)
    return rows.withColumn("swing_pct", F.round(100 * F.try_divide(F.col("rows_read") - F.col("rows_before"), F.col("rows_before")), 2)).where("rows_before is not null")


def city_quality(quality: DataFrame) -> DataFrame:
    """Per city: days set aside, mean and worst completeness and the element that has it, anything stale."""
    known = F.when(F.col("completeness").isNotNull(), F.struct("completeness", "element"))
    return quality.groupBy("city").agg(
        F.sum("expected_days").alias("expected_days"), F.sum(F.col("qc_failed_days") + F.col("out_of_bounds_days") + F.col("inconsistent_days") + F.col("unparseable_days")).alias("quarantined_days"),
        # Summed as whole ten-thousandths, so that the order of rows can't tip a tie.
        (F.round(F.sum(F.round(F.col("completeness") * 10000).cast("long")) / F.nullif(F.count("completeness"), F.lit(0))) / 10000).alias("mean_completeness"), F.min("completeness").alias("worst_completeness"), F.min(known)["element"].alias("worst_element"),
        F.bool_or(F.col("freshness") == "stale").alias("any_stale"), F.max("last_usable_date").alias("latest_date"),
    )
