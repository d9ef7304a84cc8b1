"""What a run covers: stations, elements and who reports what."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def stations_selected(selected: DataFrame, stations: DataFrame, countries: DataFrame | None = None, states: DataFrame | None = None) -> DataFrame:
    """The configured stations with their metadata, country and state names (null where unknown)."""
    out = selected.join(stations, "station_id")
    if countries is not None:
        out = out.join(countries, "country_code", "left")
    if states is not None:
        out = out.join(states, "state_code", "left")
    return out


def scoped_elements(inventory: DataFrame, selected: DataFrame, scope: DataFrame) -> DataFrame:
    """Distinct elements that a selected station reports in a year of the window."""
    overlaps = (F.col("first_year") <= F.year("end_date")) & (F.col("last_year") >= F.year("start_date"))
    mine = inventory.join(selected.select("station_id"), "station_id", "left_semi")
    return mine.crossJoin(F.broadcast(scope)).where(overlaps).select("element").distinct()


def elements_in_scope(inventory: DataFrame, selected: DataFrame, catalog: DataFrame, policy: DataFrame, scope: DataFrame) -> DataFrame:
    """Reported, documented and not excluded elements, with policy defaults and a hash of what changes values."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("∅"))
    return (
        catalog.where("is_exact_code").join(scoped_elements(inventory, selected, scope), "element", "left_semi")
        .join(policy, "element", "left").where(~F.coalesce("excluded", F.lit(False)))
        .withColumns({c: F.coalesce(c, F.lit(False)) for c in ("absent_means_zero", "persistent")})
        .select(
            "element", "description", F.regexp_replace("description", r"\s*[(\[].*$", "").alias("label"), "unit", "scale", "is_core",
            "absent_means_zero", "persistent", "fed_by", "lower_bound", "upper_bound",
            F.coalesce("display_unit", "unit").alias("display_unit"), F.coalesce("display_factor", F.lit(1.0)).alias("display_factor"),
            F.md5(F.concat_ws("|", text("scale"), text("absent_means_zero"), text("lower_bound"), text("upper_bound"))).alias("policy_hash"),
        )
    )


def station_elements(selected: DataFrame, inventory: DataFrame, elements: DataFrame) -> DataFrame:
    return inventory.join(selected.select("station_id"), "station_id", "left_semi").join(elements.select("element"), "element", "left_semi").select(
        "station_id", "element", "first_year", "last_year")


def dim_station(selected: DataFrame, reported: DataFrame) -> DataFrame:
    """The selected stations with the list of elements each reports."""
    lists = reported.groupBy("station_id").agg(F.array_join(F.array_sort(F.collect_list("element")), ", ").alias("elements_reported"))
    return selected.join(lists, "station_id", "left")


def element_coverage(inventory: DataFrame, required: list[str], first_year: int, last_year: int) -> DataFrame:
    """Per station: elements, required elements reported over the whole window, years."""
    covers = F.col("element").isin(required) & (F.col("first_year") <= first_year) & (F.col("last_year") >= last_year)
    return inventory.groupBy("station_id").agg(
        F.count_distinct("element").alias("elements"), F.count_distinct(F.when(covers, F.col("element"))).alias("required_covered"),
        F.min("first_year").alias("first_year"), F.max("last_year").alias("last_year"),
    )


def window_bounds(windows: DataFrame, today: Column) -> DataFrame:
    """``windows`` with their first and last day and what is wrong with them.

    windows: start_date, end_date, last_days, each of which may be null. An open end is today; a window starts on its date or
    ``last_days`` before its end, of which exactly one must be given. A window with an error has no bounds.
    """
    last = F.coalesce("end_date", today)
    error = F.when(F.col("start_date").isNull() == F.col("last_days").isNull(), "give either a start or a number of days").when(
        F.col("start_date") > last, "starts after its end").when(F.col("last_days") < 0, "negative number of days")
    return windows.withColumn("error", error).withColumns({
        "first_day": F.when(F.col("error").isNull(), F.coalesce("start_date", F.date_sub(last, F.col("last_days")))), "last_day": F.when(F.col("error").isNull(), last)})
