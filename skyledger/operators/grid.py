"""Dense grid station x day x element: gaps are rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skyledger.functions.values import QUARANTINED


#: What a row of a series stands for, in the order in which rows of one day come.
YEARS, FRAME, READING, FED = range(4)


def grid_window(scope: DataFrame, fct: DataFrame) -> DataFrame:
    """One row (first, last): the window's start, and its end or the latest reading, whichever is first; none if that's before the start."""
    latest = fct.where("not is_deleted").agg(F.max("obs_date").alias("latest"))
    return scope.crossJoin(F.broadcast(latest)).select(F.col("start_date").alias("first"), F.least("end_date", "latest").alias("last")).where("last >= first")


def day_spine(scope: DataFrame, fct: DataFrame) -> DataFrame:
    """The days of the window."""
    return grid_window(scope, fct).select(F.explode(F.sequence("first", "last")).alias("obs_date"))


def series_rows(window: DataFrame, selected: DataFrame, elements: DataFrame, reported: DataFrame, fct: DataFrame) -> DataFrame:
    """(station_id, element, day, kind, year, reading, fed): all that bears on a series, side by side.

    A series has a frame on the day before the window, the years it is reported in, its readings in the window and, where another
    element feeds it, that element's usable readings.
    """
    columns = ["station_id", "element", "day", "kind", "year", "reading", "fed"]
    readings = fct.where("not is_deleted and obs_date is not null").join(window, F.col("obs_date").between(F.col("first"), F.col("last"))).select(
        "station_id", "element", F.col("obs_date").alias("day"), F.struct("quality_status", "is_usable", F.col("value").alias("observed"), "is_trace", "qflag", "raw_value").alias("reading"))
    types = dict(readings.dtypes) | {"year": "struct<first_year:int,last_year:int>"}
    types["fed"] = dict(readings.select("reading.observed").dtypes)["observed"]
    before = F.date_sub("first", 1).alias("day")

    def rows(df: DataFrame, kind: int) -> DataFrame:
        there = {"kind": F.lit(kind).alias("kind")} | {c: F.col(c) for c in df.columns}
        return df.select(*[there.get(c, F.lit(None).cast(types.get(c, "int")).alias(c)) for c in columns])

    frames = selected.select("station_id").crossJoin(F.broadcast(elements.select("element"))).crossJoin(window).select("station_id", "element", before)
    years = reported.crossJoin(window).select("station_id", "element", before, F.struct("first_year", "last_year").alias("year"))
    fed = readings.where("reading.is_usable").join(F.broadcast(elements.select(F.col("element").alias("target"), "fed_by")), F.col("element") == F.col("fed_by")).select(
        "station_id", F.col("target").alias("element"), "day", F.col("reading.observed").alias("fed"))
    return rows(years, YEARS).unionByName(rows(frames, FRAME)).unionByName(rows(readings, READING)).unionByName(rows(fed, FED))


def station_day_grid(scope: DataFrame, selected: DataFrame, elements: DataFrame, reported: DataFrame, fct: DataFrame) -> DataFrame:
    """One row per selected station, day and element, with a status and, where usable or known to be nothing, a value.

    A series is kept as its readings and the gaps between them: what bears on a series is exchanged once, by (station, element), and
    sorted by day once; both neighbours of a gap come from that order. Days are made last, each row giving its own day and the gap after it.
    """
    window = F.broadcast(grid_window(scope, fct))
    series = Window.partitionBy("station_id", "element")
    order = series.orderBy("day", "kind")
    usable = F.when(F.col("reading.is_usable"), F.col("reading.observed"))
    marked = series_rows(window, selected, elements, reported, fct).select(
        "*", F.last(usable, ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)).alias("previous"),
        F.first(usable, ignorenulls=True).over(order.rowsBetween(1, Window.unboundedFollowing)).alias("next"),
        F.lag("day").over(order).alias("day_before"), F.lead("day").over(order).alias("day_after"),
        F.collect_list("year").over(series).alias("years"), F.max(F.col("kind") == FRAME).over(series).alias("framed"))
    own = (F.col("kind") >= READING) & ~F.col("day").eqNullSafe(F.col("day_before"))  # not a frame, and the day's first row
    begin = F.when(own, F.col("day")).otherwise(F.date_add("day", 1))
    end = F.greatest(F.coalesce(F.date_sub("day_after", 1), F.col("last")), F.when(own, F.col("day")))
    days = marked.where("framed").crossJoin(window).withColumn("begin", begin).withColumn("end", end).where("begin <= end").select(
        "station_id", "element", "day", "reading", "fed", "previous", "next", "years", F.explode(F.sequence("begin", "end")).alias("obs_date"))
    on_day = F.col("obs_date") == F.col("day")
    small = F.broadcast(elements.select("element", "unit", "is_core", "absent_means_zero", "persistent"))
    seen = days.join(small, "element").select(
        "*", (on_day & F.col("reading").isNotNull()).alias("has_row"), F.when(on_day, F.col("fed")).alias("fed_value"),
        F.exists("years", lambda y: F.year("obs_date").between(y["first_year"], y["last_year"])).alias("is_expected"))
    present = F.col("persistent") & (((F.col("previous") > 0) & (F.col("next") > 0)) | (F.coalesce(F.col("fed_value").cast("double"), F.lit(0.0)) > 0))
    nothing = F.col("absent_means_zero") & ~F.coalesce(present, F.lit(False))
    of_reading = lambda c: F.when(F.col("has_row"), F.col(f"reading.{c}"))
    return seen.select(
        "station_id", "obs_date", "element", "unit", "is_core", "is_expected",
        F.when(F.col("has_row"), F.col("reading.quality_status")).when(~F.col("is_expected"), "not_expected").when(nothing, "not_reported").otherwise("missing").alias("status"),
        F.when(F.col("has_row"), F.when(F.col("reading.is_usable"), F.col("reading.observed").cast("double"))).when(F.col("is_expected") & nothing, 0.0).alias("value"),
        F.coalesce(of_reading("is_trace"), F.lit(False)).alias("is_trace"), of_reading("qflag").alias("qflag"), of_reading("raw_value").alias("raw_value"),
    )


#: Columns that a wide table may get from the data: beyond that the scope is not one of elements.
MOST_CODES = 500


def scoped_codes(elements: DataFrame, most: int = MOST_CODES) -> list[str]:
    """The codes in scope, which name the wide table's columns: the one step of the pivot that the driver has to see."""
    codes = [r[0] for r in elements.select("element").distinct().orderBy("element").limit(most + 1).collect()]
    if len(codes) > most:
        raise ValueError(f"more than {most} elements in scope: too many for columns")
    return codes


def station_daily(grid: DataFrame, selected: DataFrame, elements: list[str]) -> DataFrame:
    """One row per station and day: value and status of each element, core counts, lists of missing and set-aside elements."""
    core, list_of = F.col("is_core") & F.col("is_expected"), lambda cond: F.nullif(F.array_join(F.array_sort(F.collect_list(F.when(cond, F.col("element")))), ", "), F.lit(""))
    wide = grid.groupBy("station_id", "obs_date").agg(
        *[a for e in elements for a in (F.max(F.when(F.col("element") == e, F.col("value"))).alias(e.lower()), F.max(F.when(F.col("element") == e, F.col("status"))).alias(f"{e.lower()}_status"))],
        F.count_if(core).alias("core_expected"), F.count_if(core & F.col("status").isin("valid", "trace", "not_reported")).alias("core_present"),
        list_of(F.col("status") == "missing").alias("missing_elements"), list_of(F.col("status").isin(QUARANTINED)).alias("quarantined_elements"),
    )
    return wide.join(selected.select("station_id", "city", "station_name"), "station_id")
