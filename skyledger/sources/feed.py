"""Station-day-element feed derived from the business tables, and the run's configuration.

The driver's tables hold no station data, so events become readings, users become stations and
nations become cities, by fixed formulas that the SQL oracles repeat.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.sources.shared import read_table, small_or_shuffled

KEY = ["station_id", "obs_date", "element"]
FLAGS = ["mflag", "qflag", "sflag", "obs_time"]
COLUMNS = [*KEY, "value", *FLAGS]

#: Run literals: no query depends on the clock.
LOADED_AT, CHANGED_AT = "2024-02-01 00:00:00", "2024-02-10 00:00:00"
FIRST_RUN, SECOND_RUN = "run-1", "run-2"
MAX_DELETED_PCT = 5.0
REQUIRED = ["TMAX", "TMIN", "PRCP"]
MAX_KM = 5.0

#: Element catalog (code, description, unit, scale, core).
CATALOG = [
    ("PRCP", "Precipitation (tenths of mm)", "mm", 0.1, True),
    ("SNOW", "Snowfall (mm)", "mm", 1.0, True),
    ("SNWD", "Snow depth (mm)", "mm", 1.0, True),
    ("TMAX", "Maximum temperature (tenths of degrees C)", "degrees C", 0.1, True),
    ("TMIN", "Minimum temperature (tenths of degrees C)", "degrees C", 0.1, True),
    ("TAVG", "Average daily temperature (tenths of degrees C)", "degrees C", 0.1, False),
    ("WDFG", "Direction of peak wind gust (degrees)", "degrees", 1.0, False),
    ("WSFG", "Peak gust wind speed (tenths of meters per second)", "meters per second", 0.1, False),
    ("WT**", "Weather type [pattern]", None, 1.0, False),
]
#: Policy (element, excluded, absent_means_zero, persistent, fed_by, lower, upper, display unit, factor).
POLICY = [
    ("TMAX", False, False, False, None, -60.0, 50.0, None, None),
    ("TMIN", False, False, False, None, -60.0, 50.0, None, None),
    ("TAVG", False, False, False, None, -60.0, 50.0, None, None),
    ("PRCP", False, False, False, None, 0.0, 500.0, None, None),
    ("SNOW", False, False, False, None, 0.0, 1000.0, "cm", 0.1),
    ("SNWD", False, True, True, "SNOW", 0.0, 5000.0, "cm", 0.1),
    ("WSFG", False, True, False, None, 0.0, 100.0, "km/h", 3.6),
    ("WDFG", False, True, False, None, 0.0, 360.0, None, None),
]
#: Window, days to "lagging" and "stale", volume swing in percent.
SCOPE = ("2024-01-01", "2024-01-31", 3, 6, 20.0)


def station_id(user: Column) -> Column:
    return F.concat(F.lit("CAN"), F.lpad(user.cast("string"), 8, "0"))


def _every(n: int) -> Column:
    return F.col("event_id") % n == 0


def feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """event_id, user_id and the eight text columns of an observation file; duplicates and bad values included."""
    kind, tenths = F.col("event_type"), F.floor(F.col("value") * 10).cast("long")
    element = (
        F.when(kind == "view", F.when(_every(5), "TAVG").otherwise("TMAX")).when(kind == "click", "TMIN").when(kind == "purchase", "PRCP")
        .when(kind == "signup", F.when(_every(4), "WDFG").otherwise("SNOW")).otherwise(F.when(_every(3), "WSFG").otherwise("SNWD"))
    )
    raw = (
        F.when(F.col("element").isin("TMAX", "TMIN", "TAVG"), tenths % 900 - 200).when(F.col("element") == "WDFG", tenths % 36 * 10)
        .when(F.col("element").isin("SNOW", "SNWD"), tenths % 1200).otherwise(tenths)
    )
    day = F.date_format("ts", "yyyyMMdd")
    return (
        read_table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "event_type", "value")
        .withColumn("element", element)
        .select(
            "event_id", "user_id", station_id(F.col("user_id")).alias("station_id"),
            F.when(_every(73), F.substring(day, 1, 7)).otherwise(day).alias("obs_date"), "element",
            F.when(_every(71), "n/a").when(_every(11), "0").otherwise(raw.cast("string")).alias("value"),
            F.when(_every(11), "T").alias("mflag"), F.when(_every(17), "I").alias("qflag"), F.lit("C").alias("sflag"),
            F.lit(None).cast("string").alias("obs_time"),
        )
    )


def first_snapshot(rows: DataFrame) -> DataFrame:
    """The feed as published first: some readings come only later."""
    return rows.where(~_every(89)).select("event_id", F.col("station_id").alias("file_station"), *COLUMNS)


def second_snapshot(rows: DataFrame) -> DataFrame:
    """The feed as published next: removals, revised values and flags, and rows filed under another station."""
    number = F.col("value").try_cast("long")
    return rows.where(~_every(97)).select(
        "event_id", F.col("station_id").alias("file_station"),
        F.when(_every(103), "XXX00000000").otherwise(F.col("station_id")).alias("station_id"), "obs_date", "element",
        F.when(_every(53), F.coalesce((number + 1).cast("string"), F.col("value"))).otherwise(F.col("value")).alias("value"),
        "mflag", F.when(_every(59), "G").otherwise(F.col("qflag")).alias("qflag"), "sflag", "obs_time",
    )


def stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw station metadata, all text."""
    u, n = F.col("user_id"), F.col("c_nationkey")
    users = read_table(spark, sf_dir, "events").select("user_id").distinct()
    customers = read_table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("user_id"), "c_nationkey")
    nations = read_table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_regionkey")
    suffix = F.element_at(F.array(*[F.lit(x) for x in ("INTL A", "A", "AP", "CENTRE", "INT", "HARBOUR")]), (u % 6 + 1).cast("int"))
    degrees = lambda base, step: F.format_string("%.4f", base + step * 0.0005)
    return users.join(customers, "user_id").join(small_or_shuffled(nations), "c_nationkey").select(
        "user_id", station_id(u).alias("id"), F.concat(F.lit("R"), F.col("n_regionkey").cast("string")).alias("state"),
        F.concat(F.lit("N"), n.cast("string"), F.lit(" "), suffix).alias("name"),
        F.when(u % 3 == 0, F.lpad(u.cast("string"), 5, "0")).otherwise("").alias("wmo_id"),
        degrees(F.lit(45.0) + n % 5, (u * 37) % 100).alias("latitude"), degrees(F.lit(-75.0) - n % 7, -((u * 53) % 100)).alias("longitude"),
        F.when(u % 10 == 0, "-999.9").otherwise(F.concat((u % 500).cast("string"), F.lit(".5"))).alias("elevation"),
        F.when(u % 4 == 0, "GSN").otherwise("").alias("gsn_flag"), F.lit("").alias("hcn_crn_flag"), "c_nationkey",
    )


def countries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw country codes and names, one for each nation."""
    return read_table(spark, sf_dir, "nation").select(F.concat(F.lit("C"), F.chr(F.col("n_nationkey") + 65)).alias("code"), F.col("n_name").alias("name"))


def inventory(rows: DataFrame) -> DataFrame:
    """Which station reports which element over which years, as text; a few stopped before the window."""
    u = F.col("user_id")
    gone = (u % 7 == 0) & F.col("element").isin("SNWD", "PRCP")
    return rows.select("user_id", "station_id", "element").distinct().select(
        F.col("station_id").alias("id"), "element", (2010 + u % 15).cast("string").alias("first_year"), F.when(gone, "2023").otherwise("2024").alias("last_year"),
    )


def cities(metadata: DataFrame) -> DataFrame:
    """One configured city for each nation; some pin their station."""
    n = F.col("c_nationkey")
    return metadata.groupBy("c_nationkey", "state").agg(F.max("id").alias("last_id")).select(
        F.concat(F.lit("City "), n.cast("string")).alias("city"), F.col("state").alias("province"),
        F.concat(F.lit("N"), n.cast("string"), F.lit(" ")).alias("prefix"), F.lit("CA").alias("country"),
        F.when(n % 9 == 0, F.col("last_id")).alias("pinned_id"),
    )


def selected_stations(metadata: DataFrame) -> DataFrame:
    """The stations whose days the marts cover: (city, province, station_id)."""
    u = F.col("user_id")
    return metadata.where(u % 5 != 4).select(F.concat(F.lit("Town "), u.cast("string")).alias("city"), F.col("state").alias("province"), F.col("id").alias("station_id"))


def catalog(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(CATALOG, "code string, description string, unit string, scale double, core boolean")


def policy(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        POLICY, "element string, excluded boolean, absent_means_zero boolean, persistent boolean, fed_by string, "
        "lower_bound double, upper_bound double, display_unit string, display_factor double")


def scope(spark: SparkSession) -> DataFrame:
    """One row: the window and the quality thresholds."""
    one = spark.createDataFrame([SCOPE], "start_date string, end_date string, freshness_warn_days int, freshness_error_days int, volume_change_warn_pct double")
    return one.withColumns({c: F.to_date(c) for c in ("start_date", "end_date")})
