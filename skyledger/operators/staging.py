"""Text to types. Values that don't parse become null and keep their text beside them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.functions.values import obs_day


def typed_observations(raw: DataFrame) -> DataFrame:
    extra = [c for c in ("raw_changed_at", "raw_run_id") if c in raw.columns]
    return raw.select(
        "station_id", obs_day(F.col("obs_date")).alias("obs_date"), "element", F.col("value").try_cast("int").alias("raw_value"),
        "mflag", "qflag", "sflag", "obs_time", F.col("obs_date").alias("obs_date_text"), F.col("value").alias("value_text"), *extra,
    )


def typed_stations(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.col("id").alias("station_id"), F.substring("id", 1, 2).alias("country_code"), F.substring("id", 3, 1).alias("network_code"),
        F.substring("id", 4, 100).alias("network_station_id"), F.col("latitude").try_cast("double").alias("latitude"),
        F.col("longitude").try_cast("double").alias("longitude"), F.nullif("elevation", F.lit("-999.9")).try_cast("double").alias("elevation_m"),
        F.col("state").alias("state_code"), F.col("name").alias("station_name"), (F.col("gsn_flag") == "GSN").alias("is_gsn"), "hcn_crn_flag", "wmo_id",
    )


def typed_inventory(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.col("id").alias("station_id"), "element", F.col("first_year").try_cast("int").alias("first_year"), F.col("last_year").try_cast("int").alias("last_year")
    )


def typed_elements(raw: DataFrame) -> DataFrame:
    """The catalog; codes with * or # name families and match no observation."""
    return raw.select(F.col("code").alias("element"), "description", "unit", "scale", F.col("core").alias("is_core"), (~F.col("code").rlike("[*#]")).alias("is_exact_code"))


def typed_countries(raw: DataFrame) -> DataFrame:
    return raw.select(F.col("code").alias("country_code"), F.col("name").alias("country_name"))
