"""Assessment of every value against flags, bounds and its pair of the day."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

PAIR = ("TMAX", "TMIN")


def checked(observations: DataFrame, selected: DataFrame, elements: DataFrame) -> DataFrame:
    """Scaled values with a status, before pairs are compared. Bounds look at the unrounded product."""
    scaled = F.col("raw_value") * F.col("scale")
    status = (
        F.when(F.col("obs_date").isNull() | F.col("raw_value").isNull(), "unparseable").when(F.col("qflag").isNotNull(), "qc_failed")
        .when((scaled < F.col("lower_bound")) | (scaled > F.col("upper_bound")), "out_of_bounds").when(F.col("mflag") == "T", "trace").otherwise("valid")
    )
    return (
        observations.join(selected.select("station_id"), "station_id", "left_semi")
        .join(F.broadcast(elements.select("element", "unit", "scale", "lower_bound", "upper_bound", "policy_hash")), "element")
        .withColumn("value", scaled.cast("decimal(12,1)")).withColumn("is_trace", F.col("mflag") == "T").withColumn("quality_status", status)
        .drop("scale", "lower_bound", "upper_bound")
    )


def assess(observations: DataFrame, selected: DataFrame, elements: DataFrame) -> DataFrame:
    """Adds "inconsistent": both of a day's pair when both were valid and the maximum is below the minimum.

    One window over (station, day) instead of joining the table with itself twice.
    """
    day = Window.partitionBy("station_id", "obs_date")
    valid = F.col("quality_status") == "valid"
    lowest_max = F.min(F.when(valid & (F.col("element") == PAIR[0]), F.col("value"))).over(day)
    highest_min = F.max(F.when(valid & (F.col("element") == PAIR[1]), F.col("value"))).over(day)
    inverted = F.col("obs_date").isNotNull() & F.col("element").isin(*PAIR) & F.coalesce(lowest_max < highest_min, F.lit(False))
    rows = checked(observations, selected, elements)
    return rows.withColumn("quality_status", F.when(inverted, "inconsistent").otherwise(F.col("quality_status")))


def inverted_days(rows: DataFrame) -> DataFrame:
    """Days whose valid maximum is below their valid minimum, from ``checked`` rows."""
    valid = rows.where((F.col("quality_status") == "valid") & F.col("element").isin(*PAIR) & F.col("obs_date").isNotNull())
    return valid.groupBy("station_id", "obs_date").agg(
        F.min(F.when(F.col("element") == PAIR[0], F.col("value"))).alias("tmax"), F.max(F.when(F.col("element") == PAIR[1], F.col("value"))).alias("tmin"),
    ).where("tmax < tmin")


def tavg_outside(fct: DataFrame, tolerance: float = 0.5) -> DataFrame:
    """Days whose usable mean lies outside the usable minimum and maximum by more than ``tolerance``."""
    of = lambda e: F.max(F.when(F.col("element") == e, F.col("value").cast("double")))
    days = fct.where("is_usable and not is_deleted").where(F.col("element").isin("TAVG", "TMIN", "TMAX")).groupBy("station_id", "obs_date").agg(
        of("TAVG").alias("tavg"), of("TMIN").alias("tmin"), of("TMAX").alias("tmax"))
    return days.where((F.col("tavg") < F.col("tmin") - tolerance) | (F.col("tavg") > F.col("tmax") + tolerance)).where("tmin is not null and tmax is not null")


def inverted_usable(fct: DataFrame) -> DataFrame:
    """Days whose usable maximum lies below their usable minimum; there are none unless the assessment is broken."""
    of = lambda e: F.max(F.when(F.col("element") == e, F.col("value")))
    days = fct.where("is_usable and not is_deleted").where(F.col("element").isin(*PAIR)).groupBy("station_id", "obs_date").agg(of(PAIR[0]).alias("tmax"), of(PAIR[1]).alias("tmin"))
    return days.where("tmax < tmin")
