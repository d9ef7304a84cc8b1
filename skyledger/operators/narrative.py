"""Short texts from fact sheets, and the queue of what still has to be written or repaired."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyledger.functions.values import USABLE, short
from skyledger.operators.marts import latest_per_key


def fact(facts: Column, element: str) -> Column:
    """The fact of an element, null if there is none."""
    return F.get(F.filter(facts, lambda f: f["element"] == element), F.lit(0))


def usable(f: Column) -> Column:
    return F.coalesce(f["status"].isin(USABLE) & f["value"].isNotNull(), F.lit(False))


def nothing_to_report(facts: Column) -> Column:
    return ~F.exists(facts, lambda f: f["element"].isin("TMAX", "TMIN", "PRCP") & f["status"].isin(USABLE))


def template_narratives(sheets: DataFrame) -> DataFrame:
    """A fixed-form text of at most three sentences, with the values it cites."""
    of = {e: F.col(f"_{e}") for e in ("TMAX", "TMIN", "PRCP", "SNOW", "WSFG")}
    both = usable(of["TMAX"]) & usable(of["TMIN"])
    rain, snow = of["PRCP"], usable(of["SNOW"]) & F.coalesce(of["SNOW"]["value"] > 0, F.lit(False))
    status = F.coalesce(rain["status"], F.lit(""))
    wet = usable(rain) & F.coalesce(rain["value"] > 0, F.lit(False))
    first = F.when(both, F.concat("city", F.lit(" reached a high of "), short(of["TMAX"]["value"]), F.lit(" °C and a low of "), short(of["TMIN"]["value"]), F.lit(" °C."))).otherwise(
        F.concat(F.lit("Temperature readings for "), "city", F.lit(" were not available.")))
    second = F.when(status == "trace", "There was a trace of precipitation.").when(wet, F.concat(short(rain["value"]), F.lit(" mm of precipitation fell."))).when(
        status == "valid", "It stayed dry.").otherwise("The precipitation reading was not available.")
    second = F.when(snow, F.concat(F.regexp_replace(second, r"\.+$", ""), F.lit(", with "), short(of["SNOW"]["value"]), F.lit(" cm of snow."))).otherwise(second)
    third = F.when(usable(of["WSFG"]), F.concat(F.lit("Gusts peaked at "), F.round(of["WSFG"]["value"]).cast("long").cast("string"), F.lit(" km/h.")))
    cite = lambda cond, e: F.when(cond, F.array(F.struct(F.lit(e).alias("element"), of[e]["value"].alias("value")))).otherwise(F.array().cast("array<struct<element:string,value:double>>"))
    cited = F.concat(cite(both, "TMAX"), cite(both, "TMIN"), cite((status != "trace") & wet, "PRCP"), cite(snow, "SNOW"), cite(usable(of["WSFG"]), "WSFG"))
    named = sheets.withColumns({f"_{e}": fact(F.col("fact_list"), e) for e in of})
    return named.withColumn("narrative", F.concat_ws(" ", first, second, third)).withColumn("cited", cited).drop(*[f"_{e}" for e in of])


def recent(rows: DataFrame, days: int) -> DataFrame:
    """Rows of the last ``days`` days that each station has."""
    latest = F.max("obs_date").over(Window.partitionBy("station_id"))
    return rows.withColumn("_latest", latest).where(F.col("obs_date") > F.date_sub("_latest", days)).drop("_latest")


def pending(sheets: DataFrame, written: DataFrame, quality: DataFrame, model: str, version: str, days: int) -> DataFrame:
    """Recent fact sheets without a text of this model and version for these very facts, at stations that aren't stale."""
    done = written.where((F.col("model") == model) & (F.col("version") == version)).select("station_id", "obs_date", "input_hash")
    stale = quality.where("freshness = 'stale'").select("station_id").distinct()
    return recent(sheets, days).join(done, ["station_id", "obs_date", "input_hash"], "left_anti").join(stale, "station_id", "left_anti")


def batches(queue: DataFrame, size: int, most: int) -> DataFrame:
    """Numbers of the batches the queue is sent in, newest days first; batches beyond ``most`` are deferred.

    Positions are counted per day first, so no window holds the whole queue.
    """
    within = F.row_number().over(Window.partitionBy("obs_date").orderBy("city", "station_id")) - 1
    days = queue.groupBy("obs_date").agg(F.count(F.lit(1)).alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy(F.col("obs_date").desc()).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = queue.withColumn("_at", within).join(F.broadcast(days.select("obs_date", before.alias("_before"))), "obs_date")
    batch = F.floor((F.col("_before") + F.col("_at")) / size)
    return placed.withColumn("batch", batch).withColumn("deferred", batch >= most).drop("_at", "_before")


def latest_narratives(daily: DataFrame, validation: DataFrame) -> DataFrame:
    """The newest text of each station-day with the verdict on that very attempt."""
    key = ["station_id", "obs_date", "input_hash", "model", "version", "attempt"]
    return latest_per_key(daily.join(validation, key, "left"), ["station_id", "obs_date"], [F.col("generated_at").desc(), F.col("attempt").desc()])


def unrepaired(latest: DataFrame, sheets: DataFrame, model: str, version: str, days: int) -> DataFrame:
    """Latest texts that failed at their first attempt, for facts that still hold, on recent days."""
    failed = latest.where(~F.col("passed") & (F.col("attempt") == 1) & (F.col("model") == model) & (F.col("version") == version))
    return recent(sheets, days).select("station_id", "city", "obs_date", "input_hash").join(
        failed.select("station_id", "obs_date", "input_hash", "narrative", "failed_checks"), ["station_id", "obs_date", "input_hash"])
