"""Evaluation of texts on fixed cases: a result for every case, a nested record for every run, the latest run of each version.

A case that has no fact sheet, or a sheet without a draft, is an outcome of its own: it counts as a case and hasn't passed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.operators.textcheck import CHECKS, STYLE

#: Results that a row of a record holds, about.
PART = 500


def _named(tests: list[tuple[str, Column]]) -> Column:
    """The names of the tests that hold, in order."""
    return F.filter(F.array(*[F.when(holds, F.lit(name)) for name, holds in tests]), lambda x: x.isNotNull())


def results(cases: DataFrame, sheets: DataFrame, checked: DataFrame) -> DataFrame:
    """(version, case_id, city, obs_date, outcome, passed, failed, warnings, style, chars, narrative) for each case under each version.

    cases: (case_id, city, obs_date); sheets: (station_id, city, obs_date, ..), one per city and day; checked: drafts with their version and a
    boolean per check. Cases and versions are configuration, and few; sheets and drafts are met by key.
    """
    versions = checked.select("version").distinct()
    days = cases.join(sheets.select("city", "obs_date", "station_id"), ["city", "obs_date"], "left").crossJoin(F.broadcast(versions))
    drafts = checked.select("version", "station_id", "obs_date", "narrative", *[n for n, _ in CHECKS])
    met = days.join(drafts, ["version", "station_id", "obs_date"], "left")
    text = F.coalesce("narrative", F.lit(""))
    written = text != ""
    of = lambda severity: _named([(n, written & ~F.col(n)) for n, s in CHECKS if s == severity])
    found = met.select(
        "version", "case_id", "city", "obs_date", F.when(F.col("station_id").isNull(), "no sheet").when(~written, "no text").alias("outcome"), of("error").alias("failed"),
        of("warn").alias("warnings"), _named([(n, text.rlike(p)) for n, p in STYLE.items()]).alias("style"), F.char_length(text).alias("chars"), text.alias("narrative"))
    passed = F.col("outcome").isNull() & (F.size("failed") == 0)
    return found.withColumn("passed", passed).withColumn("outcome", F.coalesce("outcome", F.when(passed, "passed").otherwise("failed")))


def run_record(found: DataFrame, eval_id: Column, model: str, evaluated_at: Column, most: int = PART) -> DataFrame:
    """One record per version: counts over its cases, with the results themselves as an array by case.

    A record with more than ``most`` results is about as many rows as that goes into them: they differ in ``part`` (from 0) and in the results they hold. Which part
    a result is in, its hash says, so no task gathers a version. found: read twice.
    """
    count = lambda c: F.sum(F.size(c)).cast("long")
    one = F.struct("case_id", "outcome", "passed", "failed", "warnings", "style", "narrative")
    records = found.groupBy("version").agg(
        F.count(F.lit(1)).alias("cases"), F.count_if("passed").alias("passed"), F.count_if(F.col("outcome") == "no sheet").alias("no_sheet"), F.count_if(F.col("outcome") == "no text").alias("no_text"),
        count("failed").alias("error_failures"), count("warnings").alias("warnings"), count("style").alias("style_issues"), F.round(F.avg("chars"), 1).alias("avg_chars"))
    parts = F.ceil(F.col("cases") / most)
    of = records.select(F.col("version").alias("_version"), parts.alias("_parts"))
    dealt = found.join(F.broadcast(of), F.col("version").eqNullSafe(F.col("_version"))).groupBy("_version", F.pmod(F.xxhash64(*found.columns), F.col("_parts")).alias("_part")).agg(
        F.array_sort(F.collect_list(one)).alias("results"))
    rows = records.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1)))
    met = rows.join(dealt, F.col("version").eqNullSafe(F.col("_version")) & (F.col("part") == F.col("_part")), "left").drop("_version", "_part")
    whole = met.withColumn("results", F.coalesce("results", F.array().cast(dict(dealt.dtypes)["results"])))
    return whole.withColumns({"eval_id": eval_id, "model": F.lit(model), "evaluated_at": evaluated_at})


def latest_evaluations(ledger: DataFrame) -> DataFrame:
    """The last run of each version and model, and how many more or fewer of its cases passed than in the run before."""
    order = F.struct("evaluated_at", "eval_id", "passed", "cases", "error_failures", "warnings", "style_issues")
    last_two = F.slice(F.reverse(F.array_sort(F.collect_list(order))), 1, 2)  # a version's runs are few
    records = ledger.where("part = 0") if "part" in ledger.columns else ledger
    rows = records.groupBy("version", "model").agg(last_two.alias("l"), F.count(F.lit(1)).alias("runs"))
    return rows.select("version", "model", "runs", "l", F.element_at("l", 1).alias("x")).select(
        "version", "model", "runs", "x.*", (F.col("x.passed") - F.get("l", F.lit(1))["passed"]).alias("passed_change"))
