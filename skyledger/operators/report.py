"""One document per station: nested extracts of tables that have keys of their own, put together in one exchange."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: What a fact is, as it stands in a sheet's JSON.
FACTS = "array<struct<element string, label string, value double, unit string, status string, compass string>>"


def nested(base: DataFrame, key: str, extracts: dict[str, DataFrame]) -> DataFrame:
    """``base`` (one row per key) with an array of each extract's rows, in the order of their columns; empty where a key has none.

    All extracts travel side by side, each row in a struct of its own, so they are exchanged once however many there are. What
    a key gathers must be bounded by nature (days of a window, runs, cases).
    """
    rows = [df.select(key, F.struct(*[F.col(c) for c in df.columns if c != key]).alias(name)) for name, df in extracts.items()]
    together = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), rows)
    found = together.groupBy(key).agg(*[F.array_sort(F.collect_list(name)).alias(name) for name in extracts])
    types = dict(found.dtypes)
    joined = base.join(found, key, "left")
    return joined.select(*base.columns, *[F.coalesce(F.col(n), F.array().cast(types[n])).alias(n) for n in extracts])


def parsed_facts(text: Column) -> Column:
    return F.from_json(text, FACTS)


def station_documents(
    stations: DataFrame, resolved: DataFrame, daily: DataFrame, quality: DataFrame, changes: DataFrame, texts: DataFrame, sheets: DataFrame, evaluated: DataFrame, failures: DataFrame,
) -> DataFrame:
    """One row per station: how it was chosen, its days, quality, changes, texts with facts and checks, evaluations and failing tests.

    stations: (station_id, city, province, station_name); resolved: candidates of each city; texts: the latest of each day, with the verdict as names;
    sheets: with ``facts`` as JSON, which is parsed and carried along; evaluated: results by city; failures: failing rows as JSON.
    """
    facts = sheets.select("station_id", "obs_date", parsed_facts(F.col("facts")).alias("facts"))
    checks = F.when(F.coalesce("failed_checks", F.lit("")) != "", F.split("failed_checks", ", ")).otherwise(F.array().cast("array<string>"))
    with_facts = texts.select("station_id", "obs_date", "attempt", "narrative", "passed", checks.alias("failed")).join(facts, ["station_id", "obs_date"], "left")
    chosen = resolved.groupBy("city").agg(F.count(F.lit(1)).alias("candidates"), F.count_if("selected").alias("selected"))
    of_city = stations.select("station_id", "city")
    return nested(stations.join(chosen, "city", "left"), "station_id", {
        "daily": daily.select("station_id", "obs_date", *[c for c in daily.columns if c not in ("station_id", "obs_date", "city", "station_name")]),
        "quality": quality.select("station_id", "element", "completeness", "freshness"),
        "changes": changes.select("station_id", "changed_at", "run_id", "inserted", "updated", "deleted", "historical_changes"),
        "texts": with_facts,
        "evaluations": evaluated.join(of_city, "city").select("station_id", "version", "case_id", "obs_date", "outcome", "passed"),
        "tests": failures.select(F.get_json_object("failing_row", "$.station_id").alias("station_id"), "test_name", "tested", "severity").where("station_id is not null"),
    })
