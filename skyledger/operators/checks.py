"""Data tests: each gives the failing rows; none means it passed."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def not_null(rows: DataFrame, column: str) -> DataFrame:
    return rows.where(F.col(column).isNull())


def unique_combination(rows: DataFrame, columns: list[str]) -> DataFrame:
    return rows.groupBy(*columns).agg(F.count(F.lit(1)).alias("n_rows")).where("n_rows > 1")


def unique(rows: DataFrame, column: str) -> DataFrame:
    return unique_combination(rows.where(F.col(column).isNotNull()), [column])


def accepted_values(rows: DataFrame, column: str, values: list[str]) -> DataFrame:
    return rows.where(~F.col(column).isin(values))


def relationships(rows: DataFrame, column: str, parents: DataFrame, parent: str) -> DataFrame:
    return rows.where(F.col(column).isNotNull()).join(parents.select(F.col(parent).alias(column)), column, "left_anti")


def within_bounds(rows: DataFrame, column: str, low: float, high: float) -> DataFrame:
    return rows.where((F.col(column) < low) | (F.col(column) > high))


def single_row(rows: DataFrame) -> DataFrame:
    return rows.agg(F.count(F.lit(1)).alias("n_rows")).where("n_rows <> 1")


def all_failures(results: list[tuple[str, str, str, DataFrame]]) -> DataFrame:
    """(test, tested table, severity, failing rows) to one table with each failing row as JSON."""
    as_json = [
        rows.select(F.lit(name).alias("test_name"), F.lit(tested).alias("tested"), F.lit(severity).alias("severity"), F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("failing_row"))
        for name, tested, severity, rows in results
    ]
    return reduce(DataFrame.unionByName, as_json)


def breaks(kind: str, column: str, given: list | tuple | None) -> Column:
    """True where a row fails a test that needs no other row."""
    value = F.col(column)
    if kind == "not_null":
        return value.isNull()
    if kind == "accepted_values":
        return ~value.isin(given)
    low, high = given
    return (value < low) | (value > high)


def row_failures(rows: DataFrame, tested: str, identity: list[Column], tests: list[tuple[str, str, Column]]) -> DataFrame:
    """All (test, severity, condition) of one table in one pass; shaped like ``all_failures``."""
    failed = F.filter(F.array(*[F.when(bad, F.struct(F.lit(name).alias("test_name"), F.lit(severity).alias("severity"))) for name, severity, bad in tests]), lambda x: x.isNotNull())
    as_json = F.to_json(F.struct(*identity), {"ignoreNullFields": "false"})
    return rows.select(F.explode(failed).alias("t"), as_json.alias("failing_row")).select("t.test_name", F.lit(tested).alias("tested"), "t.severity", "failing_row")


def test_status(tests: DataFrame, failures: DataFrame) -> DataFrame:
    """(test_name, tested, severity) of every test with its failing rows: pass, or fail or warn by severity."""
    n = failures.groupBy("test_name").agg(F.count(F.lit(1)).alias("failing"))
    rows = tests.join(n, "test_name", "left").withColumn("failing", F.coalesce("failing", F.lit(0)))
    return rows.withColumn("status", F.when(F.col("failing") == 0, "pass").when(F.col("severity") == "error", "fail").otherwise("warn"))


def health_status(problems: DataFrame, sections: list[str]) -> DataFrame:
    """(section, severity) of every problem to one status for each of ``sections``: ERROR over WARN over OK, which notes leave as it is."""
    count = lambda severity: F.count_if(F.col("severity") == severity)
    found = problems.groupBy("section").agg(count("error").alias("errors"), count("warn").alias("warnings"), count("info").alias("notes"))
    every = problems.sparkSession.createDataFrame([(s,) for s in sections], "section string")
    return every.join(found, "section", "left").select(
        "section", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("errors", "warnings", "notes")],
        F.when(F.col("errors") > 0, "ERROR").when(F.col("warnings") > 0, "WARN").otherwise("OK").alias("status"))
