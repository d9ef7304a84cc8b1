"""Sinks: snapshots, append-only logs, keyed replacement and all-or-nothing publication of several tables."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.operators.facts import keyed_replace


MANIFEST = "number long, run_id string, paths string"


def write_snapshot(df: DataFrame, path: str, comments: dict[str, str] | None = None) -> None:
    """Replaces the table; column comments go with the schema."""
    for c, text in (comments or {}).items():
        df = df.withMetadata(c, {"comment": text})
    df.write.mode("overwrite").parquet(path)


def append_log(df: DataFrame, path: str, run_id: str) -> None:
    """Adds a run's rows to an append-only log; writing a run again replaces only that run."""
    df.withColumn("run_id", F.lit(run_id)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run_id").parquet(path)


def publish(spark: SparkSession, tables: dict[str, DataFrame], root: str, run_id: str) -> None:
    """Writes all tables under the run's own folder and then one manifest, which readers follow: all or nothing.

    Publications are numbered in the order they are made, whatever the runs are called. One writer at a time.
    """
    spark.createDataFrame([], MANIFEST).write.mode("ignore").json(f"{root}/manifest")  # there for good after the first publication
    numbers = spark.read.schema(MANIFEST).json(f"{root}/manifest")
    number = (numbers.agg(F.max("number")).first()[0] or 0) + 1
    paths = {name: f"{root}/{run_id}/{name}" for name in tables}
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(paths[name])
    spark.createDataFrame([(number, run_id, json.dumps(paths))], MANIFEST).coalesce(1).write.mode("append").json(f"{root}/manifest")


def published(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A table as of the latest manifest."""
    latest = spark.read.schema(MANIFEST).json(f"{root}/manifest").agg(F.max_by("paths", "number").alias("paths")).first()
    return spark.read.parquet(json.loads(latest["paths"])[name])


def replace_keys(spark: SparkSession, root: str, name: str, new: DataFrame, key: list[str], run_id: str) -> None:
    """Publishes the table with the rows of ``new`` in place of those with their key; new columns are taken on."""
    publish(spark, {name: keyed_replace(published(spark, root, name), new, key)}, root, run_id)


def wide_after(stored: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    """A wide table after ``new`` has replaced the rows of its keys: columns that only ``new`` has are taken on (null elsewhere), those it no longer has go."""
    return keyed_replace(stored.select(*[c for c in stored.columns if c in new.columns]), new, key).select(*new.columns)


def register(spark: SparkSession, df: DataFrame, table: str, comment: str | None = None, columns: dict[str, str] | None = None) -> None:
    """Writes a catalog table, replacing it, with a comment of its own and comments on its columns."""
    for c, text in (columns or {}).items():
        df = df.withMetadata(c, {**df.schema[c].metadata, "comment": text})
    df.write.mode("overwrite").format("parquet").saveAsTable(table)
    if comment is not None:
        quoted = comment.replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(f"COMMENT ON TABLE {table} IS '{quoted}'")


def table_exists(spark: SparkSession, table: str) -> bool:
    return spark.catalog.tableExists(table)


def catalog_columns(spark: SparkSession, database: str = "default") -> DataFrame:
    """(table_name, table_comment, position, column_name, data_type, column_comment) of a database's tables, temporary views left out."""
    rows = [
        (t.name, t.description, n, c.name, c.dataType, c.description)
        for t in spark.catalog.listTables(database) if not t.isTemporary for n, c in enumerate(spark.catalog.listColumns(f"{database}.{t.name}"), 1)]
    return spark.createDataFrame(rows, "table_name string, table_comment string, position int, column_name string, data_type string, column_comment string")


def write_report(df: DataFrame, path: str) -> None:
    """Rows as JSON lines, decimals as numbers and dates in ISO form."""
    numbers = [F.col(c).cast("double").alias(c) if t.startswith("decimal") else F.col(c) for c, t in df.dtypes]
    df.select(*numbers).write.mode("overwrite").option("dateFormat", "yyyy-MM-dd").json(path)


def tables(spark: SparkSession, database: str = "default") -> list[tuple[str, str, str, str | None]]:
    """(database, table, column, comment) of what the catalog holds."""
    return [(database, t.name, c.name, c.description) for t in spark.catalog.listTables(database) for c in spark.catalog.listColumns(t.name, database)]
