"""Exact deduplication by stateful streaming.

A digest log (digest, identifier, content locator) runs through a streaming aggregation whose keyed
state lies in RocksDB on disk and has no expiry; the state of a digest holds the smallest
identifier, that row's locator and the number of rows. Rows that hit a digest seen before are then
compared with the keeper's full text, which the locator finds; a row that differs (a digest
collision) is grouped by its full text instead.

Beyond what may be broadcast, rows are looked up behind a filter of the wanted places, so that texts
which surely aren't wanted are not moved.

Only DataFrame operations: no Python runs on the executors.

Defined results: a null text counts as empty; a null ``doc_id`` sorts after every other and is
never a ``keep_id`` unless the whole group has none; of rows with equal text and equal id, the
first by (file, row) stays; an empty table gives an empty result; ``keep_first`` returns every input
column as it was, whatever its name (rows travel as one struct). Very long texts are digested and compared whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from skyledger.sources.shared import shared_dir, those_in, those_not_in, written, written_alone

SPACE = r"[\x20\x09-\x0D]+"
STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # Else each partition's store takes several MB of disk before it holds anything.
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
    # One bound for all the stores of an executor.
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "128",
}


def normalised(text: Column) -> Column:
    """Null as empty, each run of white space as one space."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE, " ")


def with_locator(docs: DataFrame) -> DataFrame:
    """(row, _dd_file, _dd_row): each row as a struct, and the place it can be read from again.

    Rows that don't come straight from files are first written to the shared folder.
    """
    def placed(stored: DataFrame) -> DataFrame:
        place = stored.metadataColumn("_metadata")
        return stored.select(
            F.struct(*[F.col(f"`{c}`") for c in stored.columns]).alias("row"), place["file_path"].alias("_dd_file"), place["row_index"].alias("_dd_row"))

    try:
        return placed(docs)
    except AnalysisException:
        return placed(written(docs, "dedup-docs"))


def keyed_state(log: DataFrame, path: str, trigger_bytes: str | None = None) -> DataFrame:
    """Runs the digest log written at ``path`` through the stateful stream; one row per digest.

    trigger_bytes: size of a micro-batch, for logs whose new digests shouldn't arrive all at once.
    """
    spark = log.sparkSession
    out, checkpoint = shared_dir(spark, "dedup-state"), shared_dir(spark, "dedup-stream")
    before = {k: spark.conf.get(k, None) for k in STATE}
    for k, v in STATE.items():
        spark.conf.set(k, v)
    try:
        source = spark.readStream.schema(log.schema)
        if trigger_bytes:
            source = source.option("maxBytesPerTrigger", trigger_bytes)
        state = source.parquet(path).groupBy("digest").agg(
            F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "file", "row")).alias("keeper"),
            F.count(F.lit(1)).alias("n"),
        )
        (
            state.writeStream.outputMode("update")
            .option("checkpointLocation", checkpoint)
            .foreachBatch(lambda batch, i: batch.write.mode("overwrite").parquet(f"{out}/batch={i}"))
            .trigger(availableNow=True)
            .start()
            .awaitTermination()
        )
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    # A later batch only lowers the keeper and raises the count, so the last state of a digest is this.
    return (
        spark.read.schema(state.schema).parquet(f"{out}/batch=*")
        .groupBy("digest").agg(F.min("keeper").alias("keeper"), F.max("n").alias("n"))
    )


def exact_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", trigger_bytes: str | None = None
) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256, file, row (the locator)."""
    return _deduplicated(with_locator(docs), id_col, text_col, trigger_bytes)


def _deduplicated(placed: DataFrame, id_col: str, text_col: str, trigger_bytes: str | None = None) -> DataFrame:
    spark, row = placed.sparkSession, F.col("row")
    path = shared_dir(spark, "dedup-log")
    placed.select(
        row[id_col].alias("id"), F.unhex(F.sha2(normalised(row[text_col]), 256)).alias("digest"),
        F.col("_dd_file").alias("file"), F.col("_dd_row").alias("row"),
    ).write.parquet(path)
    log = spark.read.parquet(path)
    if log.isEmpty():
        return spark.createDataFrame(
            [], f"id {dict(log.dtypes)['id']}, keep_id {dict(log.dtypes)['id']}, group_size long, kept boolean, "
            "text_sha256 string, file string, row long")
    state = written(keyed_state(log, path, trigger_bytes), "dedup-digests")
    seen = log.join(state, "digest")
    is_keeper = (F.col("file") == F.col("keeper.file")) & (F.col("row") == F.col("keeper.row"))

    # Hits: rows of digests seen more than once. Only their texts are read again and moved.
    hits = written(
        seen.where("n > 1").select("digest", "id", "file", "row", is_keeper.alias("is_keeper")), "dedup-hits"
    )
    texts = those_in(placed.select(normalised(row[text_col]).alias("bytes"), "_dd_file", "_dd_row"), hits, {"file": F.col("_dd_file"), "row": F.col("_dd_row")})
    first = texts.where("is_keeper").select("digest", F.col("bytes").alias("keeper_bytes"))
    odd = written(
        texts.where("not is_keeper").join(first, "digest").where("bytes <> keeper_bytes")
        .select("digest", "id", "file", "row", "bytes"),
        "dedup-collisions",
    )
    digest_hex = F.lower(F.hex("digest")).alias("text_sha256")
    result = seen.select(
        "id", F.col("keeper.id").alias("keep_id"), F.col("n").alias("group_size"), is_keeper.alias("kept"),
        digest_hex, "file", "row",
    )
    return result if odd.isEmpty() else _split_collisions(result, odd)


def _split_collisions(result: DataFrame, odd: DataFrame) -> DataFrame:
    """Rows whose bytes differ from their digest's keeper, regrouped by the bytes themselves."""
    keeper = F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "file", "row")).alias("keeper")
    groups = odd.groupBy("digest", "bytes").agg(keeper, F.count(F.lit(1)).alias("n"))
    own = odd.join(groups, ["digest", "bytes"]).select("file", "row", "keeper", "n")
    less = odd.groupBy(F.lower(F.hex("digest")).alias("text_sha256")).agg(F.count(F.lit(1)).alias("less"))
    moved = F.col("keeper").isNotNull()
    return (
        result.join(less, "text_sha256", "left").join(own, ["file", "row"], "left")
        .select(
            "id", F.when(moved, F.col("keeper.id")).otherwise(F.col("keep_id")).alias("keep_id"),
            F.when(moved, F.col("n")).otherwise(F.col("group_size") - F.coalesce("less", F.lit(0))).alias("group_size"),
            F.when(moved, (F.col("file") == F.col("keeper.file")) & (F.col("row") == F.col("keeper.row")))
            .otherwise(F.col("kept")).alias("kept"),
            "text_sha256", "file", "row",
        )
    )


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that repeat an earlier text; columns as they were."""
    placed = with_locator(docs)
    dropped = written_alone(docs.sparkSession, lambda: _deduplicated(placed, id_col, text_col).where("not kept").select(
        F.col("file").alias("_dd_f"), F.col("row").alias("_dd_r")), "dedup-dropped")
    return those_not_in(placed, dropped, {"_dd_f": F.col("_dd_file"), "_dd_r": F.col("_dd_row")}).select("row.*")
