"""Work tables in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from functools import cache, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows and bytes up to which a side may be broadcast; beyond either the join is left to shuffle.
BROADCAST_ROWS, BROADCAST_BYTES = 200_000, 32 << 20
#: Parts that the rows of one key are dealt to where a lookup is too large to broadcast.
SALTS = 64
#: Words of 64 bits that a filter of keys has at most, so that it can be broadcast whatever the number of keys.
FILTER_WORDS = 1 << 20
#: The work tables that the innermost ``scratch`` of this thread of work has to remove.
_scratch: ContextVar[list[str] | None] = ContextVar("scratch", default=None)


@cache
def _own_folder() -> str:
    return f"file://{tempfile.mkdtemp(prefix='skyledger-')}"


def shared_dir(spark: SparkSession, label: str) -> str:
    """A new path under ``spark.checkpoint.dir``.

    The cluster names that folder. Only a session that is a single process (tests, a laptop) may do without:
    there a local folder is shared by driver and executors. On a cluster without the setting this is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.conf.get("spark.master", "")
        if master != "local" and not master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        root = _own_folder()
    path = f"{root.rstrip('/')}/skyledger/{label}-{uuid.uuid4().hex}"
    mine = _scratch.get()
    if mine is not None:
        mine.append(path)
    return path


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Removes the work tables made inside when it ends; what is to stay must have been written elsewhere by then.

    Only tables of the thread that entered are removed, so that what other threads run meanwhile keeps its own.
    """
    mine: list[str] = []
    before = _scratch.set(mine)
    try:
        yield
    finally:
        _scratch.reset(before)
        jvm = spark._jvm
        for path in mine:
            where = jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a table in the shared folder: cuts lineage, survives lost executors, is computed once."""
    path = shared_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def written_alone(spark: SparkSession, make: Callable[[], DataFrame], label: str) -> DataFrame:
    """What ``make`` returns as a table in the shared folder; the work tables made on the way go once it is written."""
    path = shared_dir(spark, label)
    with scratch(spark):
        df = make()
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def is_small(df: DataFrame, rows: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES) -> bool:
    """Whether ``df`` has at most ``rows`` rows and about ``size`` bytes; reads no more than a few more rows than that."""
    width = reduce(lambda a, b: a + b, [F.coalesce(F.octet_length(c), F.lit(0)) if t in ("string", "binary") else F.lit(16) for c, t in df.dtypes], F.lit(16))
    found = df.limit(rows + 1).agg(F.count(F.lit(1)).alias("rows"), F.sum(width).alias("bytes")).first()
    return found["rows"] <= rows and (found["bytes"] or 0) <= size


def small_or_shuffled(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` with a broadcast hint if it is small, else as it is (a shuffle join).

    ``df`` should be cheap to read twice (a written table) and narrow.
    """
    return F.broadcast(df) if is_small(df, rows) else df


def looked_up(rows: DataFrame, side: DataFrame, on: dict[str, Column], how: str = "inner") -> DataFrame:
    """``rows`` with the columns of ``side`` whose key columns equal the expressions ``on`` (nulls are equal); the key columns go.

    ``side`` has one row for each key and is a written table. If it is small it is broadcast and ``rows`` stay where
    they are. Else each key is salted, so that a key with very many rows is dealt to many tasks.
    """
    def joined(left: DataFrame, right: DataFrame, hint: Callable[[DataFrame], DataFrame], *more: Column) -> DataFrame:
        met = reduce(lambda a, b: a & b, [*more, *(value.eqNullSafe(right[key]) for key, value in on.items())])
        return left.join(hint(right), met, how).drop(*[right[key] for key in on])

    if is_small(side):
        return joined(rows, side, F.broadcast)
    salted = side.withColumn("_salt_of", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    dealt = rows.withColumn("_salt", F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int"))
    return joined(dealt, salted, lambda df: df, F.col("_salt") == F.col("_salt_of")).drop("_salt", "_salt_of")


def _filter_place(*key: Column) -> tuple[Column, Column]:
    """The word of a filter that a key belongs to, and its two bits there."""
    h = F.xxhash64(*key)
    bit = lambda shift: F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftrightunsigned(h, shift).bitwiseAND(F.lit(63)).cast("int"))
    return F.pmod(h, F.lit(FILTER_WORDS)), bit(40).bitwiseOR(bit(52))


def may_be_in(rows: DataFrame, side: DataFrame, on: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """``rows`` in two parts: those whose key may be among the keys of ``side``, and those whose key surely isn't.

    A filter of the keys is tested where the rows are. It has a fixed size: with 7 million keys about 4 in 100 rows are taken for one of them wrongly,
    with 70 million nearly all are, which costs time, never a row. ``rows`` is read once for each part.
    """
    word, bits = _filter_place(*[F.col(key) for key in on])
    keys = written(side.select(word.alias("_f_word"), bits.alias("_f_bits")).groupBy("_f_word").agg(F.bit_or("_f_bits").alias("_f_bits")), "key-filter")
    word, bits = _filter_place(*on.values())
    tested = rows.withColumn("_f_own", bits).join(F.broadcast(keys), word == keys["_f_word"], "left")
    may = F.coalesce(F.col("_f_bits").bitwiseAND(F.col("_f_own")) == F.col("_f_own"), F.lit(False))
    return tuple(tested.where(part).drop("_f_own", "_f_word", "_f_bits") for part in (may, ~may))


def _matched(side: DataFrame, on: dict[str, Column]) -> Column:
    return reduce(lambda a, b: a & b, [value == side[key] for key, value in on.items()])


def those_in(rows: DataFrame, side: DataFrame, on: dict[str, Column]) -> DataFrame:
    """``rows`` joined to ``side``, a written table, by keys that equal the expressions ``on``. Rows that surely have no match aren't moved."""
    if is_small(side):
        return rows.join(F.broadcast(side), _matched(side, on))
    return may_be_in(rows, side, on)[0].join(side, _matched(side, on))


def those_not_in(rows: DataFrame, side: DataFrame, on: dict[str, Column]) -> DataFrame:
    """``rows`` without a match in ``side``, a written table, by keys that equal the expressions ``on``. Rows that surely have none are passed on where they are."""
    if is_small(side):
        return rows.join(F.broadcast(side), _matched(side, on), "left_anti")
    may, none = may_be_in(rows, side, on)
    return none.unionByName(may.join(side, _matched(side, on), "left_anti"))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
