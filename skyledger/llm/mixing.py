"""Mixing sources to target weights.

Words are counted per source, targets follow from the weights (a source gives at most ``most``
times its words; what it can't give is shared again by weight), the rate of a source is target by
words, and a document is taken floor(rate) times plus once more with the fraction's probability,
drawn from a hash of seed and id, so that reruns agree.

The targets are one row per source. They are looked up by each document where it is: no text is
moved by its source, however many documents have the same one.

Defined results: a null text has no words and is taken like any other (its copies weigh nothing);
a null source is a source of its own and comes last; rows that repeat an id share its draw; an
empty table gives an empty result. ``mix`` adds the columns named in WORK, in place of input columns
of these names; ``emit`` returns every input column, whatever its name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyledger.sources.shared import looked_up, written

WORD = r"[^\x20\x09-\x0D]+"
#: Weights by the rank of a source, repeating.
WEIGHTS = (1, 2, 3)
WORK = ("_mx_size", "_mx_source_size", "_mx_target", "_mx_rate", "_mx_copies")


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def draw(seed: str, key: Column) -> Column:
    """Uniform in [0, 1), from the first 32 bits of a digest."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("null"))))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") / F.lit(4294967296.0)


def source_targets(totals: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = 3) -> DataFrame:
    """(source, source_size) to (source, source_size, target).

    A source is filled up when its limit by weight is no higher than what the sources not yet filled
    up would get; taken in the order of limit by weight this is one pass of running sums. The
    windows hold one row per source, never a document.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    rank = (F.row_number().over(by_name) - 1) % len(weights)
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), rank + 1).cast("long")
    limits = totals.select("source", "source_size", weight.alias("w"), (F.lit(most) * F.col("source_size")).alias("lim"))
    order = Window.orderBy(F.col("lim") / F.col("w"), F.col("source").asc_nulls_last())
    before, every = order.rowsBetween(Window.unboundedPreceding, -1), Window.orderBy(F.lit(1)).rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    zero = F.lit(0).cast("long")
    swept = limits.select(
        "*",
        (F.sum("source_size").over(every) - F.coalesce(F.sum("lim").over(before), zero)).alias("left_size"),
        (F.sum("w").over(every) - F.coalesce(F.sum("w").over(before), zero)).alias("left_w"),
    ).withColumn("full", F.col("lim") / F.col("w") <= F.col("left_size") / F.col("left_w"))
    full = lambda c: F.sum(F.when(F.col("full"), F.col(c)).otherwise(zero)).over(every)
    rest = swept.select(
        "source", "source_size", "w", "lim", "full",
        (F.sum("source_size").over(every) - full("lim")).alias("rest_size"), (F.sum("w").over(every) - full("w")).alias("rest_w"),
    )
    target = F.when(F.col("full"), F.col("lim").cast("double")).otherwise(F.col("w") * F.col("rest_size") / F.col("rest_w"))
    return rest.select("source", "source_size", target.alias("target"))


def rates(docs: DataFrame, text_col: str, source_col: str, weights: tuple[int, ...], most: int) -> DataFrame:
    """(_mx_source, _mx_source_size, _mx_target, _mx_rate) as a written table, one row per source."""
    totals = docs.select(F.col(source_col).alias("source"), n_words(F.col(text_col)).alias("size")).groupBy("source").agg(F.sum("size").alias("source_size"))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    return written(source_targets(totals, weights, most).select(
        F.col("source").alias("_mx_source"), F.col("source_size").alias("_mx_source_size"), F.col("target").alias("_mx_target"), rate.alias("_mx_rate")), "mix-rates")


def _copies(seed: str, key: Column) -> Column:
    whole = F.floor("_mx_rate")
    return (whole + (draw(seed, key) < F.col("_mx_rate") - whole).cast("int")).cast("int")


def mix(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    weights: tuple[int, ...] = WEIGHTS, most: int = 3, seed: str = "mix",
) -> DataFrame:
    """``docs`` with _mx_size, _mx_source_size, _mx_target, _mx_rate and _mx_copies."""
    plain = docs.drop(*[c for c in WORK if c in docs.columns])
    found = looked_up(plain.withColumn("_mx_size", n_words(F.col(text_col))), rates(docs, text_col, source_col, weights, most), {"_mx_source": F.col(source_col)})
    return found.withColumn("_mx_copies", _copies(seed, F.col(id_col)))


def emit(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    weights: tuple[int, ...] = WEIGHTS, most: int = 3, seed: str = "mix",
) -> DataFrame:
    """Each row of ``docs`` as often as the mix takes it; columns as they were."""
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    found = looked_up(whole, rates(docs, text_col, source_col, weights, most), {"_mx_source": F.col("row")[source_col]})
    return found.select("row", F.explode(F.array_repeat(F.lit(1), _copies(seed, F.col("row")[id_col])))).select("row.*")
