"""Shards of near equal bytes by histogram sort.

Documents are ordered by a hash of their text, then by a hash of their id, so equal texts stand together. Splitters between
shards are found by counting, not by sorting:

1. One pass over the texts writes a work table: what is carried along, size, and the two parts of the key.
2. Keys are drawn by hash from every interval that still holds an open splitter (a fixed number for each splitter); they become
   the next probes. Bytes and rows below each probe are counted exactly over all partitions: a partition adds up its own
   histogram, the histograms are summed in one grouping. An interval shrinks by the number of its probes with each pass, so
   a few passes do at any size; an interval with few rows is probed at each of its rows, so it always ends.
3. A probe is the start of a group of equal texts, so that groups stay whole. Only a group that itself is larger than the
   tolerance is probed inside, by the second part of the key: however many rows it has, it is dealt over several shards.
4. Shards are cut into ranges of about RANGE_BYTES by the same splitters (with a wider tolerance), and the rows are exchanged once, to
   their range. A row's slot is its rank in the range plus the rows counted below the range: no task holds a shard.

The driver holds splitters and probes, a bounded number for each range (at most MAX_RANGES), never rows.

Law: ``bytes``. A shard's bytes differ from the mean by at most twice the tolerance (a share of the mean), or by the size of
the documents at its two borders, as no document is cut. Groups of equal texts smaller than the tolerance are in one shard, unless
one of their borders is further from the splitter than the tolerance allows.

Defined results: a null text has the bytes of an empty one and stands with it; very long texts are sized, never moved unless carried
along; rows that repeat an id and a text are told apart by their place in the work table; an empty table gives an empty
result; other columns don't matter unless they are carried along, in a struct, so that no name clashes.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skyledger.sources.shared import written

SHARDS, TOLERANCE = 16, 0.01
#: Bytes of a range on average, ranges of a shard at least, ranges at most; a range's own tolerance.
RANGE_BYTES, LEAST_RANGES, MAX_RANGES, RANGE_TOLERANCE = 256 << 20, 8, 16_384, 0.2
#: Keys drawn for each open splitter in a pass.
DRAWN = 16
#: Rows a worker places before it adds them to its histogram.
HELD_ROWS = 1 << 18
#: Low bits of the key's second part that tell rows of one id apart.
ROW_BITS = 24
_LOW, _HIGH = np.iinfo(np.int64).min, np.iinfo(np.int64).max

Key = tuple[int, int]
FIRST: Key = (_LOW, _LOW)


def buckets(h: np.ndarray, t: np.ndarray, probes: list[Key]) -> np.ndarray:
    """How many of the sorted probes are at or below each key (h, t)."""
    heads = np.fromiter((p[0] for p in probes), np.int64, len(probes))
    tails = np.fromiter((p[1] for p in probes), np.int64, len(probes))
    low, high = np.searchsorted(heads, h, "left"), np.searchsorted(heads, h, "right")
    found, equal = low.copy(), np.flatnonzero(low < high)
    one = equal[high[equal] - low[equal] == 1]
    found[one] += tails[low[one]] <= t[one]
    several = equal[high[equal] - low[equal] > 1]
    for at in np.unique(low[several]):
        mine = several[low[several] == at]
        found[mine] += np.searchsorted(tails[at : high[mine[0]]], t[mine], "right")
    return found


def _mixed(h: np.ndarray, t: np.ndarray, seed: int) -> np.ndarray:
    x = (h.view(np.uint64) ^ (t.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15))) + np.uint64(seed * 0x632BE59BD9B4E019 % (1 << 64))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def drawn(keys: DataFrame, intervals: list[tuple[Key, Key, float]], seed: int) -> list[Key]:
    """Keys of rows inside the intervals (sorted, apart from one another), each drawn with its interval's chance."""
    bounds = [b for low, high, _ in intervals for b in (low, high)]
    limits = np.array([min(1.0, chance) * float(1 << 53) for *_, chance in intervals])

    def draw(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            h, t = batch["h"].to_numpy(np.int64), batch["t"].to_numpy(np.int64)
            at = buckets(h, t, bounds)
            inside = np.flatnonzero(at % 2)
            taken = inside[(_mixed(h[inside], t[inside], seed) >> np.uint64(11)).astype(np.float64) < limits[at[inside] // 2]]
            yield pd.DataFrame({"h": h[taken], "t": t[taken]})

    return [tuple(r) for r in keys.select("h", "t").mapInPandas(draw, "h long, t long").collect()]


def counted(keys: DataFrame, probes: list[Key]) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, rows) from each sorted probe up to the next, exactly, over all partitions."""
    n = len(probes) + 1

    def histogram(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        size, rows, held, n_held = np.zeros(n, np.int64), np.zeros(n, np.int64), [], 0

        def add() -> None:
            at, of = np.concatenate([x for x, _ in held]), np.concatenate([x for _, x in held])
            size[:] += np.bincount(at, weights=of, minlength=n).astype(np.int64)  # whole numbers below 2**53 are exact
            rows[:] += np.bincount(at, minlength=n)

        for batch in batches:
            held.append((buckets(batch["h"].to_numpy(np.int64), batch["t"].to_numpy(np.int64), probes), batch["size"].to_numpy(np.int64)))
            n_held += len(batch)
            if n_held > HELD_ROWS:
                add()
                held, n_held = [], 0
        if held:
            add()
        full = np.flatnonzero(rows)
        yield pd.DataFrame({"bucket": full, "bytes": size[full], "n": rows[full]})

    each = keys.select("h", "t", "size").mapInPandas(histogram, "bucket long, bytes long, n long")
    size, rows = np.zeros(n, np.int64), np.zeros(n, np.int64)
    for r in each.groupBy("bucket").agg(F.sum("bytes").alias("bytes"), F.sum("n").alias("n")).collect():
        size[r["bucket"]], rows[r["bucket"]] = r["bytes"], r["n"]
    return size, rows


class Splitters:
    """What is known of keys: bytes and rows below each counted probe."""

    def __init__(self, size: int, rows: int):
        self.keys, self.size, self.rows = [FIRST], {FIRST: 0}, {FIRST: 0}
        self.all_size, self.all_rows = size, rows

    def learn(self, key: Key, size: int, rows: int) -> None:
        if key not in self.size:
            self.keys.insert(bisect_left(self.keys, key), key)
            self.size[key], self.rows[key] = size, rows

    def bracket(self, target: float) -> tuple[Key, Key | None]:
        """The last probe with at most ``target`` bytes below it, and the next one (None: the end)."""
        i = bisect_right(self.keys, target, key=lambda k: self.size[k]) - 1
        return self.keys[i], self.keys[i + 1] if i + 1 < len(self.keys) else None

    def nearest(self, target: float, within: float) -> Key | None:
        """The probe next to the target, a group's start if one is near enough; None if none is within the tolerance."""
        at = bisect_left(self.keys, target - within, key=lambda k: self.size[k])
        near = []
        while at < len(self.keys) and self.size[self.keys[at]] <= target + within:
            near.append(self.keys[at])
            at += 1
        return min(near, key=lambda k: (k[1] != _LOW, abs(self.size[k] - target), k), default=None)


def splitters(keys: DataFrame, targets: list[tuple[float, float]], size: int, rows: int, drawn_each: int = DRAWN) -> list[tuple[Key, int, int]]:
    """(key, bytes below, rows below) for each (target bytes, tolerance), targets rising; keys: (h, t, size)."""
    known, found, seed = Splitters(size, rows), {}, 0
    while True:
        wanted: dict[tuple[Key, Key | None], int] = {}
        for i, (target, within) in enumerate(targets):
            if i in found:
                continue
            low, high = known.bracket(target)
            left = (known.rows[high] if high else rows) - known.rows[low]
            near = known.nearest(target, within)
            if near is None and (left <= 1 or high == (low[0], low[1] + 1)):  # nothing to part: the nearer of its two ends
                near = high if high and known.size[high] - target < target - known.size[low] else low
            if near is None:
                wanted[low, high] = wanted.get((low, high), 0) + 1
            else:
                found[i] = near
        if not wanted:
            return [(k, known.size[k], known.rows[k]) for k in (found[i] for i in range(len(targets)))]
        seed += 1
        intervals = [
            (low, high or (_HIGH, _HIGH), drawn_each * n / max(1, (known.rows[high] if high else rows) - known.rows[low]))
            for (low, high), n in sorted(wanted.items(), key=lambda x: x[0][0])
        ]
        probes = set()
        ends = [low for low, *_ in intervals]
        for h, t in drawn(keys, intervals, seed):
            low, high, _ = intervals[bisect_right(ends, (h, t)) - 1]
            inside = low[0] == h and (high[0] == h or high == (h + 1, _LOW))  # all of the interval is one group
            around = [(h, t), (h, t + 1)] if inside else [(h, _LOW), (h + 1, _LOW)]
            probes |= {k for k in around if max(k) <= _HIGH}
        bounds = {low for low, *_ in intervals} | {high for _, high, _ in intervals}
        probes = sorted(probes | bounds)
        each, n = counted(keys, probes)
        below, before, at = 0, 0, None
        for k, key in enumerate(probes):
            if key in known.size:
                at = (known.size[key], known.rows[key])
                below = before = 0
            elif at is not None and key != (_HIGH, _HIGH):
                known.learn(key, at[0] + below, at[1] + before)
            below, before = below + int(each[k + 1]), before + int(n[k + 1])


def shard(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: list[str] | None = None, shards: int = SHARDS,
    tolerance: float = TOLERANCE, range_bytes: int = RANGE_BYTES, drawn_each: int = DRAWN,
) -> DataFrame:
    """One row per document: row (a struct of the columns ``carry``, by default all), size, shard, slot."""
    text, low_bits = F.coalesce(F.col(f"`{text_col}`"), F.lit("")), (1 << ROW_BITS) - 1
    tie = F.xxhash64(F.col(f"`{id_col}`")).bitwiseAND(F.lit(~low_bits)).bitwiseOR(F.xxhash64(F.monotonically_increasing_id()).bitwiseAND(F.lit(low_bits)))
    table = written(docs.select(
        F.struct(*[F.col(f"`{c}`") for c in carry or docs.columns]).alias("row"), (F.octet_length(text) + 1).cast("long").alias("size"),
        F.xxhash64(text).alias("h"), tie.alias("t")), "sharding")
    all_ = table.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("size"), F.count(F.lit(1)).alias("rows")).first()
    each = max(LEAST_RANGES, min(MAX_RANGES // shards, -(-all_["size"] // (shards * range_bytes))))
    step = all_["size"] / (shards * each)
    targets = [(k * step, tolerance * step * each if k % each == 0 else RANGE_TOLERANCE * step) for k in range(1, shards * each)]
    found = [(FIRST, 0, 0), *(splitters(table, targets, all_["size"], all_["rows"], drawn_each) if all_["rows"] else [(FIRST, 0, 0)] * len(targets))]
    borders = [f[0] for f in found[each::each]]
    # Ranges may come out of order where tolerances overlap; a range never reaches over a shard's border.
    cuts = sorted({f[0]: f[2] for f in found}.items())
    keys = [k for k, _ in cuts]
    of_shard = np.array([bisect_right(borders, k) for k in keys])
    start = {s: min(n for (_, n), x in zip(cuts, of_shard, strict=True) if x == s) for s in set(of_shard.tolist())}
    before = np.array([n - start[s] for (_, n), s in zip(cuts, of_shard.tolist(), strict=True)])

    @F.pandas_udf("range int, shard int, before long")
    def placed(h: pd.Series, t: pd.Series) -> pd.DataFrame:
        at = buckets(h.to_numpy(np.int64), t.to_numpy(np.int64), keys) - 1
        return pd.DataFrame({"range": at.astype(np.int32), "shard": of_shard[at].astype(np.int32), "before": before[at]})

    rank = F.row_number().over(Window.partitionBy("p.range").orderBy("h", "t")) - 1
    return table.withColumn("p", placed("h", "t")).select("row", "size", F.col("p.shard").alias("shard"), (F.col("p.before") + rank).cast("long").alias("slot"))


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder per shard, its rows in files by slot."""
    sharded.select("row.*", F.col("shard").alias("shard_"), F.col("slot").alias("slot_")).sortWithinPartitions("shard_", "slot_").write.partitionBy("shard_").parquet(path)
