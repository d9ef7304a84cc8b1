"""SimHash near-duplicates, found through a vantage-point tree over the fingerprints.

Each text gets a 64-bit fingerprint from its word shingles. Equal fingerprints are one point. A
vantage-point tree, laid out on a bounded sample of fingerprints (only the shards' borders depend
on it, never a result), sends each point to one home shard, and to the shard across a border as
well where the triangle bound allows a partner there: with radius r and a ball of m bits around
vantage point v, a point at a distance from m+1 to m+r also goes inside. So any two points within r
bits meet in at least one shard. In a shard the same tree goes on in memory down to small blocks,
which are compared exactly. A shard reports a spanning forest, never all pairs of a group; links
across shards are joined by distributed connected components.

For whole pipelines (``keep_one``) the trees propose and whole shingle sets decide: only pairs of a Jaccard similarity of 0.8
or more are linked. One tree over all fingerprints proposes what lies within ``TREE_BITS``. Pairs of that similarity lie up to ``NEAR_BITS``
apart, where one tree over all would part nothing, so a tree for each first shingle that documents have in common finds those. What these leave
apart is proposed by rarest shingles (a prefix filter). With ``exact`` no such pair is missed: all documents are then proposed by
their rarest shingles, and neither fingerprints nor marks tell pairs in the last round.

Defined results: a null or wordless text has fingerprint zero and is linked like any other; a null
``doc_id`` takes part and is never the smallest id (a group of such rows only has a null id);
repeated rows are returned as often as they come; an empty table gives an empty result. Very long texts are hashed
whole, a block of shingles at a time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyledger.llm.batches import bounded
from skyledger.llm.components import components, lowest as _lowest
from skyledger.llm.exact_dedup import with_locator
from skyledger.sources.shared import those_in, those_not_in, written, written_alone

SEED = 42
#: Fingerprints the tree's borders are laid out on, and points a shard should hold.
SAMPLE, SHARD_POINTS, MOST_SHARDS = 16_384, 16_384, 2_048
#: Points up to which a block is compared point by point.
BLOCK = 192
CHUNK = 1 << 16


def shingle_hashes(text: str | None, words_per_shingle: int) -> np.ndarray:
    """XXH64 of every shingle; A-Z is lower-cased, words end at ASCII white space, fewer words are one shingle."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    line, digest = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) <= words_per_shingle:
        return np.array([digest(line, SEED)], np.uint64)
    size = np.fromiter(map(len, words), np.int64, len(words)) + 1
    end = np.cumsum(size) - 1
    begin, end = (end - size + 1)[: len(words) - words_per_shingle + 1].tolist(), end[words_per_shingle - 1 :].tolist()
    return np.fromiter((digest(line[i:j], SEED) for i, j in zip(begin, end, strict=True)), np.uint64, len(begin))


def fingerprint(hashes: np.ndarray) -> int:
    """Bits set in over half of the hashes."""
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), CHUNK):
        bits = np.unpackbits(hashes[at : at + CHUNK].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


_KEYS = np.random.default_rng(SEED).integers(1, 1 << 63, 64, dtype=np.uint64) | np.uint64(1)


def shared_keys(hashes: np.ndarray, keys: int) -> list[int]:
    """The shingle that comes first under each of ``keys`` orders, mixed with the order's number."""
    if not len(hashes):
        return [0] * keys
    return [int(np.int64(np.uint64((hashes * _KEYS[k]).min()).view(np.int64))) for k in range(keys)]


def fingerprints(docs: DataFrame, text_col: str = "text", words: int = 3) -> DataFrame:
    """``docs`` without its text, with ``_sh_`` (fp: the fingerprint as a signed long)."""
    others = [F.col(f"`{c}`") for c in docs.columns if c != text_col]

    @F.pandas_udf("fp long")
    def hashed(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame({"fp": [int(np.uint64(fingerprint(shingle_hashes(t, words))).view(np.int64)) for t in texts]}, dtype="int64")

    return bounded(docs).select(*others, hashed(F.col(text_col)).alias("_sh_"))


def bits_apart(points: np.ndarray, from_: np.uint64) -> np.ndarray:
    return np.bitwise_count(points ^ from_)


def _border(points: np.ndarray, radius: int) -> tuple[np.uint64, int] | None:
    """A vantage point and ball size that part the points with few on the border; None if nothing parts them."""
    best = None
    for v in points[np.linspace(0, len(points) - 1, min(8, len(points))).astype(int)]:
        count = np.bincount(bits_apart(points, v), minlength=65 + radius).cumsum()
        for m in range(64):
            inside, reach = count[m], count[m + radius]
            worst = max(reach, len(points) - inside)
            if 0 < inside < len(points) and (best is None or worst < best[0]):
                best = (worst, v, m)
    return None if best is None or best[0] > 0.9 * len(points) else (best[1], best[2])


def lay_out(sample: np.ndarray, shards: int, radius: int) -> list[tuple[int, int, int, int]]:
    """The tree as rows (vantage point, ball, row inside, row outside); a shard s is row -1 - s.

    The largest leaf is parted until there are enough, so that dense regions get more shards.
    """
    tree: list[list[int]] = []
    leaves = [(np.unique(sample), None, 0)]  # points, parent row, side
    done: list[tuple[int | None, int]] = []
    while leaves and len(leaves) + len(done) < shards:
        leaves.sort(key=lambda x: len(x[0]))
        points, parent, side = leaves.pop()
        border = _border(points, radius) if len(points) >= 8 else None
        if border is None:
            done.append((parent, side))
            continue
        v, m = border
        apart = bits_apart(points, v)
        tree.append([int(v), m, 0, 0])
        if parent is not None:
            tree[parent][side] = len(tree) - 1
        leaves += [(points[apart <= m], len(tree) - 1, 2), (points[apart > m], len(tree) - 1, 3)]
    for s, (parent, side) in enumerate([*done, *((p, k) for _, p, k in leaves)]):
        if parent is not None:
            tree[parent][side] = -1 - s
    return [tuple(x) for x in tree]


def shards_of(points: np.ndarray, tree: list[tuple[int, int, int, int]], radius: int) -> Iterator[tuple[int, np.ndarray]]:
    """(shard, indices of the points that belong or reach there)."""
    todo = [(0 if tree else -1, np.arange(len(points)))]
    while todo:
        row, at = todo.pop()
        if row < 0:
            yield -1 - row, at
            continue
        v, m, inside, outside = tree[row]
        apart = bits_apart(points[at], np.uint64(v))
        for child, belongs in ((inside, apart <= m + radius), (outside, apart > m)):
            if belongs.any():
                todo.append((child, at[belongs]))


def _midpoint_links(points: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links of points that no vantage point parts: two points within 2 bits share a value at most 1 bit from each.

    The values near each point are sorted in passes by value range, so the cost is linear in the points.
    """
    own, passes = points[at], max(1, len(at) * 65 >> 24)
    steps = [np.uint64(0), *(np.uint64(1) << np.uint64(i) for i in range(64))]
    a, b = [], []
    for p in range(passes):
        near, who = [], []
        for s in steps:
            x = own ^ s
            mine = np.flatnonzero((x * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(32)) % np.uint64(passes) == p)
            near.append(x[mine])
            who.append(at[mine])
        near, who = np.concatenate(near), np.concatenate(who)
        order = np.argsort(near, kind="stable")
        near, who = near[order], who[order]
        same = np.flatnonzero(near[1:] == near[:-1])
        label = _lowest(len(points), who[same], who[same + 1])
        moved = np.flatnonzero(label != np.arange(len(points)))
        a.append(moved)
        b.append(label[moved])
    return np.concatenate(a), np.concatenate(b)


def _peel(points: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that join points no vantage point parts: each point reached is compared with those not yet reached.

    A group whose points lie near one another is reached at once and costs little more than its size.
    """
    left, a, b = np.arange(len(points)), [], []
    while len(left):
        todo, left = [int(left[0])], left[1:]
        while todo and len(left):
            i = todo.pop()
            near = np.bitwise_count(points[left] ^ points[i]) <= radius
            a.append(np.full(int(near.sum()), i))
            b.append(left[near])
            todo += left[near].tolist()
            left = left[~near]
    return np.concatenate(a) if a else np.zeros(0, int), np.concatenate(b) if b else np.zeros(0, int)


def leaves(points: np.ndarray, radius: int, worth: float = 2.0) -> Iterator[np.ndarray]:
    """Indices of the points in each leaf of a vantage-point tree: any two points within ``radius`` meet in one.

    A leaf of more than ``BLOCK`` points is one that no vantage point parts, or that parting would leave with more than ``worth`` times
    the comparisons.
    """
    todo = [np.arange(len(points))]
    while todo:
        at = todo.pop()
        border = _border(points[at], radius) if len(at) > BLOCK else None
        if border is not None:
            v, m = border
            apart = bits_apart(points[at], v)
            inside, outside = at[apart <= m + radius], at[apart > m]
            if len(inside) ** 2 + len(outside) ** 2 <= worth * len(at) ** 2:
                todo += [inside, outside]
                continue
        yield at


def links(points: np.ndarray, radius: int) -> np.ndarray:
    """Labels (lowest index) of distinct points linked at ``radius`` bits or fewer, by a vantage-point tree."""
    a, b = [], []
    for at in leaves(points, radius):
        own = points[at]
        if len(at) <= BLOCK:
            i, j = np.nonzero(np.bitwise_count(own[:, None] ^ own[None, :]) <= radius)
            up = i < j
            a.append(at[i[up]])
            b.append(at[j[up]])
        elif radius == 2:
            x, y = _midpoint_links(points, at)
            a.append(x)
            b.append(y)
        else:
            x, y = _peel(own, radius)
            a.append(at[x])
            b.append(at[y])
    return _lowest(len(points), np.concatenate(a) if a else np.arange(0), np.concatenate(b) if b else np.arange(0))


def linked_points(points: DataFrame, radius: int, sample: int = SAMPLE, shard_points: int = SHARD_POINTS) -> DataFrame:
    """Distinct fp to edges (a, b) that join exactly the points linked at ``radius`` bits."""
    spark = points.sparkSession
    n = points.count()
    picked = points.orderBy(F.xxhash64("fp"), "fp").limit(sample).select("fp").toPandas()["fp"].to_numpy(np.int64)
    tree = lay_out(picked.view(np.uint64), max(6, min(MOST_SHARDS, -(-n // shard_points))), radius)
    shared_tree = spark.sparkContext.broadcast(tree)  # at most MOST_SHARDS rows

    def dealt(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            fp = batch["fp"].to_numpy(np.int64)
            for shard, at in shards_of(fp.view(np.uint64), shared_tree.value, radius):
                yield pd.DataFrame({"shard": np.int32(shard), "fp": fp[at]})

    def joined(shard: pd.DataFrame) -> pd.DataFrame:
        fp = np.unique(shard["fp"].to_numpy(np.int64).view(np.uint64))
        label = links(fp, radius)
        moved = np.flatnonzero(label != np.arange(len(fp)))
        return pd.DataFrame({"a": fp[moved].view(np.int64), "b": fp[label[moved]].view(np.int64)})

    return points.select("fp").mapInPandas(dealt, "shard int, fp long").groupBy("shard").applyInPandas(joined, "a long, b long")


def grouped(docs: DataFrame, text_col: str = "text", words: int = 3, radius: int = 2) -> DataFrame:
    """``docs`` without its text, with ``_sh_fp`` and ``_sh_group`` (equal for all documents that links reach)."""
    hashed = written(fingerprints(docs, text_col, words), "simhash")
    points = written(hashed.select(F.col("_sh_.fp").alias("fp")).distinct(), "simhash-points")
    member = components(linked_points(points, radius))
    group = written(points.join(member, points["fp"] == member["node"], "left").select(
        F.col("fp").alias("_sh_point"), F.coalesce("component", "fp").alias("_sh_group")), "simhash-groups")
    others = [F.col(f"`{c}`") for c in docs.columns if c != text_col]
    return hashed.join(group, F.col("_sh_.fp") == F.col("_sh_point")).select(*others, F.col("_sh_.fp").alias("_sh_fp"), "_sh_group")


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3, radius: int = 2
) -> DataFrame:
    """(id, fp, component_id): one row per input row; component_id is the smallest id reachable by links."""
    placed = written(grouped(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), "text", words, radius), "simhash-placed")
    least = placed.groupBy("_sh_group").agg(F.min("id").alias("component_id"))
    return placed.join(written(least, "simhash-least"), "_sh_group").select("id", F.col("_sh_fp").alias("fp"), "component_id")


#: For whole pipelines: five-word shingles, a Jaccard similarity of 0.8, one of eight first shingles in common.
WORDS, SIMILARITY, KEYS = 5, 0.8, 8
#: Bits by which fingerprints of proposed pairs differ at most; four-bit marks of first shingles (under so many orders) by
#: which pairs are told, and how many must be equal. At a similarity of 0.8 these miss a pair with chances of about 5 and
#: 2 in 10,000; of pairs at 0.65 about 2 in 100 are proposed.
NEAR_BITS, MARKS, AGREE = 20, 256, 186
#: Bits within which the tree over all fingerprints proposes pairs.
TREE_BITS = 2
#: A cell's tree goes on only where that saves a tenth of the comparisons.
WORTH = 0.9
#: Rounds in which each point is held against its likeliest partner only, before the remaining pairs are proposed by their rarest shingles.
ROUNDS = 2
#: Points that a task compares with one another; rows of such cells in a shard.
BOUND, SHARD_ROWS = 1_024, 1 << 14
#: Bands by which the points of a key are parted when too many have it, in each of two steps, and first shingles to a band.
#: A pair of similarity 0.8 has none of 16 bands in common with a chance of (1 - 0.8**4)**16, about 2 in 10,000 a step;
#: documents that share a passage only, at a similarity of 0.4, have a given band in common with a chance of 0.026.
BANDS, IN_BAND = 16, 4
_MARK_KEYS = np.random.default_rng(SEED + 1).integers(1, 1 << 63, MARKS, dtype=np.uint64) | np.uint64(1)


def marks_and_bands(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Four bits of the first shingle under each of ``MARKS`` orders, 16 to a number, and the hashes of both steps' bands."""
    first = np.full(MARKS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(hashes), 1024):
        np.minimum(first, (hashes[at : at + 1024, None] * _MARK_KEYS).min(axis=0), out=first)
    nibbles = (first >> np.uint64(20) & np.uint64(15)).reshape(-1, 16) << np.arange(0, 64, 4, dtype=np.uint64)
    bands = (first[: 2 * BANDS * IN_BAND].reshape(2 * BANDS, IN_BAND) * _MARK_KEYS[:IN_BAND]).sum(axis=1, dtype=np.uint64)
    return np.bitwise_or.reduce(nibbles, axis=1).view(np.int64), (bands >> np.uint64(32)).astype(np.uint32).view(np.int32)


def marks_equal(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """How many four-bit marks of each row of ``x`` and ``y`` are equal."""
    z = (x ^ y).view(np.uint64)
    z |= z >> np.uint64(1)
    z |= z >> np.uint64(2)
    return MARKS - np.bitwise_count(z & np.uint64(0x1111111111111111)).sum(axis=1, dtype=np.int64)


def shingle_sets(docs: DataFrame, words: int) -> DataFrame:
    """(id, text, file, row) to (id, file, row, _sh_): the hash of the set of shingles, its size, fingerprint, first shingles, bands and marks."""

    @F.pandas_udf("point long, size long, fp long, keys array<long>, bands array<int>, marks array<long>")
    def hashed(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for text in texts:
            found = np.unique(shingle_hashes(text, words))
            mark, bands = marks_and_bands(found)
            rows.append((
                xxhash.xxh3_64_intdigest(found.tobytes()) - (1 << 63), len(found), int(np.uint64(fingerprint(found)).view(np.int64)),
                np.array(shared_keys(found, KEYS), np.int64), bands, mark,
            ))
        return pd.DataFrame(rows, columns=["point", "size", "fp", "keys", "bands", "marks"])

    return bounded(docs).select("id", "file", "row", hashed("text").alias("_sh_"))


def verified(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) whose shingle sets have a Jaccard similarity of ``similarity`` or more."""

    @F.pandas_udf("boolean")
    def near(x: pd.Series, y: pd.Series) -> pd.Series:
        out = []
        for s, t in zip(x, y, strict=True):
            s, t = np.frombuffer(s, np.uint64), np.frombuffer(t, np.uint64)
            common = len(np.intersect1d(s, t, assume_unique=True))
            out.append(common + 1e-9 >= similarity * (len(s) + len(t) - common))
        return pd.Series(out, dtype=bool)

    return (
        bounded(pairs).join(sets.select(F.col("point").alias("a"), F.col("shingles").alias("x")), "a")
        .join(sets.select(F.col("point").alias("b"), F.col("shingles").alias("y")), "b").where(near("x", "y")).select("a", "b")
    )


def with_part(keyed: DataFrame, member: DataFrame) -> DataFrame:
    """``keyed`` with ``part``: the component of each point under the links found so far, ``member`` (node, component)."""
    return keyed.drop("part").join(member.select(F.col("node").alias("point"), "component"), "point", "left").withColumn(
        "part", F.coalesce("component", "point")).drop("component")


def tree_pairs(points: DataFrame, radius: int, similarity: float) -> DataFrame:
    """Pairs (a, b) of points that the tree over all fingerprints links at ``radius`` bits; of equal fingerprints, each point with one of them."""
    one = written(points.groupBy("fp").agg(F.min(F.struct("point", "size")).alias("one")), "near-fingerprints")
    edges = written(linked_points(one.select("fp"), radius), "near-tree")
    x, y = (one.select(F.col("fp").alias(side), F.col("one").alias(f"{side}_one")) for side in "ab")
    apart = edges.join(x, "a").join(y, "b").select(F.col("a_one").alias("p"), F.col("b_one").alias("q"))
    equal = points.join(one, "fp").where("point <> one.point").select(F.struct("point", "size").alias("p"), F.col("one").alias("q"))
    return apart.unionByName(equal).where(F.least("p.size", "q.size") + 1e-9 >= similarity * F.greatest("p.size", "q.size")).select(
        F.greatest("p.point", "q.point").alias("a"), F.least("p.point", "q.point").alias("b")).distinct()


def star_pairs(keyed: DataFrame, turn: int, similarity: float) -> DataFrame:
    """Pairs (a, b) of one point of each key with every other that may be near it and isn't linked to it yet; a pair may come by several keys."""
    apart = lambda z: F.bit_count((z.bitwiseOR(F.shiftright(z, 1)).bitwiseOR(F.shiftright(z, 2)).bitwiseOR(F.shiftright(z, 3))).bitwiseAND(F.lit(0x1111111111111111)))
    unequal = F.aggregate(F.zip_with("marks", "one.marks", lambda x, y: apart(x.bitwiseXOR(y))), F.lit(0), lambda n, k: n + k)
    one = keyed.groupBy("key").agg(
        F.min_by(F.struct("point", "size", "fp", "marks", "part", "rank"), F.xxhash64("point", F.lit(turn))).alias("one"),
        (F.min("part") < F.max("part")).alias("open"))
    return keyed.join(one.where("open"), "key").where(
        (F.col("part") != F.col("one.part")) & (F.bit_count(F.col("fp").bitwiseXOR(F.col("one.fp"))) <= NEAR_BITS)
        & (F.least("size", "one.size") + 1e-9 >= similarity * F.greatest("size", "one.size")) & (unequal <= MARKS - AGREE)
    ).select(F.greatest("point", "one.point").alias("a"), F.least("point", "one.point").alias("b"))


def rarest_shingles(docs: DataFrame, points: DataFrame, words: int, similarity: float) -> DataFrame:
    """(point, key, rank): the shingles that two sets of ``similarity`` must have one of in common, of those that more than one set holds.

    Sets of sizes m and n that similar share at least ``similarity`` x m shingles. So if each set is put in one order, the rarest
    first, a shared one is among the first m - ceil(similarity x m) + 1 of either. How many sets hold a shingle is counted over all of them.
    ``rank`` is a shingle's place in its set, from 1.
    """

    def listed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for point, text in zip(batch["point"], batch["text"], strict=True):
                found = np.unique(shingle_hashes(text, words))
                for at in range(0, len(found), CHUNK):
                    yield pd.DataFrame({"point": point, "size": len(found), "shingle": found[at : at + CHUNK].view(np.int64)})

    # One document stands for its set.
    places = written(points.select("point", F.col("at.file").alias("_f"), F.col("at.row").alias("_r")), "near-places")
    one = those_in(docs, places, {"_f": F.col("file"), "_r": F.col("row")}).select("point", "text")
    held = written(bounded(one).mapInPandas(listed, "point long, size long, shingle long"), "near-shingles")
    several = written(held.groupBy("shingle").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(F.col("shingle").alias("common"), "n"), "near-common")
    # A set's own shingles come before those that several hold, so places are counted from the end and own ones need not be moved.
    last = F.row_number().over(Window.partitionBy("point").orderBy(F.desc("n"), F.desc("shingle")))
    ranked = those_in(held, several, {"common": F.col("shingle")}).withColumn("rank", (F.col("size") - last + 1).cast("int"))
    return ranked.where(F.col("size") - F.col("rank") + 1 >= F.ceil(similarity * F.col("size") - 1e-6)).select("point", F.col("shingle").alias("key"), "rank")


def cells(keyed: DataFrame, points: DataFrame, bound: int, exact: bool = False) -> DataFrame:
    """``keyed`` dealt to cells of about ``bound`` points a side, so that all points of a key in different parts meet.

    A key's largest part ('most') is only compared with the rest: a large group of copies that is linked already costs
    as much as it has rows. Keys of which more than ``bound`` points lie outside the largest part are parted by
    bands of several first shingles, in two steps; what is still larger is dealt block by block, so that every pair meets and no task holds more than two blocks.
    With ``exact`` bands, which can miss a pair, aren't used: large keys are dealt block by block at once.
    """
    dealt, todo = [], keyed
    for step in range(3):
        of = todo.groupBy("key", "part").agg(F.count(F.lit(1)).alias("n")).groupBy("key").agg(
            F.sum("n").alias("n"), F.max(F.struct("n", "part")).alias("most"))
        of = of.where("n > most.n").select("key", F.col("most.part").alias("most"), F.col("most.n").alias("n_most"), (F.col("n") - F.col("most.n")).alias("rest"))
        todo = written(todo.join(of, "key"), "near-keys")
        large = (F.col("rest") > bound) if step < 2 and not exact else F.lit(False)
        here = todo.where(~large)
        blocks = lambda n: F.ceil(F.col(n) / bound).cast("int")
        block = lambda n: F.pmod(F.xxhash64("point"), blocks(n)).cast("int")
        cell = lambda i, j, kind: F.struct(i.cast("int").alias("i"), j.cast("int").alias("j"), F.lit(kind).alias("kind"))
        upto = lambda n: F.sequence(F.lit(0), blocks(n) - 1)
        small = F.col("rest") + F.col("n_most") <= bound
        zero = F.lit(0)
        rest = F.concat(
            F.transform(upto("n_most"), lambda j: cell(block("rest"), j, "most")),
            F.transform(F.filter(upto("rest"), lambda j: j != block("rest")), lambda j: cell(F.least(j, block("rest")), F.greatest(j, block("rest")), "rest")))
        most = F.transform(upto("rest"), lambda i: cell(i, block("n_most"), "most"))
        dealt.append(here.withColumn("cell", F.explode(
            F.when(small, F.array(cell(zero, zero, "most"))).when(F.col("part") == F.col("most"), most).otherwise(rest))
        ).select(F.xxhash64(F.lit(step), "key", "cell").alias("cell"), "point", "size", "fp", "marks", "part", "rank"))
        if step == 2 or exact:
            break
        todo = todo.where(large).select("key", "point", "size", "fp", "marks", "part", "rank")
        if todo.isEmpty():
            break
        todo = todo.join(points.select("point", "bands"), "point").select(
            "*", F.posexplode(F.slice("bands", step * BANDS + 1, BANDS)).alias("order", "band")
        ).select(F.xxhash64("key", "order", "band").alias("key"), "point", "size", "fp", "marks", "part", "rank")
    out = dealt[0]
    for more in dealt[1:]:
        out = out.unionByName(more)
    return out


def cell_pairs(dealt: DataFrame, similarity: float, keep: str, shard_rows: int = SHARD_ROWS, exact: bool = False) -> DataFrame:
    """Pairs (a, b) of points in one cell and different parts that may be near, found by a vantage-point tree over the cell's fingerprints.

    ``keep`` is "all", "likeliest" (each point's only) or "points": (point, part) of those in such a pair, at a row a point and cell.
    Where ``rank`` isn't 0, a pair needs the cell's shingle early enough in both sets to be the first that they share.
    With ``exact`` nothing but sizes and ranks rules a pair out.
    """
    bits, agree = (64, 0) if exact else (NEAR_BITS, AGREE)
    shards = max(6, -(-dealt.count() // shard_rows))

    def compared(shard: pd.DataFrame) -> pd.DataFrame:
        shard = shard.sort_values(["cell", "point"], ignore_index=True)
        cell, point, part, rank = (shard[c].to_numpy(np.int64) for c in ("cell", "point", "part", "rank"))
        fp, size = shard["fp"].to_numpy(np.int64).view(np.uint64), shard["size"].to_numpy(float)
        mark = np.array(shard["marks"].tolist(), np.int64).reshape(len(shard), MARKS // 16)
        begin = np.append(0, np.flatnonzero(cell[1:] != cell[:-1]) + 1)
        a, b, open_ = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], np.zeros(len(shard), bool)
        for i, j in zip(begin.tolist(), [*begin[1:].tolist(), len(cell)], strict=True):
            top, partner = np.zeros(j - i, np.int64), np.full(j - i, -1)  # of each point of the cell
            for p, q, equal in _may_be_near(i, j, fp, size, part, rank, mark, bits, agree, similarity):
                if keep == "all":
                    a.append(np.maximum(point[p], point[q]))
                    b.append(np.minimum(point[p], point[q]))
                    continue
                if keep == "points":
                    open_[p] = open_[q] = True
                    continue
                p, q, equal = np.append(p, q), np.append(q, p), np.append(equal, equal)
                order = np.lexsort((q, -equal, p))
                p, q, equal = p[order], q[order], equal[order]
                first = np.append(True, p[1:] != p[:-1])[: len(p)]
                p, q, equal = p[first], q[first], equal[first]
                better = equal > top[p - i]
                top[p[better] - i], partner[p[better] - i] = equal[better], q[better]
            p = np.flatnonzero(partner >= 0)
            a.append(np.maximum(point[p + i], point[partner[p]]))
            b.append(np.minimum(point[p + i], point[partner[p]]))
        if keep == "points":
            return shard.loc[open_, ["point", "part"]].drop_duplicates()
        return pd.DataFrame({"a": np.concatenate(a), "b": np.concatenate(b)}).drop_duplicates()

    out = "point long, part long" if keep == "points" else "a long, b long"
    return dealt.groupBy(F.pmod(F.xxhash64("cell"), F.lit(shards)).alias("shard")).applyInPandas(compared, out).distinct()


def _may_be_near(
    i: int, j: int, fp: np.ndarray, size: np.ndarray, part: np.ndarray, rank: np.ndarray, mark: np.ndarray, bits: int, agree: int, similarity: float
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Of the rows i to j, those that may be near: (rows, rows, equal marks), a bounded number at a time; a pair may come more than once."""
    for leaf in leaves(fp[i:j], bits, WORTH):
        leaf = leaf + i
        for at in range(0, len(leaf), 256):
            own, other = leaf[at : at + 256], leaf[at:]
            x, y = np.nonzero(
                (np.bitwise_count(fp[own, None] ^ fp[None, other]) <= bits) & (part[own, None] != part[None, other])
                & (np.minimum(size[own, None], size[None, other]) + 1e-9 >= similarity * np.maximum(size[own, None], size[None, other])))
            x, y = own[x[x < y]], other[y[x < y]]
            common = np.ceil(similarity / (1 + similarity) * (size[x] + size[y]) - 1e-6)  # shingles that a near pair shares at least
            early = (rank[x] <= size[x] - common + 1) & (rank[y] <= size[y] - common + 1)
            x, y = x[early], y[early]
            for k in range(0, len(x), CHUNK):
                p, q = x[k : k + CHUNK], y[k : k + CHUNK]
                equal = marks_equal(mark[p], mark[q])
                yield p[equal >= agree], q[equal >= agree], equal[equal >= agree]


def near_groups(docs: DataFrame, words: int = WORDS, similarity: float = SIMILARITY, bound: int = BOUND, exact: bool = False) -> DataFrame:
    """(id, text, file, row) to (id, file, row, _sh_group): equal for all documents that links of ``similarity`` reach.

    The tree over all fingerprints proposes what it links, and two turns link one point of each key to those near it, so that large
    groups of copies are one part. Then all points of a key in different parts are compared by a tree over their fingerprints: a few rounds hold
    each against its likeliest partner, which joins families of near copies at a cost of a pair a point. Points that still may be near one in
    another part are listed, not their pairs, and are proposed by their rarest shingles among themselves: a text with too many words of its own to be
    near any other is in no pair, however large its family. Every link has been verified.
    ``exact`` misses no link, at the cost of counting every shingle and of verifying more pairs.
    """
    hashed = written(shingle_sets(docs, words), "near-docs")
    points = hashed.groupBy("_sh_.point").agg(F.first("_sh_").alias("p"), F.min(F.struct("file", "row")).alias("at"))
    points = written(points.select("p.*", "at"), "near-points")
    if exact:
        keyed = written_alone(docs.sparkSession, lambda: rarest_shingles(docs, points, words, similarity), "near-rarest")
    else:
        keyed = points.select("point", F.posexplode("keys").alias("order", "first")).select("point", F.xxhash64("order", "first").alias("key"), F.lit(0).alias("rank"))
    # Most keys are of one point only: marks are moved once these are gone.
    several = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key")
    keyed = written(keyed.join(several, "key").join(points.select("point", "size", "fp", "marks"), "point").select(
        "key", "point", "size", "fp", "marks", F.col("point").alias("part"), "rank"), "near-keyed")

    def sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"point": batch["point"], "shingles": [np.unique(shingle_hashes(t, words)).tobytes() for t in batch["text"]]})

    def checked(proposed: DataFrame) -> DataFrame:
        """The proposed pairs that hold. Only the texts of documents in some proposed pair are read again."""
        return written_alone(docs.sparkSession, lambda: held(written(proposed, "near-pairs")), "near-links")

    def held(pairs: DataFrame) -> DataFrame:
        these = pairs.select(F.col("a").alias("point")).unionByName(pairs.select(F.col("b").alias("point"))).distinct()
        wanted = written(points.join(these, "point", "left_semi").select("point", F.col("at.file").alias("_f"), F.col("at.row").alias("_r")), "near-wanted")
        found = those_in(docs, wanted, {"_f": F.col("file"), "_r": F.col("row")}).select("point", "text")
        found = written(bounded(found).mapInPandas(sets, "point long, shingles binary"), "near-sets")
        return verified(pairs, found, similarity)

    def joined(member: DataFrame | None, more: DataFrame) -> DataFrame:
        """(node, component) under all links so far: the new ones join the components that the earlier ones made."""
        edges = more if member is None else more.unionByName(member.select(F.col("node").alias("a"), F.col("component").alias("b")))
        return written_alone(docs.sparkSession, lambda: components(edges), "near-parts")

    member = None
    for turn in range(2):
        proposed = star_pairs(keyed, turn, similarity)
        if turn == 0:
            proposed = proposed.unionByName(tree_pairs(points, TREE_BITS, similarity))
        member = joined(member, checked(proposed.distinct()))
        keyed = written(with_part(keyed, member), "near-keyed")
    dealt = written(cells(keyed, points, bound, exact), "near-cells")
    for _ in range(ROUNDS):
        more = checked(cell_pairs(dealt, similarity, "likeliest"))
        if more.isEmpty():
            break
        member = joined(member, more)
        # Cells in one part have nothing left to compare.
        dealt = with_part(dealt, member)
        mixed = dealt.groupBy("cell").agg((F.min("part") < F.max("part")).alias("open")).where("open").select("cell")
        dealt = written(dealt.join(mixed, "cell", "left_semi"), "near-cells")
    if not exact:
        left = written(cell_pairs(dealt, similarity, "points"), "near-left")
        these = written(points.join(left, "point").select("point", "size", "fp", "marks", "part", "at"), "near-left-points")
        rare = written_alone(docs.sparkSession, lambda: rarest_shingles(docs, these, words, similarity), "near-rarest")
        dealt = written(cells(these.drop("at").join(rare, "point"), points, bound, exact=True), "near-cells")
    member = joined(member, checked(cell_pairs(dealt, similarity, "all", exact=exact)))
    return hashed.join(member, F.col("_sh_.point") == F.col("node"), "left").select("id", "file", "row", F.coalesce("component", "_sh_.point").alias("_sh_group"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, similarity: float = SIMILARITY, bound: int = BOUND, exact: bool = False) -> DataFrame:
    """``docs`` with one row of each group (the smallest id, then the first by place); columns as they were."""
    placed = with_locator(docs)
    texts = placed.select(F.col("row")[id_col].alias("id"), F.col("row")[text_col].alias("text"), F.col("_dd_file").alias("file"), F.col("_dd_row").alias("row"))
    group = written_alone(docs.sparkSession, lambda: near_groups(texts, words, similarity, bound, exact), "simhash-placed")
    first = group.groupBy("_sh_group").agg(F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "file", "row")).alias("stays"), F.count(F.lit(1)).alias("n"))
    several = written(first.where("n > 1").select("_sh_group", F.col("stays.file").alias("_f"), F.col("stays.row").alias("_r")), "simhash-several")
    dropped = written(
        group.join(several, "_sh_group").where("not (file = _f and row = _r)").select(F.col("file").alias("_dd_f"), F.col("row").alias("_dd_r")), "simhash-dropped")
    return those_not_in(placed, dropped, {"_dd_f": F.col("_dd_file"), "_dd_r": F.col("_dd_row")}).select("row.*")


def as_hex(fp: str = "fp") -> Column:
    """A fingerprint as 16 lower-case hex digits."""
    return F.lower(F.lpad(F.hex(F.col(fp)), 16, "0"))
