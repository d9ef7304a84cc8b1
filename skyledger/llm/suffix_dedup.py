"""Removal of long byte strings that come more than once, by hash-compared suffix sorting.

A string of ``length`` bytes is known by its anchor: the first of its ``gram``-byte pieces with the
least hash. Equal strings have equal anchors at equal places, so it is enough to bring together the
anchors (about one in 90 bytes) instead of all suffixes. Each anchor stands for the strings it is the
anchor of, which make up its context, at most twice ``length`` bytes.

1. Texts are read once: compressed texts, anchors, hashes of anchors and contexts go to a work table.
2. Anchors whose hash comes once are done with. Of the others each different context has a
   representative, which stands for its copies, so that copies are settled once however many there are.
3. One pass over the texts cuts out the representatives' contexts, and of every copy the bytes that must
   equal the representative's: the part between two anchors, and the tail where a run of copied
   contexts ends. Grouped by their place in the representative, least and greatest must be the same bytes.
   If any differ, two contexts had one hash, and all is done again with another hash: no string is ever
   removed on a hash alone.
4. Contexts are dealt to shards by anchor. In a shard the suffixes at the starts of runs of strings that
   may repeat are merge-sorted; two suffixes are compared at their first difference, which a binary search
   over prefix polynomial hashes finds; the longest common extension with a neighbour settles the strings it
   covers, once its bytes have been compared.
   An anchor with more than ``hot`` different contexts is parted first: the strings that start at most STEP
   bytes apart have ``length`` - STEP + 1 bytes in common, and those with the same common bytes are a shard's
   group of their own. What is still larger is grouped string by string, by the bytes themselves. So no task
   holds more than about two groups of ``hot`` contexts, and no match is lost.
5. The strings found go back to their documents by key, and what they cover is cut out.

Defined results: a null text is empty; texts shorter than ``length`` keep everything; repeated rows
are documents of their own (so both lose what they share); an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import count

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.llm.batches import bounded
from skyledger.sources.shared import scratch, shared_dir, written

LENGTH, GRAM = 200, 24
#: Bytes of a text that are searched for anchors at a time; contexts in a shard on average.
CHUNK, SHARD_CONTEXTS = 1 << 20, 4096
#: Different contexts up to which an anchor is settled whole; starts of strings that are settled together beyond.
HOT, STEP = 4096, 8
#: Bits of the contexts' hashes; bytes that a worker holds before it hands rows on.
BITS, HELD = 64, 1 << 21
_BASE = np.uint64(0x9E3779B97F4A7C15 | 5)
_PLACE = np.uint64(CHUNK * 2 - 1)


def gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """A mixed 64-bit hash of the ``gram`` bytes from each place on, by doubling."""
    hashes, width, total, done, power = data.astype(np.uint64) + np.uint64(1), 1, None, 0, _BASE
    while True:
        if gram & width:
            if total is None:
                total, done = hashes, width
            else:
                n = len(data) - done - width + 1
                total, done = total[:n] * power + hashes[done : done + n], done + width
        if width * 2 > gram:
            break
        n = len(data) - 2 * width + 1
        hashes, width, power = hashes[:n] * power + hashes[width : width + n], 2 * width, power * power
    mixed = total ^ (total >> np.uint64(31))
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    return mixed ^ (mixed >> np.uint64(29))


def anchors(data: bytes, length: int = LENGTH, gram: int = GRAM) -> list[tuple[np.ndarray, ...]]:
    """(anchor, first start, last start, hash) of the runs of strings with one anchor, by chunk."""
    found, whole, span = [], np.frombuffer(data, np.uint8), length - gram + 1
    for at in range(0, len(data) - length + 1, CHUNK):
        part = whole[at : at + CHUNK + length - 1]
        hashes = gram_hashes(part, gram)
        keys = (hashes & ~_PLACE) | np.arange(len(hashes), dtype=np.uint64)
        blocks = np.full(-(-len(keys) // span) * span, np.iinfo(np.uint64).max, np.uint64)
        blocks[: len(keys)] = keys
        blocks = blocks.reshape(-1, span)
        upto = np.minimum.accumulate(blocks, axis=1).ravel()
        since = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
        n = len(keys) - span + 1
        place = (np.minimum(since[:n], upto[span - 1 : span - 1 + n]) & _PLACE).astype(np.int64)
        first = np.append(0, np.flatnonzero(place[1:] != place[:-1]) + 1)
        last = np.append(first[1:], n) - 1
        found.append((place[first] + at, first + at, last + at, hashes[place[first]]))
    return found


class Suffixes:
    """Suffixes of joined contexts, compared by prefix polynomial hashes (modulo 2**64)."""

    def __init__(self, data: np.ndarray, end: np.ndarray):
        self.data, self.end = data, end  # end: where the context of a place ends
        powers = np.full(len(data) + 1, _BASE, np.uint64)
        powers[0] = 1
        self.shift = np.cumprod(powers, dtype=np.uint64)
        inverse = np.full(len(data) + 1, np.uint64(pow(int(_BASE), -1, 1 << 64)), np.uint64)
        inverse[0] = 1
        self.unshift = np.cumprod(inverse, dtype=np.uint64)
        self.prefix = np.append(np.uint64(0), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self.shift[:-1], dtype=np.uint64))

    def hash(self, at: np.ndarray, length: np.ndarray | int) -> np.ndarray:
        return (self.prefix[at + length] - self.prefix[at]) * self.unshift[at]

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Length of the common extension of suffixes, within their contexts, by binary search."""
        low, high = np.zeros(len(a), np.int64), np.minimum(self.end[a] - a, self.end[b] - b)
        while (open_ := low < high).any():
            mid = (low + high + 1) // 2
            same = self.hash(a, mid) == self.hash(b, mid)
            low, high = np.where(open_ & same, mid, low), np.where(open_ & ~same, mid - 1, high)
        return low

    def less(self, a: np.ndarray, b: np.ndarray, group: np.ndarray) -> np.ndarray:
        """Whether suffix a sorts before b: by group, then by bytes, a prefix first, then by place."""
        at = self.common(a, b)
        over_a, over_b = a + at >= self.end[a], b + at >= self.end[b]
        byte = self.data[np.minimum(a + at, len(self.data) - 1)] < self.data[np.minimum(b + at, len(self.data) - 1)]
        inside = np.where(over_a | over_b, np.where(over_a & over_b, a < b, over_a), byte)
        return np.where(group[a] != group[b], group[a] < group[b], inside)

    def sort(self, at: np.ndarray, group: np.ndarray) -> np.ndarray:
        """Merge sort of suffixes, all merges of a level at once; each item finds its rank in the other run."""
        at, width, n = at.copy(), 1, len(at)
        while width < n:
            own = np.arange(n)
            pair, left = own // (2 * width) * (2 * width), own % (2 * width) < width
            begin = np.where(left, np.minimum(pair + width, n), pair)
            stop = np.where(left, np.minimum(pair + 2 * width, n), np.minimum(pair + width, n))
            low, high = begin.copy(), stop.copy()
            while len(open_ := np.flatnonzero(low < high)):
                mid = (low[open_] + high[open_]) // 2
                before = self.less(at[mid], at[open_], group)
                low[open_], high[open_] = np.where(before, mid + 1, low[open_]), np.where(before, high[open_], mid)
            merged = np.empty_like(at)
            merged[np.where(left, own, own - width) + (low - begin)] = at
            at, width = merged, 2 * width
        return at


def _same_bytes(data: np.ndarray, a: np.ndarray, b: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Whether data[a:a+length] equals data[b:b+length], for each."""
    if not len(a):
        return np.zeros(0, bool)
    step = np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length)
    equal = data[np.repeat(a, length) + step] == data[np.repeat(b, length) + step]
    return np.logical_and.reduceat(equal, np.cumsum(length) - length) | (length == 0)


def repeated_strings(contexts: list[bytes], anchor: np.ndarray, key: np.ndarray, count: np.ndarray, length: int = LENGTH) -> np.ndarray:
    """For joined contexts, whether the string of ``length`` from each place on comes in another context too.

    anchor: place of the anchor in each context; key: its hash; count: how often the context comes.
    """
    size = np.fromiter(map(len, contexts), np.int64, len(contexts))
    begin = np.cumsum(size) - size
    data = np.frombuffer(b"".join(contexts), np.uint8)
    row = np.repeat(np.arange(len(contexts)), size)
    suffixes = Suffixes(data, (begin + size)[row])
    starts = np.flatnonzero(np.arange(len(data)) + length <= suffixes.end)
    found = np.zeros(len(data), bool)
    found[starts] = count[row[starts]] > 1
    # Strings can only be equal under one anchor and at one distance from it.
    group = np.zeros(len(data), np.uint64)
    offset = starts - begin[row[starts]] - anchor[row[starts]] + CHUNK
    group[starts] = (key[row[starts]] ^ (offset.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))) * _BASE
    hashed = suffixes.hash(starts, length) ^ group[starts]
    order = np.argsort(hashed, kind="stable")
    starts, hashed = starts[order], hashed[order]
    new = np.append(True, hashed[1:] != hashed[:-1]) if len(hashed) else np.zeros(0, bool)
    member = np.cumsum(new) - 1
    several = np.bincount(member, minlength=1)[member] > 1 if len(member) else np.zeros(0, bool)
    starts, member = starts[several], member[several]
    class_of = np.full(len(data), -1, np.int64)
    class_of[starts] = member
    open_ = np.zeros(len(data) + 1, bool)
    open_[:-1][starts] = ~found[starts]
    while True:
        run = np.flatnonzero(open_[:-1] & ~np.append(False, open_[:-2] & (row[1:] == row[:-1]))) if len(data) else np.zeros(0, int)
        if not len(run):
            break
        sorted_ = suffixes.sort(starts[np.isin(member, class_of[run])], group)
        place = np.empty(len(data), np.int64)
        place[sorted_] = np.arange(len(sorted_))
        best, mate = np.zeros(len(run), np.int64), run.copy()
        for step in (-1, 1):
            other = sorted_[np.clip(place[run] + step, 0, len(sorted_) - 1)]
            fits = (other != run) & (group[other] == group[run])
            extent = np.where(fits, suffixes.common(run, other), 0)
            mate, best = np.where(extent > best, other, mate), np.maximum(best, extent)
        best = np.where(best >= length, best, 0)
        true = _same_bytes(data, run, mate, best) & (best > 0)
        for i in np.flatnonzero(~true):  # a collision: look among all with this hash
            peers = starts[member == class_of[run[i]]]
            own = data[run[i] : run[i] + length].tobytes()
            true[i] = any(p != run[i] and key[row[p]] == key[row[run[i]]] and data[p : p + length].tobytes() == own for p in peers)
            best[i] = length
        covered = np.zeros(len(data) + 1, np.int64)
        np.add.at(covered, run, 1)
        np.add.at(covered, run + best - length + 1, -1)
        settled = np.cumsum(covered[:-1]) > 0
        hit = np.zeros(len(data) + 1, np.int64)
        np.add.at(hit, run[true], 1)
        np.add.at(hit, run[true] + best[true] - length + 1, -1)
        found |= np.cumsum(hit[:-1]) > 0
        open_[:-1] &= ~settled
    return found


def ranges_of(flags: np.ndarray) -> list[tuple[int, int]]:
    """First and last place of each run of true flags."""
    edge = np.flatnonzero(np.diff(np.concatenate(([0], flags.astype(np.int8), [0]))))
    return list(zip(edge[::2].tolist(), (edge[1::2] - 1).tolist(), strict=True))


def covered_spans(starts: list[tuple[int, int]], length: int = LENGTH) -> list[tuple[int, int]]:
    """Maximal byte spans covered by strings that start in the given ranges."""
    spans: list[list[int]] = []
    for a, b in sorted(starts):
        if spans and a <= spans[-1][1]:
            spans[-1][1] = max(spans[-1][1], b + length)
        else:
            spans.append([a, b + length])
    return [tuple(x) for x in spans]


ANCHOR = "array<struct<pos int, first int, last int, h long, c long>>"


def work_table(docs: DataFrame, id_col: str, text_col: str, length: int, gram: int, seed: int, bits: int) -> DataFrame:
    """(key, id, packed, anchors): each text compressed, with its anchors, their hashes and those of their contexts."""
    ids = docs.schema[id_col].dataType.simpleString()
    source = bounded(docs).select(
        F.monotonically_increasing_id().alias("key"), F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text")
    )
    mask = (1 << bits) - 1

    def searched(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pack = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            rows, held = [], 0
            for key, id_, text in zip(batch["key"], batch["id"], batch["text"], strict=True):
                data = (text or "").encode("utf-8", "surrogatepass")
                found = []
                for pos, first, last, h in anchors(data, length, gram):
                    found += [
                        (p, a, b, x, (xxhash.xxh3_64_intdigest(data[a : b + length], (p - a) + (seed << 32)) & mask) - (1 << 63))
                        for p, a, b, x in zip(pos.tolist(), first.tolist(), last.tolist(), h.view(np.int64).tolist(), strict=True)
                    ]
                rows.append((key, id_, pack.compress(data), found))
                held += len(data)
                if held > HELD:
                    yield pd.DataFrame(rows, columns=["key", "id", "packed", "anchors"])
                    rows, held = [], 0
            yield pd.DataFrame(rows, columns=["key", "id", "packed", "anchors"])

    made = source.mapInPandas(searched, f"key long, id string, packed binary, anchors {ANCHOR}")
    return written(made.withColumn("id", F.col("id").cast(ids)), "suffix-texts")


def repeated_anchors(texts: DataFrame) -> DataFrame:
    """(key, pos, first, last, h, c, n, rk, rpos, kinds, uneven): the anchors whose hash comes again.

    n: how often the context comes; rk, rpos: key and place of its representative; kinds: different contexts of the anchor;
    uneven: whether contexts with this hash differ in their length or in the anchor's place.
    """
    spark, path = texts.sparkSession, shared_dir(texts.sparkSession, "suffix-marked")
    with scratch(spark):  # what leads to the table goes once it is written
        placed = texts.select("key", F.explode("anchors").alias("a")).select("key", "a.*")
        several = written(placed.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("h"), "suffix-repeated")
        again = written(placed.join(several, "h"), "suffix-again")
        shape = F.struct(F.col("pos") - F.col("first"), F.col("last") - F.col("first"))
        one = written(again.groupBy("h", "c").agg(
            F.min(F.struct("key", "pos")).alias("r"), F.count(F.lit(1)).alias("n"), (F.min(shape) != F.max(shape)).alias("uneven")), "suffix-kinds")
        kinds = one.groupBy("h").agg(F.count(F.lit(1)).alias("kinds"))
        one = one.join(kinds, "h").select("h", "c", "n", F.col("r.key").alias("rk"), F.col("r.pos").alias("rpos"), "kinds", "uneven")
        marked = again.join(one, ["h", "c"])
        marked.write.parquet(path)
    return spark.read.schema(marked.schema).parquet(path)


#: What is cut out of the texts. kind 0: a representative's context (h, c, n, kinds and the anchor's place in it);
#: kinds 1 and 2: a part or tail that must equal the representative's (its key as h, its place there as c); kind 3: the shape of
#: a context that must equal that of all with its hash (h, c), only where shapes are known to differ.
CUT = "kind int, h long, c long, n long, kinds long, anchor int, data binary"


def cut_out(texts: DataFrame, marked: DataFrame, length: int) -> DataFrame:
    wanted = marked.groupBy("key").agg(F.collect_list(F.struct("h", "c", "n", "first", "last", "pos", "rk", "rpos", "kinds", "uneven")).alias("wanted"))

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            rows, held = [], 0
            for key, packed, some in zip(batch["key"], batch["packed"], batch["wanted"], strict=True):
                data = unpack.decompress(packed)
                some = sorted(some, key=lambda x: x["first"])
                for x, after in zip(some, [*some[1:], None], strict=True):
                    first, last, pos = x["first"], x["last"], x["pos"]
                    own = x["rk"] == key and x["rpos"] == pos
                    if own and x["kinds"] > 1:
                        rows.append((0, x["h"], x["c"], x["n"], x["kinds"], pos - first, data[first : last + length]))
                    if x["uneven"]:
                        rows.append((3, x["h"], x["c"], 0, 0, 0, f"{pos - first} {last - first}".encode()))
                    if x["n"] > 1:
                        shift = pos - x["rpos"]
                        rows.append((1, x["rk"], first - shift, 0, 0, 0, data[first : last + 1]))
                        goes_on = after is not None and after["n"] > 1 and after["first"] == last + 1 and after["rk"] == x["rk"] and after["pos"] - after["rpos"] == shift
                        if own or not goes_on:
                            rows.append((2, x["rk"], last + 1 - shift, 0, 0, 0, data[last + 1 : last + length]))
                    held += 3 * length
                    if held > HELD:
                        yield pd.DataFrame(rows, columns=["kind", "h", "c", "n", "kinds", "anchor", "data"])
                        rows, held = [], 0
            yield pd.DataFrame(rows, columns=["kind", "h", "c", "n", "kinds", "anchor", "data"])

    return written(texts.select("key", "packed").join(wanted, "key").mapInPandas(cut, CUT), "suffix-cut")


def copies_agree(cut: DataFrame) -> bool:
    """Whether every copy of a context has its representative's bytes."""
    same = cut.where("kind > 0").groupBy("kind", "h", "c").agg(F.min("data").alias("low"), F.max("data").alias("high"))
    return same.where("low <> high").isEmpty()


def settled(contexts: DataFrame, length: int) -> DataFrame:
    """(h, c, a, b): ranges of starts, within each context, of strings that come again.

    contexts: (h, c, n, at, anchor, group, data); ``data`` starts at place ``at`` of the context; only rows of one group can
    have a string in common.
    """
    shards = max(6, -(-contexts.count() // SHARD_CONTEXTS))

    def settle(shard: pd.DataFrame) -> pd.DataFrame:
        shard = shard.sort_values(["group", "h", "c", "at"], ignore_index=True)
        flags = repeated_strings(
            list(shard["data"]), shard["anchor"].to_numpy(np.int64), shard["group"].to_numpy(np.int64).view(np.uint64),
            shard["n"].to_numpy(np.int64), length)
        rows, place = [], 0
        for h, c, at, data in zip(shard["h"], shard["c"], shard["at"], shard["data"], strict=True):
            rows += [(h, c, at + a, at + b) for a, b in ranges_of(flags[place : place + len(data)])]
            place += len(data)
        return pd.DataFrame(rows, columns=["h", "c", "a", "b"])

    return contexts.groupBy(F.pmod(F.xxhash64("group"), F.lit(shards)).alias("shard")).applyInPandas(settle, "h long, c long, a int, b int")


def parted(contexts: DataFrame, length: int, with_data: bool) -> DataFrame:
    """Contexts cut into pieces of at most STEP starts; a piece's group is the hash of the bytes that all its strings have in common."""
    schema = "h long, c long, n long, at int, anchor int, group long, data binary" if with_data else "group long"

    def part(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows, held = [], 0
            for h, c, n, anchor, data in zip(batch["h"], batch["c"], batch["n"], batch["anchor"], batch["data"], strict=True):
                for end in range(anchor, -STEP, -STEP):
                    begin, last = max(0, end - STEP + 1), min(end, len(data) - length)
                    if last < begin:
                        continue
                    group = xxhash.xxh3_64_intdigest(data[end : end - STEP + 1 + length], (h ^ (anchor - end)) & ((1 << 64) - 1)) - (1 << 63)
                    rows.append((h, c, n, begin, anchor - begin, group, data[begin : last + length]) if with_data else (group,))
                    held += length
                if held > HELD:
                    yield pd.DataFrame(rows, columns=[x.split()[0] for x in schema.split(", ")])
                    rows, held = [], 0
            yield pd.DataFrame(rows, columns=[x.split()[0] for x in schema.split(", ")])

    return contexts.select("h", "c", "n", "anchor", "data").mapInPandas(part, schema)


def one_by_one(pieces: DataFrame, length: int) -> DataFrame:
    """(h, c, a, b) for pieces of groups of any size: strings are grouped by their own bytes."""

    def strings(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(h, c, n, at + i, anchor - i, data[i : i + length]) for h, c, n, at, anchor, data in zip(
                batch["h"], batch["c"], batch["n"], batch["at"], batch["anchor"], batch["data"], strict=True) for i in range(len(data) - length + 1)]
            yield pd.DataFrame(rows, columns=["h", "c", "n", "a", "off", "string"])

    single = pieces.select("h", "c", "n", "at", "anchor", "data").mapInPandas(strings, "h long, c long, n long, a int, off int, string binary")
    again = single.groupBy("h", "off", "string").agg(F.sum("n").alias("all")).where("all > 1").drop("all")
    return single.join(again, ["h", "off", "string"]).select("h", "c", "a", F.col("a").alias("b"))


def repeated_ranges(marked: DataFrame, cut: DataFrame, length: int, hot: int = HOT) -> DataFrame:
    """(key, ranges): the starts of repeated strings by document."""
    contexts = cut.where("kind = 0")
    usual = contexts.where(F.col("kinds") <= hot).select("h", "c", "n", F.lit(0).alias("at"), "anchor", F.col("h").alias("group"), "data")
    found = written(settled(usual, length), "suffix-settled")
    many = contexts.where(F.col("kinds") > hot)
    if not many.isEmpty():
        several = written(parted(many, length, False).groupBy("group").agg(F.count(F.lit(1)).alias("size")).where("size > 1"), "suffix-groups")
        pieces = written(parted(many, length, True).join(several, "group"), "suffix-pieces")
        copied = many.where("n > 1").select("h", "c", F.lit(0).alias("a"), (F.octet_length("data") - length).alias("b"))
        found = found.unionByName(copied).unionByName(settled(pieces.where(F.col("size") <= hot), length)).unionByName(
            one_by_one(pieces.where(F.col("size") > hot), length))
        found = written(found, "suffix-settled")
    equal = marked.where("kinds = 1").select("key", F.col("first").alias("from"), F.col("last").alias("to"))
    differing = marked.where("kinds > 1").join(found, ["h", "c"]).select("key", (F.col("first") + F.col("a")).alias("from"), (F.col("first") + F.col("b")).alias("to"))
    return equal.unionByName(differing).groupBy("key").agg(F.collect_list(F.struct("from", "to")).alias("ranges"))


def remove_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, gram: int = GRAM, hot: int = HOT, bits: int = BITS,
) -> DataFrame:
    """One row per document: id, n_bytes, spans (removed, in bytes, end exclusive) and kept (binary)."""
    ids = docs.schema[id_col].dataType.simpleString()
    spark, path = docs.sparkSession, shared_dir(docs.sparkSession, "suffix-ranges")
    for seed in count():
        texts = work_table(docs, id_col, text_col, length, gram, seed, BITS if seed else bits)
        with scratch(spark):  # anchors and contexts go once the ranges are written
            marked = repeated_anchors(texts)
            cut = cut_out(texts, marked, length)
            if copies_agree(cut):
                found = repeated_ranges(marked, cut, length, hot)
                found.write.parquet(path)
                break
    ranges = spark.read.schema(found.schema).parquet(path)

    def removed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            rows = []
            for id_, packed, some in zip(batch["id"], batch["packed"], batch["ranges"], strict=True):
                data = unpack.decompress(packed)
                spans = covered_spans([(x["from"], x["to"]) for x in some], length) if some is not None else []
                edges = [0, *(e for s in spans for e in s), len(data)]
                kept = b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))
                rows.append((id_, len(data), spans, kept))
            yield pd.DataFrame(rows, columns=["id", "n_bytes", "spans", "kept"])

    made = texts.select("key", F.col("id").cast("string").alias("id"), "packed").join(ranges, "key", "left").select("id", "packed", "ranges").mapInPandas(
        removed, "id string, n_bytes long, spans array<struct<start long, end long>>, kept binary")
    return made.withColumn("id", F.col("id").cast(ids))
