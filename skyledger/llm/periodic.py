"""Periodic runs of words, found by the grouping phase of a linear suffix sorter and the runs theorem.

A run is a stretch of consecutive words with smallest period q, at least ``least`` words and twice q long, that no neighbouring word
extends keeping that period. Every run contains, under one of two opposite orders of the words, a root: the longest Lyndon
factor at its place, of length q. So:

1. Words of a document get numbers. A run of ``least`` words or more is covered by windows of least/2 words that come again in the
   document; only stretches of such words are kept (hashes may keep a few more), which loses no run and no neighbour that
   would extend one.
2. The stretches of a batch are joined by symbols that come once, which no run holds. ``lyndon_lengths`` is phase one of the
   suffix sorter: suffixes are grouped by first symbol; groups are taken from the highest down, and each place that a group's
   members point back to (the nearest lower one to the left) takes their context onto its own as often as they point.
   Where it ends, a suffix's group is its longest Lyndon prefix: the Lyndon array, without a suffix array.
3. It runs under both orders. A root is extended to both sides by its longest common extension with itself one period on:
   binary search over prefix hashes, then compared word by word; whatever a hash got wrong is extended word by word.

Each document is read once where it is: nothing is shuffled, and a worker holds one batch of texts (bounded in rows and bytes).

Defined results: a null or empty text has no words and no runs; a very long text is handled whole, in time in proportion to its length (times a
logarithm); repeated rows give repeated rows; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.llm.batches import bounded
from skyledger.llm.suffix_dedup import Suffixes

LEAST = 12
#: Bytes of collapsed texts that a worker holds before it hands rows on.
HELD = 4 << 20
_MIX = np.uint64(0x9E3779B97F4A7C15)


def lyndon_lengths(symbols: list[int]) -> list[int]:
    """Length of the longest Lyndon factor from each place on; symbols are 0, 1, ... without gaps."""
    n, k = len(symbols), max(symbols, default=-1) + 1
    members: list[list[int]] = [[] for _ in range(k)]
    for i, s in enumerate(symbols):
        members[s].append(i)
    group, context = list(symbols), [1] * k
    below, above = list(range(-1, k - 1)), [*range(1, k), -1]
    left = list(range(n + 1))  # at i + 1: itself while place i is open, else a place further left; 0: none
    lengths = [1] * n

    current = k - 1
    while current >= 0:
        mine = [i for i in members[current] if group[i] == current]
        for i in mine:
            left[i + 1] = i
        length, pointed = context[current], {}
        for i in mine:
            lengths[i] = length
            at = i
            while left[at] != at:
                at = left[at]
            step = i
            while left[step] != at:  # paths are shortened to their end
                left[step], step = at, left[step]
            if at:
                pointed[at - 1] = pointed.get(at - 1, 0) + 1
        by_count: dict[int, list[int]] = {}
        for j, times in pointed.items():
            by_count.setdefault(times, []).append(j)
        for times in sorted(by_count, reverse=True):
            moved: dict[int, int] = {}
            for j in by_count[times]:
                old = group[j]
                new = moved.get(old)
                if new is None:  # a group of its own, right above the one it leaves
                    new = moved[old] = len(members)
                    members.append([])
                    context.append(context[old] + times * length)
                    up = above[old]
                    below.append(old)
                    above.append(up)
                    above[old], below[up] = new, new  # above the highest there is always the current group
                members[new].append(j)
            for j in by_count[times]:
                group[j] = moved[group[j]]
        members[current] = []
        current = below[current]
    return lengths


def extended(words: np.ndarray, i: int, p: int) -> tuple[int, int]:
    """(start, end) of the stretch of period p around place i, word by word."""
    a, b = i, i
    while a > 0 and words[a - 1] == words[a - 1 + p]:
        a -= 1
    while b + p < len(words) and words[b] == words[b + p]:
        b += 1
    return a, b + p


def _equal(words: np.ndarray, a: np.ndarray, b: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Whether words[a:a+length] equals words[b:b+length], for each; lengths are positive."""
    if not len(a):
        return np.zeros(0, bool)
    begin = np.cumsum(length) - length
    step = np.arange(length.sum()) - np.repeat(begin, length)
    return np.logical_and.reduceat(words[np.repeat(a, length) + step] == words[np.repeat(b, length) + step], begin)


def runs_of(words: np.ndarray, least: int = LEAST) -> np.ndarray:
    """Rows (start, length, period) of all runs of a sequence of numbers, by start, then period."""
    none, n = np.zeros((0, 3), np.int64), len(words)
    if n < 2:
        return none
    symbols = np.unique(words, return_inverse=True)[1]
    codes = (symbols.astype(np.uint64) + np.uint64(1)) * _MIX
    codes ^= codes >> np.uint64(29)
    forward, backward = (Suffixes(x, np.full(n, n, np.int64)) for x in (codes, codes[::-1].copy()))
    found = []
    for ranks in (symbols, symbols.max() - symbols):
        p = np.array(lyndon_lengths(ranks.tolist()), np.int64)
        at = np.arange(n)
        root = np.flatnonzero(at + p < n)
        behind = np.maximum(root - 1, 0)
        root = root[(symbols[root] == symbols[root + p[root]]) | (root > 0) & (symbols[behind] == symbols[behind + p[root]])]
        period = p[root]
        right = forward.common(root, root + period)
        inner = root > 0
        lead = np.zeros(len(root), np.int64)
        lead[inner] = backward.common(n - root[inner], n - root[inner] - period[inner])
        start, length = root - lead, lead + period + right
        wanted = (length >= 2 * period) & (length >= least)
        found.append(np.stack([start, length, period, root], axis=1)[wanted])
    roots = np.concatenate(found)
    if not len(roots):
        return none
    runs, of = np.unique(roots[:, :3], axis=0, return_inverse=True)
    start, length, period = runs.T
    true = _equal(words, start, start + period, length - period)
    # Two stretches had one hash: each root that led to such a run is extended word by word.
    again = [(a, b - a, p) for i, p in roots[~true[of.ravel()]][:, [3, 2]].tolist() for a, b in [extended(words, i, p)]]
    runs = np.concatenate([runs[true], np.array(again, np.int64).reshape(-1, 3)])
    runs = runs[(runs[:, 1] >= 2 * runs[:, 2]) & (runs[:, 1] >= least)]
    runs = np.unique(runs, axis=0)
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def recurring(words: np.ndarray, document: np.ndarray, window: int) -> np.ndarray:
    """Whether each word lies in a window of so many words of its document that comes there again."""
    n = len(words) - window + 1
    live = np.zeros(len(words) + 1, np.int64)
    if n <= 0:
        return live[:-1] > 0
    mixed = (words.astype(np.uint64) + np.uint64(1)) * _MIX
    mixed ^= mixed >> np.uint64(32)
    key = document[:n].astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    for step in range(window):
        key = key * np.uint64(0x2545F4914F6CDD1D) + mixed[step : step + n]
    inside = np.flatnonzero(document[:n] == document[window - 1 :])
    order = inside[np.argsort(key[inside], kind="stable")]
    same = key[order[1:]] == key[order[:-1]]
    again = order[np.append(False, same) | np.append(same, False)] if len(order) else order
    np.add.at(live, again, 1)
    np.add.at(live, again + window, -1)
    return np.cumsum(live[:-1]) > 0


def runs_of_batch(words: np.ndarray, document: np.ndarray, least: int = LEAST) -> np.ndarray:
    """Rows (start, length, period) of the runs of many documents, starts counted over the whole batch."""
    live = recurring(words, document, (least + 1) // 2)
    new = live & ~np.append(False, live[:-1] & (document[1:] == document[:-1])) if len(words) else live
    place, stretch = np.flatnonzero(live), np.cumsum(new)[live]
    if not len(place):
        return np.zeros((0, 3), np.int64)
    # Between two stretches stands a number that comes once.
    at = np.arange(len(place)) + stretch - 1
    joined = np.full(at[-1] + 1, -1, np.int64)
    joined[at] = words[place]
    between = np.flatnonzero(joined < 0)
    joined[between] = int(words.max()) + 1 + np.arange(len(between))
    back = np.zeros(len(joined), np.int64)
    back[at] = place
    runs = runs_of(joined, least)
    runs[:, 0] = back[runs[:, 0]]
    return runs


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST) -> DataFrame:
    """One row per document: id, n_words, runs (by start, then period; in words) and collapsed.

    collapsed: the words, joined by one space, without those that a run contains after its first period.
    """
    ids = docs.schema[id_col].dataType.simpleString()
    source = bounded(docs).select(F.col(id_col).cast("string").alias("id"), F.col(text_col).cast("binary").alias("text"))

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = [(text or b"").split() for text in batch["text"]]  # bytes part at exactly the six white characters of ASCII
            number: dict[bytes, int] = {}
            words = np.array([number.setdefault(w, len(number)) for text in texts for w in text], np.int64)
            size = np.fromiter(map(len, texts), np.int64, len(texts))
            begin = np.cumsum(size) - size
            document = np.repeat(np.arange(len(texts)), size)
            runs = runs_of_batch(words, document, least)
            owner = np.searchsorted(begin, runs[:, 0], "right") - 1 if len(runs) else np.zeros(0, np.int64)
            while len(runs) and (empty := size[owner] == 0).any():  # an empty document begins where the next one does
                owner[empty] -= 1
            dropped = np.zeros(len(words) + 1, np.int64)
            np.add.at(dropped, runs[:, 0] + runs[:, 2], 1)
            np.add.at(dropped, runs[:, 0] + runs[:, 1], -1)
            dropped = np.cumsum(dropped[:-1]) > 0
            of: dict[int, list[tuple[int, int, int]]] = {}
            for k, (start, length, period) in zip(owner.tolist(), runs.tolist(), strict=True):
                of.setdefault(k, []).append((start - int(begin[k]), length, period))
            rows, held = [], 0
            for k, (id_, text) in enumerate(zip(batch["id"], texts, strict=True)):
                if k in of:
                    gone = dropped[begin[k] : begin[k] + size[k]]
                    text = [w for w, g in zip(text, gone.tolist(), strict=True) if not g]
                collapsed = b" ".join(text).decode("utf-8", "surrogatepass")
                rows.append((id_, int(size[k]), of.get(k, []), collapsed))
                held += len(collapsed)
                if held > HELD:
                    yield pd.DataFrame(rows, columns=["id", "n_words", "runs", "collapsed"])
                    rows, held = [], 0
            yield pd.DataFrame(rows, columns=["id", "n_words", "runs", "collapsed"])

    made = source.mapInPandas(search, "id string, n_words long, runs array<struct<start long, length long, period long>>, collapsed string")
    return made.withColumn("id", F.col("id").cast(ids))
