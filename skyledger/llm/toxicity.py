"""Toxicity from the nearest labelled examples by exact TF-IDF cosine.

Every word of a text counts. Document frequencies come from all labelled texts, of which equal ones count
once. A word's weight is tf x idf x relevance, where relevance is log2(2 + texts of label 1 / texts of label 0
with the word), a published supervised term weight: without it the many common words of long texts drown the
few that matter (the README has both recalls). It is 1 for a word that only label 0 has and rises without a
threshold, so no word is left out.

The examples are a bounded sample of the labelled texts: at most ``examples`` of each label and ``example_bytes`` of their text,
those with the smallest hash of their text; a text longer than a 16th of these bytes is no example, but its words count. The vocabulary is all words of the examples; a word that no example holds can't
add to any cosine. A block-max inverted index over the examples finds the exact nearest ones: frequent
words have their largest weight in every block of examples, rare words are added up from their postings, and
both together bound what an example of a block can reach. Blocks are scored whole only where that bound
reaches the k-th nearest. Examples are laid out by recursive halving along leading directions, so that
blocks hold like texts and the bounds are tight.

Votes are weighted by similarity and by how many labelled texts an example stands for; a logistic curve
fitted to leave-one-out votes of all examples, taken in Spark tasks, turns the vote into a probability.

Defined results: a null, empty or wordless text, or one with no word of an example, gets the share of label 1
among the labelled texts and no evidence; labels that are null are not learned from, and of several labels
of one text each counts; ties between examples go to the one first in the index; with nothing to learn
from every score is 0; repeated rows get equal scores; an empty table gives an empty result; other columns pass
through. Very long texts are scored whole. ``rate`` adds ``_tx_score`` and ``_tx_evidence`` (identifiers of the nearest examples, as text,
nearest first), in place of input columns of these names.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from functools import cached_property
from hashlib import sha256
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyledger.llm.batches import bounded
from skyledger.sources.shared import written

#: Nearest examples that vote, examples of each label at most, examples of a block.
NEAREST, EXAMPLES, BLOCK = 15, 8_192, 64
#: Bytes of text that the examples of a label have at most, so that their words, vectors and index are bounded whatever the texts' lengths.
EXAMPLE_BYTES = 1 << 26
#: Blocks scored first; words (the most frequent ones) that have a weight in every block.
FIRST_BLOCKS, FREQUENT = 6, 256
#: Texts scored together; texts whose result a worker remembers.
TOGETHER, KNOWN = 32, 20_000
#: Weight of the overall share that a vote starts from.
PRIOR = 0.1
#: ASCII characters other than letters, digits and apostrophes part words.
_PART = bytes(i if chr(i).isalnum() or i >= 128 or i == 39 else 32 for i in range(256))


def words(text: str | None) -> list[bytes]:
    return (text or "").lower().encode("utf-8", "surrogatepass").translate(_PART).split()


class Vocabulary:
    """Words and their weights. Kept as one string of bytes; the table of words is made where texts are read."""

    def __init__(self, words_: bytes, weight: np.ndarray):
        self.words, self.weight = words_, weight  # words parted by line ends, in the order of their numbers

    def __getstate__(self) -> dict:
        return {"words": self.words, "weight": self.weight}

    @cached_property
    def terms(self) -> dict[bytes, int]:
        return {w: i for i, w in enumerate(self.words.split(b"\n"))} if self.words else {}

    def vector(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """(terms, weights) of a text as a unit vector; terms ascending, none if it has no known word."""
        count = Counter(words(text))
        at = np.fromiter(map(self.terms.get, count, repeat(-1)), np.int32, len(count))
        order = np.argsort(at)
        order = order[np.searchsorted(at, 0, sorter=order) :]
        at = at[order]
        x = (1 + np.log(np.fromiter(count.values(), float, len(count))[order])) * self.weight[at]
        return at, (x / np.sqrt((x * x).sum()) if len(x) else x)


@dataclass
class Index:
    """Examples (unit vectors) by term. Terms are numbered by falling frequency among the examples."""

    vocabulary: Vocabulary
    labels: np.ndarray
    stands_for: np.ndarray
    ids: list[str]
    hashes: np.ndarray
    begin: np.ndarray  # by term, into the postings
    example: np.ndarray
    weight: np.ndarray
    base: float = 0.0
    curve: tuple[float, float] = (0.0, 1.0)
    #: The index as tasks have it, without the curve.
    shared: Broadcast | None = field(default=None, repr=False)

    def __getstate__(self) -> dict:
        """Without what the postings give again."""
        return {k: v for k, v in self.__dict__.items() if k not in ("frequent", "most", "place", "known", "shared")}

    @cached_property
    def frequent(self) -> np.ndarray:
        """Weights of the frequent terms: terms x blocks x examples of a block."""
        n, blocks = min(FREQUENT, len(self.begin) - 1), -(-len(self.labels) // BLOCK)
        dense = np.zeros((n, blocks * BLOCK))
        upto = self.begin[n] if n else 0
        dense[np.repeat(np.arange(n), np.diff(self.begin[: n + 1])), self.example[:upto]] = self.weight[:upto]
        return dense.reshape(n, blocks, BLOCK)

    @cached_property
    def most(self) -> np.ndarray:
        """The largest weight of each frequent term in each block."""
        return self.frequent.max(axis=2) if self.frequent.size else np.zeros(self.frequent.shape[:2])

    @cached_property
    def place(self) -> dict[tuple[int, int], int]:
        return {(int(h), int(y)): i for i, (h, y) in enumerate(zip(self.hashes, self.labels, strict=True))}

    @cached_property
    def known(self) -> dict[bytes, tuple[float, np.ndarray]]:
        """(score, nearest examples) of texts met lately, by their digest and the curve."""
        return {}

    def nearest(self, at: np.ndarray, x: np.ndarray, k: int = NEAREST, but: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """(examples, cosines) of the k nearest with a cosine above 0, nearest first, without example ``but``."""
        return self.nearest_of([(at, x)], k, [but])[0]

    def nearest_of(self, vectors: list[tuple[np.ndarray, np.ndarray]], k: int = NEAREST, but: list[int] | None = None) -> list[tuple[np.ndarray, np.ndarray]]:
        """``nearest`` of each of a few vectors. Those whose bounds leave many blocks open get the frequent words' part in one product."""
        n, blocks = self.most.shape
        every = [self._bounded(at, x, k, i) for (at, x), i in zip(vectors, but or [-1] * len(vectors), strict=True)]
        wide = [i for i, e in enumerate(every) if len(e[-1]) * 4 > blocks]
        row = {i: r for r, i in enumerate(wide)}
        whole = np.zeros((len(wide), n))
        for i, r in row.items():
            at, x = vectors[i]
            upto = np.searchsorted(at, n)
            whole[r, at[:upto]] = x[:upto]
        if wide:
            whole = (whole @ self.frequent.reshape(n, blocks * BLOCK)).reshape(len(wide), blocks, BLOCK)
        out = []
        for i, ((at, x), (score, first, found, rest)) in enumerate(zip(vectors, every, strict=True)):
            if len(rest):
                more = score[rest] + whole[row[i]][rest] if i in row else self._whole(rest, score, at, x)
                found, first = np.concatenate([found, more]), np.concatenate([first, rest])
            cosine, example = found.ravel(), (first[:, None] * BLOCK + np.arange(BLOCK)).ravel()
            if len(cosine) > 4 * k:
                near = cosine >= np.partition(cosine, -k)[-k] - 1e-9
                cosine, example = cosine[near], example[near]
            cosine, example = cosine[cosine > 1e-12], example[cosine > 1e-12]
            best = np.lexsort((example, -np.round(cosine, 9)))[:k]
            out.append((example[best], cosine[best]))
        return out

    def _bounded(self, at: np.ndarray, x: np.ndarray, k: int, but: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """What rare words give each example, the blocks scored first, their cosines, and the other blocks that can reach the k-th nearest of these."""
        n, blocks = self.most.shape
        upto = np.searchsorted(at, n)
        rare = at[upto:]
        begin = self.begin[rare]
        size = self.begin[rare + 1] - begin
        step = np.repeat(begin - (np.cumsum(size) - size), size)
        step += np.arange(len(step))
        part = np.repeat(x[upto:], size)
        part *= self.weight.take(step)
        score = np.bincount(self.example.take(step), part, blocks * BLOCK).astype(float, copy=False).reshape(blocks, BLOCK)
        if but >= 0:
            score[but // BLOCK, but % BLOCK] = -2.0
        bound = score.max(axis=1) + x[:upto] @ self.most[at[:upto]]
        # A hair of room for rounding: only a block that can't reach the k-th nearest is left out.
        first = np.argsort(-bound, kind="stable")[:FIRST_BLOCKS]
        found = self._whole(first, score, at, x)
        least = max(np.partition(found.ravel(), -k)[-k], 0.0) if found.size >= k else 0.0
        open_ = bound >= max(least - 1e-9, 1e-12)
        open_[first] = False
        return score, first, found, np.flatnonzero(open_)

    def _whole(self, blocks: np.ndarray, score: np.ndarray, at: np.ndarray, x: np.ndarray) -> np.ndarray:
        """Cosines of the examples in the given blocks: what rare words gave and the frequent ones."""
        upto = np.searchsorted(at, len(self.most))
        return score[blocks] + np.tensordot(x[:upto], self.frequent[at[:upto, None], blocks[None, :]], (0, 0))

    def vote(self, found: np.ndarray, cosine: np.ndarray) -> float:
        """Weighted share of label 1, drawn to the overall share where the near examples are few."""
        w = cosine**2 * self.stands_for[found]
        return float((w @ self.labels[found] + PRIOR * self.base) / (w.sum() + PRIOR))

    def score(self, text: str | None, curve: tuple[float, float] | None = None) -> tuple[float, list[str]]:
        return self.scores([text], curve)[0]

    def scores(self, texts: Iterable[str | None], curve: tuple[float, float] | None = None) -> list[tuple[float, list[str]]]:
        """Score and identifiers of the nearest examples of each text; equal texts that a worker has met lately are scored once."""
        curve = curve or self.curve
        out, keys, new = [], [], {}

        def settle() -> None:
            met = {key: self.vocabulary.vector(text) for key, text in new.items()}
            full = {key: v for key, v in met.items() if len(v[0]) and len(self.labels)}
            near = dict(zip(full, self.nearest_of(list(full.values())), strict=True))
            for key in met:
                found, cosine = near.get(key, ((), ()))
                one = float(1 / (1 + np.exp(-(curve[0] + curve[1] * self.vote(found, cosine))))) if len(found) else self.base
                self.known[key] = one, found
            for key in keys:
                one, found = self.known[key]
                out.append((one, [self.ids[i] for i in found]))
            keys.clear()
            new.clear()
            if len(self.known) > KNOWN:
                self.known.clear()

        for text in texts:
            keys.append(key := sha256((text or "").encode("utf-8", "surrogatepass")).digest() + np.array(curve).tobytes())
            if key not in self.known:
                new[key] = text
            if len(new) == TOGETHER:
                settle()
        settle()
        return out


def platt(vote: np.ndarray, label: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Logistic curve over the votes by Newton steps, with Platt's smoothed targets."""
    n1, n0 = (weight * label).sum(), (weight * (1 - label)).sum()
    y = np.where(label == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    x, b = np.column_stack([np.ones(len(vote)), vote]), np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        step = np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2), x.T @ (weight * (y - p)) - 1e-3 * b)
        b = b + np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return float(b[0]), float(b[1])


def laid_out(example: np.ndarray, term: np.ndarray, weight: np.ndarray, n: int, terms: int, directions: int = 8, rounds: int = 6) -> np.ndarray:
    """An order of the examples that puts like ones side by side.

    The examples' leading directions come from a few rounds of orthogonal iteration; then parts are halved, each along the
    direction in which it is widest, down to a block. Only the bounds' tightness depends on it, never a result.
    """
    if n <= BLOCK:
        return np.arange(n)
    along = np.random.default_rng(0).standard_normal((n, min(directions, n)))
    for _ in range(rounds):
        along = np.linalg.qr(along - along.mean(axis=0))[0]
        for k in range(along.shape[1]):
            side = np.bincount(term, weight * along[example, k], terms)
            along[:, k] = np.bincount(example, weight * side[term], n)
    out, todo = [], [np.arange(n)]
    while todo:
        part = todo.pop()
        if len(part) <= BLOCK:
            out.append(part)
            continue
        own = along[part]
        part = part[np.argsort(own[:, own.var(axis=0).argmax()], kind="stable")]
        half = -(-len(part) // BLOCK) // 2 * BLOCK  # whole blocks, so that no block straddles two parts
        todo += [part[half:], part[:half]]
    return np.concatenate(out)


def distinct_texts(labelled: DataFrame) -> DataFrame:
    """(h, label, id, text, copies) of (id, text, label): one row for each different text and label, as a written table."""
    text = F.coalesce("text", F.lit(""))
    once = labelled.select(F.col("id").cast("string").alias("id"), text.alias("text"), "label", F.xxhash64(text).alias("h"), F.sha2(text, 256).alias("digest"))
    return written(once.groupBy("h", "digest", "label").agg(F.min("id").alias("id"), F.first("text").alias("text"), F.count(F.lit(1)).alias("copies")), "toxic-texts")


def term_counts(texts: DataFrame) -> DataFrame:
    """(term, n1, n0): texts of each label that hold the term, over all of (text, label). Terms are bytes as Latin-1."""

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found: dict[bytes, list[int]] = {}

        def out() -> Iterator[pd.DataFrame]:
            rows = [(w.decode("latin-1"), n1, n0) for w, (n0, n1) in found.items()]
            for at in range(0, len(rows) or 1, 1 << 14):
                part = pd.DataFrame(rows[at : at + (1 << 14)], columns=["term", "n1", "n0"], dtype=object)
                yield part.astype({"n1": "int64", "n0": "int64"})

        for batch in batches:
            for text, label in zip(batch["text"], batch["label"], strict=True):
                for w in set(words(text)):
                    found.setdefault(w, [0, 0])[label] += 1
            if len(found) > 1 << 18:  # bounded memory; the same term may come again
                yield from out()
                found.clear()
        yield from out()

    return bounded(texts).mapInPandas(counted, "term string, n1 long, n0 long").groupBy("term").agg(F.sum("n1").alias("n1"), F.sum("n0").alias("n0"))


def chosen_examples(texts: DataFrame, examples: int, example_bytes: int = EXAMPLE_BYTES) -> tuple[DataFrame, dict[int, int]]:
    """The texts of each label with the smallest hashes, as a written table; and the number of texts of each label.

    At most ``examples`` of a label, and at most ``example_bytes`` of text; a text longer than a 16th of that is no example.
    """
    number = {r["label"]: r["n"] for r in texts.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    order = F.shiftrightunsigned("h", 1)
    share = {y: min(1.0, (examples + 8 * examples**0.5 + 16) / n) for y, n in number.items()}
    near = texts.where(order / F.lit(2.0**63) <= F.when(F.col("label") == 1, share.get(1, 0.0)).otherwise(share.get(0, 0.0)))
    by_hash = Window.partitionBy("label").orderBy(order, "h", "digest").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sized = near.select("h", "digest", "label", F.octet_length("text").cast("long").alias("bytes")).where(F.col("bytes") <= example_bytes // 16)
    ranked = sized.select("h", "digest", "label", F.row_number().over(by_hash).alias("rank"), F.sum("bytes").over(by_hash).alias("total"))
    few = written(ranked.where((F.col("rank") <= examples) & (F.col("total") <= example_bytes)).select("h", "digest", "label"), "toxic-chosen")
    return written(near.join(F.broadcast(few), ["h", "digest", "label"]).select("h", "label", "id", "text"), "toxic-examples"), number


def train(labelled: DataFrame, examples: int = EXAMPLES, example_bytes: int = EXAMPLE_BYTES) -> Index:
    """An index of (id, text, label) rows, label 0 or 1."""
    spark = labelled.sparkSession
    texts = distinct_texts(labelled)
    chosen, number = chosen_examples(texts, examples, example_bytes)
    n1, n0 = number.get(1, 0), number.get(0, 0)
    base = n1 / max(1, n1 + n0)
    used = term_counts(chosen).select("term", (F.col("n1") + F.col("n0")).alias("used"))
    # One row for each word of a bounded number of texts, numbered by falling frequency among these.
    counts = term_counts(texts).join(used, "term").toArrow().sort_by([("used", "descending"), ("term", "ascending")])
    of1, of0 = (counts[c].to_numpy().astype(float) for c in ("n1", "n0"))
    relevance = np.log2(2 + of1 / np.maximum(1, of0))
    vocabulary = Vocabulary("\n".join(counts["term"].to_pylist()).encode("latin-1"), (np.log((1 + n1 + n0) / (1 + of1 + of0)) + 1) * relevance)
    terms = len(of1)
    del counts, of1, of0
    bare = spark.sparkContext.broadcast(vocabulary)

    def vectors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [bare.value.vector(t) for t in batch["text"]]
            yield pd.DataFrame({
                "h": batch["h"], "label": batch["label"], "id": batch["id"], "at": [a.astype("<i4").tobytes() for a, _ in found], "x": [x.astype("<f4").tobytes() for _, x in found]})

    rows = bounded(chosen).mapInPandas(vectors, "h long, label int, id string, at binary, x binary").toArrow()
    # Mixed by hash, so that neither label comes first among equally near examples.
    rows = rows.sort_by([("h", "ascending"), ("label", "ascending")])
    n = rows.num_rows
    term, weight = np.frombuffer(b"".join(rows["at"].to_pylist()), "<i4"), np.frombuffer(b"".join(rows["x"].to_pylist()), "<f4")
    size = np.fromiter((len(a.as_buffer()) // 4 for a in rows["at"]), np.int64, n) if n else np.zeros(0, np.int64)
    rows = rows.select(["h", "label", "id"])
    example = np.repeat(np.arange(n, dtype=np.int32), size)
    order = laid_out(example, term, weight, n, terms)
    place = np.empty(n, np.int32)
    place[order] = np.arange(n)
    rows, example = rows.take(pa.array(order)), place[example]
    sort = np.lexsort((example, term))
    begin = np.searchsorted(term[sort], np.arange(terms + 1))
    example, weight = example[sort], weight[sort]
    del term, sort
    labels = rows["label"].to_numpy().astype(float)
    stands = {y: number.get(y, 0) / max(1, int((labels == y).sum())) for y in (0, 1)}
    index = Index(
        vocabulary, labels, np.array([stands[int(y)] for y in labels]), [i or "" for i in rows["id"].to_pylist()], rows["h"].to_numpy().astype(np.int64),
        begin, example, weight, base)
    bare.unpersist()
    index.shared = shared = spark.sparkContext.broadcast(index)  # bounded by the examples' words
    if not len(labels):
        return index

    def votes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            index = shared.value
            place = [index.place[key] for key in zip(batch["h"], batch["label"], strict=True)]
            out = []
            for at in range(0, len(batch), TOGETHER):
                own = place[at : at + TOGETHER]
                near = index.nearest_of([index.vocabulary.vector(t) for t in batch["text"].iloc[at : at + TOGETHER]], but=own)
                out += [(i, index.vote(*found)) for i, found in zip(own, near, strict=True) if len(found[0])]
            yield pd.DataFrame(out, columns=["i", "vote"])

    found = bounded(chosen).mapInPandas(votes, "i int, vote double").toPandas().sort_values("i")
    if len(found):
        index.curve = platt(found["vote"].to_numpy(float), labels[found["i"]], index.stands_for[found["i"]])
    return index


def rate(docs: DataFrame, index: Index, text_col: str = "text") -> DataFrame:
    """``docs`` with ``_tx_score`` and ``_tx_evidence``."""
    shared, curve = index.shared or docs.sparkSession.sparkContext.broadcast(index), index.curve

    @F.pandas_udf("score double, evidence array<string>")
    def scored(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame(shared.value.scores(texts, curve), columns=["score", "evidence"])

    others = [F.col(f"`{c}`") for c in docs.columns if c not in ("_tx_score", "_tx_evidence")]
    found = bounded(docs).select(F.struct(*others).alias("row"), scored(F.col(text_col)).alias("found"))
    return found.select("row.*", F.col("found.score").alias("_tx_score"), F.col("found.evidence").alias("_tx_evidence"))


def fold(key: Column, of: int = 3) -> Column:
    return F.crc32(key.cast("string").cast("binary")) % of
