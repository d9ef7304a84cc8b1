"""Quality rules by tokeniser fertility.

One pass measures each whole text: word and line counts for the base rules, and how public
vocabularies take it: characters per token and token entropy under a byte-level BPE, and the share
of bytes that a piece vocabulary, tokenising the whole text, falls back to. Bands of these three
measures are laid over the corpus per language (or script, where no language is given) and length
class: median plus or minus ``width`` scaled median deviations, from exact counts over all different
texts that pass the base rules; copies of a text count once, so that a group of copies doesn't make
the band. A document outside its band is rejected.

Bands are one row per language and length class. Each document looks its band up where it is: no
text is moved by its language, however many documents have the same one.

Defined results: a null or wordless text has no words and fails the base rules; a null language
falls back to the text's main script; classes with fewer than ``least`` different texts take the band of
their language, or of the whole corpus; repeated rows get equal verdicts; an empty table gives an
empty result. ``measured`` and ``judged`` add the columns named in WORK, in place of input columns of
these names; ``keep_good`` returns every input column, whatever its name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyledger.llm import vocab
from skyledger.llm.batches import bounded
from skyledger.sources.shared import looked_up, written

SPACES = b" \t\n\x0b\x0c\r"
SYMBOLS = b"#*$%&|<>"
REPEAT = 8
WORK = ("_q_", "_q_base_failed", "_q_kept")
MEASURES = ("chars_per_token", "fallback_share", "entropy")
#: Bins per unit in which the measures are counted.
BINS = 200
#: Least half width of a band: characters a token (as a part of the median), share, bits.
LEAST_HALF = {"chars_per_token": 0.08, "fallback_share": 0.02, "entropy": 0.6}
#: First code points of the blocks that tell a script (Unicode block table), and their scripts.
SCRIPTS = (
    (0x0000, "other"), (0x0041, "latin"), (0x0250, "other"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"),
    (0x0590, "hebrew"), (0x0600, "arabic"), (0x0900, "indic"), (0x0E00, "thai"), (0x0E80, "other"), (0x1100, "hangul"),
    (0x1200, "other"), (0x1E00, "latin"), (0x1F00, "greek"), (0x2000, "other"), (0x3040, "kana"), (0x3100, "other"),
    (0x3400, "han"), (0xA000, "other"), (0xAC00, "hangul"), (0xD7B0, "other"),
)
_FIRST = np.array([x for x, _ in SCRIPTS])
_MIX = np.random.default_rng(8).integers(1, 1 << 63, REPEAT, dtype=np.uint64) | np.uint64(1)


def main_script(text: str) -> str:
    block = np.searchsorted(_FIRST, np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32), "right") - 1
    count: dict[str, int] = {}
    for i, n in enumerate(np.bincount(block, minlength=len(SCRIPTS)).tolist()):
        count[SCRIPTS[i][1]] = count.get(SCRIPTS[i][1], 0) + n
    count["other"] = 0
    return max(sorted(count), key=count.get)


def repeated_words(words: list[bytes], window: int = REPEAT) -> int:
    """Words within windows of ``window`` words that come twice or more."""
    if len(words) <= window:
        return 0
    seen: dict[bytes, int] = {}
    ids = np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.uint64, len(words))
    if len(seen) == len(words):
        return 0
    m = len(ids) - window + 1
    mixed = np.zeros(m, np.uint64)
    for k in range(window):
        mixed += ids[k : k + m] * _MIX[k]
    order = np.sort(mixed)
    twice = order[1:][order[1:] == order[:-1]]
    if not len(twice):
        return 0
    at = np.flatnonzero(np.isin(mixed, twice))  # equal windows are among these; now by the words themselves
    _, which, count = np.unique(np.lib.stride_tricks.sliding_window_view(ids, window)[at], axis=0, return_inverse=True, return_counts=True)
    change = np.zeros(len(ids) + 1, np.int64)
    hit = at[count[which.ravel()] > 1]
    np.add.at(change, hit, 1)
    np.add.at(change, hit + window, -1)
    return int((np.cumsum(change[:-1]) > 0).sum())


def measures(text: str | None, bpe: str, pieces: str) -> tuple:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_tokens and the three MEASURES."""
    text = text or ""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    lines = [x for x in raw.split(b"\n") if x.strip(SPACES)]
    ids = vocab.encode(bpe, text)
    entropy = 0.0
    if len(ids):
        n = np.unique(ids, return_counts=True)[1]
        entropy = float(np.log2(len(ids)) - (n * np.log2(n)).sum() / len(ids))
    return (
        len(words), len(text) - (len(raw) - len(raw.translate(None, SPACES))), len(raw) - len(raw.translate(None, SYMBOLS)),
        len(lines) - len(set(lines)), repeated_words(words), len(ids),
        len(text) / len(ids) if len(ids) else 0.0, min(1.0, vocab.fallback_bytes(pieces, text) / len(raw)) if raw else 0.0, entropy,
    )


def digest(text: str | None) -> bytes:
    """A 128-bit hash of the whole text, each run of white space as one space."""
    return xxhash.xxh3_128_digest(b" ".join((text or "").encode("utf-8", "surrogatepass").split()))


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_tokens")


def measured(docs: DataFrame, text_col: str = "text", lang_col: str | None = "lang", bpe: str | None = None, pieces: str | None = None) -> DataFrame:
    """``docs`` with ``_q_``: the counts and measures of each text, its language or script, and a digest of its words."""
    bpe = bpe or vocab.vocabulary_path("byte_bpe_50k.tiktoken")
    pieces = pieces or vocab.vocabulary_path("piece_bpe_32k.model")
    fields = [f"{c} long" for c in COUNTS] + [f"{c} double" for c in MEASURES] + ["kind string", "digest binary"]

    @F.pandas_udf(", ".join(fields))
    def measure(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for texts, langs in batches:
            rows = [
                (*measures(t, bpe, pieces), lang if lang is not None else main_script(t or ""), digest(t))
                for t, lang in zip(texts, langs, strict=True)
            ]
            yield pd.DataFrame(rows, columns=[*COUNTS, *MEASURES, "kind", "digest"])

    lang = F.col(lang_col).cast("string") if lang_col else F.lit(None).cast("string")
    return bounded(docs).withColumn("_q_", measure(F.col(text_col), lang))


def base_failed(q: str = "_q_") -> Column:
    return (F.col(f"{q}.n_words") < 20) | (100 * F.col(f"{q}.n_repeat_words") > 30 * F.col(f"{q}.n_words"))


def length_class(q: str = "_q_") -> Column:
    return F.floor(F.log2(F.greatest(F.col(f"{q}.n_tokens"), F.lit(1)))).cast("int")


def _median(counted: DataFrame, keys: list[str], value: str, name: str) -> DataFrame:
    """Median of ``value`` by keys, from (keys, value, n)."""
    w = Window.partitionBy(*keys)
    upto = F.sum("n").over(w.orderBy(value))
    return (
        counted.select(*keys, value, upto.alias("upto"), F.sum("n").over(w).alias("all"))
        .where(2 * F.col("upto") >= F.col("all")).groupBy(*keys).agg(F.min(value).alias(name), F.max("all").alias("docs"))
    )


def bands(found: DataFrame, width: float = 6.0) -> DataFrame:
    """(kind, class, measure, docs, low, high); class -1: any length, kind '*': any language or script.

    Each different text counts once. Counts by bin first: what the medians are taken from is at most bins by kinds by classes.
    """
    once = found.where(~base_failed()).groupBy(F.col("_q_.kind").alias("kind"), length_class().alias("class"), F.col("_q_.digest").alias("digest")).agg(
        F.min(F.struct(*[F.round(F.col(f"_q_.{m}") * BINS).cast("long").alias(m) for m in MEASURES])).alias("bins"))
    good = once.select(
        "kind", "class", F.explode(F.array(*[F.struct(F.lit(m).alias("measure"), F.col(f"bins.{m}").alias("bin")) for m in MEASURES])).alias("x"),
    ).groupBy("kind", "class", "x.measure", "x.bin").agg(F.count(F.lit(1)).alias("n"))
    good = written(good, "quality-counts")
    levels = good.unionByName(good.withColumn("class", F.lit(-1))).unionByName(good.withColumn("class", F.lit(-1)).withColumn("kind", F.lit("*")))
    keys = ["kind", "class", "measure"]
    levels = levels.groupBy(*keys, "bin").agg(F.sum("n").alias("n"))
    middle = _median(levels, keys, "bin", "mid")
    off = levels.join(middle.select(*keys, "mid"), keys).select(*keys, F.abs(F.col("bin") - F.col("mid")).alias("off"), "n").groupBy(*keys, "off").agg(F.sum("n").alias("n"))
    spread = _median(off, keys, "off", "mad").select(*keys, "mad")
    half = F.lit(width * 1.4826) * F.col("mad") / BINS
    least = F.create_map(*[F.lit(x) for m in LEAST_HALF.items() for x in m])[F.col("measure")] * F.when(
        F.col("measure") == "chars_per_token", F.col("mid") / BINS
    ).otherwise(F.lit(1.0))
    half = F.greatest(half, least)
    mid = F.col("mid") / BINS
    # Only unusually many fallback bytes and unusually little entropy speak against a text.
    return middle.join(spread, keys).select(
        *keys, "docs",
        F.when(F.col("measure") == "fallback_share", F.lit(0.0)).otherwise(mid - half).alias("low"),
        F.when(F.col("measure") == "entropy", F.lit(64.0)).otherwise(mid + half).alias("high"),
    )


def judged(found: DataFrame, width: float = 6.0, least: int = 30) -> DataFrame:
    """``found`` (a written table with ``_q_``) with _q_base_failed and _q_kept."""
    limits = written(bands(found, width), "quality-bands")
    pivot = lambda rows, keys: rows.groupBy(*keys).agg(
        *[F.max(F.when(F.col("measure") == m, F.struct("low", "high"))).alias(m) for m in MEASURES]
    )
    enough = limits.where(F.col("docs") >= least)
    exact = written(pivot(enough.where("class >= 0"), ["kind", "class"]).select(
        F.col("kind").alias("_q_k1"), F.col("class").alias("_q_c1"), F.struct(*MEASURES).alias("_q_b1")), "quality-bands")
    kind = written(pivot(enough.where("class = -1 and kind <> '*'"), ["kind"]).select(F.col("kind").alias("_q_k2"), F.struct(*MEASURES).alias("_q_b2")), "quality-bands")
    every = written(pivot(limits.where("kind = '*'"), ["kind"]).select(F.col("kind").alias("_q_k3"), F.struct(*MEASURES).alias("_q_b3")), "quality-bands")
    placed = looked_up(found, exact, {"_q_k1": F.col("_q_.kind"), "_q_c1": length_class()}, "left")
    placed = looked_up(looked_up(placed, kind, {"_q_k2": F.col("_q_.kind")}, "left"), every, {"_q_k3": F.lit("*")}, "left")
    band = F.coalesce("_q_b1", "_q_b2", "_q_b3")
    within = F.lit(True)
    for m in MEASURES:
        within &= F.coalesce(F.col(f"_q_.{m}").between(band[m]["low"], band[m]["high"]), F.lit(True))
    return placed.withColumn("_q_base_failed", base_failed()).withColumn("_q_kept", ~base_failed() & within).drop("_q_b1", "_q_b2", "_q_b3")


def keep_good(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``docs`` without the rejected rows; columns as they were."""
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    found = written(measured(whole).select("row", "_q_"), "quality-docs")
    return judged(found).where("_q_kept").select("row.*")
