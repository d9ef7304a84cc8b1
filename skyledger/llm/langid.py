"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Document frequencies are counted over every text that has a label. The classifier is fitted by
follow-the-regularised-leader (FTRL-proximal, elastic net) on a bounded sample of the labelled rows:
at most ``per_language`` of each language and ``rows`` in all, those with the smallest hash of
identifier and text, of which equal ones count once. A hash threshold for each language, from its count,
picks them in the scan, so that no language is gathered whole. A fifth of the sample is set aside to
fit the temperature that calibrates the probabilities. N-grams are hashed to BUCKETS, where different ones
may share a weight; the model (buckets x languages) is bounded.

Defined results: a null text or one without a letter is ``und`` with score 0; so is every text where
there is nothing to learn from; rows with a null or empty label aren't learned from; ties go to the
language first in code point order; repeated rows get equal results; an empty table gives an empty
result; other columns pass through. ``identify`` adds ``_li_lang`` and ``_li_score``, in place of input
columns of these names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.llm.batches import bounded
from skyledger.sources.shared import looked_up, written

#: Buckets the n-grams are hashed to, n-gram lengths, rows a language and all languages are learned from at most.
BUCKETS, ORDERS, PER_LANGUAGE, ROWS = 1 << 16, (1, 2, 3), 512, 16_384
UNDETERMINED = "und"
_MIX = np.uint64(0x9E3779B97F4A7C15)
_SPACE = np.ones(1 << 16, bool)
_SPACE[[i for i in range(1 << 16) if chr(i).isalpha()]] = False


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(buckets, counts) of the n-grams of a lower-cased text; a run of other characters is one space."""
    codes = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    gap = _SPACE[np.minimum(codes, 0xFFFF)] & (codes < 0x10000)
    codes = np.where(gap, np.uint64(32), codes)[~(gap & np.append(False, gap[:-1]))]
    grams, keys = np.zeros_like(codes), []
    for n in range(1, max(ORDERS) + 1):
        grams = (grams[: len(codes) - n + 1] * np.uint64(1_000_003)) + codes[n - 1 :] + np.uint64(n)
        if n in ORDERS:
            keys.append((grams * _MIX >> np.uint64(48)).astype(np.int64))
    count = np.bincount(np.concatenate(keys), minlength=BUCKETS)
    found = np.flatnonzero(count)
    return found.astype(np.int32), count[found]


def vector(found: np.ndarray, count: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = (1 + np.log(count)) * idf[found]
    return x / np.sqrt((x * x).sum())


@dataclass
class Model:
    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray  # buckets x languages
    temperature: float = 1.0

    def predict(self, text: str | None) -> tuple[str, float]:
        if not self.languages or not has_letter(text):
            return UNDETERMINED, 0.0
        found, count = features(text)
        p = softmax(vector(found, count, self.idf) @ self.weights[found] / self.temperature)
        return self.languages[int(p.argmax())], float(p.max())


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def ftrl(rows: list[tuple[np.ndarray, np.ndarray, int]], classes: int, epochs: int = 4, alpha: float = 2.0, beta: float = 1.0, l1: float = 0.02, l2: float = 0.1) -> np.ndarray:
    """Weights of a softmax regression by FTRL-proximal with per-coordinate rates and elastic-net penalties."""
    z, n = np.zeros((BUCKETS, classes)), np.zeros((BUCKETS, classes))

    def weights(at: np.ndarray | slice) -> np.ndarray:
        return np.where(np.abs(z[at]) <= l1, 0.0, -(z[at] - np.sign(z[at]) * l1) / ((beta + np.sqrt(n[at])) / alpha + l2))

    for _ in range(epochs):
        for found, x, y in rows:
            w = weights(found)
            p = softmax(x @ w)
            p[y] -= 1
            g = x[:, None] * p[None, :]
            z[found] += g - (np.sqrt(n[found] + g * g) - np.sqrt(n[found])) / alpha * w
            n[found] += g * g
    return weights(slice(None))


def fitted_temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The temperature with the least negative log likelihood, by golden section on its logarithm.

    The labels are smoothed by one wrong one in all, so that rows without an error don't ask for certainty.
    """
    n, classes = logits.shape
    if not n or classes < 2:
        return 1.0
    target = np.full((n, classes), 1 / (n + 2) / (classes - 1))
    target[np.arange(n), labels] = (n + 1) / (n + 2)
    loss = lambda t: -(target * np.log(softmax(logits / np.exp(t)) + 1e-12)).sum(axis=1).mean()
    a, b, r = np.log(0.02), np.log(20.0), (5**0.5 - 1) / 2
    for _ in range(60):
        c, d = b - r * (b - a), a + r * (b - a)
        a, b = (a, d) if loss(c) < loss(d) else (c, b)
    return float(np.exp((a + b) / 2))


def document_frequencies(texts: DataFrame) -> tuple[np.ndarray, int]:
    """(documents by bucket, documents), over all rows of the one column ``text``."""

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        df, n = np.zeros(BUCKETS, np.int64), 0
        for batch in batches:
            for text in batch["text"]:
                if has_letter(text):
                    df[features(text)[0]] += 1
                    n += 1
        at = np.flatnonzero(df)
        yield pd.DataFrame({"bucket": np.append(at, -1).astype(np.int32), "n": np.append(df[at], n)})

    rows = bounded(texts).mapInPandas(counted, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()
    df = np.zeros(BUCKETS, np.int64)
    inner = rows[rows["bucket"] >= 0]
    df[inner["bucket"].to_numpy()] = inner["n"].to_numpy()
    return df, int(rows.loc[rows["bucket"] < 0, "n"].sum())


def sampled(labelled: DataFrame, per_language: int, rows: int) -> DataFrame:
    """(lang, h, text): the rows of (text, lang, h) with the smallest hashes of each language, at most as many as given.

    What a language's threshold lets through is a few standard deviations more than wanted, whatever the table's size.
    """
    counts = written(labelled.select("lang", "h").distinct().groupBy("lang").agg(F.count(F.lit(1)).alias("n")), "langid-counts")  # copies count once
    wanted = max(1, min(per_language, rows // max(1, counts.count())))
    share = (wanted + 8 * wanted**0.5 + 16) / F.col("n")
    few = written(counts.select(F.col("lang").alias("_of"), F.least(share, F.lit(1.0)).alias("share")), "langid-shares")
    place = F.shiftrightunsigned("h", 11) / F.lit(float(1 << 53))  # uniform in [0, 1)
    near = looked_up(labelled, few, {"_of": F.col("lang")}).where(place < F.col("share")).select("lang", "h", "text")
    # Equal rows have equal hashes and count once; what is gathered of a language is bounded by now.
    near = written(near.groupBy("lang", "h").agg(F.min("text").alias("text")), "langid-near")
    ends = near.select("lang", "h").groupBy("lang").agg(F.sort_array(F.collect_list(F.shiftrightunsigned("h", 1))).alias("hs"))
    end = ends.select(F.col("lang").alias("_of"), F.element_at("hs", F.least(F.size("hs"), F.lit(wanted))).alias("end"))
    return looked_up(near, written(end, "langid-ends"), {"_of": F.col("lang")}).where(F.shiftrightunsigned("h", 1) <= F.col("end")).drop("end")


def train(docs: DataFrame, key: Column, text_col: str = "text", lang_col: str = "lang", per_language: int = PER_LANGUAGE, rows: int = ROWS) -> Model:
    """A model of the rows of ``docs`` with a label; ``key`` orders the rows of a language by its hash."""
    labelled = docs.select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang"), F.xxhash64(key, F.col(text_col)).alias("h")).where(
        "lang is not null and lang <> '' and text is not null"
    )
    df, n = document_frequencies(labelled.select("text"))

    def featured(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            batch = batch[[has_letter(t) for t in batch["text"]]]
            found = [features(t) for t in batch["text"]]
            yield pd.DataFrame({"lang": batch["lang"], "h": batch["h"], "found": [a for a, _ in found], "count": [c for _, c in found]})

    found = sampled(labelled, per_language, rows).mapInPandas(featured, "lang string, h long, found array<int>, count array<long>").toPandas()
    found["h"] = found["h"].to_numpy(np.int64).view(np.uint64)
    found = found.sort_values(["lang", "h"], ignore_index=True)
    found["rank"] = found.groupby("lang").cumcount() + 1
    rows = found.sort_values(["rank", "lang"], ignore_index=True)
    languages = sorted(set(rows["lang"]), key=lambda x: x.encode())
    idf = np.log((1 + n) / (1 + df)) + 1
    if not languages:
        return Model([], idf, np.zeros((BUCKETS, 0)))
    at = {lang: i for i, lang in enumerate(languages)}
    data = [(np.asarray(f), vector(np.asarray(f), np.asarray(c), idf), at[lang]) for lang, f, c in zip(rows["lang"], rows["found"], rows["count"], strict=True)]
    aside = (rows["rank"] % 5 == 0).to_numpy()
    weights = ftrl([x for x, out in zip(data, aside, strict=True) if not out], len(languages))
    held = [x for x, out in zip(data, aside, strict=True) if out]
    logits = np.array([x @ weights[f] for f, x, _ in held]).reshape(len(held), len(languages))
    return Model(languages, idf, weights, fitted_temperature(logits, np.array([y for _, _, y in held], int)))


def identify(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with ``_li_lang`` and ``_li_score``."""
    shared_model = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang string, score double")
    def predict(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([shared_model.value.predict(t) for t in texts], columns=["lang", "score"])

    others = [F.col(f"`{c}`") for c in docs.columns if c not in ("_li_lang", "_li_score")]
    found = bounded(docs).select(F.struct(*others).alias("row"), predict(F.col(text_col)).alias("found"))
    return found.select("row.*", F.col("found.lang").alias("_li_lang"), F.col("found.score").alias("_li_score"))
