"""Secret scan with a trigram inverted index.

From each rule's regular expression a Boolean query of trigrams is derived that every match must
satisfy. The texts are indexed in shards of a few hundred rows: one pass over a text's trigrams gives
those that some query mentions, and their postings are the rows that contain them (as a bitmap). Queries
are answered by intersecting and uniting postings, and only the candidates are verified with the
expression; a rule without mandatory trigrams scans every text of the shard. Index, query and
verification of a shard are one step over the whole text, so nothing is shuffled and a lost task only
repeats its shard. All rules share a shard's index; ``postings`` keeps it as a table for further runs, and
``candidates`` answers a rule from that table without reading a text.

Spans are code points, end exclusive, leftmost and non-overlapping per rule; a match that a rule's
check refuses is dropped without another try.

Defined results: a null text counts as empty and has no spans; repeated rows are each scanned; an
empty table gives an empty result; other columns pass through. The span column is ``_sec_spans``, in
place of an input column of this name.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from functools import reduce
from re import _constants as op
from re import _parser as parser

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.llm.batches import bounded

#: Texts in a shard of the index.
SHARD = 512


def entropy(value: str) -> float:
    n = [value.count(c) for c in set(value)]
    return -sum(x / len(value) * math.log2(x / len(value)) for x in n)


@dataclass(frozen=True)
class Rule:
    kind: str
    pattern: str
    #: Length that ``group`` of a match must have at least.
    least: int = 0
    group: int = 0
    flags: int = 0
    check: Callable[[re.Match], bool] | None = field(default=None, compare=False)


#: Fixed patterns of the base rules, in the order in which spans of one start are listed.
BASE = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", least=12, group=2, flags=re.ASCII),
    Rule("access", r"AKIA[A-Z0-9]+", least=18),
    Rule("hex", r"[0-9a-f]+", least=16),
)
#: Fixed patterns: published token formats of well-known services, and free-standing random strings.
MORE = (
    Rule("private_key", r"-----BEGIN (?:[A-Z]+ )?PRIVATE KEY-----"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("git_token", r"(?:ghp|gho|ghs|ghr|glpat)[_-][A-Za-z0-9_-]{20,}"),
    Rule("chat_token", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("map_key", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("pay_key", r"(?:sk|rk)_live_[A-Za-z0-9]{16,}"),
    Rule("url_login", r"[a-z]{3,12}://[A-Za-z0-9._%-]+:[^\s:@/]{4,64}@[A-Za-z0-9.-]+"),
    Rule(
        "random", r"[A-Za-z0-9+/]{32,}={0,2}",
        check=lambda m: entropy(m[0]) >= 4.3 and bool(re.search(r"[a-z]", m[0]) and re.search(r"[A-Z]", m[0]) and re.search(r"[0-9]", m[0])),
    ),
)
RULES = BASE + MORE

# A query is True (no condition), a trigram, ("and", ...) or ("or", ...).
Query = bool | str | tuple


def _both(a: Query, b: Query) -> Query:
    return b if a is True else a if b is True else ("and", a, b)


def _either(parts: list[Query]) -> Query:
    return True if any(p is True for p in parts) else parts[0] if len(parts) == 1 else ("or", *parts)


def _grams(texts: set[str]) -> Query:
    """What holds for a text that contains one of ``texts``."""
    parts: list[Query] = []
    for t in sorted(texts):
        q: Query = True
        for i in range(len(t) - 2):
            q = _both(q, t[i : i + 3])
        parts.append(q)
    return _either(parts)


#: Alternatives up to which strings are kept exactly.
EXACT = 24


def _walk(tree) -> tuple[set[str] | None, Query]:
    """(the strings it matches if they are few, else None; a condition on any match)."""
    runs: set[str] | None = {""}  # strings that end here, exactly known since the last gap
    query: Query = True
    for kind, arg in tree:
        exact, own = _one(kind, arg)
        if exact is not None and runs is not None and len(runs) * len(exact) <= EXACT:
            runs = {a + b for a in runs for b in exact}
            continue
        if runs is not None:
            query = _both(query, _grams(runs))
        if exact is None:
            query, runs = _both(query, own), {""}
        else:
            runs = exact
    return (runs, query) if query is True and _whole(tree) else (None, _both(query, _grams(runs)))


def _whole(tree) -> bool:
    """Whether every part of the tree is exactly known."""
    return all(_one(kind, arg)[0] is not None for kind, arg in tree)


def _one(kind, arg) -> tuple[set[str] | None, Query]:
    if kind is op.LITERAL:
        return {chr(arg).lower()}, True
    if kind is op.SUBPATTERN:
        return _walk(arg[3])
    if kind is op.BRANCH:
        found = [_walk(x) for x in arg[1]]
        if all(x is not None for x, _ in found) and sum(len(x) for x, _ in found) <= EXACT:
            return set().union(*(x for x, _ in found)), True
        return None, _either([q if x is None else _grams(x) for x, q in found])
    if kind in (op.MAX_REPEAT, op.MIN_REPEAT, op.POSSESSIVE_REPEAT):
        least, most, inner = arg
        exact, query = _walk(inner)
        if exact is not None and most is not parser.MAXREPEAT and most <= 1:
            return (exact | {""}) if least == 0 else exact, True
        return None, (True if least == 0 else query if exact is None else _grams(exact))
    if kind is op.IN and all(k is op.LITERAL for k, _ in arg) and len(arg) <= 4:
        return {chr(x).lower() for _, x in arg}, True
    if kind in (op.AT, op.ASSERT, op.ASSERT_NOT):
        return {""}, True
    return None, True


def trigram_query(pattern: str) -> Query:
    """A condition on the lower-cased trigrams of any text with a match; True if there is none."""
    exact, query = _walk(parser.parse(pattern))
    return query if exact is None else _both(query, _grams(exact))


def trigrams_of(query: Query) -> set[str]:
    return set() if query is True else {query} if isinstance(query, str) else set().union(*map(trigrams_of, query[1:]))


def answer(query: Query, postings: dict[str, np.ndarray], rows: int) -> np.ndarray:
    if query is True:
        return np.ones(rows, bool)
    if isinstance(query, str):
        return postings[query]
    parts = [answer(q, postings, rows) for q in query[1:]]
    return np.logical_and.reduce(parts) if query[0] == "and" else np.logical_or.reduce(parts)


class Grams:
    """The trigrams that some query mentions, numbered; found in a text by one pass over its bytes.

    Trigrams of other than ASCII characters are left out: a query that needs one is true for all texts.
    """

    def __init__(self, grams: set[str]):
        self.names = sorted(grams)
        self.number = np.full(1 << 21, -1, np.int32)
        for i, g in enumerate(self.names):
            a, b, c = g.encode("ascii")
            self.number[(a << 14) | (b << 7) | c] = i

    def of(self, text: str) -> np.ndarray:
        """Numbers of the wanted trigrams in the lower-cased text."""
        data = np.frombuffer(text.lower().encode("utf-8", "surrogatepass"), np.uint8)
        if len(data) < 3:
            return np.zeros(0, np.int32)
        low = (data & 127).astype(np.int32)
        code = (low[:-2] << 14) | (low[1:-1] << 7) | low[2:]
        found = self.number[code]
        at = np.flatnonzero(found >= 0)
        if len(at) and not text.isascii():
            wide = data >= 128
            at = at[~(wide[at] | wide[at + 1] | wide[at + 2])]
        return np.unique(found[at])


def index(texts: list[str], grams: Grams) -> dict[str, np.ndarray]:
    """Postings of the wanted trigrams: for each, the rows whose lower-cased text contains it."""
    table = np.zeros((len(grams.names), len(texts)), bool)
    for row, text in enumerate(texts):
        table[grams.of(text), row] = True
    return dict(zip(grams.names, table, strict=True))


def matches(rule: Rule, text: str) -> Iterator[tuple[int, int]]:
    for m in re.finditer(rule.pattern, text, rule.flags):
        if len(m[rule.group]) >= rule.least and (rule.check is None or rule.check(m)):
            yield m.span()


def scan_shard(texts: list[str], rules: tuple[Rule, ...], queries: list[Query], grams: Grams) -> list[list[tuple[int, str, int]]]:
    """(start, kind, end) of each text, by start and then by the order of the rules."""
    found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    held = index(texts, grams)
    for k, (rule, query) in enumerate(zip(rules, queries, strict=True)):
        for row in np.flatnonzero(answer(query, held, len(texts))).tolist():
            found[row] += [(start, k, end) for start, end in matches(rule, texts[row])]
    return [[(start, rules[k].kind, end) for start, k, end in sorted(x)] for x in found]


def queries_of(rules: tuple[Rule, ...]) -> tuple[list[Query], set[str]]:
    """Each rule's query, and all their trigrams."""
    queries = [q if all(map(str.isascii, trigrams_of(q))) else True for q in (trigram_query(r.pattern) for r in rules)]
    return queries, set().union(*map(trigrams_of, queries))


def scan(docs: DataFrame, text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``docs`` with ``_sec_spans``: array of (kind, start, end)."""
    queries, wanted = queries_of(rules)

    @F.pandas_udf("array<struct<kind string, start long, end long>>")
    def spans(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        grams = Grams(wanted)
        for batch in batches:
            texts = [t or "" for t in batch]
            out: list = []
            for at in range(0, len(texts), SHARD):
                out += [
                    [{"kind": kind, "start": start, "end": end} for start, kind, end in row]
                    for row in scan_shard(texts[at : at + SHARD], rules, queries, grams)
                ]
            yield pd.Series(out, dtype=object)

    return bounded(docs).withColumn("_sec_spans", spans(F.col(text_col)))


def postings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The index as a table (gram, shard, ids): the ids of a shard's texts that contain the trigram, for the rules' trigrams.

    A shard is a batch of texts of one task, so a posting is bounded however frequent its trigram is.
    """
    wanted = queries_of(rules)[1]
    ids = docs.schema[id_col].dataType.simpleString()

    def indexed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        grams = Grams(wanted)
        for batch in batches:
            for at in range(0, len(batch), SHARD):
                part = batch.iloc[at : at + SHARD]
                key = part["id"].to_numpy(object)
                held = index([t or "" for t in part["text"]], grams)
                some = [(g, str(part["place"].iloc[0]), key[rows].tolist()) for g, rows in held.items() if rows.any()]
                yield pd.DataFrame(some, columns=["gram", "shard", "ids"])

    source = bounded(docs).select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text"), F.monotonically_increasing_id().alias("place"))
    return source.mapInPandas(indexed, "gram string, shard string, ids array<string>").withColumn("ids", F.col("ids").cast(f"array<{ids}>"))


def candidates(held: DataFrame, rule: Rule) -> DataFrame | None:
    """(id) of the texts that may have a match, from the table of ``postings``; None where every text may."""
    query = queries_of((rule,))[0][0]
    if query is True:
        return None

    def of(q: Query) -> DataFrame:
        if isinstance(q, str):
            return held.where(F.col("gram") == q).select(F.explode("ids").alias("id"))
        parts = [of(p) for p in q[1:]]
        return reduce(DataFrame.intersect if q[0] == "and" else DataFrame.union, parts)

    return of(query).distinct()
