"""Spelling variants: words one edit apart, by composing automata, and the usual form of each.

Two words are near if they differ by one inserted, deleted or replaced code point. Pairs are what the composition
vocabulary . one edit . vocabulary accepts, where the vocabulary is a minimal acyclic acceptor and the transducer has two
states: before the edit, in which both sides stand in the same state of the acceptor, and after it, in which both read the same.

The composition is cut by initial state. If the shorter word of a pair has m code points, the edit comes after its first
m // 2 code points or before its last m - m // 2. So a word of L code points is dealt out four times: for m = L and m = L - 1, by its
beginning to the forward acceptor and by its end to the one that reads backwards. The state reached over the shared part is the
initial state of a composition of its own. A pair found backwards counts only if forwards can't find it, and the edit stands at the
last place it can, so each pair is found once. Words that share no part are never compared.

Parts are dealt to shards by hash. A part with more than ``hot`` words is dealt block by block: each two of its blocks meet in one
task, so no task holds more than about two blocks of a part, and no pair is lost. Equal states are shared over a shard.

Counts come from one pass over the texts and one grouping by word, added up in each task first. The root of a word is found by
pointer doubling over the words that have a form; counts grow tenfold along the way, so few steps do.

Defined results: a null text has no words; a null id is the text ``null`` in the hash; runs and words of any length are handled
(automata are walked without recursion); rows that repeat an id repeat their words; ties go to the word that is smaller by code points;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.sources.shared import looked_up, written

#: Code points and occurrences a word has at least; the form of a word comes this many times as often at least.
LEAST_LENGTH, LEAST_COUNT, RATIO = 7, 2, 10
LETTER = r"[A-Za-zÀ-ÿ]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Words of a part that meet in one task; memberships in a shard on average.
HOT, SHARD_WORDS = 20_000, 40_000

State = int


class Acceptor:
    """A minimal acyclic acceptor: states with equal right languages are one state, over all words put in."""

    def __init__(self):
        self.arcs: list[dict[str, State]] = []
        self.final: list[bool] = []
        self._known: dict[tuple, State] = {}

    def _state(self, arcs: dict[str, State], final: bool) -> State:
        found = self._known.setdefault((final, *arcs.items()), len(self.arcs))
        if found == len(self.arcs):
            self.arcs.append(arcs)
            self.final.append(final)
        return found

    def add(self, words: list[str], skip: int) -> State:
        """The state from which what follows the first ``skip`` code points of the words (sorted, different) is accepted."""
        open_: list[tuple[dict[str, State], bool]] = [({}, False)]
        before = ""
        for word in words:
            word = word[skip:]
            same, most = 0, min(len(word), len(before))
            while same < most and word[same] == before[same]:
                same += 1
            self._close(open_, before, same)
            open_ += [({}, False) for _ in range(len(word) - same)]
            open_[-1] = (open_[-1][0], True)
            before = word
        self._close(open_, before, 0)
        return self._state(*open_[0])

    def _close(self, open_: list[tuple[dict[str, State], bool]], word: str, depth: int) -> None:
        while len(open_) > depth + 1:
            state = self._state(*open_.pop())
            open_[-1][0][word[len(open_) - 1]] = state

    def common(self, a: State, b: State, not_first: str = "") -> list[str]:
        """What both states accept; nothing that begins with ``not_first``."""
        found, path = [], []
        stack: list[tuple[State, State, int, str]] = [(a, b, 0, "")]
        while stack:
            a, b, depth, symbol = stack.pop()
            if depth:
                del path[depth - 1 :]
                path.append(symbol)
            if self.final[a] and self.final[b]:
                found.append("".join(path))
            ours, theirs = self.arcs[a], self.arcs[b]
            for c in ours.keys() & theirs.keys() if len(ours) > 1 and len(theirs) > 1 else [c for c in ours if c in theirs]:
                if depth or c != not_first:
                    stack.append((ours[c], theirs[c], depth + 1, c))
        return found

    def one_edit_apart(self, start: State) -> list[tuple[str, str]]:
        """Pairs accepted from ``start`` that differ by one edit: (longer, shorter), or two of one length in code point order."""
        pairs, path = [], []
        stack: list[tuple[State, int, str]] = [(start, 0, "")]
        while stack:
            state, depth, symbol = stack.pop()
            if depth:
                del path[depth - 1 :]
                path.append(symbol)
            arcs = self.arcs[state]
            if len(arcs) > 1 or self.final[state]:  # else both sides go on alike
                lead = "".join(path)
                for c, after in arcs.items():
                    pairs += [(lead + c + rest, lead + rest) for rest in self.common(after, state, c)]
                if len(arcs) > 1:
                    several = sorted(arcs)
                    for i, c in enumerate(several):
                        for d in several[i + 1 :]:
                            pairs += [(lead + c + rest, lead + d + rest) for rest in self.common(arcs[c], arcs[d])]
            for c, after in arcs.items():
                stack.append((after, depth + 1, c))
        return pairs


def common_prefix(a: str, b: str) -> int:
    n = 0
    while n < min(len(a), len(b)) and a[n] == b[n]:
        n += 1
    return n


def near_in_part(acceptor: Acceptor, words: list[str], m: int, backwards: bool) -> list[tuple[str, str]]:
    """Near pairs whose shorter word has m code points, among words of m and m + 1 that share their beginning (or end)."""
    if backwards:
        start = acceptor.add(sorted(w[::-1] for w in words), m - m // 2)
        tail = words[0][::-1][: m - m // 2]
        pairs = [((tail + a)[::-1], (tail + b)[::-1]) for a, b in acceptor.one_edit_apart(start)]
        return [(a, b) for a, b in pairs if min(len(a), len(b)) == m and common_prefix(a, b) < m // 2]
    start = acceptor.add(sorted(words), m // 2)
    head = words[0][: m // 2]
    return [(head + a, head + b) for a, b in acceptor.one_edit_apart(start) if min(len(a), len(b)) == m - m // 2]


def counted_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """(word, n) of the runs of letters, one in 31 with a code point left out, by a hash of id and run."""
    run = F.col("run")
    lowered = F.when(F.octet_length(run) == F.char_length(run), F.lower(run)).otherwise(F.translate(run, UPPER, LOWER))
    h = F.crc32(F.concat(F.coalesce(F.col("id"), F.lit("null")), F.lit(":"), F.col("low")))
    cut = F.overlay("low", F.lit(""), (h % F.char_length("low") + 1).cast("int"), F.lit(1))
    runs = docs.select(F.col(id_col).cast("string").alias("id"), F.explode(F.regexp_extract_all(F.col(text_col), F.lit(f"{LETTER}{{{least_length},}}"), F.lit(0))).alias("run"))
    words = runs.select("id", lowered.alias("low")).select(F.when(h % 31 == 0, cut).otherwise(F.col("low")).alias("word"))
    return words.where(F.char_length("word") >= least_length).groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least_count)


def parts_of(words: DataFrame, least_length: int) -> DataFrame:
    """(m, backwards, part, word, n): each word under the parts in which it may meet near ones."""
    length = F.char_length("word")
    each = words.select("word", "n", F.explode(F.when(length > least_length, F.array(length, length - 1)).otherwise(F.array(length))).alias("m"))
    half = F.floor(F.col("m") / 2).cast("int")
    hashed = lambda back, piece: F.struct(F.lit(back).alias("backwards"), F.xxhash64(F.col("m"), F.lit(back), piece).alias("part"))
    sides = F.array(hashed(False, F.substring(F.col("word"), 1, half)), hashed(True, F.right("word", F.col("m") - half)))
    return each.select("m", "word", "n", F.explode(sides).alias("s")).select("m", "s.backwards", "s.part", "word", "n")


def blocks_met(parts: DataFrame, hot: int) -> DataFrame:
    """``parts`` with block, low and high: words of a part of more than ``hot`` go to each two blocks that hold theirs."""
    sizes = written(parts.groupBy("part").agg(F.count(F.lit(1)).alias("size")).where(F.col("size") > hot).select("part", F.ceil(F.col("size") / hot).cast("int").alias("blocks")), "spelling-hot")
    known = looked_up(parts.withColumnRenamed("part", "own"), sizes, {"part": F.col("own")}, "left").withColumnRenamed("own", "part")
    block = F.pmod(F.xxhash64("word"), F.coalesce("blocks", F.lit(1))).cast("int")
    met = F.transform(F.sequence(F.lit(0), F.coalesce("blocks", F.lit(1)) - 1), lambda x: F.struct(F.least(x, F.col("block")).alias("low"), F.greatest(x, F.col("block")).alias("high")))
    return known.withColumn("block", block).withColumn("met", F.explode(met)).select("m", "backwards", "part", "word", "n", "block", "met.low", "met.high")


def near_words(words: DataFrame, least_length: int = LEAST_LENGTH, hot: int = HOT, shard_words: int = SHARD_WORDS) -> DataFrame:
    """(word, n_near, best): near words counted, and the one that comes most often, as (n, word)."""
    met = blocks_met(parts_of(words, least_length), hot)
    shards = max(6, -(-4 * words.count() // shard_words))

    def compose(shard: pd.DataFrame) -> pd.DataFrame:
        acceptor, found = Acceptor(), {}
        count = dict(zip(shard["word"], shard["n"], strict=True))
        crossed = shard[shard["low"] != shard["high"]]
        block = dict(zip(zip(crossed["part"], crossed["word"], strict=True), crossed["block"], strict=True))
        groups: dict[tuple, list[str]] = {}
        for m, back, part, low, high, word in zip(shard["m"], shard["backwards"], shard["part"], shard["low"], shard["high"], shard["word"], strict=True):
            # The hash of a part only deals it out: words meet under the part itself.
            groups.setdefault((m, back, word[len(word) - (m - m // 2) :] if back else word[: m // 2], low, high, part), []).append(word)
        for (m, back, _, low, high, part), members in groups.items():
            if len(members) < 2:
                continue
            for pair in near_in_part(acceptor, members, m, back):
                if low != high and block[part, pair[0]] == block[part, pair[1]]:
                    continue  # met where the block meets itself
                for a, b in (pair, pair[::-1]):
                    n, best = found.get(a, (0, (0, "")))
                    found[a] = n + 1, min(best, (-count[b], b))
        rows = [(w, n, -top, best) for w, (n, (top, best)) in found.items()]
        return pd.DataFrame(rows, columns=["word", "n_near", "top", "best"])

    pieces = met.withColumn("shard", F.pmod(F.xxhash64("part", "low", "high"), F.lit(shards))).groupBy("shard").applyInPandas(compose, "word string, n_near long, top long, best string")
    first = F.min(F.struct((-F.col("top")).alias("minus"), F.col("best").alias("word")))
    return pieces.groupBy("word").agg(F.sum("n_near").alias("n_near"), first.alias("b")).select(
        "word", "n_near", F.struct((-F.col("b.minus")).alias("n"), F.col("b.word").alias("word")).alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, form) to (word, root): forms followed to the last, by doubling."""
    now = written(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        # Only roots that have a form themselves lead on.
        reached = now.select(F.col("root").alias("word")).distinct()
        onward = written(now.join(reached, "word", "left_semi").select(F.col("word").alias("via"), F.col("root").alias("further")), "spelling-onward")
        if onward.isEmpty():
            return now
        now = written(looked_up(now, onward, {"via": F.col("root")}, "left").select("word", F.coalesce("further", "root").alias("root")), "spelling-roots")


def variants(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT,
    ratio: int = RATIO, hot: int = HOT, shard_words: int = SHARD_WORDS,
) -> DataFrame:
    """One row per word: word, n, n_near, form, form_n (null without a form) and root."""
    words = written(counted_words(docs, id_col, text_col, least_length, least_count), "spelling-words")
    near = near_words(words, least_length, hot, shard_words)
    has = F.col("best.n") >= ratio * F.col("n")
    found = written(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(has, F.col("best.word")).alias("form"), F.when(has, F.col("best.n")).alias("form_n")), "spelling-found")
    last = roots(found.where("form is not null"))
    return found.join(last, "word", "left").withColumn("root", F.coalesce("root", "word"))
