"""Sharding, spelling variants and periodic runs against brute force."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from skyledger.llm import periodic, queries, sharding, spelling
from skyledger.sources.shared import shared_dir

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def documents(duck):
    return duck.sql("SELECT doc_id, text FROM documents").fetchall()


# Sharding


def laws_hold(rows, shards, tolerance):
    """rows: (text, size, shard, slot)."""
    total, most = sum(r[1] for r in rows), max(r[1] for r in rows)
    size, slots = collections.Counter(), collections.defaultdict(list)
    for _, n, s, slot in rows:
        size[s] += n
        slots[s].append(slot)
    assert set(size) <= set(range(shards))
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())
    for s in range(shards):
        assert abs(size[s] - total / shards) <= 2 * max(tolerance * total / shards, most)


def test_sharding_query(spark, sf, documents):
    got = queries.op11_sharding(spark, sf).collect()
    text = dict(documents)
    assert collections.Counter(r.doc_id for r in got) == collections.Counter(i for i, _ in documents)
    for r in got:
        data = (text[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(data) + 1, zlib.crc32(data), "bytes", None)
    laws_hold([(text[r.doc_id], r.size, r.shard, r.slot) for r in got], 16, sharding.TOLERANCE)


def sharded(spark, rows, **given):
    docs = spark.createDataFrame(rows, "doc_id long, text string, size string")
    return [(r.row.text, r.size, r.shard, r.slot) for r in sharding.shard(docs, **given).collect()]


def test_equal_texts_stay_together_unless_they_outweigh_a_shard(spark):
    rng = random.Random(5)
    small = [(i, f"copy {i // 4} " + "x" * (i // 4 % 50), "") for i in range(2000)]
    large = [(10_000 + i, "the same again and again", "") for i in range(1500)]
    rng.shuffle(small)
    rows = sharded(spark, small + large, tolerance=0.05)
    laws_hold(rows, 16, 0.05)
    where = collections.defaultdict(set)
    for text, _, s, _ in rows:
        where[text].add(s)
    assert len(where.pop("the same again and again")) > 4
    assert max(map(len, where.values())) == 1


def test_rows_that_cannot_be_told_apart_are_dealt_out(spark):
    rows = sharded(spark, [(7, "one row, many times", "")] * 900 + [(i, f"text {i}", "") for i in range(500)], drawn_each=4)
    laws_hold(rows, 16, sharding.TOLERANCE)


def test_one_text_larger_than_all_shards(spark):
    rows = sharded(spark, [(1, "x" * 200_000, ""), *[(i, f"text {i}", "") for i in range(2, 300)], (None, None, None), (None, "", None)])
    laws_hold(rows, 16, sharding.TOLERANCE)
    assert sum(r[0] is None for r in rows) == 1


@pytest.mark.parametrize("n", [0, 1, 2, 17])
def test_few_rows(spark, n):
    rows = sharded(spark, [(i, f"t{i}", "") for i in range(n)])
    assert len(rows) == n
    if n:
        laws_hold(rows, 16, sharding.TOLERANCE)


def test_counts_below_probes_are_exact(spark):
    rng = np.random.default_rng(2)
    keys = [(int(h), int(t), int(s)) for h, t, s in zip(rng.integers(-4, 4, 3000), rng.integers(-9, 9, 3000), rng.integers(1, 99, 3000), strict=True)]
    probes = sorted({(int(h), int(t)) for h, t in zip(rng.integers(-5, 5, 60), rng.integers(-10, 10, 60), strict=True)})
    size, rows = sharding.counted(spark.createDataFrame(keys, "h long, t long, size long").repartition(5), probes)
    for k, p in enumerate(probes):
        assert size[: k + 1].sum() == sum(s for h, t, s in keys if (h, t) < p)
        assert rows[: k + 1].sum() == sum((h, t) < p for h, t, _ in keys)


def test_shards_are_written_whole(spark):
    docs = spark.createDataFrame([(i, f"text {i}", "a") for i in range(200)], "doc_id long, text string, source string")
    path = shared_dir(spark, "shards")
    sharding.write_shards(sharding.shard(docs, shards=4), path)
    back = spark.read.parquet(path)
    assert back.count() == 200 and back.select("shard_").distinct().count() == 4


# Spelling variants


def left_out(doc_id, run):
    low = run.translate(str.maketrans(spelling.UPPER, spelling.LOWER))
    h = zlib.crc32(f"{'null' if doc_id is None else doc_id}:{low}".encode())
    at = h % len(low)
    return low[:at] + low[at + 1 :] if h % 31 == 0 else low


def variants_by_hand(docs, least=7, ratio=10):
    count = collections.Counter(left_out(i, r) for i, t in docs for r in re.findall("[A-Za-zÀ-ÿ]+", t or ""))
    count = {w: n for w, n in count.items() if len(w) >= least and n >= 2}
    cut = collections.defaultdict(set)
    for w in count:
        for i in range(len(w)):
            cut[i, w[:i] + w[i + 1 :]].add(w)
    near = collections.defaultdict(set)
    for (_, rest), ws in cut.items():
        for w in ws:
            near[w] |= ws - {w}
            if rest in count:
                near[w].add(rest)
                near[rest].add(w)
    form = {}
    for w, n in count.items():
        best = min(near[w], key=lambda x: (-count[x], x), default=None)
        if best is not None and count[best] >= ratio * n:
            form[w] = best
    out = {}
    for w, n in count.items():
        root = w
        while root in form:
            root = form[root]
        out[w] = (n, len(near[w]), form.get(w), count.get(form.get(w)), root)
    return out


def test_spelling_query_equals_brute_force(spark, sf, documents):
    got = {r.word: (r.n, r.n_near, r.form, r.form_n, r.root) for r in queries.op12_spelling(spark, sf).collect()}
    assert got == variants_by_hand(documents)


def planted_words():
    """Chains of forms, one large part, words of every length and some beyond the small letters."""
    rng = random.Random(9)
    stem = "abcdefghij"
    rows = [(1, " ".join([stem] * 400)), (2, " ".join(["abcdefghik"] * 30)), (3, " ".join(["abcdefghkk"] * 3)), (4, "ÀÉÏÕÜßÿ Àéïõüßÿ ÀÉÏÕÜßÿ " * 3)]
    rows += [(10 + i, " ".join(["prefix" + "".join(rng.choice("ab") for _ in range(rng.randint(1, 6)))] * 2)) for i in range(300)]
    rows += [(400, "x" * 3000 + " " + "x" * 3000 + " " + "x" * 2999 + " " + "x" * 2999), (401, None), (None, "nullable nullable words"), (402, ""), (1, "repeated repeated")]
    return rows


@pytest.mark.parametrize("hot, shard_words", [(20_000, 40_000), (5, 50)])
def test_spelling_by_blocks_equals_brute_force(spark, hot, shard_words):
    rows = planted_words()
    docs = spark.createDataFrame([(i, t, "own") for i, t in rows], "doc_id long, text string, n string")
    got = {r.word: (r.n, r.n_near, r.form, r.form_n, r.root) for r in spelling.variants(docs, hot=hot, shard_words=shard_words).collect()}
    want = variants_by_hand(rows)
    assert got == want
    assert want["abcdefghkk"][4] == "abcdefghij"


def test_every_near_pair_is_found_once():
    rng = random.Random(3)
    for _ in range(60):
        words = sorted({"".join(rng.choice("abc") for _ in range(rng.randint(7, 9))) for _ in range(80)})
        acceptor, found = spelling.Acceptor(), []
        for m in (7, 8, 9):
            for back in (False, True):
                parts = collections.defaultdict(list)
                for w in words:
                    if len(w) in (m, m + 1):
                        parts[w[len(w) - (m - m // 2) :] if back else w[: m // 2]].append(w)
                for part in parts.values():
                    found += map(frozenset, spelling.near_in_part(acceptor, part, m, back))
        drops = {w: {w[:i] + w[i + 1 :] for i in range(len(w))} for w in words}
        near = {frozenset((a, b)) for a in words for b in words if a != b and (
            b in drops[a] or len(a) == len(b) and sum(x != y for x, y in zip(a, b, strict=True)) == 1)}
        assert len(found) == len(set(found)) and set(found) == near


def test_equal_endings_are_one_state():
    acceptor = spelling.Acceptor()
    acceptor.add(sorted(a + b for a in "pqrs" for b in ("ing", "ed")), 0)
    assert len(acceptor.arcs) == 6  # start, after the first letter, and the two endings joined at their last state


# Periodic runs


def runs_by_hand(words, least=12):
    n, found = len(words), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            a = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            if i + q - a >= max(least, 2 * q) and not any((s, e) == (a, i + q) for s, e in found):
                found[a, i + q] = q  # the smallest period of a stretch comes first
    return sorted((a, b - a, q) for (a, b), q in found.items())


def collapsed_by_hand(words, runs):
    gone = {i for a, length, q in runs for i in range(a + q, a + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def test_periodic_query_equals_brute_force(spark, sf, documents):
    got = {r.doc_id: r for r in queries.op13_periodic(spark, sf).collect()}
    some = 0
    for doc_id, text in documents:
        words = WORD.findall(text or "")
        h, n = zlib.crc32(str(doc_id).encode()), len(words)
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
        runs, r = runs_by_hand(words), got[doc_id]
        some += bool(runs)
        best = min(runs, key=lambda x: (-x[1], x[0], x[2]), default=None)
        want = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
        assert (r.n_runs, r.start, r.length, r.period, r.exponent_milli) == (len(runs), *want)
        assert r.runs_sha256 == hashlib.sha256("".join(f"{a},{b},{c}\n" for a, b, c in runs).encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(collapsed_by_hand(words, runs).encode()).hexdigest()
    assert some > 5


def lyndon_by_hand(s):
    return [max(j - i for j in range(i + 1, len(s) + 1) if all(s[i:j] < s[k:j] for k in range(i + 1, j))) for i in range(len(s))]


def test_groups_end_as_longest_lyndon_factors():
    rng = random.Random(1)
    for _ in range(1500):
        s = [rng.randrange(rng.randint(1, 4)) for _ in range(rng.randint(0, 25))]
        ranks = [sorted(set(s)).index(x) for x in s]
        assert periodic.lyndon_lengths(ranks) == lyndon_by_hand(ranks)


def thue_morse(n):
    return [bin(i).count("1") % 2 for i in range(n)]


def test_runs_equal_brute_force():
    rng = random.Random(2)
    cases = [[rng.randrange(k) for _ in range(rng.randint(0, 70))] for k in (1, 2, 2, 3, 5) for _ in range(150)]
    fibonacci = ["a", "ab"]
    while len(fibonacci[-1]) < 400:
        fibonacci.append(fibonacci[-1] + fibonacci[-2])
    cases += [[ord(c) for c in fibonacci[-1]], thue_morse(600), [i % 7 for i in range(500)]]
    for s in cases:
        for least in (2, 12):
            assert [tuple(r) for r in periodic.runs_of(np.array(s, np.int64), least).tolist()] == runs_by_hand(s, least)


def test_a_hash_that_is_wrong_is_found_out(monkeypatch):
    class Blind(periodic.Suffixes):
        def hash(self, at, length):
            return super().hash(at, length) & np.uint64(3)

    monkeypatch.setattr(periodic, "Suffixes", Blind)
    rng = random.Random(4)
    for _ in range(200):
        s = [rng.randrange(2) for _ in range(40)]
        found = {tuple(r) for r in periodic.runs_of(np.array(s, np.int64), 4).tolist()}
        assert found == set(runs_by_hand(s, 4))


def test_batches_equal_single_documents():
    rng = random.Random(6)
    for _ in range(100):
        docs = []
        for _ in range(rng.randint(0, 6)):
            s = [rng.randrange(6) for _ in range(rng.randint(0, 70))]
            a = rng.randrange(len(s)) if s else 0
            docs.append([x if i < a else s[a + (i - a) % 5] for i, x in enumerate(s)])
        begin = np.cumsum([0, *map(len, docs)])
        words = np.array([x for d in docs for x in d], np.int64)
        got = periodic.runs_of_batch(words, np.repeat(np.arange(len(docs)), np.diff(begin)))
        assert [tuple(r) for r in got.tolist()] == [(a + int(b), n, q) for d, b in zip(docs, begin, strict=False) for a, n, q in runs_by_hand(d)]


def test_periodic_texts_of_all_kinds(spark):
    texts = [None, "", "  \t ", "one", "a b " * 8, "palabra " * 30_000, "x" * 300_000, "ha\x85ha   " * 9, "one two three four five six seven\n" * 3, "tick\ntock\r" * 40_000]
    docs = spark.createDataFrame([(i, t, "own") for i, t in enumerate(texts)] + [(4, texts[4], "own"), (None, texts[4], "own")], "doc_id long, text string, runs string")
    got = {(r.id, r.collapsed): r for r in periodic.periodic_runs(docs).collect()}
    assert len(got) == 11
    for i, t in [*enumerate(texts), (None, texts[4])]:
        words = WORD.findall(t or "")
        runs = runs_by_hand(words) if len(words) < 1000 else [(0, len(words), len(set(words)))]
        r = got[i, collapsed_by_hand(words, runs)]
        assert (r.n_words, [tuple(x) for x in r.runs]) == (len(words), runs)


def test_repeating_follows_its_rule(spark):
    docs = spark.createDataFrame([(i, f"w{i} a b c d e f g h i j k l m n o p q r s t") for i in range(200)] + [(None, "a b"), (3, None)], "doc_id long, text string")
    for r in queries.repeating(docs).where(F.col("doc_id").isNotNull() & F.col("text").isNotNull()).collect():
        words = f"w{r.doc_id} a b c d e f g h i j k l m n o p q r s t".split()
        h, n = zlib.crc32(str(r.doc_id).encode()), len(words)
        if h % 10 == 0:
            a = h // 10 % n
            p = 1 + (n - a) // (3 + h // 10 % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
        assert r.text.split() == words
