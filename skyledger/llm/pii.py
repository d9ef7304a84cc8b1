"""Personal data by weak supervision, with DataFrame functions only.

Base patterns find e-mail addresses, network addresses, payment cards and phone numbers; further
candidate patterns find personal names after a title or a cue, national numbers, bank accounts, local phone
numbers and street addresses. Labelers then vote on each candidate: its own format (regex and
checksum), gazetteers, the words before it, words that speak against it, and its surroundings.
The gazetteers of names and streets are learned: a word enters when enough different candidates hold it
on which the other labelers agree; a few frequent given names are there from the start.
Expectation-maximisation over the counts of vote patterns (of all candidates in the corpus)
estimates how reliable each labeler is, and its posteriors train a logistic span classifier on kind, length, share of
digits, word before, what follows, and each kind's own votes. It decides which of the further candidates stay.
Spans of the base patterns always stay.

The driver only sees counts by feature pattern: at most kinds x 3**labelers x lengths x shares x words x followers rows,
whatever the corpus; all but few of these never occur.

Spans are code points, end exclusive, leftmost and non-overlapping per kind; a match that fails its
kind's check is dropped without another try.

Defined results: a null text counts as empty and has no spans; repeated rows get equal spans; with no
candidates only base spans are returned; an empty table gives an empty result. Very long texts are searched
whole, in time that grows with their length. Other columns pass through. The span column is ``_pii_spans``: array of (kind, start, end), in place of an input column of this name.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.sources.shared import looked_up, written

#: Kinds in the order in which spans of one start are listed, base kinds first.
BASE = ("email", "ip", "card", "phone")
MORE = ("person", "national_id", "bank_account", "local_phone", "street")
KINDS = BASE + MORE

#: Fixed patterns. Possessive forms match the same as greedy ones here and need no stack on long runs; a match
#: starts where a run of its characters starts, or where the match before it ended.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?:\G|(?<![0-9]))[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "person": r"\b(?:Mr|Mrs|Ms|Dr|Prof|Herr|Frau|Mme|Monsieur|Madame|Señora?|Sra?)\.? \p{Lu}\p{Ll}{1,20}+(?: \p{Lu}\p{Ll}{1,20}+){0,2}+"
              r"|(?<=\b(?:[Nn]ame|[Dd]ear|[Cc]ontact|[Ss]igned|[Rr]egards,)[: ]{1,2})\p{Lu}\p{Ll}{1,20}+(?: \p{Lu}\p{Ll}{1,20}+){1,2}+",
    "national_id": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "bank_account": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "local_phone": r"(?=[(0-9])(?<![0-9+.(-])(?<!\+[0-9 ().-]{1,12})(?:\([0-9]{3}\)|[0-9]{3})[ .-][0-9]{3}[.-][0-9]{4}(?![0-9.-])",
    "street": r"(?<![0-9.,])[0-9]{1,5} (?:\p{Lu}\p{Ll}{1,20}+ ){1,3}+(?:Street|St|Avenue|Ave|Road|Rd|Lane|Drive|Boulevard|Blvd)\b",
}
#: What a text must hold for a pattern to be tried at all.
HINTS = {
    "email": "@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9](?:[\x20-]?[0-9]){11}", "phone": r"\+[0-9]", "national_id": r"[0-9]-[0-9]",
    "bank_account": r"[A-Z][0-9]{2}", "local_phone": r"[0-9]{3}\)?[ .-][0-9]{3}", "street": r"[0-9] \p{Lu}",
}
#: Names the gazetteer starts from: frequent given names in four languages.
GIVEN_NAMES = (
    "james", "mary", "john", "linda", "robert", "susan", "michael", "sarah", "david", "karen", "hans", "anna", "peter", "ursula",
    "klaus", "monika", "jean", "marie", "pierre", "nathalie", "michel", "isabelle", "jose", "carmen", "antonio", "maria", "manuel", "lucia",
)
#: Words before a span that speak for its kind, and words that speak against any.
BEFORE = {
    "email": r"mail|contact|write", "ip": r"\bip\b|address|host|server", "card": r"card|karte|carte|tarjeta|visa|pay", "phone": r"tel|phone|call|fax|mobil",
    "person": r"name|dear|by|from|contact|signed|regards", "national_id": r"ssn|social|security|national", "bank_account": r"iban|account|konto|compte|cuenta|bank",
    "local_phone": r"tel|phone|call|fax|mobil", "street": r"address|live|street|home|adresse",
}
AGAINST = r"version|isbn|order|figure|page|model|part no|invoice|total|\bv$|\$\s*$"
LABELERS = ("format", "gazetteer", "before", "against", "around")
#: Different candidates that must hold a word, with the other labelers agreeing, before it enters a gazetteer.
SUPPORT = 3
#: Classes of the word before a candidate (by hash) and the values of the other features of its surroundings.
WORDS = 32
CONTEXT = {"share": range(4), "word": range(WORDS + 1), "after": range(4)}


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


#: Matches whose lengths are summed at a time, so that long lists of matches cost little more than their number.
STEP = 128


def matches(text: Column, pattern: str) -> Column:
    """array of (start, end, match), leftmost and non-overlapping.

    The text between matches and the matches themselves give the places as running sums of lengths.
    """
    def placed(parts: Column) -> Column:
        size = F.size(parts["found"])
        lengths = F.zip_with(
            F.slice(parts["between"], 1, F.greatest(size, F.lit(1))), parts["found"],
            lambda b, m: F.struct(F.length(b).alias("before"), (F.length(b) + F.length(F.coalesce(m, F.lit("")))).alias("both")),
        )
        total = lambda some: F.aggregate(some, F.lit(0), lambda n, x: n + x["both"])

        def by_block(lens: Column) -> Column:
            sums = F.transform(F.sequence(F.lit(0), F.floor((size - 1) / STEP).cast("int")), lambda k: total(F.slice(lens, k * STEP + 1, STEP)))
            upto = F.aggregate(sums, F.array(F.lit(0)), lambda a, s: F.concat(a, F.array(F.element_at(a, -1) + s)))
            return let(upto, lambda blocks: F.transform(parts["found"], lambda m, i: start(lens, blocks, m, i)))

        def start(lens: Column, blocks: Column, m: Column, i: Column) -> Column:
            block = F.floor(i / STEP).cast("int")
            at = F.get(blocks, block) + total(F.slice(lens, block * STEP + 1, i % STEP)) + F.get(lens, i)["before"]
            return F.struct(at.alias("start"), (at + F.length(m)).alias("end"), m.alias("match"))

        return let(lengths, by_block)

    none = F.array().cast("array<struct<start:int,end:int,match:string>>")
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    return let(found, lambda f: F.when(F.size(f) == 0, none).otherwise(
        let(F.struct(f.alias("found"), F.split(text, pattern, -1).alias("between")), placed)))


def digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn(number: Column) -> Column:
    def step(total: Column, i: Column) -> Column:
        d = F.substring(number, F.length(number) - i, F.lit(1)).cast("int")
        twice = F.when(d > 4, d * 2 - 9).otherwise(d * 2)
        return total + F.when(i % 2 == 1, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(0), F.length(number) - 1), F.lit(0), step) % 10 == 0


def at_most_255(part: Column) -> Column:
    return let(F.regexp_replace(part, "^0+", ""), lambda p: (F.length(p) < 3) | (F.length(p) == 3) & (p <= "255"))


CHECKS: dict[str, Callable[[Column], Column]] = {
    "ip": lambda m: F.forall(F.split(m, r"\."), at_most_255),
    "card": lambda m: let(digits(m), lambda d: F.when(F.length(d).between(12, 19), luhn(d)).otherwise(F.lit(False))),
    "phone": lambda m: F.length(digits(m)).between(9, 15),
}


def candidates(text: Column) -> Column:
    """array of (start, rank of the kind, end, match, before, after), sorted."""
    def of_kind(kind: str) -> Column:
        found = matches(text, PATTERNS[kind])
        if kind in CHECKS:
            found = F.filter(found, lambda s: CHECKS[kind](s["match"]))
        wide = F.transform(found, lambda s: F.struct(
            s["start"].alias("start"), F.lit(KINDS.index(kind)).alias("rank"), s["end"].alias("end"), s["match"].alias("match"),
            F.substring(text, F.greatest(s["start"] - 23, F.lit(1)), F.least(s["start"], F.lit(24))).alias("before"),
            F.substring(text, s["end"] + 1, F.lit(2)).alias("after")))
        none = F.array().cast("array<struct<start:int,rank:int,end:int,match:string,before:string,after:string>>")
        return F.when(text.rlike(HINTS[kind]), wide).otherwise(none) if kind in HINTS else wide

    return F.array_sort(F.concat(*[of_kind(k) for k in KINDS]))


def _kind(s: Column) -> Column:
    return F.element_at(F.array(*[F.lit(k) for k in KINDS]), s["rank"] + 1)


#: Capitalised words that stand where a name could, and aren't one.
NO_NAME = r"\b(?:Sir|Madam|Customer|Service|Support|Team|Us|Our|The|And|Sales|Office|Reader|Friends?|Members?|Department|Server|President)\b"


def mod_97(account: Column) -> Column:
    """Whether an account number (letters and digits) passes its check: first four to the end, letters as 10 to 35, remainder 1 of 97."""
    turned = F.concat(F.substring(account, F.lit(5), F.length(account)), F.substring(account, 1, 4))
    code = lambda c: F.ascii(c)
    step = lambda n, c: F.when(code(c) >= 65, (n * 100 + code(c) - 55) % 97).otherwise((n * 10 + code(c) - 48) % 97)
    return F.aggregate(F.split(turned, "(?<=.)(?=.)"), F.lit(0), step) == 1


def gazetteer_words(s: Column) -> Column:
    """The words by which a gazetteer is asked about a candidate: those of a name (or of an address's local part), or of a street."""
    kind, match = _kind(s), s["match"]
    parts = lambda text, of: F.transform(F.filter(F.split(F.lower(text), r"[^\p{L}]+"), lambda w: F.length(w) >= 3), lambda w: F.concat(F.lit(of), w))
    name = F.regexp_replace(match, r"^(?:Mr|Mrs|Ms|Dr|Prof|Herr|Frau|Mme|Monsieur|Madame|Señora?|Sra?)\.? ", "")
    return F.array_distinct(
        F.when(kind == "person", parts(name, "name ")).when(kind == "email", parts(F.substring_index(match, "@", 1), "name "))
        .when(kind == "street", parts(F.regexp_replace(match, r" [^ ]+$", ""), "street ")).otherwise(F.array().cast("array<string>")))


def votes(s: Column) -> list[Column]:
    """A vote of each labeler on a candidate: 1 for, -1 against, 0 none. The gazetteer's is given later, once it has been learned."""
    kind, match, before = _kind(s), s["match"], F.lower(s["before"])
    number = digits(match)
    area = F.substring(match, 1, 3)
    vote = lambda good, bad: F.when(good, 1).when(bad, -1).otherwise(0)
    shape = (
        F.when(kind == "email", vote(match.rlike(r"\.[A-Za-z]{2,10}$"), ~match.rlike(r"\.[A-Za-z]+$")))
        .when(kind == "ip", vote(~match.rlike(r"^0|\.0[0-9]"), match.rlike(r"^0\.")))
        .when(kind == "card", vote(match.rlike("^[3-6]"), match.rlike("^0")))
        .when(kind == "phone", vote(~match.rlike(r"^\+0"), match.rlike(r"^\+0")))
        .when(kind == "national_id", vote(~area.isin("000", "666") & ~match.rlike("^9|-00-|-0000$"), area.isin("000", "666") | match.rlike("^9|-00-|-0000$")))
        .when(kind == "bank_account", let(F.regexp_replace(match, " ", ""), lambda m: vote(F.length(m).between(15, 34) & mod_97(m), F.lit(True))))
        .when(kind == "local_phone", vote(number.rlike("^[2-9]"), number.rlike("^[01]")))
        .when(kind == "person", vote(match.rlike(r"\p{Ll} \p{Lu}") & ~match.rlike(NO_NAME), match.rlike(NO_NAME)))
        .otherwise(vote(match.rlike("^[1-9]"), match.rlike("^0")))
    )
    context = reduce(lambda c, k: c.when(kind == k, before.rlike(BEFORE[k])), KINDS[1:], F.when(kind == KINDS[0], before.rlike(BEFORE[KINDS[0]])))
    return [
        shape, F.lit(0), F.when(context, 1).otherwise(0), F.when(before.rlike(AGAINST), -1).otherwise(0),
        # Part of a longer string of characters, or set apart on both sides.
        vote(s["before"].rlike(r"(?:^|[\s(:,;\"'])$") & s["after"].rlike(r"^(?:$|[\s).,;:\"'])"), s["before"].rlike(r"[A-Za-z0-9_/=]$") | s["after"].rlike("^[A-Za-z0-9_/=]")),
    ]


def features(s: Column) -> Column:
    """(rank, votes, length class): what estimation and classifier see of a candidate."""
    return F.struct(
        s["rank"].alias("rank"), *[v.cast("int").alias(n) for n, v in zip(LABELERS, votes(s), strict=True)],
        F.least(F.floor(F.log2(s["end"] - s["start"])).cast("int"), F.lit(6)).alias("size"),
        F.least(F.floor(4 * F.length(digits(s["match"])) / F.length(s["match"])).cast("int"), F.lit(3)).alias("share"),
        let(F.regexp_extract(F.lower(s["before"]), r"(\p{L}+)[^\p{L}]*$", 1), lambda w: F.when(w == "", WORDS).otherwise((F.crc32(w.cast("binary")) % WORDS).cast("int"))).alias("word"),
        F.when(s["after"] == "", 0).when(s["after"].rlike(r"^\s"), 1).when(s["after"].rlike(r"^[\p{L}0-9]"), 2).otherwise(3).alias("after"),
    )


def learned(found: DataFrame, support: int = SUPPORT) -> DataFrame:
    """(word): the words of the gazetteers, from the spans of all documents.

    A word enters if at least ``support`` different candidates hold it that two of format, words before and surroundings vote
    for and none votes against, and if these are at least half of all candidates with the word.
    """
    f = F.col("s.f")
    agreed = ((f["format"] == 1).cast("int") + (f["before"] == 1).cast("int") + (f["around"] == 1).cast("int") >= 2) & (F.least(f["format"], f["against"], f["around"]) >= 0)
    kinds = [KINDS.index(k) for k in ("person", "street")]
    some = found.select(F.explode(F.filter("spans", lambda s: s["rank"].isin(kinds))).alias("s"))
    # Equal candidates are counted before anything is grouped by word.
    once = some.select(F.explode("s.words").alias("word"), F.col("s.key").alias("key"), agreed.alias("agreed")).groupBy("word", "key").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("agreed").cast("long")).alias("yes"))
    return once.groupBy("word").agg(F.sum("n").alias("n"), F.sum("yes").alias("yes"), F.count_if(F.col("yes") > 0).alias("different")).where(
        (F.col("different") >= support) & (2 * F.col("yes") >= F.col("n"))).select("word")


def with_gazetteer(found: DataFrame, known: DataFrame) -> DataFrame:
    """``found`` (row, id, spans) with the gazetteer's votes: for a candidate of which a word is known, or is among the given names.

    Only words of candidates meet the gazetteer, which is broadcast if it is small; a word that very many candidates hold is dealt to many tasks.
    """
    spans = found.select("id", F.posexplode("spans").alias("i", "s")).select("id", "i", F.explode("s.words").alias("word"))
    hit = looked_up(spans, known, {"known": F.col("word")}).groupBy("id").agg(F.collect_set("i").alias("hits"))
    hit = written(hit.withColumnRenamed("id", "hit_id"), "pii-known")
    seeds = F.array(*[F.lit(f"name {n}") for n in GIVEN_NAMES])
    met = looked_up(found, hit, {"hit_id": F.col("id")}, "left")
    return met.select("row", F.transform("spans", lambda s, i: s.withField("f", s["f"].withField("gazetteer", F.when(
        F.arrays_overlap(s["words"], seeds) | F.coalesce(F.array_contains("hits", i), F.lit(False)), 1).otherwise(0))).dropFields("words", "key")).alias("spans"))


def reliabilities(rows: list[tuple], rounds: int = 100) -> dict[tuple, float]:
    """Posterior of each vote pattern by expectation-maximisation.

    rows: (rank, votes, n). Labelers are independent given the truth; each has its own chances of the three
    votes for true and for false candidates, shared by all kinds; each kind has its own share of true ones.
    """
    ranks = {r for r, _, _ in rows}
    prior = dict.fromkeys(ranks, 0.7)
    k = len(LABELERS)
    chance = [{y: {v: {1: 0.5, 0: 0.4, -1: 0.1}[v if y else -v] for v in (-1, 0, 1)} for y in (0, 1)} for _ in range(k)]
    post: dict[tuple, float] = {}
    for _ in range(rounds):
        for rank, vote, _ in rows:
            yes = math.log(prior[rank]) + sum(math.log(chance[j][1][v]) for j, v in enumerate(vote))
            no = math.log(1 - prior[rank]) + sum(math.log(chance[j][0][v]) for j, v in enumerate(vote))
            post[rank, vote] = 1 / (1 + math.exp(max(-60, min(60, no - yes))))
        for rank in ranks:
            own = [(post[r, vote], n) for r, vote, n in rows if r == rank]
            prior[rank] = min(0.98, max(0.02, (sum(p * n for p, n in own) + 7) / (sum(n for _, n in own) + 10)))
        for j in range(k):
            for y in (0, 1):
                # Pseudo-counts keep a labeler from turning against its meaning on few candidates.
                n = {v: 20 * {1: 0.5, 0: 0.4, -1: 0.1}[v if y else -v] for v in (-1, 0, 1)}
                for r, vote, m in rows:
                    n[vote[j]] += m * (post[r, vote] if y else 1 - post[r, vote])
                total = sum(n.values())
                chance[j][y] = {v: x / total for v, x in n.items()}
    return post


def _inputs(rank: int, vote: tuple, size: int, *context: int) -> list[str]:
    own = [f"{n}{v}" for n, v in zip(LABELERS, vote, strict=True)]
    return [f"kind{rank}", f"size{size}", *own, *(f"kind{rank} {o}" for o in own), *(f"{n}{v}" for n, v in zip(CONTEXT, context))]


def classifier(rows: Iterable[tuple], post: dict[tuple, float], rounds: int = 300, rate: float = 0.5, l2: float = 1e-3) -> dict[str, float]:
    """Weights of a logistic regression on one-hot inputs, trained on the posteriors; rows: (rank, votes, size, features of the context, n)."""
    number: dict[str, int] = {"bias": 0}
    at, want, n = [], [], []
    for rank, vote, size, *context, m in rows:
        at.append([0, *(number.setdefault(x, len(number)) for x in _inputs(rank, vote, size, *context))])
        want.append(post[rank, vote])
        n.append(m)
    if not at:
        return {"bias": 0.0}
    at, want, n = np.array(at), np.array(want), np.array(n, float)
    weight = np.zeros(len(number))
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(weight[at].sum(axis=1), -30, 30)))
        slope = np.bincount(at.ravel(), np.repeat(n * (p - want), at.shape[1]), len(number))
        weight -= rate * (slope / n.sum() + l2 * weight)
    return dict(zip(number, weight.tolist(), strict=True))


def _score(f: Column, weight: dict[str, float]) -> Column:
    """Log odds of a candidate's features under the classifier."""
    def of(names: list[str], at: Column) -> Column:
        return F.coalesce(F.get(F.array(*[F.lit(weight.get(x, 0.0)) for x in names]), at), F.lit(0.0))

    kinds, vote = range(len(KINDS)), range(-1, 2)
    parts = [of([f"kind{k}" for k in kinds], f["rank"]), of([f"size{k}" for k in range(7)], f["size"])]
    parts += [of([f"{n}{v}" for v in vote], f[n] + 1) for n in LABELERS]
    parts += [of([f"kind{k} {n}{v}" for k in kinds for v in vote], f["rank"] * 3 + f[n] + 1) for n in LABELERS]
    parts += [of([f"{n}{v}" for v in values], f[n]) for n, values in CONTEXT.items()]
    return reduce(lambda a, b: a + b, parts, F.lit(weight.get("bias", 0.0)))


def find(docs: DataFrame, text_col: str = "text", support: int = SUPPORT) -> DataFrame:
    """``docs``, without its text, with ``_pii_spans``."""
    others = [c for c in docs.columns if c not in (text_col, "_pii_spans")]
    text = F.coalesce(F.col(text_col), F.lit(""))
    wide = F.transform(let(text, candidates), lambda s: F.struct(
        s["start"].alias("start"), s["rank"].alias("rank"), s["end"].alias("end"), features(s).alias("f"), gazetteer_words(s).alias("words"), F.xxhash64(s["match"]).alias("key")))
    row = F.struct(*[F.col(f"`{c}`") for c in others], F.lit(0).alias("_pii_none"))
    found = written(docs.select(row.alias("row"), F.monotonically_increasing_id().alias("id"), wide.alias("spans")), "pii-found")
    known = written(learned(found, support).withColumnRenamed("word", "known"), "pii-gazetteer")
    found = written(with_gazetteer(found, known), "pii")
    counted = found.select(F.explode("spans.f").alias("f")).groupBy("f").agg(F.count(F.lit(1)).alias("n")).collect()
    rows = sorted((r["f"]["rank"], tuple(r["f"][n] for n in LABELERS), r["f"]["size"], *(r["f"][n] for n in CONTEXT), r["n"]) for r in counted)
    merged: dict[tuple, int] = {}
    for rank, vote, *_, n in rows:
        merged[rank, vote] = merged.get((rank, vote), 0) + n
    post = reliabilities([(rank, vote, n) for (rank, vote), n in sorted(merged.items())]) if rows else {}
    weight = classifier(rows, post)
    stays = F.filter("spans", lambda s: (s["rank"] < len(BASE)) | (_score(s["f"], weight) >= 0))
    return found.select(*[F.col("row")[c].alias(c) for c in others], F.transform(stays, lambda s: F.struct(
        _kind(s).alias("kind"), s["start"].cast("long").alias("start"), s["end"].cast("long").alias("end"))).alias("_pii_spans"))
