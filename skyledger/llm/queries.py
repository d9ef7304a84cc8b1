"""The registered queries of this subpackage, each on its whole table, and their SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.llm import exact_dedup, langid, mixing, packing, periodic, pii, quality, secrets, sharding, simhash, spelling, suffix_dedup, toxicity
from skyledger.sources.shared import read_table, small_or_shuffled, written


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(read_table(spark, sf_dir, "documents"), words=3, radius=2)
    return found.select(F.col("id").alias("doc_id"), simhash.as_hex("fp").alias("fingerprint"), "component_id")


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact_dedup.exact_dedup(read_table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", "text_sha256")


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(read_table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return mixed.select(
        "doc_id", F.col("_mx_size").alias("size"), F.col("_mx_source_size").alias("source_size"),
        F.col("_mx_target").alias("target"), (F.col("_mx_size") * F.col("_mx_copies")).alias("taken"),
    )


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    found = written(quality.measured(docs).drop("text"), "quality")
    q = [F.col(f"_q_.{c}").alias(c) for c in (*quality.COUNTS, *quality.MEASURES)]
    return quality.judged(found).select(
        "doc_id", *q, F.col("_q_base_failed").alias("base_failed"), F.col("_q_kept").alias("kept")
    )


def spans_text(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def of_kind(spans: str, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.filter("_pii_spans", lambda s: s["kind"].isin(*pii.BASE))
    count = [of_kind("_pii_spans", k) for k in pii.BASE]
    return found.select("doc_id", *count, F.sha2(spans_text(base), 256).alias("base_sha256"), spans_text(F.col("_pii_spans")).alias("spans"))


def op6_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    fold = toxicity.fold(F.col("doc_id"))
    model = langid.train(docs.where(fold != 1), F.col("doc_id"))
    found = langid.identify(docs.select("doc_id", "text"), model)
    held_out = F.coalesce(fold == 1, F.lit(False)).alias("held_out")
    return found.select("doc_id", held_out, F.col("_li_lang").alias("lang_pred"), F.col("_li_score").alias("score"))


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.remove_repeats(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    n_removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select(
        F.col("id").alias("doc_id"), "n_bytes", n_removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack(read_table(spark, sf_dir, "documents").select("doc_id", "text"), keep="ids_crc32")
    return packed.select(F.col("id").alias("doc_id"), "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The spans are kept in a written table, so that no column of the result scans the texts again.
    found = written(secrets.scan(read_table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text"), "secrets")
    kinds = [r.kind for r in secrets.BASE]
    base = F.filter("_sec_spans", lambda s: s["kind"].isin(kinds))
    count = [of_kind("_sec_spans", k) for k in kinds]
    return found.select("doc_id", *count, F.sha2(spans_text(base), 256).alias("base_sha256"), spans_text(F.col("_sec_spans")).alias("spans"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    fold = toxicity.fold(F.col("doc_id"))
    labels = read_table(spark, sf_dir, "labels").where("toxic in (0, 1)").select("doc_id", F.col("toxic").cast("int").alias("label"))
    labelled = docs.where(fold != 1).join(small_or_shuffled(labels.where(fold != 1)), "doc_id")
    index = toxicity.train(labelled.select(F.col("doc_id").alias("id"), "text", "label"))
    found = toxicity.rate(docs, index)
    return found.select(
        "doc_id", F.coalesce(fold == 1, F.lit(False)).alias("held_out"), F.col("_tx_score").alias("score"),
        F.when(F.col("_tx_score") >= 0.7, 1).otherwise(0).cast("int").alias("predicted"), F.col("_tx_evidence").alias("evidence"),
    )


def op11_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"))
    found = sharding.shard(docs, carry=["doc_id", "text_crc32"])
    return found.select("row.doc_id", "size", "row.text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(read_table(spark, sf_dir, "documents").select("doc_id", "text")).select("word", "n", "n_near", "form", "form_n", "root")


def repeating(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text) where one in ten, by a hash of the id, repeats a stretch of its words from some word on to its end."""
    h = F.crc32(F.col("doc_id").cast("string"))
    words = docs.withColumn("h", h).withColumn("w", F.when(F.col("h") % 10 == 0, F.regexp_extract_all("text", F.lit(mixing.WORD), F.lit(0))))
    placed = words.withColumn("g", F.expr("h div 10")).withColumn("n", F.size("w")).withColumn("a", F.when(F.col("n") > 0, F.expr("cast(g % n as int)"))).withColumn(
        "p", F.expr("cast(1 + (n - a) div (3 + g % 8) as int)"))
    spread = F.expr("array_join(concat(slice(w, 1, a), slice(flatten(array_repeat(slice(w, a + 1, p), cast(ceil((n - a) / p) as int))), 1, n - a)), ' ')")
    return placed.select("doc_id", F.when(F.col("a").isNotNull(), spread).otherwise(F.col("text")).alias("text"))


def op13_periodic(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic.periodic_runs(repeating(read_table(spark, sf_dir, "documents").select("doc_id", "text")))
    longest = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("minus"), r["start"].alias("start"), r["period"].alias("period"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    return found.select("id", F.size("runs").cast("long").alias("n_runs"), longest.alias("longest"), F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256")).select(
        F.col("id").alias("doc_id"), "n_runs", F.col("longest.start").alias("start"), (-F.col("longest.minus")).alias("length"), F.col("longest.period").alias("period"),
        F.expr("(-longest.minus * 1000) div longest.period").alias("exponent_milli"), "runs_sha256", "collapsed_sha256")


QUERIES = {
    "op1_simhash": op1_simhash,
    "op2_exact_dedup": op2_exact_dedup,
    "op3_mixing": op3_mixing,
    "op4_quality": op4_quality,
    "op5_pii": op5_pii,
    "op6_langid": op6_langid,
    "op7_suffix_dedup": op7_suffix_dedup,
    "op8_packing": op8_packing,
    "op9_secrets": op9_secrets,
    "op10_toxicity": op10_toxicity,
    "op11_sharding": op11_sharding,
    "op12_spelling": op12_spelling,
    "op13_periodic": op13_periodic,
}

ORACLE = {
    "op2_exact_dedup": r"""
WITH n AS (
  SELECT doc_id, row_number() OVER () AS rn,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t
  FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
       row_number() OVER (PARTITION BY t ORDER BY doc_id NULLS LAST, rn) = 1 AS kept, sha256(t) AS text_sha256
FROM n""",
    "op3_mixing": r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, 3 * source_size AS lim,
             1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS w FROM s),
b AS (SELECT *, sum(source_size) OVER () AS total, sum(w) OVER () AS tw,
             coalesce(sum(lim) OVER q, 0) AS lim_before, coalesce(sum(w) OVER q, 0) AS w_before
      FROM w WINDOW q AS (ORDER BY lim::DOUBLE / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
f AS (SELECT *, lim::DOUBLE / w <= (total - lim_before)::DOUBLE / (tw - w_before) AS filled FROM b),
t AS (SELECT source, source_size,
             CASE WHEN filled THEN lim::DOUBLE
                  ELSE (w * (total - coalesce(sum(lim) FILTER (filled) OVER (), 0)))::DOUBLE
                       / (tw - coalesce(sum(w) FILTER (filled) OVER (), 0))::DOUBLE END AS target FROM f),
r AS (SELECT d.*, t.source_size, t.target,
             CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0.0 END AS rate,
             ('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, 'null')), 1, 8))::BIGINT / 4294967296.0 AS u
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       (size * (floor(rate) + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM r""",
    # crc32 by its table, which follows from the polynomial.
    "op12_spelling": r"""
WITH RECURSIVE tab AS (
  SELECT list_transform(range(256), lambda i: list_reduce([i, 1, 1, 1, 1, 1, 1, 1, 1], lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
runs AS (
  SELECT coalesce(doc_id::VARCHAR, 'null') AS id,
         translate(unnest(regexp_extract_all(text, '[A-Za-z\x{00C0}-\x{00FF}]{7,}')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low
  FROM documents),
each AS (SELECT id, low, count(*) AS n FROM runs GROUP BY ALL),
hexed AS (SELECT *, hex(encode(id || ':' || low)) AS x FROM each),
hashed AS (
  SELECT low, n, xor(list_reduce(list_prepend(4294967295, list_transform(range(1, len(x) + 1, 2), lambda i: ('0x' || substr(x, i, 2))::BIGINT)),
                                 lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) AS h
  FROM hexed, tab),
words AS (
  SELECT CASE WHEN h % 31 = 0 THEN substr(low, 1, h % length(low)) || substr(low, h % length(low) + 2) ELSE low END AS word, n FROM hashed),
v AS (SELECT word, sum(n)::BIGINT AS n FROM words WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
cut AS (
  SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM (SELECT *, unnest(range(1, length(word) + 1)) AS i FROM v)),
pairs AS (
  SELECT a.word, b.word AS other, b.n FROM cut a JOIN cut b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM cut a JOIN v b ON a.rest = b.word
  UNION SELECT b.word, a.word, a.n FROM cut a JOIN v b ON a.rest = b.word),
near AS (
  SELECT word, count(*) AS n_near, first(other ORDER BY n DESC, other) AS best, max(n) AS best_n FROM pairs GROUP BY word),
f AS (
  SELECT word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN best_n >= 10 * v.n THEN best END AS form,
         CASE WHEN best_n >= 10 * v.n THEN best_n END AS form_n FROM v LEFT JOIN near USING (word)),
chain AS (
  SELECT word, word AS here, 0 AS step FROM f UNION ALL SELECT c.word, f.form, step + 1 FROM chain c JOIN f ON f.word = c.here WHERE f.form IS NOT NULL),
ends AS (SELECT word, max_by(here, step) AS root FROM chain GROUP BY word)
SELECT word, n, n_near, form, form_n, root FROM f JOIN ends USING (word)""",
}
