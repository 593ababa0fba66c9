"""One query per operator, with production parameters, over whole tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mysem.llm import bytepairs, decontaminate, dedup_exact, dialogues, language, neardup, pieces, pii, quality, runs, secrets, sharding, toxicity
from mysem.llm.registry import query, table

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@query(
    "op10_exact_dedup",
    f"""
    SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
           doc_id = max(doc_id) OVER w AS kept, sha256(t) AS text_sha256
    FROM (SELECT doc_id, translate(coalesce(text, ''), '{UPPER}', '{LOWER}') AS t FROM documents)
    WINDOW w AS (PARTITION BY t)
    """,
)
def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which documents are copies of which."""
    return dedup_exact.exact_duplicates(table(spark, sf_dir, "documents"))


@query(
    "op8_decontaminate",
    rf"""
    WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
    b AS (SELECT CAST(item_id AS VARCHAR) AS item_id, regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
          FROM benchmark WHERE item_id IS NOT NULL AND text IS NOT NULL),
    q AS (SELECT DISTINCT item_id, k, array_to_string(w[i:i + k - 1], ' ') AS gram
          FROM (SELECT item_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM (SELECT *, least(10, len(w)) AS k FROM b WHERE len(w) > 0))),
    g AS (SELECT doc_id, k, i, array_to_string(w[i:i + k - 1], ' ') AS gram
          FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, (SELECT DISTINCT k FROM q) WHERE len(w) >= k)),
    m AS (SELECT doc_id, item_id, g.k, i FROM g JOIN q ON g.gram = q.gram AND g.k = q.k),
    h AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM m) GROUP BY doc_id),
    t AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids FROM (SELECT DISTINCT doc_id, item_id FROM m) GROUP BY doc_id)
    SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
           sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
    FROM d LEFT JOIN h USING (doc_id) LEFT JOIN t USING (doc_id)
    """,
)
def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How much of each document is benchmark text."""
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


@query("op1_language_id")
def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of each document."""
    return language.identify(table(spark, sf_dir, "documents"))


@query("op7_sharding")
def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """24 shards, each with the mixture of sources."""
    placed = sharding.interleaved(table(spark, sf_dir, "documents"), shards=24)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


@query("op9_sentencepiece")
def op9_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The token ids of each document, decoded again."""
    return pieces.encode_texts(table(spark, sf_dir, "documents"))


@query("op4_toxicity")
def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How toxic each document is, and its offending sentences."""
    docs = table(spark, sf_dir, "documents")
    weights = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, weights, toxicity.is_held_out("doc_id").alias("held_out")).select(
        "doc_id", "held_out", "score", "predicted", "n_sentences", "offending"
    )


@query("op2_quality")
def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How good each document is, learned without labels."""
    return quality.assess(table(spark, sf_dir, "documents"))


@query("op3_ngram_jaccard")
def op3_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes of near-duplicate documents and each document's number of links."""
    return neardup.near_duplicates(table(spark, sf_dir, "documents"))


@query("op6_secrets")
def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of each document."""
    return secrets.scan(table(spark, sf_dir, "documents"))


@query("op5_pii")
def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of each document."""
    return pii.scan(table(spark, sf_dir, "documents"))


@query("op11_conversation_repair")
def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults of damaged conversations and their cheapest repair."""
    given = table(spark, sf_dir, "conversations")
    return dialogues.of_all(dialogues.audit(dialogues.damaged(given)), given)


def _sha(text) -> Column:
    return F.sha2(text.cast("binary"), 256)


@query("op12_periodic_runs")
def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of words of each document, some of which are made to repeat themselves."""
    found = runs.periodic_runs(runs.with_repeats(table(spark, sf_dir, "documents")))
    # The longest; of equal ones the first to start, then the shortest period.
    best = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("order"), r["start"].alias("start"), r["period"].alias("period"), r["length"].alias("length"))))
    lines = F.transform("runs", lambda r: F.concat_ws(",", *[r[c].cast("string") for c in ("start", "length", "period")]))
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        *[F.col(f"best.{c}").alias(c) for c in ("start", "length", "period")],
        F.floor(F.expr("best.length * 1000 div best.period")).cast("long").alias("exponent_milli"),
        _sha(F.array_join(F.transform(lines, lambda x: F.concat(x, F.lit("\n"))), "")).alias("runs_sha256"),
        _sha(F.col("collapsed")).alias("collapsed_sha256"),
    )


@query("op13_byte_pairs")
def op13_byte_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Byte-level BPE ids of each document, decoded again."""
    docs = table(spark, sf_dir, "documents").withColumn("text", F.coalesce("text", F.lit("")))
    return bytepairs.encode_texts(docs).select(
        "doc_id", "n_tokens", _sha(F.array_join(F.col("ids").cast("array<string>"), ",")).alias("ids_sha256"), _sha(F.col("decoded")).alias("decoded_sha256")
    )
