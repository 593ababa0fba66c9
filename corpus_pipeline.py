"""The corpus pipeline: documents in a known language, once each, free of benchmark text, as tokens."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mysem.llm import decontaminate, dedup_exact, language, neardup, pieces
from mysem.llm.registry import query, table
from mysem.operators.numbering import number_rows
from mysem.session import written

# Up to this many rows to drop (16 bytes each) their keys are broadcast; more are joined by a shuffle.
SMALL_DROPS = 2_000_000


def _named(c: str) -> Column:
    """The column ``c``, whatever characters are in its name."""
    return F.col(f"`{c.replace('`', '``')}`")


def _keyed(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` with a key for each row, and the key's name, so that a decision on a row holds for that row alone, whatever its id.

    The key is the row's place in its file, the same at every pass, after the file's number. File names are numbered in a written table, which
    Spark joins as its size asks for. A file must not be listed twice. Rows that do not come straight from Parquet files are written first.
    """
    key = "_" * (1 + max(map(len, docs.columns))) + "row"
    try:
        places = docs.metadataColumn("_metadata")
        placed = docs.withColumns({key: places["row_index"], f"{key}_file": places["file_path"]})
        placed.schema  # fails here if the rows have no place
    except AnalysisException:
        return written(docs.withColumn(key, F.monotonically_increasing_id()), "keyed-rows"), key
    names = placed.select(f"{key}_file").distinct()
    numbers = written(number_rows(names, f"{key}_file", f"{key}_number", start=0), "files")
    rows = placed.join(numbers, f"{key}_file")
    return rows.select(*[_named(c) for c in docs.columns], (F.col(key) + F.shiftleft(f"{key}_number", 40)).alias(key)), key


def _without(rows: DataFrame, key: str, gone: DataFrame) -> DataFrame:
    """The documents of ``rows`` less those whose key is in ``gone.doc_id``."""
    gone = written(gone.select(F.col("doc_id").alias(key)), "gone")
    return rows.join(F.broadcast(gone) if gone.count() <= SMALL_DROPS else gone, key, "left_anti").drop(key)


def _all_but_one(rows: DataFrame, key: str, members: DataFrame, group: str, first: Column) -> DataFrame:
    """The ``members`` (keys as ``doc_id``) that are not the one of their ``group`` with the least ``first``, of equal ones the least key."""
    ids = members.join(rows.select(F.col(key).alias("doc_id"), F.col("doc_id").cast("long").alias("__id")), "doc_id")
    kept = ids.groupBy(group).agg(F.min(F.struct(first, "doc_id")).alias("kept")).select(F.col("kept.doc_id").alias("doc_id"))
    return members.join(kept, "doc_id", "left_anti")


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop texts without letters and texts that resemble no language of the labelled rows; with no labelled row drop only the former.

    How little resemblance is none is measured on labelled rows left out of training; if none are left out, texts with any resemblance stay.
    The columns travel with the prediction, so nothing is shuffled. Null and empty texts go; rows that repeat each get their own verdict.
    """
    filters = language.train(docs)
    if not filters.languages:
        return docs.where(F.coalesce(docs["text"].rlike(r"\p{L}"), F.lit(False)))
    cut = language.least_score(docs) or 0.0
    names = [f"__{i}" for i in range(len(docs.columns))]
    judged = language.predict(docs, filters, *[_named(c).alias(n) for c, n in zip(docs.columns, names)])
    kept = judged.where((F.col("lang_pred") != "und") & (F.col("score") >= cut))
    return kept.select(*[F.col(n).alias(c) for c, n in zip(docs.columns, names)])


def one_of_each_copy(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, keep one row, with the largest id; without an id only if no copy has one."""
    rows, key = _keyed(docs)
    copies = written(dedup_exact.exact_duplicates(rows, key).where("group_size > 1"), "copies")
    # Negative ids would overflow at the least long; its complement keeps the order.
    return _without(rows, key, _all_but_one(rows, key, copies, "keep_id", F.struct(F.col("__id").isNull(), F.bitwise_not("__id"))))


def one_of_each_class(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near-duplicates, keep one row, with the least id; without an id only if no other has one."""
    rows, key = _keyed(docs)
    alike = written(neardup.near_duplicates(rows, key).where("n_links > 0"), "alike")
    return _without(rows, key, _all_but_one(rows, key, alike, "class_id", F.struct(F.col("__id").isNull(), F.col("__id"))))


def free_of_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop rows with a window of a benchmark item.

    Null and empty texts stay, as all rows do if the benchmark has no words; rows that repeat each get their own verdict; a table without rows stays so.
    """
    rows, key = _keyed(docs)
    return _without(rows, key, decontaminate.contamination(rows, table(spark, sf_dir, "benchmark"), key).where("n_hit > 0"))


def as_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of what is left, and whether decoding gives the text back.

    Null texts have null ids, empty ones none; rows that repeat an id each get a row; a table without rows gives none.
    """
    return pieces.encode_texts(docs)


STAGES = [
    ("language ID", known_language),
    ("exact dedup", one_of_each_copy),
    ("n-gram Jaccard join", one_of_each_class),
    ("benchmark decontamination", free_of_benchmark),
    ("SentencePiece encoding and decoding", as_tokens),
]

# The language, near-duplicate and token stages are beyond SQL.
ORACLE_SQL = None


@query("pipeline", ORACLE_SQL)
def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
