"""Shards that all hold the mixture of sources: proportional stratified interleaving.

Rows are shuffled by a seeded hash and ranked within their source. Row r of n gets the fraction
(r - 1/2) / n; sorted by it, every stretch of rows holds the sources in proportion. The sorted rows are
cut into equal stretches. Both rankings are range sorts numbered by partition, so a source may hold
any share of the rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mysem.session import written

# Rows of one partition are numbered in the low bits of monotonically_increasing_id.
_LOW = (1 << 33) - 1


def _sorted_and_numbered(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """``df`` sorted over all partitions, with ``part`` and ``place`` (from 0) of each row."""
    ordered = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id())
    at = F.col("at")
    return written(ordered, name).withColumns({"part": F.shiftright(at, 33), "place": at.bitwiseAND(F.lit(_LOW))}).drop("at")


def interleaved(df: DataFrame, shards: int, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", seed: int = 17) -> DataFrame:
    """One row per row of ``df``: ``doc_id, size, text_crc32, shard, slot``.

    ``size`` is the text's UTF-8 bytes plus 8; null texts have none. Shards 0 to ``shards`` - 1 differ by at most
    one row; ``slot`` counts from 0 in each. Rows without a source are a source of their own. Rows that
    repeat an id are told apart by where they were read. Empty tables give no rows.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary")
    # Thin rows are written once: the sorts sample their input and must not read the texts again.
    thin = written(
        df.select(
            F.col(id_col).cast("long").alias("doc_id"),
            F.col(source_col).cast("string").alias("source"),
            (F.octet_length(text) + 8).cast("long").alias("size"),
            F.crc32(text).alias("text_crc32"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "shard-rows",
    ).withColumn("lot", F.xxhash64(F.lit(seed), "doc_id"))

    ranked = _sorted_and_numbered(thin, [F.col("source"), F.col("lot"), F.col("row")], "shard-ranks")
    # One row per partition and source in it: at most partitions plus sources.
    runs = ranked.groupBy("source", "part").agg(F.count("*").alias("n"), F.min("place").alias("first"))
    sources = runs.groupBy("source").agg(F.sum("n").alias("total"))
    before = F.sum("n").over(Window.partitionBy("source").orderBy("part")) - F.col("n")
    starts = runs.withColumn("before", before).join(sources.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of"))).select(
        F.col("source").alias("run_source"), F.col("part").alias("run_part"), "first", "before", "total"
    )
    starts = written(starts, "shard-runs")
    placed = ranked.join(starts, F.col("source").eqNullSafe(F.col("run_source")) & (F.col("part") == F.col("run_part")))
    fraction = (F.col("before") + F.col("place") - F.col("first") + F.lit(0.5)) / F.col("total")
    placed = written(placed.select("doc_id", "source", "size", "text_crc32", "lot", "row", fraction.alias("fraction")), "shard-fractions")

    mixed = _sorted_and_numbered(placed, [F.col("fraction"), F.col("source"), F.col("lot"), F.col("row")], "shard-order")
    # One row per partition.
    parts = mixed.groupBy("part").agg(F.count("*").alias("n"))
    everything = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    offsets = parts.select(
        F.col("part").alias("of_part"),
        (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("offset"),
        F.sum("n").over(everything).alias("rows"),
    )
    at = mixed.join(F.broadcast(offsets), F.col("part") == F.col("of_part")).withColumn("at", F.col("offset") + F.col("place"))
    numbered = at.withColumn("shard", F.expr(f"(at * {int(shards)}) div rows"))
    # The first place of shard s is the ceiling of s * rows / shards.
    return numbered.select(
        "doc_id", "size", "text_crc32", F.col("shard").cast("int").alias("shard"), F.expr(f"at - (shard * rows + {int(shards)} - 1) div {int(shards)}").alias("slot")
    )
