"""Exact duplicates through content-defined chunk recipes.

A text is cut where a rolling hash of its bytes says so, and becomes a recipe: the ordered
list of its chunks' 64-bit identifiers. An identifier is verified when every chunk that has it
agrees in 128 bits of its SHA-256 digest; recipes that hold an identifier of two different
chunks are compared with those digests too. Texts are read once and never shuffled: what moves
is 8 bytes per chunk for the comparison and 24 for the verification, combined before the shuffle.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mysem.llm import texts as T
from mysem.session import written

WINDOW = 16
MIN_BYTES = 256
MAX_BYTES = 1 << 16
CUT_BITS = 11

# One 32-bit value per byte, from a rule.
_GEAR = (T.mixed(np.arange(256) + 1) >> np.uint64(32)).astype(np.uint32)


def cuts(data: bytes, starts: np.ndarray, total: int) -> list[list[int]]:
    """For each text (``starts`` in ``data``) its chunk ends: content-defined, 256 to 65536 bytes, the last one shorter."""
    flat = np.frombuffer(data, dtype=np.uint8)
    rolled = _GEAR[flat]
    for step in (1, 2, 4, 8):
        rolled[step:] = rolled[step:] + (rolled[:-step] << np.uint32(step))
    found = np.flatnonzero((rolled >> np.uint32(32 - CUT_BITS)) == 0) + 1
    ends = np.append(starts[1:], total)
    lows, highs = np.searchsorted(found, starts), np.searchsorted(found, ends)
    out = []
    for start, end, low, high in zip(starts.tolist(), ends.tolist(), lows.tolist(), highs.tolist()):
        last, mine = start, []
        for at in found[low:high].tolist():
            while at - last > MAX_BYTES:
                last += MAX_BYTES
                mine.append(last)
            if at - last >= MIN_BYTES and at < end:
                mine.append(at)
                last = at
        while end - last > MAX_BYTES:
            last += MAX_BYTES
            mine.append(last)
        mine.append(end)
        out.append(mine)
    return out


def _recipes(batch: pa.RecordBatch, bits: int) -> pa.RecordBatch:
    parts = [(t or "").encode("utf-8", "surrogatepass").lower() for t in batch.column("text").to_pylist()]
    sizes = np.fromiter(map(len, parts), dtype=np.int64, count=len(parts))
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    whole = [hashlib.sha256(p).hexdigest() for p in parts]
    data = b"".join(parts)
    ids, high, low = [], [], []
    for start, ends in zip(starts.tolist(), cuts(data, starts, len(data))):
        mine: list[int] = []
        checks: list[bytes] = []
        for end in ends:
            piece = data[start:end]
            mine.append(int.from_bytes(hashlib.blake2b(piece, digest_size=8).digest(), "big", signed=True) >> (64 - bits))
            checks.append(hashlib.sha256(piece).digest())
            start = end
        ids.append(mine)
        high.append([int.from_bytes(c[:8], "big", signed=True) for c in checks])
        low.append([int.from_bytes(c[8:16], "big", signed=True) for c in checks])
    longs = pa.list_(pa.int64())
    return pa.RecordBatch.from_arrays(
        [batch.column("doc_id"), pa.array(whole), pa.array(ids, longs), pa.array(high, longs), pa.array(low, longs)],
        names=["doc_id", "text_sha256", "recipe", "high", "low"],
    )


def exact_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", id_bits: int = 64) -> DataFrame:
    """One row per row of ``df``: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Texts are equal when identical after lower-casing A-Z. Of equal texts the largest id stays.
    Null texts count as empty; empty texts equal each other. Null ids never win over others; a group
    of null ids only has a null ``keep_id`` and is kept. Rows that repeat both id and text are one
    document: all carry the same answer and all count in ``group_size``. Empty tables give no rows.
    ``id_bits`` shortens the identifiers, which only tests need.
    """
    rows = T.inputs(df, id_col, text_col)
    recipes = written(
        T.map_runs(
            rows,
            "doc_id bigint, text_sha256 string, recipe array<bigint>, high array<bigint>, low array<bigint>",
            lambda batch: _recipes(batch, id_bits),
        ).withColumn("row", F.monotonically_increasing_id()),
        "chunk-recipes",
    )
    chunks = recipes.select("row", F.explode(F.arrays_zip("recipe", "high", "low")).alias("c")).select("row", "c.*")
    store = chunks.groupBy("recipe").agg(*[f(c).alias(f"{n}_{c}") for c in ("high", "low") for n, f in (("least", F.min), ("most", F.max))])
    # Written, so that the join below has a plain table on either side and Spark can split a hot chunk.
    shared = written(store.where("least_high <> most_high OR least_low <> most_low").select("recipe"), "shared-identifiers")
    # Documents with an identifier of two different chunks; none in practice.
    unsure = chunks.select("row", "recipe").join(shared, "recipe", "left_semi").select("row").distinct().withColumn("unsure", F.lit(True))
    keyed = recipes.join(unsure, "row", "left").select(
        "doc_id", "text_sha256", F.when(F.col("unsure"), F.concat("recipe", "high", "low")).otherwise(F.col("recipe")).alias("key")
    )
    groups = written(
        keyed.groupBy("key").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size")).where("group_size > 1"), "copy-groups"
    )
    many = F.col("group_size").isNotNull()
    return keyed.join(groups, "key", "left").select(
        "doc_id",
        F.when(many, F.col("keep_id")).otherwise(F.col("doc_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).alias("group_size"),
        F.when(many, F.col("doc_id").eqNullSafe(F.col("keep_id"))).otherwise(True).alias("kept"),
        "text_sha256",
    )
