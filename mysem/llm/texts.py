"""Whole texts as flat numpy arrays, and mapping over Arrow batches in bounded pieces."""

from __future__ import annotations

import os
import shutil
import tempfile
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Rows are handled in runs of about this many bytes of text; a longer text is a run of its own.
RUN_BYTES = 1 << 20

_MIX_A = np.uint64(0x9E3779B97F4A7C15)
_MIX_B = np.uint64(0xBF58476D1CE4E5B9)
_BASE = np.uint64(0x2545F4914F6CDD1D)


def inputs(df: DataFrame, id_col: str, text_col: str, *more: Column) -> DataFrame:
    """Only what an operator reads, under its own names, so other columns of any name do not matter."""
    return df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), *more)


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Let the Python workers of a local session import this package.

    On a cluster the package is deployed as usual (``--py-files`` or ``PYTHONPATH``).
    """
    context = spark.sparkContext
    if context.applicationId in _shipped or not context.master.startswith("local") or context.master.startswith("local-cluster"):
        return
    top = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    context.addPyFile(shutil.make_archive(os.path.join(tempfile.mkdtemp(prefix="mysem-py-"), "mysem"), "zip", top, "mysem"))
    _shipped.add(context.applicationId)


def map_runs(df: DataFrame, schema: str, fn: Callable[[pa.RecordBatch], pa.RecordBatch | None], sized_by: str = "text") -> DataFrame:
    """Apply ``fn`` to runs of rows; memory follows ``RUN_BYTES`` and the longest single text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end in run_ranges(batch.column(sized_by)):
                out = fn(batch.slice(first, end - first))
                if out is not None and out.num_rows:
                    yield out

    ship(df.sparkSession)
    return df.mapInArrow(run, schema)


def run_ranges(texts: pa.Array) -> list[tuple[int, int]]:
    """Row ranges whose texts hold about ``RUN_BYTES`` bytes."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    if not len(sizes):
        return []
    run = np.cumsum(sizes) // RUN_BYTES
    cuts = [0, *(np.flatnonzero(np.diff(run)) + 1).tolist(), len(sizes)]
    return list(zip(cuts[:-1], cuts[1:]))


def mixed(values: np.ndarray) -> np.ndarray:
    """Well-spread 64-bit hashes of 64-bit values."""
    x = values.astype(np.uint64) * _MIX_A
    x ^= x >> np.uint64(31)
    x *= _MIX_B
    x ^= x >> np.uint64(29)
    return x


def code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the texts, each followed by a line feed, and where each text starts."""
    flat = np.frombuffer(("\n".join(texts) + "\n").encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    lengths = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
    return flat, np.concatenate([[0], np.cumsum(lengths + 1)[:-1]]).astype(np.int64)


def ascii_lower(codes: np.ndarray) -> np.ndarray:
    """A-Z to a-z, all else unchanged."""
    return codes + np.where((codes >= 65) & (codes <= 90), np.uint32(32), np.uint32(0))


def word_mask(codes: np.ndarray) -> np.ndarray:
    """True for digits, a-z and everything beyond ASCII (of lower-cased code points)."""
    return ((codes >= 97) & (codes <= 122)) | ((codes >= 48) & (codes <= 57)) | (codes >= 128)


def powers(n: int) -> np.ndarray:
    out = np.full(max(n, 1), _BASE, dtype=np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def words(codes: np.ndarray, mask: np.ndarray, prefix: int | None = None) -> tuple[np.ndarray, ...]:
    """Start, length and hash of each run of True in ``mask``; with ``prefix`` also the hash of its first code points."""
    at = np.flatnonzero(mask)
    if not len(at):
        empty = np.zeros(0, dtype=np.int64)
        return (empty, empty, empty.astype(np.uint64)) + ((empty.astype(np.uint64),) if prefix else ())
    first = np.concatenate([[0], np.flatnonzero(np.diff(at) != 1) + 1])
    length = np.diff(np.append(first, len(at)))
    place = np.arange(len(at)) - np.repeat(first, length)
    values = mixed(codes[at] + np.uint32(1)) * powers(int(length.max()))[place]
    hashes = mixed(np.add.reduceat(values, first) + length.astype(np.uint64))
    if not prefix:
        return at[first], length, hashes
    heads = mixed(np.add.reduceat(np.where(place < prefix, values, np.uint64(0)), first))
    return at[first], length, hashes, heads


def sums_by_row(values: np.ndarray, starts: np.ndarray, total: int) -> np.ndarray:
    """Sums of ``values`` between consecutive ``starts`` (of ``total`` values); empty ranges give 0."""
    running = np.concatenate([[0], np.cumsum(values)])
    return running[np.append(starts[1:], total)] - running[starts]

