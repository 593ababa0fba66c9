"""A hashed linear scorer whose parts are joined by noisy-or, trained by iterative parameter mixing.

A document has parts (sentences, or itself as only part); a part has hashed features. A part's
probability is the logistic of its weights' sum, the document's is noisy-or of its parts. In each
round every partition starts from the mixed weights, makes one AdaGrad pass over its documents, and
returns the weights it changed; their means over the partitions that changed them, less a shrinkage
towards zero, are the next weights.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mysem.llm import texts as T
from mysem.session import written

BITS = 22
SIZE = 1 << BITS
PARTITIONS = 8
ROUNDS = 10
BATCH = 4
# Features of fewer documents have no weight.
MIN_DOCUMENTS = 4

EXAMPLES = "label double, features array<int>, amounts array<float>, parts array<int>"


def places(hashes: np.ndarray) -> np.ndarray:
    """Weight numbers of hashed features; the last one is the bias."""
    return (hashes % np.uint64(SIZE - 1)).astype(np.int32)


def sampled(ids: DataFrame, most: int, id_col: str = "doc_id") -> DataFrame:
    """About ``most`` rows by a hash of the id, never more than twice that; all if there are fewer."""
    n = ids.count()
    if n <= most:
        return ids
    return ids.where(F.pmod(F.xxhash64(F.lit("sample"), id_col), F.lit(1 << 30)) < int((1 << 30) * most / n)).limit(2 * most)


def logistic(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


class Weights:
    """Weights as the few that are not zero, which is what is broadcast; a task spreads them out once."""

    def __init__(self, weights: np.ndarray):
        self.at = np.flatnonzero(weights).astype(np.int32)
        self.values = weights[self.at].astype(np.float32)

    @property
    def dense(self) -> np.ndarray:
        if "spread" not in self.__dict__:
            self.spread = np.zeros(SIZE, dtype=np.float32)
            self.spread[self.at] = self.values
        return self.spread


def part_scores(weights: np.ndarray, features: np.ndarray, amounts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Probability of each part; ``sizes`` are the numbers of features of the parts."""
    starts = np.cumsum(sizes) - sizes
    return logistic(T.sums_by_row(weights[features] * amounts, starts, len(features)) + weights[SIZE - 1])


def noisy_or(scores: np.ndarray, parts: np.ndarray) -> np.ndarray:
    """1 less the product of (1 - score) over the parts of each document; 0 without parts."""
    starts = np.cumsum(parts) - parts
    return -np.expm1(T.sums_by_row(np.log1p(-np.clip(scores, 0, 1 - 1e-12)), starts, len(scores)))


def train(examples: DataFrame, bias: float, rate: float = 0.5, decay: float = 1e-4, shrink: float = 0.0, rounds: int = ROUNDS) -> np.ndarray:
    """Weights fitted to ``examples`` (columns of ``EXAMPLES``), which are few by contract: a bounded sample.

    After each round all weights but the bias move ``shrink`` towards zero and stop there, so that features which
    do not recur lose their weight.
    """
    spark = examples.sparkSession
    # Dealt and sorted by what they hold, so that the weights do not depend on how the input was split.
    order = [F.xxhash64("features", "amounts", "parts", "label"), F.xxhash64("parts", "label", "features")]
    examples = written(examples.repartition(PARTITIONS, order[0]).sortWithinPartitions(*order), "examples")
    common = examples.select(F.explode(F.array_distinct("features")).alias("at")).groupBy("at").count().where(F.col("count") >= MIN_DOCUMENTS)
    usable = np.append(common.select("at").toPandas()["at"].to_numpy(dtype=np.int32), np.int32(SIZE - 1))
    used = spark.sparkContext.broadcast(usable)
    weights = np.zeros(SIZE, dtype=np.float32)
    weights[SIZE - 1] = bias
    for _ in range(rounds):
        shared = spark.sparkContext.broadcast(Weights(weights))

        def fit(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            start = shared.value.dense
            w = start.astype(np.float64)
            allowed = np.zeros(SIZE, dtype=bool)
            allowed[used.value] = True
            squares = np.full(SIZE, 1e-2)
            for batch in batches:
                rows = list(zip(batch.column("label").to_pylist(), *(batch.column(c) for c in ("features", "amounts", "parts"))))
                for first in range(0, len(rows), BATCH):
                    some = rows[first : first + BATCH]
                    numbers = lambda k: [r[k].values.to_numpy(zero_copy_only=False) for r in some]
                    features, amounts = np.concatenate(numbers(1)), np.concatenate(numbers(2)).astype(np.float64)
                    per_doc = numbers(3)
                    sizes = np.concatenate(per_doc).astype(np.int64)
                    n_parts = np.array([len(x) for x in per_doc])
                    if not len(sizes):
                        continue
                    p = part_scores(w, features, amounts, sizes)
                    whole = np.repeat(np.clip(noisy_or(p, n_parts), 1e-9, 1 - 1e-9), n_parts)
                    y = np.repeat([r[0] for r in some], n_parts)
                    slope = y * p * (1 - whole) / whole - (1 - y) * p
                    # Weight of the document, not of its many parts, on the bias.
                    bias_change = slope.sum() / max(1.0, n_parts.mean())
                    at, where = np.unique(np.append(features, SIZE - 1), return_inverse=True)
                    change = np.bincount(where, weights=np.append(np.repeat(slope, sizes) * amounts, bias_change))
                    at, change = at[allowed[at]], change[allowed[at]]
                    step = change - decay * w[at]
                    squares[at] += step * step
                    w[at] += rate * step / np.sqrt(squares[at])
            at = np.flatnonzero(w != start)
            yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(w[at])], names=["at", "w"])

        # The usable features: those of MIN_DOCUMENTS of a bounded sample.
        mixed = examples.mapInArrow(fit, "at int, w double").groupBy("at").agg(F.avg("w").alias("w")).toPandas()
        shared.destroy()
        weights = weights.copy()
        weights[mixed["at"].to_numpy()] = mixed["w"].to_numpy()
        weights[:-1] = np.sign(weights[:-1]) * np.maximum(np.abs(weights[:-1]) - np.float32(shrink), 0)
    return weights
