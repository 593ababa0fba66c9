"""Toxic documents and the sentences that make them so: multiple-instance learning with noisy-or.

Only documents are labelled. A sentence's probability is the logistic of the weights of its words and of
their first four characters (hashed); a document's is noisy-or of its sentences'. Gradients reach the
sentences through noisy-or, so that the scorer learns which sentences account for the labels. Weights
shrink after each round: one sentence of a document suffices for its label, and what else stands in it
must not share the credit.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mysem.llm import hashed
from mysem.llm import texts as T

# Documents the scorer is fitted on; all are used if there are fewer.
MAX_TRAINING_DOCUMENTS = 20_000
PREFIX = 4
# How far weights shrink after each round of training.
SHRINK = 0.1
_PREFIX_SALT = np.uint64(0x5851F42D4C957F2D)
# Characters that end a sentence.
ENDS = ".!?\n"


def sentences(texts: list[str]) -> tuple[np.ndarray, ...]:
    """Features of all sentences with words, their number per sentence, sentences per text, and where each begins and ends in its text."""
    codes, starts = T.code_points(texts)
    lowered = [t.lower() for t in texts]
    if all(len(low) == len(t) for low, t in zip(lowered, texts)):
        lower = T.code_points(lowered)[0]
    else:
        # Lower-casing that changes a length would shift positions: lower A-Z only.
        lower = T.ascii_lower(codes)
    at, size, words, heads = T.words(lower, T.word_mask(lower), PREFIX)
    end = np.isin(codes, np.array([ord(c) for c in ENDS], dtype=np.uint32))
    # Sentence numbers; the line feed after each text ends its last sentence.
    number = np.cumsum(end) - end
    of_word = number[at]
    present, first, count = np.unique(of_word, return_index=True, return_counts=True)
    features = np.empty(2 * len(at), dtype=np.int32)
    features[0::2] = hashed.places(words)
    features[1::2] = hashed.places(heads ^ _PREFIX_SALT)
    begin = at[first]
    last = first + count - 1
    stop = at[last] + size[last] if len(first) else at
    text = np.searchsorted(starts, begin, "right") - 1
    return features, 2 * count, np.bincount(text, minlength=len(texts)), begin - starts[text], stop - starts[text]


def training_rows(df: DataFrame, labels: DataFrame, most: int = MAX_TRAINING_DOCUMENTS, folds: int = 5, fold: int = 0) -> DataFrame:
    """Examples of a bounded sample of the labelled rows outside the held-out fold.

    Rows without id or label teach nothing; an id with several labels counts with their mean.
    """
    ids = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("double").alias("label"))
    ids = ids.where("doc_id IS NOT NULL AND label IS NOT NULL").where(~is_held_out("doc_id", folds, fold)).groupBy("doc_id").agg(F.avg("label").alias("label"))
    # At most twice ``most`` rows of two numbers.
    sample = F.broadcast(hashed.sampled(ids, most))
    rows = T.inputs(df, "doc_id", "text").where("text IS NOT NULL").join(sample, "doc_id")

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        features, sizes, parts, _, _ = sentences(batch.column("text").to_pylist())
        ends = np.cumsum(parts)
        words = np.concatenate([[0], np.cumsum(sizes)])
        cut = words[np.concatenate([[0], ends])]
        lists = lambda flat, at, kind: pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(flat, kind))
        return pa.RecordBatch.from_arrays(
            [
                batch.column("label"),
                lists(features, cut, pa.int32()),
                lists(np.ones(len(features), np.float32), cut, pa.float32()),
                lists(sizes.astype(np.int32), np.concatenate([[0], ends]), pa.int32()),
            ],
            names=["label", "features", "amounts", "parts"],
        )

    return T.map_runs(rows, hashed.EXAMPLES, run)


def is_held_out(id_col: str, folds: int = 5, fold: int = 0) -> Column:
    """Whether a row is held out of training, by its id; rows without an id are."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % folds == fold, F.lit(True))


def fit(df: DataFrame, labels: DataFrame, most: int = MAX_TRAINING_DOCUMENTS) -> np.ndarray:
    """Weights learned from a documents and a labels table; without examples every score is near 0."""
    return hashed.train(training_rows(df, labels, most), bias=-5.0, decay=0.0, shrink=SHRINK)


def score(df: DataFrame, weights: np.ndarray, *more: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row ``doc_id``, the columns ``more``, ``score``, ``predicted``, ``n_sentences`` and ``offending``.

    ``offending``: start, end (code points) and probability of the sentences at 0.5 or more. Null and empty texts,
    and texts without words, have no sentence and score 0. Rows that repeat an id each get a row.
    """
    shared = df.sparkSession.sparkContext.broadcast(hashed.Weights(weights))
    rows = T.inputs(df, id_col, text_col, *more)
    extra = [f for f in rows.schema.fields if f.name not in ("doc_id", "text")]
    span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        features, sizes, parts, begin, stop = sentences([t or "" for t in batch.column("text").to_pylist()])
        p = hashed.part_scores(shared.value.dense, features, 1.0, sizes)
        owner = np.repeat(np.arange(len(parts)), parts)
        whole = hashed.noisy_or(p, parts) + 0.0
        found: dict[int, list[dict]] = {}
        for i in np.flatnonzero(p >= 0.5).tolist():
            found.setdefault(int(owner[i]), []).append({"start": int(begin[i]), "end": int(stop[i]), "score": float(p[i])})
        return pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                *(batch.column(f.name) for f in extra),
                pa.array(whole),
                pa.array((whole >= 0.5).astype(np.int32)),
                pa.array(parts.astype(np.int64)),
                pa.array([found.get(i, []) for i in range(len(parts))], span),
            ],
            names=["doc_id", *(f.name for f in extra), "score", "predicted", "n_sentences", "offending"],
        )

    kinds = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in extra)
    return T.map_runs(rows, f"doc_id bigint, {kinds}score double, predicted int, n_sentences bigint, offending array<struct<start:int,end:int,score:double>>", run)
