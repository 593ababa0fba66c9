"""Text quality from weak labels.

Heuristic labellers vote good or bad on a document, or say nothing. Expectation-maximisation over the counts of
vote patterns of all documents estimates how accurate each labeller is and how likely each pattern means a good
document. The posteriors label a hashed linear scorer, which sees character classes and repetition, not the votes.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mysem.llm import hashed
from mysem.llm import texts as T
from mysem.session import written

# Documents the scorer is fitted on; all are used if there are fewer.
MAX_TRAINING_DOCUMENTS = 20_000
GOOD, BAD, NONE = "g", "b", "-"
EM_ROUNDS = 200
# Words among which different ones are counted.
WINDOW = 200
# Ordinary punctuation.
PUNCTUATION = ".,;:!?'\"()-\n"

# Labeller: name, its vote, statistic, and when it casts the vote; else it says nothing.
LABELLERS: list[tuple[str, str, str, Callable]] = [
    ("symbols", BAD, "symbol_share", lambda x: x > 0.06),
    ("capitals", BAD, "capital_share", lambda x: x > 0.5),
    ("echo", BAD, "repeated_word_share", lambda x: x > 0.15),
    ("monotony", BAD, "different_word_share", lambda x: x < 0.25),
    ("lines", BAD, "repeated_line_share", lambda x: x > 0.35),
    ("fragments", BAD, "lone_symbol_share", lambda x: x > 0.1),
    ("shouting", BAD, "exclamation_share", lambda x: x > 0.1),
    ("plain", GOOD, "symbol_share", lambda x: x < 0.02),
    ("variety", GOOD, "different_word_share", lambda x: x > 0.45),
    ("lower", GOOD, "capital_share", lambda x: x < 0.2),
]


def statistics(texts: list[str]) -> dict[str, np.ndarray]:
    """What the labellers look at, per text; 0 where a text has nothing to measure (variety: 1)."""
    codes, starts = T.code_points(texts)
    lower = T.ascii_lower(codes)
    word = T.word_mask(lower)
    ends = np.append(starts[1:], len(codes)) - 1
    per_text = lambda flags: T.sums_by_row(flags, starts, len(codes)).astype(float)
    ratio = lambda a, b: np.divide(a, b, out=np.zeros(len(texts)), where=b > 0)
    plain = word | np.isin(codes, np.array([32, *map(ord, PUNCTUATION)], dtype=np.uint32))
    # Beyond ASCII only a few letters matter here: those that a case change moves by 32.
    upper = (codes >= 65) & (codes <= 90) | (codes >= 0xC0) & (codes <= 0xDE)
    at, _, words = T.words(lower, word)
    first = np.searchsorted(at, starts)
    n_words = np.diff(np.append(first, len(at)))
    owner = np.repeat(np.arange(len(texts)), n_words)
    echo = np.zeros(len(at))
    echo[1:] = (words[1:] == words[:-1]) & (owner[1:] == owner[:-1])
    # Different words of each stretch of WINDOW words: equal ones of a stretch have equal keys.
    place = np.arange(len(at)) - np.repeat(first, n_words)
    stretch = np.cumsum(place % WINDOW == 0)
    different = owner[np.unique(T.mixed(words ^ T.mixed(stretch)), return_index=True)[1]]
    line_repeats = np.zeros(len(texts))
    for i, t in enumerate(texts):
        lines = [x for x in t.split("\n") if x]
        line_repeats[i] = 1 - len(set(lines)) / len(lines) if len(lines) > 2 else 0
    solid = (codes > 32).copy()
    token_at, token_size, _ = T.words(codes, solid)
    wordy = np.concatenate([[0], np.cumsum(word)])
    lone = (wordy[token_at + token_size] == wordy[token_at]).astype(float)
    token_first = np.searchsorted(token_at, starts)
    n_tokens = np.diff(np.append(token_first, len(token_at)))
    lone_sum = T.sums_by_row(lone, token_first, len(token_at))
    chars = (ends - starts).astype(float)
    # Long texts repeat words anyway, so variety is that of their stretches, by length.
    variety = np.where(n_words > 0, ratio(np.bincount(different, minlength=len(texts)).astype(float), n_words.astype(float)), 1.0)
    return {
        "symbol_share": ratio(per_text(~plain), chars),
        "capital_share": ratio(per_text(upper), per_text(word | upper)),
        "repeated_word_share": ratio(T.sums_by_row(echo, first, len(at)), n_words.astype(float)),
        "different_word_share": variety,
        "repeated_line_share": line_repeats,
        "lone_symbol_share": ratio(lone_sum, n_tokens.astype(float)),
        "exclamation_share": ratio(per_text(codes == ord("!")), np.maximum(n_words, 1).astype(float)),
    }


def votes(stats: dict[str, np.ndarray]) -> list[str]:
    """One character per labeller and text."""
    columns = [np.where(when(stats[s]), vote, NONE) for _, vote, s, when in LABELLERS]
    return ["".join(row) for row in zip(*columns)]


def features(texts: list[str], stats: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashed features, their amounts (length 1 per text) and their number per text: four-grams of character classes, and how repetitive words and lines are."""
    codes, starts = T.code_points(texts)
    kind = codes.astype(np.uint64) + np.uint64(16)
    lower = T.ascii_lower(codes)
    kind[T.word_mask(lower)] = 1
    kind[(codes >= 65) & (codes <= 90) | (codes >= 0xC0) & (codes <= 0xDE)] = 2
    kind[(codes >= 48) & (codes <= 57)] = 3
    values = T.mixed(kind)
    grams = T.mixed(sum((np.roll(values, -i) * T.powers(4)[i] for i in range(4)), np.zeros(len(codes), np.uint64)))
    ends = np.append(starts[1:], len(codes))
    inside = np.ones(len(codes), bool)
    for back in range(1, 5):
        inside[np.maximum(ends - back, 0)] = False
    owner = np.repeat(np.arange(len(texts)), ends - starts)[inside]
    pairs = (owner.astype(np.uint64) << np.uint64(hashed.BITS)) | hashed.places(grams[inside]).astype(np.uint64)
    levels = [
        (np.arange(len(texts), dtype=np.uint64) << np.uint64(hashed.BITS))
        | hashed.places(T.mixed((np.minimum(np.floor(stats[s] * 20), 20) + 100 * (k + 1)).astype(np.uint64))).astype(np.uint64)
        for k, s in enumerate(("repeated_word_share", "different_word_share", "repeated_line_share"))
    ]
    keys, counts = np.unique(np.concatenate([pairs, *levels]), return_counts=True)
    text = (keys >> np.uint64(hashed.BITS)).astype(np.int64)
    amounts = np.log1p(counts)
    sizes = np.bincount(text, minlength=len(texts))
    norm = np.sqrt(np.bincount(text, weights=amounts**2, minlength=len(texts)))
    amounts = amounts / np.maximum(norm, 1e-9)[text]
    # The repetition levels weigh as much as all the rest.
    amounts[np.searchsorted(keys, np.concatenate(levels))] = 0.5
    return (keys & np.uint64(hashed.SIZE - 1)).astype(np.int32), amounts, sizes


def estimate(patterns: dict[str, int], rounds: int = EM_ROUNDS) -> tuple[dict[str, float], list[tuple[float, float]], float]:
    """Posterior of good per vote pattern; per labeller the chance of its vote in its own and in the other class; the share of good.

    Silence says nothing: a labeller that looks for one fault knows nothing of others. Documents with any bad vote
    start as likely bad. A labeller is taken to be no worse than chance.
    """
    if not patterns:
        return {}, [], 0.5
    keys = sorted(patterns)
    counts = np.array([patterns[k] for k in keys], dtype=float)
    cast = np.array([[c != NONE for c in k] for k in keys])
    means_good = np.array([vote == GOOD for _, vote, _, _ in LABELLERS])
    post = np.where(cast[:, ~means_good].any(axis=1), 0.1, 0.9)
    for _ in range(rounds):
        good, bad = counts * post, counts * (1 - post)
        share = (good.sum() + 1) / (counts.sum() + 2)
        in_good = (good @ cast + 1) / (good.sum() + 2)
        in_bad = (bad @ cast + 1) / (bad.sum() + 2)
        ratio = np.log(in_good) - np.log(in_bad)
        ratio = np.where(means_good, np.maximum(ratio, 0), np.minimum(ratio, 0))
        fresh = hashed.logistic(np.log(share) - np.log(1 - share) + cast @ ratio)
        done = np.abs(fresh - post).max() < 1e-9
        post = fresh
        if done:
            break
    own, other = np.where(means_good, in_good, in_bad), np.where(means_good, in_bad, in_good)
    return dict(zip(keys, post.tolist())), list(zip(own.tolist(), other.tolist())), float(share)


def assess(df: DataFrame, most: int = MAX_TRAINING_DOCUMENTS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row ``doc_id, votes, posterior, score, predicted``.

    ``votes``: one character per labeller of ``LABELLERS``; ``posterior``: the label model's chance of a good text; ``score``: the
    linear scorer's; ``predicted``: 1 if ``score`` is 0.5 or more. Null texts count as empty; a text without words gets what its
    votes and features (none but repetition) give. Rows that repeat an id each get a row.
    """
    rows = T.inputs(df, id_col, text_col)

    def vote(batch: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(votes(statistics([t or "" for t in batch.column("text").to_pylist()])), pa.string())], names=["doc_id", "votes"]
        )

    cast = written(T.map_runs(rows, "doc_id bigint, votes string", vote), "votes")
    # At most two to the power of the labellers.
    patterns = {r.votes: r.n for r in cast.groupBy("votes").agg(F.count("*").alias("n")).collect()}
    posterior, _, _ = estimate(patterns)
    ids = cast.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.first("votes").alias("votes"))
    shared = df.sparkSession.sparkContext.broadcast(posterior)

    def example(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [t or "" for t in batch.column("text").to_pylist()]
        found, amounts, sizes = features(texts, statistics(texts))
        offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
        lists = lambda flat, kind: pa.ListArray.from_arrays(offsets, pa.array(flat, kind))
        return pa.RecordBatch.from_arrays(
            [
                pa.array([shared.value[v] for v in batch.column("votes").to_pylist()], pa.float64()),
                lists(found, pa.int32()),
                lists(amounts.astype(np.float32), pa.float32()),
                pa.array([[n] for n in sizes.tolist()], pa.list_(pa.int32())),
            ],
            names=["label", "features", "amounts", "parts"],
        )

    # At most twice ``most`` rows of an id and a few letters.
    sample = F.broadcast(hashed.sampled(ids, most))
    weights = hashed.train(T.map_runs(rows.join(sample, "doc_id"), hashed.EXAMPLES, example), bias=0.0)
    model = df.sparkSession.sparkContext.broadcast(hashed.Weights(weights))

    def score(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [t or "" for t in batch.column("text").to_pylist()]
        stats = statistics(texts)
        cast_now = votes(stats)
        p = hashed.part_scores(model.value.dense, *features(texts, stats))
        return pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                pa.array(cast_now, pa.string()),
                pa.array([shared.value[v] for v in cast_now], pa.float64()),
                pa.array(p),
                pa.array((p >= 0.5).astype(np.int32)),
            ],
            names=["doc_id", "votes", "posterior", "score", "predicted"],
        )

    return T.map_runs(rows, "doc_id bigint, votes string, posterior double, score double, predicted int", score)
