"""Language identification with bit-sliced n-gram Bloom filters.

Each language has a Bloom filter of its frequent character n-grams. The filters are stored bit-sliced:
position p of one array holds bit L if the filter of language L has bit p set, so that the AND of an
n-gram's positions is the mask of all languages that contain it. A text's n-grams are looked up once for
all languages; the popcount of each bit, less the hits its filter's fill would give by chance, decides.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mysem.llm import texts as T
from mysem.session import written

N = 4
# An n-gram belongs to a language if it makes up this share of the n-grams of its texts, so a language
# has at most 1 / MIN_SHARE of them whatever the corpus holds.
MIN_SHARE = 2e-5
HASHES = 3
BITS_PER_GRAM = 12
# More languages than this are an error: the filters are broadcast.
MAX_LANGUAGES = 1024
# The cut of scores lies between what all but these shares of held-out documents reach in their own language and stay below in the others.
TAIL = 0.001
FOREIGN_TAIL = 0.05
# Scores are tallied this fine.
BINS = 1000
# A task passes its counts on when it has this many different n-grams.
COUNTS_HELD = 1 << 21

_letters: list[np.ndarray] = []


def letter_table() -> np.ndarray:
    """True at the code points that are letters."""
    if not _letters:
        _letters.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000))
    return _letters[0]


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the n-grams of the lower-cased texts, and the number in each text.

    Runs of other characters than letters count as one space; each text has a space at either end. N-grams
    lie within a text. A text of fewer than N characters with a letter is one n-gram.
    """
    padded = [" " + t.lower() + " " * (N - 1) for t in texts]
    codes, starts = T.code_points(padded)
    letter = letter_table()[codes]
    ends = np.append(starts[1:], len(codes)) - 1
    codes = np.where(letter, codes, np.uint32(32))
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    keep[starts] = True
    keep[ends] = False
    kept = codes[keep].astype(np.uint64)
    row_of = np.cumsum(keep)
    first = row_of[starts] - 1
    sizes = np.diff(np.append(first, len(kept)))
    values = T.mixed(kept + np.uint64(1))
    n = max(0, len(kept) - N + 1)
    hashes = np.zeros(n, dtype=np.uint64)
    weights = T.powers(N)
    for i in range(N):
        hashes += values[i : i + n] * weights[i]
    hashes = T.mixed(hashes)
    # Windows that begin in the last N-1 places of a text would reach into the next.
    counts = np.maximum(sizes - N + 1, 0)
    begin = np.repeat(first, counts) + np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts)
    hashes = hashes[begin]
    short = np.flatnonzero((counts == 0) & (sizes > 1))
    if len(short):
        extra = np.array([sum(int(values[first[r] + i]) * int(weights[i]) for i in range(sizes[r])) % 2**64 for r in short.tolist()], dtype=np.uint64)
        hashes = np.insert(hashes, (np.cumsum(counts) - counts)[short], T.mixed(extra))
        counts[short] = 1
    return hashes, counts


@dataclass
class Filters:
    """Bit-sliced filters: ``slices[lane, p]`` holds the bits of 64 languages at position p."""

    languages: list[str]
    slices: np.ndarray
    false_rate: np.ndarray

    def masks(self, hashes: np.ndarray, lane: int) -> np.ndarray:
        """Which languages of a lane contain each n-gram, one bit each."""
        size = np.uint64(self.slices.shape[1] - 1)
        out = self.slices[lane][hashes & size]
        for i in range(1, HASHES):
            out = out & self.slices[lane][(hashes >> np.uint64(20 * i)) & size]
        return out


def build_filters(languages: list[str], members: list[tuple[int, str]]) -> Filters:
    """Filters of (n-gram hash, language) pairs."""
    number = {name: i for i, name in enumerate(languages)}
    per_language = np.bincount([number[lang] for _, lang in members], minlength=len(languages)) if members else np.zeros(len(languages))
    size = 1 << int(np.ceil(np.log2(max(1024, BITS_PER_GRAM * per_language.max(initial=1)))))
    lanes = max(1, -(-len(languages) // 64))
    kind = np.uint8 if len(languages) <= 8 else np.uint64
    slices = np.zeros((lanes, size), dtype=kind)
    fill = np.zeros(len(languages))
    hashes = np.array([h for h, _ in members], dtype=np.int64).view(np.uint64)
    owner = np.array([number[lang] for _, lang in members], dtype=np.int64)
    for i in range(len(languages)):
        mine = hashes[owner == i]
        bit = kind(1) << kind(i % 64)
        for j in range(HASHES):
            slices[i // 64][(mine >> np.uint64(20 * j)) & np.uint64(size - 1)] |= bit
        fill[i] = np.count_nonzero(slices[i // 64] & bit) / size
    return Filters(languages, slices, fill**HASHES)


def train(df: DataFrame, text_col: str = "text", lang_col: str = "lang", min_share: float = MIN_SHARE) -> Filters:
    """Filters of the n-grams that make up ``min_share`` of a language's n-grams over all rows of ``df``.

    Rows without text or language teach nothing. N-grams of no language-specific share are dropped by the
    share alone, which also drops those that rows with a wrong language bring in.
    """
    rows = df.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text")).where("lang IS NOT NULL AND text IS NOT NULL")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
        n_held = 0

        def merge(pairs: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
            keys, where = np.unique(np.concatenate([k for k, _ in pairs]), return_inverse=True)
            return keys, np.bincount(where, weights=np.concatenate([c for _, c in pairs])).astype(np.int64)

        def emit() -> Iterator[pa.RecordBatch]:
            for lang, pairs in held.items():
                keys, counts = merge(pairs)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(keys)), pa.array(keys.view(np.int64)), pa.array(counts)], names=["lang", "gram", "n"])
            held.clear()

        for batch in batches:
            for first, end in T.run_ranges(batch.column("text")):
                by_lang: dict[str, list[str]] = {}
                for lang, text in zip(batch.column("lang")[first:end].to_pylist(), batch.column("text")[first:end].to_pylist()):
                    by_lang.setdefault(lang, []).append(text)
                for lang, texts in by_lang.items():
                    keys, counts = np.unique(grams(texts)[0], return_counts=True)
                    pairs = held.setdefault(lang, [])
                    pairs.append((keys, counts))
                    n_held += len(keys)
                    if len(pairs) >= 8:
                        n_held -= sum(len(k) for k, _ in pairs)
                        held[lang] = [merge(pairs)]
                        n_held += len(held[lang][0][0])
                if n_held >= COUNTS_HELD:
                    yield from emit()
                    n_held = 0
        yield from emit()

    T.ship(df.sparkSession)
    counts = rows.mapInArrow(count, "lang string, gram bigint, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    counts = written(counts, "language-grams")
    totals = counts.groupBy("lang").agg(F.sum("n").alias("total")).limit(MAX_LANGUAGES + 1).collect()
    if len(totals) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    languages = sorted(r.lang for r in totals)
    if not languages:
        return build_filters([], [])
    need = F.create_map(*[F.lit(x) for r in totals for x in (r.lang, r.total * min_share)])
    frequent = counts.where(F.col("n") >= need[F.col("lang")]).select("gram", "lang")
    return build_filters(languages, [tuple(r) for r in frequent.collect()])


def predict(df: DataFrame, filters: Filters, *more: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row ``doc_id``, the columns ``more``, ``lang_pred`` and ``score`` (0 to 1).

    ``score`` is the winner's share of the text's n-grams after the correction. Ties go to the language first
    in the alphabet. Texts that are null or have no letter, and all texts if nothing was learned, are ``und``
    with score 0.
    """
    shared = df.sparkSession.sparkContext.broadcast(filters)
    rows = T.inputs(df, id_col, text_col, *more)
    extra = [f for f in rows.schema.fields if f.name not in ("doc_id", "text")]

    def decide(batch: pa.RecordBatch) -> pa.RecordBatch:
        model = shared.value
        hashes, counts = grams([t or "" for t in batch.column("text").to_pylist()])
        starts = np.cumsum(counts) - counts
        best = np.full(len(counts), -1.0)
        winner = np.zeros(len(counts), dtype=np.int64)
        for i in range(len(model.languages)):
            if i % 64 == 0:
                masks = model.masks(hashes, i // 64)
            hits = T.sums_by_row((masks >> masks.dtype.type(i % 64)) & masks.dtype.type(1), starts, len(hashes))
            true = np.clip((hits - counts * model.false_rate[i]) / (1 - model.false_rate[i]), 0, None)
            better = true > best
            best[better], winner[better] = true[better], i
        named = (counts > 0) & bool(model.languages)
        names = np.array([*model.languages, "und"], dtype=object)
        score = np.where(named, np.clip(best / np.maximum(counts, 1), 0, 1), 0.0)
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), *(batch.column(f.name) for f in extra), pa.array(names[np.where(named, winner, len(model.languages))], pa.string()), pa.array(score)],
            names=["doc_id", *(f.name for f in extra), "lang_pred", "score"],
        )

    kinds = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in extra)
    return T.map_runs(rows, f"doc_id bigint, {kinds}lang_pred string, score double", decide)


def _own_and_other(batch: pa.RecordBatch, model: Filters) -> pa.RecordBatch:
    """Per text of a known language with a letter its score in that language, and the best in the others (null if there are none)."""
    hashes, counts = grams([t or "" for t in batch.column("text").to_pylist()])
    starts = np.cumsum(counts) - counts
    labels = batch.column("lang").to_numpy(zero_copy_only=False)
    own, other = np.full(len(counts), np.nan), np.full(len(counts), -1.0)
    for i, name in enumerate(model.languages):
        if i % 64 == 0:
            masks = model.masks(hashes, i // 64)
        hits = T.sums_by_row((masks >> masks.dtype.type(i % 64)) & masks.dtype.type(1), starts, len(hashes))
        share = np.clip((hits - counts * model.false_rate[i]) / (1 - model.false_rate[i]) / np.maximum(counts, 1), 0, 1)
        mine = labels == name
        own[mine] = share[mine]
        other[~mine] = np.maximum(other[~mine], share[~mine])
    known = (counts > 0) & ~np.isnan(own)
    return pa.RecordBatch.from_arrays([pa.array(own[known]), pa.array(other[known], mask=other[known] < 0)], names=["own", "other"])


def least_score(df: DataFrame, text_col: str = "text", lang_col: str = "lang") -> float | None:
    """A cut between the scores of documents of a learned language and those of other languages; null if no labelled row is held out.

    Filters learn from three quarters of the labelled texts, picked by the text so that copies stay together, and score the rest:
    each in its own language, and in the best other one, as if its own had not been learned. The cut is half way between
    what all but ``TAIL`` of the texts reach in their own language and what all but ``FOREIGN_TAIL`` stay below elsewhere (0 if there is one language).
    """
    rows = df.select(F.lit(0).alias("doc_id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"))
    apart = F.crc32(F.col("text").cast("binary")) % 4 == 2
    rows = rows.where("text IS NOT NULL AND lang IS NOT NULL")
    shared = df.sparkSession.sparkContext.broadcast(train(rows.where(~apart)))
    scores = T.map_runs(rows.where(apart).select("text", "lang"), "own double, other double", lambda batch: _own_and_other(batch, shared.value))
    bins = [F.floor(F.col(c) * BINS).cast("int") for c in ("own", "other")]
    tallies = written(scores.groupBy(bins[0].alias("own"), bins[1].alias("other")).agg(F.count("*").alias("n")), "language-scores")

    def quantile(name: str, share: float) -> float | None:
        found = tallies.where(F.col(name).isNotNull()).groupBy(name).agg(F.sum("n").alias("n")).orderBy(name).collect()
        upto = np.cumsum([r.n for r in found])
        if not len(upto):
            return None
        return found[int(np.searchsorted(upto, share * upto[-1], "right").clip(0, len(found) - 1))][name] / BINS

    own, other = quantile("own", TAIL), quantile("other", 1 - FOREIGN_TAIL)
    return None if own is None else (own + (other or 0.0)) / 2


def held_out(id_col: str = "doc_id", folds: int = 4, fold: int = 2) -> Column:
    """Whether a row is held out of training, by its id; rows without an id are."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % folds == fold, F.lit(True))


def identify(df: DataFrame) -> DataFrame:
    """Learn from the rows of a documents table that are not held out, and predict all."""
    filters = train(df.where(~held_out()))
    return predict(df, filters, held_out().alias("held_out")).select("doc_id", "held_out", "lang_pred", "score")
