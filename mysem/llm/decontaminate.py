"""Benchmark decontamination with a distributed positional inverted index.

The index is a table of segments. A segment covers a run of documents and holds, for each term of
the test items, its postings: the places of the term among the words of the segment. Segments are
built where the documents are read, so nothing is shuffled and no term is hot. A search takes each
test window in a segment, starts from the postings of its rarest term there, shifts them to where the
window would begin, and intersects with the other terms' postings from rare to common. Exact phrases
need every term in its place; proximity matches allow each to be a few words off.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mysem.llm import texts as T
from mysem.session import written

WINDOW = 10
# Words between documents in the count of places: no match reaches across, whatever the slop up to MAX_SLOP.
GAP = 64
MAX_SLOP = 16
# Test items are searched in blocks of about this many characters, one at a time, in one index.
BLOCK_CHARS = 8_000_000
# Up to this many different words of all items (8 bytes each) they are broadcast and only their postings kept; beyond it those of all words.
MAX_TERMS = 8_000_000
# Candidate places looked at together.
CANDIDATES = 1 << 20

INDEX = "segment bigint, doc_ids array<bigint>, n_words array<int>, terms array<bigint>, counts array<int>, places array<int>"
FOUND = "segment bigint, place int, doc_id bigint, n_words bigint, spans array<struct<start:int,end:int>>, items array<string>, near array<string>"


def tokens(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words (A-Z lower-cased; runs of digits, a-z and characters beyond ASCII), and the number in each text."""
    codes, starts = T.code_points(texts)
    codes = T.ascii_lower(codes)
    at, _, hashes = T.words(codes, T.word_mask(codes))
    first = np.searchsorted(at, starts)
    return hashes, np.diff(np.append(first, len(at)))


class Block:
    """The windows of some test items: ``windows[k]`` holds windows of k words as rows of numbers into ``terms``."""

    def __init__(self, items: list[tuple[str, str]], size: int):
        hashes, counts = tokens([text for _, text in items]) if items else (np.zeros(0, np.uint64), np.zeros(0, int))
        self.names = [name for name, _ in items]
        self.terms = np.unique(hashes)
        numbers = np.searchsorted(self.terms, hashes)
        ends = np.cumsum(counts)
        rows: dict[int, list[np.ndarray]] = {}
        owners: dict[int, list[np.ndarray]] = {}
        for item, (first, end) in enumerate(zip((ends - counts).tolist(), ends.tolist())):
            k = min(size, end - first)
            if k:
                rows.setdefault(k, []).append(np.lib.stride_tricks.sliding_window_view(numbers[first:end], k))
                owners.setdefault(k, []).append(np.full(end - first - k + 1, item))
        self.windows = {k: np.concatenate(v) for k, v in rows.items()}
        self.owners = {k: np.concatenate(v) for k, v in owners.items()}


def blocks(benchmark: DataFrame, size: int) -> Iterator[Block]:
    """The items in blocks of bounded size, at least one block; rows without id or text have no words."""
    items: list[tuple[str, str]] = []
    chars, any_yet = 0, False
    for name, text in benchmark.where("item_id IS NOT NULL AND text IS NOT NULL").select("item_id", "text").toLocalIterator():
        items.append((name, text))
        chars += len(text)
        if chars >= BLOCK_CHARS:
            yield Block(items, size)
            items, chars, any_yet = [], 0, True
    if items or not any_yet:
        yield Block(items, size)


def vocabulary(tests: DataFrame) -> np.ndarray | None:
    """Sorted hashes of the words of all items, or null if they are more than ``MAX_TERMS``."""

    def words(batch: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(np.unique(tokens([t or "" for t in batch.column("text").to_pylist()])[0]).view(np.int64))], names=["term"])

    found = written(T.map_runs(tests, "term bigint", words).distinct(), "terms")
    if found.count() > MAX_TERMS:
        return None
    return np.sort(found.toPandas()["term"].to_numpy(np.int64).view(np.uint64))


def build_index(docs: DataFrame, terms: np.ndarray | None) -> DataFrame:
    """Segments of ``docs`` (``doc_id, text``) with the postings of ``terms`` (sorted hashes; null: of all words); every document is in one segment."""
    shared = docs.sparkSession.sparkContext.broadcast(terms)
    counter = {"task": None, "n": 0}

    def segment(batch: pa.RecordBatch) -> pa.RecordBatch:
        wanted = shared.value
        hashes, counts = tokens([t or "" for t in batch.column("text").to_pylist()])
        place = np.arange(len(hashes)) + np.repeat(np.arange(1, len(counts) + 1) * GAP, counts)
        if wanted is None:
            here = np.arange(len(hashes))
        elif len(wanted):
            here = np.flatnonzero(wanted[np.minimum(np.searchsorted(wanted, hashes), len(wanted) - 1)] == hashes)
        else:
            here = np.zeros(0, np.int64)
        here = here[np.argsort(hashes[here], kind="stable")]
        present, how_many = np.unique(hashes[here], return_counts=True)
        task = TaskContext.get()
        if counter["task"] != task.taskAttemptId():
            counter.update(task=task.taskAttemptId(), n=0)
        counter["n"] += 1
        name = (task.partitionId() << 32) + counter["n"]
        lists = lambda values, kind: pa.array([values], pa.list_(kind))
        return pa.RecordBatch.from_arrays(
            [
                pa.array([name]),
                lists(batch.column("doc_id").to_pylist(), pa.int64()),
                lists(counts, pa.int32()),
                lists(present.view(np.int64), pa.int64()),
                lists(how_many, pa.int32()),
                lists(place[here], pa.int32()),
            ],
            names=["segment", "doc_ids", "n_words", "terms", "counts", "places"],
        )

    return T.map_runs(docs, INDEX, segment)


def _candidates(counts: np.ndarray) -> Iterator[slice]:
    """Slices of windows whose rarest terms have about ``CANDIDATES`` postings together."""
    run = np.cumsum(counts) // CANDIDATES
    edges = [0, *(np.flatnonzero(np.diff(run)) + 1).tolist(), len(counts)]
    return (slice(a, b) for a, b in zip(edges[:-1], edges[1:]) if b > a)


def intersect(windows: np.ndarray, counts: np.ndarray, first: np.ndarray, places: np.ndarray, keys: np.ndarray, slop: int) -> tuple[np.ndarray, np.ndarray]:
    """Windows and start places at which every term has a posting within ``slop`` of its place in the window.

    ``counts`` and ``first`` say where each term's postings are in ``places``; ``keys`` are the postings
    as sorted ``term << 32 | place``.
    """
    k = windows.shape[1]
    alive = np.flatnonzero((counts[windows] > 0).all(axis=1))
    order = np.argsort(counts[windows[alive]], axis=1, kind="stable")
    rarest = np.take_along_axis(windows[alive], order[:, :1], axis=1)[:, 0]
    found_w, found_at = [], []
    for part in _candidates(counts[rarest]):
        n = counts[rarest[part]]
        which = np.repeat(np.arange(part.start, part.stop), n)
        inside = np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n)
        at = places[np.repeat(first[rarest[part]], n) + inside] - order[which, 0]
        for j in range(k):
            # Starting from a posting of the rarest term, a sloppy match may begin up to ``slop`` off; the start counts from that term.
            if j == 0:
                continue
            offset = order[which, j]
            key = (windows[alive[which], offset] << 32) + at + offset
            low = np.searchsorted(keys, key - slop)
            ok = keys[np.minimum(low, len(keys) - 1)] <= key + slop
            ok &= low < len(keys)
            which, at = which[ok], at[ok]
        found_w.append(alive[which])
        found_at.append(at)
    empty = np.zeros(0, dtype=np.int64)
    return (np.concatenate(found_w), np.concatenate(found_at)) if found_w else (empty, empty)


def search(index: DataFrame, block: Block | Broadcast, slop: int = 2) -> DataFrame:
    """Matches of the block's windows, one row per document.

    ``spans``: stretches of words inside exact matches (word numbers, end exclusive, merged). ``items``: items
    with an exact window. ``near``: items with a window whose terms are each at most ``slop`` words off.
    """
    if not 0 <= slop <= MAX_SLOP:
        raise ValueError(f"slop is 0 to {MAX_SLOP}")
    shared = index.sparkSession.sparkContext.broadcast(block) if isinstance(block, Block) else block

    def look(name: int, doc_ids: list, n_words: np.ndarray, terms: np.ndarray, how_many: np.ndarray, places: np.ndarray) -> pa.RecordBatch:
        block = shared.value
        # Only the postings of the block's own words, which are sorted as the segment's are.
        terms = terms.view(np.uint64)
        number = np.searchsorted(block.terms, terms)
        mine = block.terms[np.minimum(number, len(block.terms) - 1)] == terms if len(block.terms) else np.zeros(len(terms), bool)
        places, how_many, terms = places[np.repeat(mine, how_many)], how_many[mine], number[mine]
        counts = np.zeros(len(block.terms), dtype=np.int64)
        counts[terms] = how_many
        first = np.zeros(len(block.terms), dtype=np.int64)
        first[terms] = np.cumsum(how_many) - how_many
        places = places.astype(np.int64)
        keys = (np.repeat(terms, how_many) << 32) + places
        n_docs = len(doc_ids)
        begins = np.cumsum(n_words) - n_words + np.arange(1, n_docs + 1) * GAP
        total = int(begins[-1] + n_words[-1]) + GAP
        covered = np.zeros(total + 1, dtype=np.int64)
        items: dict[int, set[str]] = {}
        near: dict[int, set[str]] = {}
        for k, windows in block.windows.items() if len(keys) else ():
            w, at = intersect(windows, counts, first, places, keys, slop)
            doc = np.searchsorted(begins, at + (slop + 1), "right") - 1
            for d, item in set(zip(doc.tolist(), block.owners[k][w].tolist())):
                near.setdefault(d, set()).add(block.names[item])
            if slop:
                for j in range(k):
                    key = (windows[w, j] << 32) + at + j
                    low = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
                    ok = keys[low] == key
                    w, at, doc = w[ok], at[ok], doc[ok]
            np.add.at(covered, at, 1)
            np.add.at(covered, at + k, -1)
            for d, item in set(zip(doc.tolist(), block.owners[k][w].tolist())):
                items.setdefault(d, set()).add(block.names[item])
        change = np.diff(np.concatenate([[0], np.cumsum(covered) > 0, [0]]).astype(np.int8))
        spans: dict[int, list[dict]] = {}
        lows, highs = np.flatnonzero(change == 1), np.flatnonzero(change == -1)
        for d, low, high in zip((np.searchsorted(begins, lows, "right") - 1).tolist(), lows.tolist(), highs.tolist()):
            spans.setdefault(d, []).append({"start": low - int(begins[d]), "end": high - int(begins[d])})
        span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
        each = range(n_docs)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(n_docs, name)),
                pa.array(np.arange(n_docs, dtype=np.int32)),
                pa.array(doc_ids, pa.int64()),
                pa.array(n_words.astype(np.int64)),
                pa.array([spans.get(d, []) for d in each], span),
                pa.array([sorted(items.get(d, ())) for d in each], pa.list_(pa.string())),
                pa.array([sorted(near.get(d, ())) for d in each], pa.list_(pa.string())),
            ],
            names=["segment", "place", "doc_id", "n_words", "spans", "items", "near"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                column = lambda name: batch.column(name)[i].values.to_numpy(zero_copy_only=False).astype(np.int64)
                yield look(batch.column("segment")[i].as_py(), batch.column("doc_ids")[i].as_py(), *map(column, ("n_words", "terms", "counts", "places")))

    return index.mapInArrow(run, FOUND)


def _added(found: DataFrame | None, index: DataFrame, block: Block, slop: int) -> DataFrame:
    """``found`` and the matches of one more block, which are written so that the block can leave memory. Of later blocks only documents with a match count."""
    shared = index.sparkSession.sparkContext.broadcast(block)
    part = search(index, shared, slop)
    part = written(part if found is None else part.where("size(near) > 0"), "matches")
    shared.destroy()
    return part if found is None else found.unionByName(part)


def words_in(spans: Column) -> Column:
    """How many words lie in any of the spans, which may overlap."""
    start = F.struct(F.lit(0).cast("long").alias("end"), F.lit(0).cast("long").alias("n"))

    def step(acc: Column, span: Column) -> Column:
        end = F.greatest(acc["end"], span["end"].cast("long"))
        fresh = end - F.greatest(acc["end"], span["start"].cast("long"))
        return F.struct(end.alias("end"), (acc["n"] + F.greatest(fresh, F.lit(0))).alias("n"))

    return F.aggregate(F.array_sort(spans), start, step, lambda acc: acc["n"])


def contamination(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW, slop: int = 2
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_words, n_hit, items, near, spans``.

    Windows are ``window`` consecutive words of an item; an item of fewer words, but not none, is one window.
    Null texts have no words; items without id or words match nothing; an item id on several rows is one item
    with the windows of all. Rows that repeat a doc_id each get a row. Empty tables give no rows or no hits.
    """
    rows = T.inputs(docs, id_col, text_col)
    tests = benchmark.select(F.col(item_col).cast("string").alias("item_id"), F.col(item_text_col).cast("string").alias("text"))
    index = written(build_index(rows, vocabulary(tests)), "postings")
    found, waiting = None, None
    for block in blocks(tests, window):
        if waiting is not None:
            found = _added(found, index, waiting, slop)
        waiting = block
    if found is None:
        found = search(index, waiting, slop)
    else:
        # The index is written, so a document meets itself under segment and place.
        found = _added(found, index, waiting, slop)
        merged = lambda c: F.flatten(F.collect_list(c)).alias(c)
        found = found.groupBy("segment", "place").agg(F.first("doc_id", True).alias("doc_id"), F.max("n_words").alias("n_words"), merged("spans"), merged("items"), merged("near"))
    return found.select(
        "doc_id",
        "n_words",
        words_in(F.col("spans")).alias("n_hit"),
        F.array_sort(F.array_distinct("items")).alias("items"),
        F.array_sort(F.array_distinct("near")).alias("near"),
        F.array_sort("spans").alias("spans"),
    )
