"""Near-duplicate texts by a chosen-path join on word n-grams.

Texts are sets of five-word shingles. Equal sets are merged first. In each run a set follows a path: at every
step it goes to the bucket of its least shingle under that step's hash, a sample shared by two sets with the
probability of their similarity. Buckets split until they are small or splitting shows that their members are
alike; then members are compared exactly, in blocks if there are many. Runs repeat until two sets of
the least similarity have met with the target recall. A pair counts in the first run in which it meets, so
links are summed without listing pairs: a block returns, per member, its number of links and one member it
is connected with.

Classes alone take less: members of a large bucket are compared with a few representatives, and then only those outside
the bucket's main class with others. Each such round moves the texts of unsettled buckets once per run again, so this pays only
for very large groups; on tables of 0.5 GB it moved more than the comparison in blocks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mysem.llm import texts as T
from mysem.session import written

SHINGLE = 5
# Least similarity as a fraction, so that comparisons are exact.
SIMILARITY = (4, 5)
RECALL = 0.995
LEVELS = 3
# Buckets of more members split, unless two members agree in the next step with this probability.
SMALL = 48
ALIKE = 0.5
# Members compared at a time: at most twice a block.
BLOCK = 256
BLOCK_BYTES = 32 << 20
# Members of a large bucket with which all others are compared in one round, and rounds before what is left is compared in blocks.
REPRESENTATIVES = 4
ROUNDS = 4


def runs_needed(similarity: float, recall: float, levels: int) -> int:
    """Runs until sets of the least similarity have met with probability ``recall``, even on the longest path."""
    return math.ceil(math.log(1 - recall) / math.log(1 - similarity**levels))


def shingle_sets(texts: list[str], size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Different shingle hashes of each text, sorted within the text, and their number.

    Words are runs of digits, a-z (A-Z lower-cased) and characters beyond ASCII. A text of fewer words than
    ``size`` has one shingle of them all, a text without words none.
    """
    codes, starts = T.code_points(texts)
    codes = T.ascii_lower(codes)
    at, _, words = T.words(codes, T.word_mask(codes))
    first = np.searchsorted(at, starts)
    n_words = np.diff(np.append(first, len(at)))
    count = np.where(n_words >= size, n_words - size + 1, np.minimum(n_words, 1))
    begin = np.repeat(first, count) + np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
    weights = T.powers(size + 1)
    length = np.repeat(np.minimum(n_words, size), count)
    hashes = length.astype(np.uint64) * weights[size]
    padded = np.append(words, np.zeros(size, np.uint64))
    for i in range(size):
        hashes += np.where(i < length, padded[begin + i], np.uint64(0)) * weights[i]
    hashes = T.mixed(hashes)
    owner = np.repeat(np.arange(len(texts)), count)
    order = np.lexsort((hashes, owner))
    hashes, owner = hashes[order], owner[order]
    fresh = np.ones(len(hashes), bool)
    fresh[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    return hashes[fresh], np.bincount(owner[fresh], minlength=len(texts))


def _sketch(batch: pa.RecordBatch, size: int, steps: int) -> pa.RecordBatch:
    texts = [t or "" for t in batch.column("text").to_pylist()]
    hashes, counts = shingle_sets(texts, size)
    starts = np.cumsum(counts) - counts
    some = np.flatnonzero(counts)

    def per_text(fold, values: np.ndarray) -> np.ndarray:
        out = np.zeros(len(texts), np.uint64)
        if len(some):
            out[some] = fold.reduceat(values, starts[some])
        return out.view(np.int64)

    least = np.stack([per_text(np.minimum, T.mixed(hashes ^ T.mixed(np.array([step + 1]))[0])) for step in range(steps)], axis=1)
    sizes = np.array([len(t.encode("utf-8", "surrogatepass")) for t in texts], np.int64)
    return pa.RecordBatch.from_arrays(
        [
            batch.column("doc_id"),
            batch.column("text_key"),
            pa.array(per_text(np.add, T.mixed(hashes))),
            pa.array(per_text(np.add, T.mixed(hashes ^ np.uint64(0x5851F42D4C957F2D)))),
            pa.array(counts.astype(np.int64)),
            pa.array(sizes),
            pa.ListArray.from_arrays(pa.array(np.arange(len(texts) + 1, dtype=np.int32) * steps), pa.array(least.ravel())),
        ],
        names=["doc_id", "text_key", "high", "low", "n_shingles", "n_bytes", "least"],
    )


def _buckets(sets: DataFrame, runs: int, levels: int) -> DataFrame:
    """``rep, text_key, copies, n_bytes, run, node, members, bytes`` for every set and run in which its bucket has another member."""
    steps = []
    for run in range(runs):
        path, nodes = F.lit(run), []
        for level in range(levels):
            path = F.xxhash64(path, F.col("least")[run * levels + level])
            nodes.append(path.alias(f"p{level}"))
        steps.append(F.struct(F.lit(run).alias("run"), *nodes))
    open_paths = written(sets.select("rep", "text_key", "copies", "n_bytes", F.explode(F.array(*steps)).alias("s")).select("rep", "text_key", "copies", "n_bytes", "s.*"), "paths")
    closed = []
    for level in range(levels):
        node = f"p{level}"
        sizes = open_paths.groupBy(node).agg(F.count("*").alias("members"), F.sum("n_bytes").alias("bytes")).where("members > 1")
        if level + 1 < levels:
            # How often two members agree in the next step is about their mean similarity.
            large = written(sizes.where(F.col("members") > SMALL), "large-buckets")
            within = open_paths.join(large.select(node), node, "left_semi").groupBy(node, f"p{level + 1}").agg(F.count("*").alias("n"))
            agree = within.groupBy(node).agg(F.sum(F.col("n").cast("double") * F.col("n")).alias("agree"))
            split = large.join(agree, node).where(F.col("agree") < ALIKE * F.col("members").cast("double") * F.col("members")).select(node, F.lit(True).alias("split"))
            sizes = sizes.join(split, node, "left")
        else:
            sizes = sizes.withColumn("split", F.lit(None).cast("boolean"))
        sized = written(open_paths.join(written(sizes, "bucket-sizes"), node), "sized-paths")
        closed.append(sized.where("split IS NULL").select("rep", "text_key", "copies", "n_bytes", "run", F.col(node).alias("node"), "members", "bytes"))
        if level + 1 < levels:
            open_paths = sized.where("split").drop("split", "members", "bytes")
    out = closed[0]
    for more in closed[1:]:
        out = out.unionByName(more)
    return out


def _links_in(hashes: list[np.ndarray], sizes: np.ndarray, allowed: np.ndarray, similarity: tuple[int, int]) -> np.ndarray:
    """Which members of a bucket are similar, of the pairs ``allowed``."""
    n = len(sizes)
    flat = np.concatenate(hashes)
    _, number, seen = np.unique(flat, return_inverse=True, return_counts=True)
    shared = seen[number] > 1
    column, number = np.unique(number[shared], return_inverse=True)
    owner = np.repeat(np.arange(n), sizes)[shared]
    order = np.argsort(number, kind="stable")
    number, owner = number[order], owner[order]
    common = np.zeros((n, n), np.float32)
    width = max(64, (1 << 21) // n)
    for first in range(0, len(column), width):
        low, high = np.searchsorted(number, [first, first + width])
        has = np.zeros((n, min(width, len(column) - first)), np.float32)
        has[owner[low:high], number[low:high] - first] = 1
        common += has @ has.T
    common = common.astype(np.int64)
    part, whole = similarity
    alike = whole * common >= part * (sizes[:, None] + sizes[None, :] - common)
    alike &= allowed
    np.fill_diagonal(alike, False)
    return alike


def _roots(alike: np.ndarray, names: np.ndarray) -> np.ndarray:
    """The least name in each member's connected part."""
    root = names.copy()
    while True:
        near = np.where(alike, root[None, :], np.iinfo(np.int64).max).min(axis=1, initial=np.iinfo(np.int64).max)
        fresh = np.minimum(root, near)
        if (fresh == root).all():
            return root
        root = fresh


def _compare(table: pa.Table, size: int, similarity: tuple[int, int]) -> pa.RecordBatch:
    """Links within each group of rows that have the same key; the table holds whole groups."""
    column = lambda name: table.column(name).to_numpy()
    keys, run, side = column("key"), column("run"), column("side")
    rep, copies = column("rep"), column("copies")
    nodes = np.stack(table.column("nodes").to_numpy()) if table.num_rows else np.zeros((0, 1))
    texts = pa.concat_arrays(table.column("text").chunks)
    # Sets of all rows, in runs of bounded size.
    hashes: list[np.ndarray] = []
    for first, end in T.run_ranges(texts):
        flat, counts = shingle_sets([t or "" for t in texts[first:end].to_pylist()], size)
        hashes += np.split(flat, np.cumsum(counts)[:-1])
    edges = np.append(np.flatnonzero(np.append(True, keys[1:] != keys[:-1])), len(keys))
    out_rep, out_links, out_root = [], [], []
    for first, end in zip(edges[:-1].tolist(), edges[1:].tolist()):
        if end - first < 2:
            continue
        here = slice(first, end)
        allowed = np.ones((end - first, end - first), bool)
        if (side[here] >= 0).any():
            allowed &= side[here][:, None] != side[here][None, :]
        for earlier in range(int(run[first])):
            met = nodes[here, earlier]
            allowed &= ~((met[:, None] == met[None, :]) & (met[:, None] != 0))
        if not allowed.any():
            continue
        sizes = np.array([len(h) for h in hashes[first:end]])
        alike = _links_in(hashes[first:end], sizes, allowed, similarity)
        some = np.flatnonzero(alike.any(axis=1))
        if len(some):
            out_rep.append(rep[here][some])
            out_links.append((alike @ copies[here])[some])
            out_root.append(_roots(alike, rep[here])[some])
    join = lambda parts: pa.array(np.concatenate(parts) if parts else np.zeros(0, np.int64))
    return pa.RecordBatch.from_arrays([join(out_rep), join(out_links), join(out_root)], names=["rep", "links", "root"])


def components(edges: DataFrame) -> DataFrame:
    """``node, label`` for every node of ``edges`` (``a, b``) that is not the least of its component, which is the label.

    Large-star and small-star steps in turn until nothing changes; each step is written.
    """
    edges = written(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "edges")
    state = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = written(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")), "least")
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = written(large, "large-star")
        least = written(large.groupBy("a").agg(F.min("b").alias("m")), "least")
        small = large.join(least, "a")
        small = small.select(F.greatest("b", "m").alias("a"), F.least("b", "m").alias("b")).where("a <> b").unionByName(least.select("a", F.col("m").alias("b"))).distinct()
        edges = written(small, "small-star")
        now = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("sum")).first()
        if now == state or now["n"] == 0:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("label"))
        state = now


def _sets(rows: DataFrame, size: int, steps: int) -> tuple[DataFrame, DataFrame]:
    """Sketches of all rows, and their different sets of shingles, each with the least of its rows and their number."""
    kinds = "doc_id bigint, text_key bigint, high bigint, low bigint, n_shingles bigint, n_bytes bigint, least array<bigint>"
    sketches = written(T.map_runs(rows, kinds, lambda batch: _sketch(batch, size, steps)), "sketches")
    merged = sketches.where(_usable()).groupBy("high", "low").agg(
        F.min(F.struct("doc_id", "text_key", "n_bytes")).alias("r"), F.count("*").alias("copies"), F.first("least").alias("least")
    )
    sets = merged.select("high", "low", F.col("r.doc_id").alias("rep"), F.col("r.text_key").alias("text_key"), F.col("r.n_bytes").alias("n_bytes"), "copies", "least")
    return sketches, written(sets, "sets")


def _usable() -> Column:
    return (F.col("n_shingles") > 0) & F.col("doc_id").isNotNull()


def _blocks(members: str, size: str) -> Column:
    return F.greatest(F.ceil(F.col(members) / BLOCK), F.ceil(F.col(size) / BLOCK_BYTES)).cast("int")


def _found(placed: DataFrame, size: int, similarity: tuple[int, int]) -> DataFrame:
    """``rep, links, root`` of the rows that have links among those of the same ``key``."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            keys = batch.column("key").to_numpy()
            changes = np.flatnonzero(keys[1:] != keys[:-1])
            if held and len(keys) and held[-1].column("key")[-1].as_py() != keys[0]:
                yield _compare(pa.Table.from_batches(held), size, similarity)
                held = []
            if len(changes):
                cut = int(changes[-1]) + 1
                yield _compare(pa.Table.from_batches([*held, batch.slice(0, cut)]), size, similarity)
                held = [batch.slice(cut)]
            elif len(keys):
                held.append(batch)
        if held:
            yield _compare(pa.Table.from_batches(held), size, similarity)

    return written(placed.repartition("key").sortWithinPartitions("key").mapInArrow(compare, "rep bigint, links bigint, root bigint"), "links")


def near_duplicates(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: tuple[int, int] = SIMILARITY, size: int = SHINGLE, recall: float = RECALL, levels: int = LEVELS
) -> DataFrame:
    """One row per row of ``df``: ``doc_id, class_id, n_links``.

    Two texts are linked if their shingle sets have at least ``similarity``; ``n_links`` counts the other rows a row is linked
    with, copies included. Classes are the connected parts, named by their least id. Texts without words, null or not, and rows
    without an id are classes of their own without links. Rows that repeat an id with another text are one document, in the class
    of both texts; their links count per text. Empty tables give no rows.
    """
    rows = T.inputs(df, id_col, text_col).withColumn("text_key", F.xxhash64(F.coalesce("text", F.lit(""))))
    runs = runs_needed(similarity[0] / similarity[1], recall, levels)
    sketches, sets = _sets(rows, size, runs * levels)
    members = written(_buckets(sets, runs, levels).drop("n_bytes"), "members")
    everywhere = members.groupBy("rep", "text_key").agg(
        F.first("copies").alias("copies"),
        F.array(*[F.coalesce(F.max(F.when(F.col("run") == r, F.col("node"))), F.lit(0)) for r in range(runs)]).alias("nodes"),
        F.collect_list(F.struct("run", "node", _blocks("members", "bytes").alias("blocks"))).alias("in"),
    )
    # Each text of a bucket moves once to its id, then once to each bucket and block.
    placed = rows.where("doc_id IS NOT NULL").withColumnRenamed("doc_id", "rep").join(everywhere, ["rep", "text_key"]).dropDuplicates(["rep", "text_key"])
    placed = placed.select("rep", "copies", "nodes", "text", F.explode("in").alias("i")).select("rep", "copies", "nodes", "text", "i.*")
    own = F.pmod(F.xxhash64("rep", F.lit("block")), F.col("blocks")).cast("int")
    placed = placed.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    placed = placed.select(
        F.xxhash64("run", "node", F.least("own", "other"), F.greatest("own", "other")).alias("key"),
        "run",
        F.when(F.col("own") == F.col("other"), -1).when(F.col("own") < F.col("other"), 0).otherwise(1).alias("side"),
        "rep",
        "copies",
        "nodes",
        "text",
    )
    found = _found(placed, size, similarity)
    links = written(found.groupBy("rep").agg(F.sum("links").alias("links")), "link-sums")
    labels = components(found.select(F.col("rep").alias("a"), F.col("root").alias("b")))
    classes = written(
        sets.select("high", "low", "rep", "copies")
        .join(links, "rep", "left")
        .join(labels.withColumnRenamed("node", "rep"), "rep", "left")
        .select("high", "low", F.coalesce("label", "rep").alias("class_id"), (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")),
        "classes",
    )
    known = sketches.select("doc_id", F.when(_usable(), F.col("high")).alias("high"), F.when(_usable(), F.col("low")).alias("low"))
    return known.join(classes, ["high", "low"], "left").select("doc_id", F.coalesce("class_id", "doc_id").alias("class_id"), F.coalesce("n_links", F.lit(0)).alias("n_links"))


def _together(rows: DataFrame, meetings: DataFrame, runs: int) -> DataFrame:
    """The texts of ``meetings`` (``rep, text_key, run, node, side, own, lefts, rights``), at every key at which they are compared.

    Of a bucket, block ``own`` of ``lefts`` of side 0 meets each of the ``rights`` blocks of side 1; those of side -1 meet one another.
    Pairs of side -1 that met on that side in an earlier run are left out.
    """
    everywhere = meetings.groupBy("rep", "text_key").agg(
        F.array(*[F.coalesce(F.max(F.when((F.col("run") == r) & (F.col("side") == -1), F.col("node"))), F.lit(0)) for r in range(runs)]).alias("nodes"),
        F.collect_list(F.struct("run", "node", "side", "own", "lefts", "rights")).alias("in"),
    )
    placed = rows.where("doc_id IS NOT NULL").withColumnRenamed("doc_id", "rep").join(everywhere, ["rep", "text_key"]).dropDuplicates(["rep", "text_key"])
    placed = placed.select("rep", "nodes", "text", F.explode("in").alias("i")).select("rep", "nodes", "text", "i.*")
    right = F.col("side") == 1
    placed = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.when(right, F.col("lefts")).otherwise(F.col("rights")) - 1)))
    return placed.select(
        F.xxhash64("run", "node", F.when(right, F.col("other")).otherwise(F.col("own")), F.when(right, F.col("own")).otherwise(F.col("other"))).alias("key"),
        F.when(F.col("side") == -1, F.col("run")).otherwise(0).alias("run"),
        "side",
        "rep",
        F.lit(1).cast("long").alias("copies"),
        "nodes",
        "text",
    )


def _meeting(members: DataFrame, side: int, lefts: Column, rights: Column) -> DataFrame:
    own = F.pmod(F.xxhash64("rep", "text_key", F.lit("block")), rights if side == 1 else lefts).cast("int")
    return members.select("rep", "text_key", "run", "node", F.lit(side).alias("side"), own.alias("own"), lefts.alias("lefts"), rights.alias("rights"))


def _representatives(members: DataFrame) -> DataFrame:
    """Up to ``REPRESENTATIVES`` members of each bucket, by hash."""
    least = [F.min(F.struct(F.xxhash64("rep", "text_key", F.lit(i)).alias("h"), "rep", "text_key")) for i in range(REPRESENTATIVES)]
    picked = members.groupBy("run", "node", "blocks").agg(F.array(*least).alias("some"))
    chosen = F.array_distinct(F.transform("some", lambda s: F.struct(s["rep"].alias("rep"), s["text_key"].alias("text_key"))))
    return picked.select("run", "node", "blocks", F.explode(chosen).alias("s")).select("run", "node", "blocks", "s.*")


def near_duplicate_classes(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: tuple[int, int] = SIMILARITY, size: int = SHINGLE, recall: float = RECALL, levels: int = LEVELS
) -> DataFrame:
    """One row per row of ``df``: ``doc_id, class_id, class_size``; the classes of ``near_duplicates`` and their rows, without links.

    Small buckets are compared whole. All members of a large one are compared with a few representatives; then, as long as many members
    are outside its largest class so far, with representatives of those; what few are left in the end, or after ``ROUNDS`` rounds, are
    compared with all members in blocks. Two members that are not compared are thus in one class already, so the classes are whole.

    Texts without words, null or not, and rows without an id are classes of their own, of one row. Rows that repeat an id with another
    text are in the class of both texts. Empty tables give no rows.
    """
    rows = T.inputs(df, id_col, text_col).withColumn("text_key", F.xxhash64(F.coalesce("text", F.lit(""))))
    runs = runs_needed(similarity[0] / similarity[1], recall, levels)
    sketches, sets = _sets(rows, size, runs * levels)
    members = written(_buckets(sets, runs, levels).drop("copies").withColumn("blocks", _blocks("members", "bytes")), "members")
    one = F.lit(1)
    large = members.where("blocks > 1")
    meetings = _meeting(members.where("blocks = 1"), -1, one, one)
    meetings = meetings.unionByName(_meeting(large, 0, F.col("blocks"), one)).unionByName(_meeting(_representatives(large), 1, F.col("blocks"), one))
    edges, last = None, large.isEmpty()
    for step in range(ROUNDS + 1):
        found = _found(_together(rows, meetings, runs if step == 0 else 1), size, similarity).select(F.col("rep").alias("a"), F.col("root").alias("b"))
        labels = components(found if edges is None else edges.unionByName(found))
        if last:
            break
        edges = labels.select(F.col("node").alias("a"), F.col("label").alias("b"))
        marked = large.join(labels.withColumnRenamed("node", "rep"), "rep", "left").withColumn("label", F.coalesce("label", "rep"))
        sizes = marked.groupBy("run", "node", "label").agg(F.count("*").alias("n"), F.sum("n_bytes").alias("bytes"))
        sizes = sizes.groupBy("run", "node").agg(
            F.max(F.struct("n", "label", "bytes")).alias("main"), (F.sum("n") - F.max(F.struct("n", "label", "bytes"))["n"]).alias("others"), F.sum("bytes").alias("bytes")
        )
        unsettled = sizes.where("others > 0").select("run", "node", F.col("main.label").alias("main"), "others", (F.col("bytes") - F.col("main.bytes")).alias("other_bytes"))
        unsettled = written(unsettled.withColumn("rights", _blocks("others", "other_bytes")), "unsettled-buckets")
        most = unsettled.agg(F.max("rights")).first()[0]
        if most is None:
            break
        whole = large.join(unsettled, ["run", "node"])
        rest = marked.join(unsettled, ["run", "node"]).where("label <> main")
        last = most == 1 or step + 1 == ROUNDS
        if last:
            meetings = _meeting(whole, 0, F.col("blocks"), F.col("rights")).unionByName(_meeting(rest, 1, F.col("blocks"), F.col("rights")))
        else:
            meetings = _meeting(whole, 0, F.col("blocks"), one).unionByName(_meeting(_representatives(rest), 1, F.col("blocks"), one))
    named = sets.select("high", "low", "rep", "copies").join(labels.withColumnRenamed("node", "rep"), "rep", "left")
    named = written(named.select("high", "low", "copies", F.coalesce("label", "rep").alias("class_id")), "classes")
    totals = named.groupBy("class_id").agg(F.sum("copies").alias("class_size"))
    known = sketches.select("doc_id", F.when(_usable(), F.col("high")).alias("high"), F.when(_usable(), F.col("low")).alias("low"))
    known = known.join(named.join(totals, "class_id").drop("copies"), ["high", "low"], "left")
    return known.select("doc_id", F.coalesce("class_id", "doc_id").alias("class_id"), F.coalesce("class_size", F.lit(1)).alias("class_size"))
