"""Exact cutting of dump files by many tasks.

Whether a ``;`` ends a statement depends on all text before it: it may stand in a literal or a comment, or another
delimiter may be in force. A lexer has few states, so each stretch of a file that one task reads is walked once from every
state it could begin in, which gives one small row: the state, and the delimiter, it would end in. Composing these rows in the order
of the file gives each stretch its true beginning. A second walk then cuts. Statements that reach over stretches are put
together from their pieces, which alone are shuffled.
"""

from __future__ import annotations

import re
import sys
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mysem.session import written

# Functions of this module travel to the workers themselves, which need not have the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Where a stretch can begin: outside everything, in a quote of one of three kinds, in a comment.
STATES = 5

# About as many characters of records are walked as one text.
CHARACTERS = 1 << 20


def walker():
    """A function that walks a text: ``walk(text, state, delimiter) -> state, delimiter, cuts``.

    The text begins at the beginning of a line. Cuts are ``(end, start, ends)``: what lies between the two is no part of a statement, and a statement
    ends there if ``ends``. Without a delimiter only DELIMITER lines are cut.
    """
    import re

    single = r"'[^'\\]*+(?:(?:\\.|'')[^'\\]*+)*+'"
    double = r'"[^"\\]*+(?:(?:\\.|"")[^"\\]*+)*+"'
    closing = {1: single[1:], 2: double[1:], 3: r"[^`]*+`", 4: r"(?:[^*]++|\*(?!/))*+\*/"}
    closing = {state: re.compile(pattern, re.S) for state, pattern in closing.items()}
    opening = {"'": 1, '"': 2, "`": 3, "/": 4}
    line = re.compile(r"DELIMITER[ \t]+(\S+)[^\n]*+\n?", re.I)
    plain: dict[str | None, re.Pattern] = {}

    def outside(delimiter: str | None) -> re.Pattern:
        """Everything up to a delimiter, a DELIMITER line, or a quote or comment that does not end."""
        if delimiter not in plain:
            first = re.escape(delimiter[0]) if delimiter else ""
            here = f"(?!{re.escape(delimiter)})" if delimiter else ""
            other = f"|{first}" if delimiter and delimiter[0] not in "'\"`/-\n" else ""
            plain[delimiter] = re.compile(
                rf"(?:[^'\"`/\-\n{first}]++|{here}(?:{single}|{double}|`[^`]*+`|/\*(?:[^*]++|\*(?!/))*+\*/|--[^\n]*+|-(?!-)|/(?!\*)|\n(?!(?i:DELIMITER)[ \t]){other}))*+",
                re.S,
            )
        return plain[delimiter]

    def walk(text: str, state: int, delimiter: str | None) -> tuple[int, str | None, list[tuple[int, int, bool]]]:
        at, cuts, cutting = 0, [], delimiter is not None
        skip = outside(delimiter).match
        while True:
            if state:
                closed = closing[state].match(text, at)
                if closed is None:
                    return state, delimiter, cuts
                at, state = closed.end(), 0
            if at == 0 or text[at - 1] == "\n":
                named = line.match(text, at)
                if named:
                    delimiter = named[1]
                    skip = outside(delimiter if cutting else None).match
                    cuts.append((at, named.end(), False))
                    at = named.end()
                    continue
            at = skip(text, at).end()
            if at == len(text):
                return 0, delimiter, cuts
            if cutting and text.startswith(delimiter, at):
                cuts.append((at, at + len(delimiter), True))
                at += len(delimiter)
            elif text[at] == "\n":
                at += 1
            else:
                state = opening[text[at]]
                at += 2 if state == 4 else 1

    return walk


def texts(batch: pa.RecordBatch, line_sep: str) -> Iterator[tuple[str, int, slice, np.ndarray, str]]:
    """``file, block, rows, starts, text`` for neighbouring rows of one stretch: their records, each ended by ``line_sep``, as one text.

    A call of a walk for each record costs more than the walk. Records begin lines, so if ``line_sep`` does not end one each is a text.
    """
    file, block, value = (batch.column(c) for c in ("file", "block", "value"))
    if not len(value):
        return
    lengths = pc.utf8_length(value).to_numpy(zero_copy_only=False).astype(np.int64) + len(line_sep)
    starts = np.cumsum(lengths) - lengths
    new = np.diff(starts // CHARACTERS) > 0 if line_sep.endswith("\n") else np.ones(len(value) - 1, bool)
    for column in (file, block):
        new |= pc.not_equal(column[1:], column[:-1]).to_numpy(zero_copy_only=False)
    bounds = [0, *(np.flatnonzero(new) + 1).tolist(), len(value)]
    for first, end in zip(bounds, bounds[1:]):
        records = pa.ListArray.from_arrays(pa.array([0, end - first], pa.int32()), value[first:end])
        text = pc.binary_join(records, line_sep)[0].as_py() + line_sep
        yield file[first].as_py(), block[first].as_py(), slice(first, end), starts[first:end] - starts[first], text


def state_maps(records: DataFrame, line_sep: str) -> DataFrame:
    """Per stretch (``file, block``) the state and delimiter it ends in, from each state it can begin in; null: the delimiter in force before."""
    make, n_states = walker, STATES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        walk, here, ends = make(), None, []

        def row() -> pa.RecordBatch:
            kinds = [("file", pa.string()), ("block", pa.int64()), ("states", pa.list_(pa.int32())), ("delimiters", pa.list_(pa.string()))]
            values = [*here, [e[0] for e in ends], [e[1] for e in ends]]
            return pa.RecordBatch.from_arrays([pa.array([v], kind) for v, (_, kind) in zip(values, kinds)], names=[n for n, _ in kinds])

        for batch in batches:
            for file, block, _, _, text in texts(batch, line_sep):
                if (file, block) != here:
                    if here is not None:
                        yield row()
                    here, ends = (file, block), [(s, None) for s in range(n_states)]
                # States that have met are walked once.
                after = {}
                for state in {e[0] for e in ends}:
                    end, _, cuts = walk(text, state, None)
                    after[state] = end, last_named(text, cuts)
                ends = [(after[s][0], after[s][1] or d) for s, d in ends]
        if here is not None:
            yield row()

    def last_named(text: str, cuts: list) -> str | None:
        return text[cuts[-1][0] : cuts[-1][1]].split()[1] if cuts else None

    return records.select("file", "block", "value").mapInArrow(run, "file string, block bigint, states array<int>, delimiters array<string>")


def beginnings(maps: DataFrame) -> DataFrame:
    """``file, block, state, delimiter`` at the beginning of each stretch: the maps before it in its file, one after the other."""

    def compose(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("block")
        state, delimiter, states, delimiters = 0, ";", [], []
        for to, named in zip(rows["states"], rows["delimiters"]):
            states.append(state)
            delimiters.append(delimiter)
            state, delimiter = int(to[state]), named[state] or delimiter
        return pd.DataFrame({"file": rows["file"], "block": rows["block"], "state": states, "delimiter": delimiters})

    # One row a stretch, some 100 bytes.
    return maps.groupBy("file").applyInPandas(compose, "file string, block bigint, state int, delimiter string")


def cut(records: DataFrame, begun: DataFrame, line_sep: str) -> DataFrame:
    """Pieces: ``stretch, seq, part, edge, text``; ``begun`` has the numbers of the stretches.

    ``edge`` is 0 for whole statements, 1 for what the first delimiter of a stretch ends, 2 for what its end leaves open.
    """
    make = walker
    names = ["stretch", "seq", "part", "edge", "text"]
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A list for each column: rows as tuples would be walked by the garbage collector again and again.
        walk, here, shown, out = make(), None, re.compile(r"\S").search, [[], [], [], [], []]
        state, delimiter, pieces, place, any_end, last, seq = 0, ";", [], None, False, (None, 0), 0

        def started(seq: int) -> tuple[int, int]:
            nonlocal last
            last = seq, last[1] + 1 if seq == last[0] else 0
            return last

        def put(edge: int, seq: int) -> None:
            nonlocal place
            row = (stretch, *(place or started(seq)), edge, pieces[0] if len(pieces) == 1 else "".join(pieces))
            for column, value in zip(out, row):
                column.append(value)
            pieces.clear()
            place = None

        def batch_of() -> pa.RecordBatch:
            done = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], names=names)
            for column in out:
                column.clear()
            return done

        for batch in batches:
            seqs = batch.column("seq").to_pylist()
            for file, block, rows, starts, text in texts(batch, line_sep):
                if (file, block) != here:
                    if here is not None:
                        put(2, seq)
                    here, any_end, last = (file, block), False, (None, 0)
                    state, delimiter, stretch = (batch.column(c)[rows.start].as_py() for c in ("state", "delimiter", "stretch"))
                starts, here_seqs, at = starts.tolist(), seqs[rows], 0
                state, delimiter, cuts = walk(text, state, delimiter)
                for end, start, ends in [*cuts, (len(text), len(text), False)]:
                    pieces.append(text[at:end])
                    # A statement's place is that of its first character that is not blank.
                    if place is None and (first := shown(text, at, end)):
                        place = started(here_seqs[bisect_right(starts, first.start()) - 1])
                    at = start
                    if ends:
                        put(0 if any_end else 1, here_seqs[bisect_right(starts, end) - 1])
                        any_end = True
                seq = here_seqs[-1]
            if out[0]:
                yield batch_of()
        if here is not None:
            put(2, seq)
            yield batch_of()

    # A row for each stretch, some 100 bytes; the join must not move the records.
    rows = records.join(F.broadcast(begun), ["file", "block"]).select("file", "block", "seq", "value", "state", "delimiter", "stretch")
    return rows.mapInArrow(run, "stretch bigint, seq bigint, part int, edge int, text string")


def whole_statements(records: DataFrame, line_sep: str) -> DataFrame:
    """``file, block, seq, part, text`` of the statements of ``records`` (``file, block, seq, value``, as a text source with ``line_sep`` reads them).

    Delimiters that hold quotes, or read as a comment with what follows them, are not understood.
    """
    begun = written(beginnings(state_maps(records, line_sep)).withColumn("stretch", F.monotonically_increasing_id()), "dump-states")
    # The names of files, longer than many a statement, are written once a stretch.
    pieces = written(cut(records, begun, line_sep), "dump-pieces")
    return joined(pieces.join(F.broadcast(begun.select("stretch", "file", "block")), "stretch").drop("stretch")).drop("parts")


def joined(pieces: DataFrame) -> DataFrame:
    """The pieces of whole statements as they are, those at edges put together: ``file, block, seq, part, text``, and ``parts``, of how many each is made."""
    edges = pieces.where("edge > 0")
    # Statements ended before an edge number the statement it belongs to.
    before = Window.partitionBy("file").orderBy("block", "edge").rowsBetween(Window.unboundedPreceding, -1)
    numbered = edges.select("file", "block", "edge", F.coalesce(F.sum(F.when(F.col("edge") == 1, 1).otherwise(0)).over(before), F.lit(0)).alias("n"))
    parts = edges.join(numbered, ["file", "block", "edge"]).groupBy("file", "n").agg(F.array_sort(F.collect_list(F.struct("block", "edge", "seq", "part", "text"))).alias("ps"))
    # A statement's place is that of its first piece that is not blank.
    first = F.coalesce(F.get(F.filter("ps", lambda p: F.trim(p["text"]) != ""), F.lit(0)), F.get("ps", F.lit(0)))
    whole = parts.select("file", first.alias("p"), F.array_join(F.transform("ps", lambda p: p["text"]), "").alias("text"), F.size("ps").alias("parts"))
    return pieces.where("edge = 0").drop("edge").withColumn("parts", F.lit(1)).unionByName(whole.select("file", "p.block", "p.seq", "p.part", "text", "parts"))
