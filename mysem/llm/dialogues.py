"""Repair of the structure of conversations: cheapest edits that leave an optional system turn, then user and assistant in turns.

Secondary-sorted streaming. Turns are repartitioned by conversation and sorted, and a mapInPandas stream carries the state of a
dynamic program across batches, so a conversation of any length needs a few numbers. Two passes:

1. from the last turn to the first, over thin rows without texts: the cheapest cost to go from each of four states. The first
   edit of the best plan from each state is one byte a turn; every so many bytes are put out as a row of their own, and so leave memory.
2. from the first turn to the last, over the texts with those rows sorted in between: follows the bytes.

A plan's cost to go is known when an edit is chosen, so of equally cheap plans the first in order of letters is found as it goes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mysem.llm import texts as T
from mysem.session import written

# States: nothing yet, after a system turn, after a user turn, after an assistant turn.
_NEXT = (2, 2, 3, 2)
_ROLES = ("user", "user", "assistant", "user")
_KEEPS = {"s": (1, None, None, None), "u": (2, 2, None, 2), "a": (None, None, 3, None)}
_LEGAL = {"su", "ua", "au"}
# Letters in their order, and their two bits.
_DELETE, _INSERT, _KEEP, _REROLE = range(4)
_LETTERS = "DIKR"
COST_INSERT, COST_REROLE, COST_DELETE, COST_TRUNCATED = 3, 3, 4, 3
_END = (0, 2 * COST_INSERT, COST_INSERT, 0)
# So many turns are decided in one row of bytes.
BLOCK = 1 << 16
_MUST_DELETE = ("blank", "duplicate")


def step_back(ahead: tuple[int, ...], initial: str, fault: str) -> tuple[tuple[int, ...], int]:
    """Costs to go before a turn, from those after it, and the first edit from each state, two bits each."""
    if fault in _MUST_DELETE:
        return tuple(c + COST_DELETE for c in ahead), 0
    late = COST_TRUNCATED if fault == "truncated" else 0
    keeps = _KEEPS.get(initial, (None,) * 4)
    base = []
    for s in range(4):
        options = [ahead[s] + COST_DELETE, late + COST_REROLE + ahead[_NEXT[s]]]
        if keeps[s] is not None:
            options.append(late + ahead[keeps[s]])
        base.append(min(options))
    two, three = min(base[2], base[3] + COST_INSERT), min(base[3], base[2] + COST_INSERT)
    cost = (min(base[0], two + COST_INSERT), min(base[1], two + COST_INSERT), two, three)
    byte = 0
    for s in range(4):
        if cost[s] == ahead[s] + COST_DELETE:
            first = _DELETE
        elif cost[s] == cost[_NEXT[s]] + COST_INSERT:
            first = _INSERT
        elif keeps[s] is not None and cost[s] == late + ahead[keeps[s]]:
            first = _KEEP
        else:
            first = _REROLE
        byte |= first << (2 * s)
    return cost, byte


def _turns(df: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """``conv``, a text ``at`` that sorts as turns do, ``role`` and ``text``; null roles and texts are one space.

    A conversation's name is led by ``=``, so that null has the empty name. Of rows of one turn, equal ones stand together.
    """
    role, text = F.coalesce(F.col(role_col).cast("string"), F.lit(" ")), F.coalesce(F.col(text_col).cast("string"), F.lit(" "))
    turn = F.col(turn_col).cast("long")
    digest = F.sha2(F.concat(F.length(role).cast("string"), F.lit(" "), role, text).cast("binary"), 256)
    # With the sign bit flipped, hexadecimal digits sort as numbers do.
    place = F.coalesce(F.lpad(F.hex(turn.bitwiseXOR(F.lit(-(1 << 63)))), 16, "0"), F.lit(""))
    return df.select(
        F.coalesce(F.concat(F.lit("="), F.col(conv_col).cast("string")), F.lit("")).alias("conv"),
        F.concat_ws(" ", place, digest).alias("at"),
        role.alias("role"),
        text.alias("text"),
    )


def _thin(turns: DataFrame) -> DataFrame:
    """One row per different turn of a conversation: ``conv``, ``at``, ``initial``, ``fault`` ('' for none) and ``copies``, how often it stands there."""
    bare = F.regexp_replace("text", r"[\x20\x09-\x0D]+", "")
    own = F.when(bare == "", "blank").when(~F.substring(bare, -1, 1).isin(".", "!", "?"), "truncated").otherwise("")
    rows = turns.select("conv", "at", F.substring("role", 1, 1).alias("initial"), own.alias("own")).groupBy("conv", "at", "initial", "own").agg(F.count("*").alias("copies"))
    rows = written(rows, "turns")
    # Turns said before: the same role and text at an earlier place. Only those that come again are joined.
    said = F.substring("at", -64, 64).alias("said")
    again = rows.groupBy("conv", said).agg(F.min("at").alias("first"), F.count("*").alias("places")).where("places > 1").drop("places")
    joined = rows.withColumn("said", said).join(again, ["conv", "said"], "left")
    duplicate = (F.col("own") != "blank") & F.col("first").isNotNull() & (F.col("at") > F.col("first"))
    return joined.select("conv", "at", "initial", F.when(duplicate, "duplicate").otherwise(F.col("own")).alias("fault"), "copies")


def _plans(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """From the last turn of each conversation to its first: bytes of edits, and counts."""
    names = ["conv", "at", "edits", "gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    out: list[tuple] = []
    conv, at, cost, edits, counts, later = None, "", _END, bytearray(), {}, None
    place, n_places, highest, lowest = None, 0, None, None

    def put(final: bool) -> None:
        nonlocal edits, counts
        gaps = highest - lowest + 1 - n_places if final and n_places else 0
        out.append((conv, at, bytes(reversed(edits)), gaps, *(counts.get(k, 0) for k in ("blank", "duplicate", "truncated", "illegal")), cost[0] if final else 0))
        edits, counts = bytearray(), {}

    for batch in batches:
        for c, a, initial, fault, copies in zip(*(batch[k].tolist() for k in ("conv", "at", "initial", "fault", "copies"))):
            if c != conv:
                if conv is not None:
                    put(True)
                conv, cost, later, place, n_places, highest = c, _END, None, None, 0, None
            elif len(edits) >= BLOCK:
                put(False)
            at = a
            here = a[:-65]  # the turn, before a space and the checksum
            if here != place:
                place = here
                if here:
                    lowest, n_places = int(here, 16), n_places + 1
                    highest = lowest if highest is None else highest
            cost, byte = step_back(cost, initial, fault)
            edits.append(byte)
            if fault:
                counts[fault] = counts.get(fault, 0) + 1
            if copies > 1:
                more = "blank" if fault == "blank" else "duplicate"
                counts[more] = counts.get(more, 0) + copies - 1
                cost = tuple(x + COST_DELETE * (copies - 1) for x in cost)
            illegal = (copies - 1) + (later is not None and initial + later not in _LEGAL)
            counts["illegal"] = counts.get("illegal", 0) + illegal
            later = initial
        if out:
            yield pd.DataFrame(out, columns=names)
            out = []
    if conv is not None:
        put(True)
        yield pd.DataFrame(out, columns=names)


def _followed(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[str, str, list[tuple[str, str, str]]]]:
    """The edits of each conversation, turn by turn: (conversation, letters, repaired turns as edit, role and text); ('', ...) once more with no letters at its end."""
    conv, state, edits, n, at = None, 0, b"", 0, None
    for batch in batches:
        for c, a, kind, given, role, text in zip(*(batch[k].tolist() for k in ("conv", "at", "kind", "edits", "role", "text"))):
            if c != conv:
                if conv is not None:
                    yield conv, *_closing(state), True
                conv, state, at = c, 0, None
            if kind == 0:
                edits, n = given, 0
                continue
            if a == at:  # a copy of the row before
                yield conv, "D", [], False
                continue
            at = a
            byte = edits[n]
            n += 1
            letters, turns = "", []
            while (edit := byte >> (2 * state) & 3) == _INSERT:
                letters += "I"
                turns.append(("I", _ROLES[state], ""))
                state = _NEXT[state]
            letters += _LETTERS[edit]
            if edit == _KEEP:
                turns.append(("K", role, text))
                state = _KEEPS[role[:1]][state]
            elif edit == _REROLE:
                turns.append(("R", _ROLES[state], text))
                state = _NEXT[state]
            yield conv, letters, turns, False
    if conv is not None:
        yield conv, *_closing(state), True


def _closing(state: int) -> tuple[str, list[tuple[str, str, str]]]:
    """What is inserted after the last turn."""
    turns = []
    while state in (1, 2):
        turns.append(("I", _ROLES[state], ""))
        state = _NEXT[state]
    return "I" * len(turns), turns


def _audits(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    audit, digest, begun, out = [], hashlib.sha256(), False, []
    for conv, letters, turns, end in _followed(batches):
        audit.append(letters)
        for _, role, text in turns:
            digest.update(f"{chr(10) if begun else ''}{role}:{text}".encode())
            begun = True
        if end:
            out.append((conv, "".join(audit), digest.hexdigest()))
            audit, digest, begun = [], hashlib.sha256(), False
            if len(out) >= 4096:
                yield pd.DataFrame(out, columns=["conv", "audit", "repaired_sha256"])
                out = []
    if out:
        yield pd.DataFrame(out, columns=["conv", "audit", "repaired_sha256"])


def _repaired(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    place, size, out = 0, 0, []
    for conv, _, turns, end in _followed(batches):
        for turn in turns:
            out.append((conv, place, *turn))
            place, size = place + 1, size + len(turn[2])
        if end:
            place = 0
        if size >= T.RUN_BYTES or len(out) >= 4096:
            yield pd.DataFrame(out, columns=["conv", "place", "edit", "role", "text"])
            size, out = 0, []
    if out:
        yield pd.DataFrame(out, columns=["conv", "place", "edit", "role", "text"])


def _planned(df: DataFrame, cols: tuple[str, str, str, str]) -> tuple[DataFrame, DataFrame]:
    """Written plans in blocks, and the turns with their plans before them, by conversation."""
    T.ship(df.sparkSession)
    turns = _turns(df, *cols)
    thin = _thin(turns).repartition("conv").sortWithinPartitions("conv", F.desc("at"))
    schema = "conv string, at string, edits binary, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint"
    plans = written(thin.mapInPandas(_plans, schema), "plans")
    none = F.lit(None)
    steered = plans.select("conv", "at", F.lit(0).alias("kind"), "edits", none.cast("string").alias("role"), none.cast("string").alias("text")).unionAll(
        turns.select("conv", "at", F.lit(1).alias("kind"), none.cast("binary").alias("edits"), "role", "text")
    )
    return plans, steered.repartition("conv").sortWithinPartitions("conv", "at", "kind")


def repaired_turns(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """The turns after repair: the conversation's column, ``place`` from 0, ``edit`` (Keep, Rerole or Insert, by initial), ``role`` and ``text``.

    See ``audit`` for the rules. A conversation of which nothing is left has no rows.
    """
    _, steered = _planned(df, (conv_col, turn_col, role_col, text_col))
    rows = steered.mapInPandas(_repaired, "conv string, place bigint, edit string, role string, text string")
    name = F.when(F.col("conv") != "", F.substring("conv", 2, 1 << 30)).cast(df.schema[conv_col].dataType)
    return rows.select(name.alias(conv_col), "place", "edit", "role", "text")


def audit(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Per conversation: ``gaps``, ``blank``, ``duplicate``, ``truncated``, ``illegal``, ``cost``, ``audit`` and ``repaired_sha256``.

    Turns are taken by number, nulls first; of one number, by a checksum of role and text, so copies stand together. Null roles and texts are one
    space; null is a conversation like any other; columns beyond the four do not matter; a table without rows gives none. A turn's fault is the first of
    blank (only ASCII white space), duplicate (role and text stood before) and truncated (the last other character is none of ``.!?``).
    Gaps are numbers missing between the least and the greatest (0 if all are null); illegal are neighbours whose roles' initials are not su, ua or au.

    The repair keeps turns (free), gives them the role user or assistant (3), deletes them (4; blank and duplicate ones always) or inserts empty
    ones of these roles (3), at 3 more for each truncated turn left, so that initials (an empty role fits nowhere) read ``(s?(ua)+)?``. ``audit`` holds the initials of the edits
    (D, I, K, R) in order, the first in order of letters among the cheapest; the checksum is of ``role:text``, joined by line feeds.
    """
    plans, steered = _planned(df, (conv_col, turn_col, role_col, text_col))
    counts = plans.groupBy("conv").agg(*[F.sum(c).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")])
    found = counts.join(steered.mapInPandas(_audits, "conv string, audit string, repaired_sha256 string"), "conv")
    name = F.when(F.col("conv") != "", F.substring("conv", 2, 1 << 30)).cast(df.schema[conv_col].dataType)
    return found.select(name.alias(conv_col), "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def damaged(df: DataFrame) -> DataFrame:
    """Conversations with faults put in by a checksum of ``conv_id:turn`` modulo 20 (nulls: one space).

    0 drops the row, 1 empties its text, 2 takes ``.``, ``!`` and ``?`` out of it, 3 repeats the row, 4 makes its role user.
    """
    as_text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    h = F.crc32(F.concat(as_text("conv_id"), F.lit(":"), as_text("turn")).cast("binary")) % 20
    text = F.when(h == 1, "").when(h == 2, F.regexp_replace(as_text("text"), "[.!?]", "")).otherwise(as_text("text"))
    role = F.when(h == 4, "user").otherwise(as_text("role"))
    rows = df.where(h != 0).select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(F.when(h == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"))
    return rows.drop("copy")


def of_all(report: DataFrame, df: DataFrame, conv_col: str = "conv_id") -> DataFrame:
    """``report`` with a row for each conversation of ``df``: zeros, an empty audit and the checksum of nothing where it has none."""
    every = df.select(F.col(conv_col)).distinct()
    both = every.join(report.withColumnRenamed(conv_col, "__conv"), F.col(conv_col).eqNullSafe(F.col("__conv")), "left").drop("__conv")
    zeros = {c: 0 for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")}
    return both.fillna(zeros | {"audit": "", "repaired_sha256": hashlib.sha256(b"").hexdigest()}, [*zeros, "audit", "repaired_sha256"])
