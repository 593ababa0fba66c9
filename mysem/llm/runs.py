"""Periodic runs of words, by Lyndon roots.

A run with period q holds a Lyndon word of q words that is the longest one beginning where it begins, under the order of
words or under the reversed order. The longest Lyndon word at each place is read off the first phase of Baier's suffix sorter,
which groups suffixes by it: groups are taken from the greatest down; each of their suffixes lengthens the nearest
suffix before it that is in a smaller group; those lengthened alike move to a new group just above their old one.
The roots are then extended to both sides as far as words one period apart are the same.

Every word of a run of ``exponent`` repeats comes ``exponent`` times inside it, so a text is first cut at words that come
less often between two cuts. Only the stretches left are sorted; no run is lost by it.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mysem.llm import texts as T

# What the regular expressions of Spark call a word here; bytes.split() cuts at the same six characters.
WORD = r"[^\x20\x09-\x0D]+"
MIN_LENGTH, MIN_EXPONENT = 6, 4


def lyndon_lengths(ranks: list[int]) -> list[int]:
    """Length of the longest Lyndon word at each place of a text of numbers."""
    n = len(ranks)
    members: list[list[int]] = []
    number: dict[int, int] = {}
    group = [0] * n
    for i, r in enumerate(ranks):
        g = number.setdefault(r, len(members))
        if g == len(members):
            members.append([])
        group[i] = g
        members[g].append(i)
    order = [number[r] for r in sorted(number)]
    # Groups form a list from great to small; places not yet taken form one from left to right.
    below, above, live = [-1] * len(members), [-1] * len(members), [len(m) for m in members]
    for small, great in zip(order, order[1:]):
        below[great], above[small] = small, great
    length = [1] * len(members)
    before, after = list(range(-1, n - 1)), list(range(1, n + 1))

    top = order[-1] if order else -1
    while top >= 0:
        span = length[top]
        times: dict[int, int] = {}
        for i in members[top]:
            if group[i] != top:
                continue
            # Members come from left to right, so all before them are taken off already.
            j, k = before[i], after[i]
            if j >= 0:
                after[j] = k
                times[j] = times.get(j, 0) + 1
            if k < n:
                before[k] = j
        if len(times) == 1:
            parts = [(list(times), next(iter(times.values())))]
        else:
            by: dict[tuple[int, int], list[int]] = {}
            for j, t in times.items():
                by.setdefault((-t, group[j]), []).append(j)
            parts = [(by[key], -key[0]) for key in sorted(by)]
        for places, t in parts:
            old = group[places[0]]
            if live[old] == len(places):
                # The whole group is lengthened and stays where it is.
                length[old] += t * span
                continue
            new = len(members)
            members.append(places)
            live.append(len(places))
            live[old] -= len(places)
            length.append(length[old] + t * span)
            for j in places:
                group[j] = new
            up = above[old]
            above.append(up)
            below.append(old)
            above[old] = new
            below[up] = new
        top = below[top]
    return [length[g] for g in group]


def _extension(a: np.ndarray, b: np.ndarray) -> int:
    """How far two sequences agree from their beginnings, compared in stretches that double."""
    n, at, step = min(len(a), len(b)), 0, 16
    while at < n:
        end = min(at + step, n)
        same = a[at:end] == b[at:end]
        if not same.all():
            return at + int(np.argmin(same))
        at += len(same)
        step *= 2
    return n


def _runs_of(codes: np.ndarray, exponent: int) -> list[tuple[int, int, int]]:
    """All runs of one stretch: start, length, period, with at least ``exponent`` repeats."""
    n = len(codes)
    found: set[tuple[int, int, int]] = set()
    back = codes[::-1]
    for ranks in (codes.tolist(), (-codes).tolist()):
        roots = np.array(lyndon_lengths(ranks))
        # A root comes at least exponent - 1 times in a run, each a period after the last.
        at = np.arange(n)
        ok = np.ones(n, bool)
        for k in range(1, exponent - 1):
            there = np.minimum(at + k * roots, n - 1)
            ok &= (at + k * roots < n) & (roots[there] == roots) & (codes[there] == codes)
        ends: dict[int, int] = {}
        for i, q in zip(np.flatnonzero(ok).tolist(), roots[ok].tolist()):
            if i + q <= ends.get(q, 0):
                continue  # in the run found last
            right = _extension(codes[i:], codes[i + q :])
            left = _extension(back[n - i :], back[n - i - q :])
            if left + q + right >= exponent * q:
                found.add((i - left, left + q + right, q))
                ends[q] = i + q + right
    return sorted(found)


def _stretches(words: list[bytes], counts: Counter, least: int, exponent: int) -> Iterator[tuple[int, int]]:
    """Stretches, as start and end, of at least ``least`` words that hold all runs: words that come less than ``exponent`` times are cut out."""
    waiting = [(0, len(words), counts, 0)]
    while waiting:
        first, end, counts, depth = waiting.pop()
        # Cutting again only saves work, so it ends after a few times.
        rare = [i for i in range(first, end) if counts[words[i]] < exponent] if depth < 8 else []
        if not rare:
            if end - first >= least:
                yield first, end
            continue
        for a, b in zip([first - 1, *rare], [*rare, end]):
            if b - a - 1 >= least:
                waiting.append((a + 1, b, Counter(words[a + 1 : b]), depth + 1))


def find_runs(words: list[bytes], least: int = MIN_LENGTH, exponent: int = MIN_EXPONENT) -> list[tuple[int, int, int]]:
    """Start, length and period of each run of at least ``least`` words and ``exponent`` (3 or more) repeats, by start, then period."""
    out = []
    for first, end in _stretches(words, Counter(words), least, exponent):
        numbers: dict[bytes, int] = {}
        codes = np.array([numbers.setdefault(w, len(numbers)) for w in words[first:end]], np.int64)
        out += [(first + a, n, q) for a, n, q in _runs_of(codes, exponent) if n >= least]
    return sorted(out, key=lambda r: (r[0], r[2]))


def kept_words(n: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """True for words that no run holds after its first period."""
    edge = np.zeros(n + 1, np.int64)
    for start, length, period in runs:
        edge[start + period] += 1
        edge[start + length] -= 1
    return np.cumsum(edge[:n]) == 0


def periodic_runs(df: DataFrame, *more: Column, id_col: str = "doc_id", text_col: str = "text", least: int = MIN_LENGTH, exponent: int = MIN_EXPONENT) -> DataFrame:
    """Per row ``doc_id``, the columns ``more``, ``n_words``, ``runs`` (start, length and period in words, by start, then period) and ``collapsed``,
    the words that no run holds after its first period, joined by one space.

    A run is a stretch of words equal to those one period on, which is its smallest, that no neighbouring word extends;
    it has ``least`` words and ``exponent`` periods (3 or more) at least. Words are cut at the six characters of ASCII white space.
    Null, empty and blank texts have no words, no runs and an empty text; rows that repeat an id each get a row.
    """
    if exponent < 3:
        raise ValueError("exponent must be 3 or more")
    rows = T.inputs(df, id_col, text_col, *more)
    extra = [f for f in rows.schema.fields if f.name not in ("doc_id", "text")]

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        counts, found, collapsed = [], [], []
        for text in batch.column("text").to_pylist():
            words = (text or "").encode("utf-8", "replace").split()
            runs = find_runs(words, least, exponent)
            if runs:
                words_kept = [w for w, ok in zip(words, kept_words(len(words), runs).tolist()) if ok]
            else:
                words_kept = words
            counts.append(len(words))
            found.append(runs)
            collapsed.append(b" ".join(words_kept).decode())
        flat = np.array([r for runs in found for r in runs], np.int64).reshape(-1, 3)
        offsets = pa.array(np.concatenate([[0], np.cumsum([len(r) for r in found])]).astype(np.int32))
        parts = pa.StructArray.from_arrays([pa.array(flat[:, i].copy()) for i in range(3)], names=["start", "length", "period"])
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), *(batch.column(f.name) for f in extra), pa.array(counts, pa.int64()), pa.ListArray.from_arrays(offsets, parts), pa.array(collapsed, pa.string())],
            names=["doc_id", *(f.name for f in extra), "n_words", "runs", "collapsed"],
        )

    kinds = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in extra)
    return T.map_runs(rows, f"doc_id bigint, {kinds}n_words bigint, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string", run)


def with_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and ``text``, where about a tenth of the texts, picked by a checksum of the id, repeat themselves from some word on.

    With h = crc32 of the decimal id, g = h / 10 rounded down and n words: if h is a multiple of 10, each word i from a = g % n on becomes
    the word a + (i - a) % p, p = 1 + (n - a) / (3 + g % 8) rounded down; words are then joined by one space. Without an id a text stays.
    """
    rows = T.inputs(df, id_col, text_col)
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10).cast("long")

    def repeated(words: Column) -> Column:
        n = F.greatest(F.size(words), F.lit(1)).cast("long")
        a = g % n
        p = F.lit(1) + F.floor((n - a) / (F.lit(3) + g % 8)).cast("long")
        return F.array_join(F.transform(words, lambda w, i: F.when(i < a, w).otherwise(F.get(words, (a + (i - a) % p).cast("int")))), " ")

    # A list of one list: so its words are cut out once, not once for each word.
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    text = F.when((h % 10 == 0) & F.col("text").isNotNull(), F.get(F.transform(F.array(words), repeated), F.lit(0))).otherwise(F.col("text"))
    return rows.select("doc_id", text.alias("text"))
