"""Byte-level BPE encoding and decoding by forced boundaries.

A pair of bytes that stands inside no token of the vocabulary cannot be crossed by any merge, so a text is cut there, and
where the model's pattern cuts it, before anything is merged. The different fragments of a run of texts are merged
independently and together, one merge each a step, and the texts' ids are strung together from those of their fragments.

A merge's rank must be larger than the ranks that make its parts (training gives no other). Then joining one pair makes
no pair of a smaller rank, and all places of a fragment's best pair can be joined in one step.
"""

from __future__ import annotations

import heapq
import json
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mysem.llm import texts as T

MODEL = "/opt/tokenizers/byte_bpe_50k.json"
# The model is broadcast.
MAX_MODEL_BYTES = 64 << 20
# Longer fragments are merged one by one.
LONG = 64
# Longer texts are worked off in parts of about this many characters.
PART = 1 << 20
_FILTER = 1 << 21
_NEVER = np.int64(1) << 40
_LETTER, _NUMBER, _SPACE, _OTHER = 0, 1, 2, 3


@dataclass
class BytePairs:
    """A model as arrays; ids are the model's own."""

    classes: np.ndarray
    inside: np.ndarray
    byte_ids: np.ndarray
    width: int
    keys: np.ndarray
    ranks: np.ndarray
    made: np.ndarray
    near: np.ndarray
    special: dict[str, int]
    out_bytes: np.ndarray
    out_starts: np.ndarray

    def find(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank of each pair of ids, and the id it makes; ``_NEVER`` if it is never merged."""
        keys = left * self.width + right
        rank, out = np.full(len(keys), _NEVER), np.zeros(len(keys), np.int64)
        maybe = np.flatnonzero(self.near[T.mixed(keys) & np.uint64(_FILTER - 1)])
        at = np.minimum(np.searchsorted(self.keys, keys[maybe]), len(self.keys) - 1)
        hit = self.keys[at] == keys[maybe]
        rank[maybe[hit]] = self.ranks[at[hit]]
        out[maybe[hit]] = self.made[at[hit]]
        return rank, out


def _alphabet() -> dict[str, int]:
    """The character that stands for each byte: itself if it prints, else the next free one from U+0100."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def _classes() -> np.ndarray:
    """Letter, number, white space or other for each code point, as the tokenizers library's own patterns see them."""
    from tokenizers import Regex, pre_tokenizers

    out = np.full(0x110000, _OTHER, np.uint8)
    # A short string at a time: the library's time grows with the square of the length.
    for first in (f for f in range(0, 0x110000, 256) if not 0xD800 <= f < 0xE000):
        block = "".join(map(chr, range(first, first + 256)))
        for kind, pattern in ((_LETTER, r"\p{L}+"), (_NUMBER, r"\p{N}+"), (_SPACE, r"\s+")):
            found = np.ones(256, bool)
            for _, (a, b) in pre_tokenizers.Split(Regex(pattern), "removed").pre_tokenize_str(block):
                found[a:b] = False
            out[first : first + 256][found] = kind
    return out


def load(path: str = MODEL) -> BytePairs:
    """Read a tokenizer file. Only plain byte-level models with ordered merges; all else is an error."""
    if os.path.getsize(path) > MAX_MODEL_BYTES:
        raise ValueError(f"{path} is larger than {MAX_MODEL_BYTES} bytes")
    with open(path, encoding="utf-8") as file:
        given = json.load(file)
    model, split = given["model"], given["pre_tokenizer"] or {}
    if split.get("type") != "ByteLevel" or split.get("add_prefix_space") or not split.get("use_regex", True) or given["normalizer"]:
        raise ValueError("only byte-level models that leave texts as they are")
    if model["type"] != "BPE" or any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")):
        raise ValueError("only plain byte-pair models")
    if any(t["single_word"] or t["lstrip"] or t["rstrip"] or re.search(r"\s", t["content"]) for t in given["added_tokens"]):
        raise ValueError("only special tokens without white space that match as they are")
    alphabet = _alphabet()
    vocab = {token: i for token, i in model["vocab"].items()}
    tokens = {i: bytes(alphabet[c] for c in token) for token, i in vocab.items()}
    special = {t["content"]: t["id"] for t in given["added_tokens"]}
    width = max([*tokens, *special.values()]) + 1

    merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
    left, right, made = (np.array([vocab[t] for t in part], np.int64) for part in zip(*[(a, b, a + b) for a, b in merges]))
    keys = left * width + right
    # A pair listed again keeps its last rank.
    keys, last = np.unique(keys[::-1], return_index=True)
    ranks = len(merges) - 1 - last
    born = np.full(width, -1, np.int64)
    np.maximum.at(born, made[ranks], ranks)
    if (born[left[ranks]] >= ranks).any() or (born[right[ranks]] >= ranks).any():
        raise ValueError("a merge comes before those that make its parts")

    inside = np.zeros(1 << 16, bool)
    pairs = [np.frombuffer(t, np.uint8).astype(np.int64) for t in tokens.values() if len(t) > 1]
    inside[np.concatenate([p[:-1] * 256 + p[1:] for p in pairs])] = True
    near = np.zeros(_FILTER, bool)
    near[T.mixed(keys) & np.uint64(_FILTER - 1)] = True
    written = [tokens.get(i, b"") for i in range(width)]
    for content, i in special.items():
        written[i] = content.encode()
    byte_ids = np.array([vocab[c] for c, _ in sorted(alphabet.items(), key=lambda x: x[1])], np.int64)
    return BytePairs(
        _classes(), inside, byte_ids, width, keys, ranks, made[ranks], near, special,
        np.frombuffer(b"".join(written), np.uint8), np.concatenate([[0], np.cumsum([len(t) for t in written])]),
    )


def _ragged(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Indices of the ranges ``starts[i]`` to ``starts[i] + counts[i]``, one after the other."""
    ends = np.cumsum(counts)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - counts, counts) + np.repeat(starts, counts)


def _begins(codes: np.ndarray, kinds: np.ndarray, hard: np.ndarray) -> np.ndarray:
    """Where the model's pattern begins a token; ``hard`` marks places between texts.

    Runs of one class are tokens. The last white space before a run joins it if it is a space and stands alone if not;
    white space before it, or at a text's end, is one token. A lone apostrophe takes the endings of short forms.
    """
    begin = np.ones(len(codes), bool)
    begin[1:] = (kinds[1:] != kinds[:-1]) | hard[1:] | hard[:-1]
    space = (kinds == _SPACE) & ~hard
    last = np.flatnonzero(space[:-1] & ~space[1:] & ~hard[1:])
    begin[last] = True
    joined = last[codes[last] == 32]
    begin[joined + 1] = False

    mark = np.flatnonzero((codes[:-1] == 39) & begin[:-1] & begin[1:])
    if len(mark):
        padded = np.append(codes, [0, 0])
        one, two = padded[mark + 1], padded[mark + 2]
        is_one = np.isin(one, [ord(c) for c in "stmd"])
        is_two = ((one == ord("l")) & (two == ord("l"))) | (np.isin(one, [ord("r"), ord("v")]) & (two == ord("e")))
        short = is_one | is_two
        begin[mark[short] + 1] = False
        begin[mark[short] + np.where(is_one, 2, 3)[short]] = True
    return begin


def _merge_all(p: BytePairs, ids: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Merge fragments of ``counts`` ids each until none can be; a step joins all places of each fragment's best pair."""
    done_ids, done_owner = [], []
    owner = np.repeat(np.arange(len(counts)), counts)
    # Rank and result of each id with the next; looked up again only where one of the two is new.
    rank, made = np.full(len(ids), _NEVER), np.zeros(len(ids), np.int64)
    new = np.arange(len(ids))
    while len(ids):
        inner = new[:-1] if len(new) and new[-1] == len(ids) - 1 else new
        paired = owner[inner] == owner[inner + 1]
        rank[new] = _NEVER
        inner = inner[paired]
        rank[inner], made[inner] = p.find(ids[inner], ids[inner + 1])
        starts = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
        sizes = np.diff(np.append(starts, len(ids)))
        best = np.repeat(np.minimum.reduceat(rank, starts), sizes)
        over = best == _NEVER
        done_ids.append(ids[over])
        done_owner.append(owner[over])
        join = (rank == best) & ~over
        # Of overlapping places of a pair of equal ids, every other one is joined, from the left.
        hit = np.flatnonzero(join)
        run = np.flatnonzero(np.append(True, (np.diff(hit) != 1) | (owner[hit[1:]] != owner[hit[:-1]]))) if len(hit) else hit
        place = np.arange(len(hit)) - np.repeat(run, np.diff(np.append(run, len(hit))))
        hit = hit[place % 2 == 0]
        ids[hit] = made[hit]
        changed = np.zeros(len(ids), bool)
        changed[hit] = True
        stay = ~over
        stay[hit + 1] = False
        ids, owner, rank, made, changed = ids[stay], owner[stay], rank[stay], made[stay], changed[stay]
        changed[:-1] |= changed[1:]
        new = np.flatnonzero(changed)
    flat, owner = np.concatenate([np.zeros(0, np.int64), *done_ids]), np.concatenate([np.zeros(0, np.int64), *done_owner])
    return flat[np.argsort(owner, kind="stable")], np.bincount(owner, minlength=len(counts))


def _merge_long(p: BytePairs, ids: list[int]) -> list[int]:
    """The same for one long fragment: a heap of pairs over a linked list of ids."""
    n = len(ids)
    after, before, alive = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
    flat = np.array(ids)
    ranks, made = p.find(flat[:-1], flat[1:])
    known: dict[tuple[int, int], tuple[int, int]] = {}
    heap = [(r, i, ids[i], ids[i + 1], m) for i, (r, m) in enumerate(zip(ranks.tolist(), made.tolist())) if r < _NEVER]
    heapq.heapify(heap)

    def offer(i: int, j: int) -> None:
        pair = ids[i], ids[j]
        if pair not in known:
            r, m = p.find(np.array(pair[:1]), np.array(pair[1:]))
            known[pair] = int(r[0]), int(m[0])
        r, m = known[pair]
        if r < _NEVER:
            heapq.heappush(heap, (r, i, *pair, m))

    while heap:
        _, i, a, b, m = heapq.heappop(heap)
        j = after[i]
        if not alive[i] or j >= n or ids[i] != a or ids[j] != b:
            continue
        ids[i], alive[j], after[i] = m, False, after[j]
        if after[i] < n:
            before[after[i]] = i
            offer(i, after[i])
        if before[i] >= 0:
            offer(before[i], i)
    return [x for x, ok in zip(ids, alive) if ok]


def parts(text: str, size: int = PART) -> Iterator[str]:
    """``text`` in parts of about ``size`` characters, cut before white space that follows something else, where a token always begins."""
    at = 0
    while len(text) - at > size:
        cut = _CUT.search(text, at + size)
        if cut is None:
            break
        yield text[at : cut.start()]
        at = cut.start()
    yield text[at:]


# Only characters that are white space by every standard.
_CUT = re.compile(r"(?<=[^\s\x1c-\x1f])[ \t\n\r]")


def encode(p: BytePairs, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts, one after the other, and how many each."""
    named = re.compile("|".join(re.escape(s) for s in sorted(p.special, key=len, reverse=True)) or r"(?!)")
    flat, ends, owns, marks = [], [], [], []
    for i, text in enumerate(texts):
        pieces = named.split(text)
        for piece, mark in zip(pieces, [*(p.special[s] for s in named.findall(text)), -1]):
            flat.append(piece)
            owns.append(i)
            marks.append(mark)
    codes, starts = T.code_points(flat)
    ends = np.append(starts[1:], len(codes)) - 1
    hard = np.zeros(len(codes), bool)
    hard[ends] = True
    begin_char = _begins(codes, p.classes[codes], hard)
    raw = np.frombuffer(("\n".join(flat) + "\n").encode("utf-8", "replace"), np.uint8)
    n_bytes = 1 + (codes >= 0x80) + (codes >= 0x800) + (codes >= 0x10000)
    byte_at = np.cumsum(n_bytes) - n_bytes
    begin = np.zeros(len(raw), bool)
    begin[byte_at[begin_char]] = True
    # The forced boundaries.
    begin[1:] |= ~p.inside[raw[:-1].astype(np.int64) * 256 + raw[1:]]
    first = np.flatnonzero(begin)
    size = np.diff(np.append(first, len(raw)))
    is_end = np.zeros(len(raw), bool)
    is_end[byte_at[ends]] = True
    at_end = np.flatnonzero(is_end[first])

    which, sample = _distinct(raw, first, size)
    start, length = first[sample], size[sample]
    n_ids = np.zeros(len(sample), np.int64)
    short = np.flatnonzero(length <= LONG)
    ids, counts = _merge_all(p, p.byte_ids[raw[_ragged(start[short], length[short])]], length[short])
    n_ids[short] = counts
    made, owner = [ids], [np.repeat(short, counts)]
    for unit in np.flatnonzero(length > LONG).tolist():
        long_ids = _merge_long(p, p.byte_ids[raw[start[unit] : start[unit] + length[unit]]].tolist())
        made.append(np.array(long_ids, np.int64))
        owner.append(np.full(len(long_ids), unit))
        n_ids[unit] = len(long_ids)
    flat_ids = np.concatenate(made)[np.argsort(np.concatenate(owner), kind="stable")]
    # The line feed after each piece is no part of it; a special token's id stands in its place.
    per = n_ids[which]
    mark = np.array(marks, np.int64)
    per[at_end] = mark >= 0
    source = (np.cumsum(n_ids) - n_ids)[which]
    source[at_end] = len(flat_ids) + np.arange(len(mark))
    out = np.concatenate([flat_ids, mark])[_ragged(source, per)]
    here = np.concatenate([[0], np.cumsum(per)])
    begins = np.concatenate([[0], at_end[:-1] + 1])
    per_piece = here[at_end + 1] - here[begins]
    totals = np.bincount(np.array(owns, np.int64), weights=per_piece, minlength=len(texts)).astype(np.int64)
    return out, totals


def _distinct(raw: np.ndarray, first: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each fragment the number of its bytes among the different ones, and a fragment with each number."""
    place = np.arange(len(raw)) - np.repeat(first, size)
    values = T.mixed(raw.astype(np.uint32) + np.uint32(1)) * T.powers(int(size.max()))[place]
    keys = T.mixed(np.add.reduceat(values, first) + size.astype(np.uint64))
    _, sample, which = np.unique(keys, return_index=True, return_inverse=True)
    same_size = (size == size[sample][which]).all()
    if same_size and (raw == raw[np.repeat(first[sample][which], size) + place]).all():
        return which, sample
    # Two fragments share a hash.
    data, numbers = raw.tobytes(), {}
    which = np.array([numbers.setdefault(data[a : a + n], len(numbers)) for a, n in zip(first.tolist(), size.tolist())])
    return which, np.unique(which, return_index=True)[1]


def decode(p: BytePairs, ids: np.ndarray, counts: np.ndarray) -> list[str]:
    """The text of each list of ids; bytes that are no UTF-8 become U+FFFD."""
    if len(ids) and not (0 <= ids.min() and ids.max() < p.width):
        raise ValueError("no such id")
    sizes = p.out_starts[ids + 1] - p.out_starts[ids]
    flat = p.out_bytes[_ragged(p.out_starts[ids], sizes)].tobytes()
    ends = np.concatenate([[0], np.cumsum(sizes)])[np.cumsum(counts)].tolist()
    return [flat[a:b].decode("utf-8", "replace") for a, b in zip([0, *ends], ends)]


def encode_texts(df: DataFrame, model: str = MODEL, *more: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row ``doc_id``, the columns ``more``, ``ids``, ``n_tokens`` and ``decoded``, the text of the ids.

    Null texts have null ids, no tokens and a null text; empty ones none. Rows that repeat an id each get a row.
    """
    shared = df.sparkSession.sparkContext.broadcast(load(model))
    rows = T.inputs(df, id_col, text_col, *more)
    extra = [f for f in rows.schema.fields if f.name not in ("doc_id", "text")]

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        p = shared.value
        given = batch.column("text").to_pylist()
        missing = np.array([t is None for t in given], bool)
        cut = [list(parts(t or "")) for t in given]
        found = []
        group: list[str] = []
        size = 0
        for part in (x for c in cut for x in c):
            group.append(part)
            size += len(part)
            if size >= PART:
                found.append(encode(p, group))
                group, size = [], 0
        if group:
            found.append(encode(p, group))
        ids = np.concatenate([f[0] for f in found])
        by_part = np.concatenate([f[1] for f in found])
        per_text = np.array([len(c) for c in cut])
        counts = T.sums_by_row(by_part, np.cumsum(per_text) - per_text, len(by_part))
        offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids.astype(np.int32)), mask=pa.array(missing))
        back = pa.array([None if g is None else t for g, t in zip(given, decode(p, ids, counts))], pa.string())
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), *(batch.column(f.name) for f in extra), lists, pa.array(counts), back],
            names=["doc_id", *(f.name for f in extra), "ids", "n_tokens", "decoded"],
        )

    kinds = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in extra)
    return T.map_runs(rows, f"doc_id bigint, {kinds}ids array<int>, n_tokens bigint, decoded string", run)


def decode_ids(df: DataFrame, model: str = MODEL, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """Per row ``doc_id`` and ``text`` (null for null ids). An id the model lacks is an error."""
    shared = df.sparkSession.sparkContext.broadcast(load(model))
    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(ids_col).cast("array<int>").alias("ids"))

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                ids = batch.column("ids")[i].values
                text = None
                if ids is not None:
                    flat = ids.to_numpy(zero_copy_only=False).astype(np.int64)
                    text = decode(shared.value, flat, np.array([len(flat)]))[0]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(i, 1), pa.array([text], pa.string())], names=["doc_id", "text"])

    T.ship(df.sparkSession)
    return rows.mapInArrow(run, "doc_id bigint, text string")
