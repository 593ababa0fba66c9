"""SentencePiece encoding and decoding by batched Viterbi.

Texts are cut into units that no piece crosses; the different units of a run of texts advance together,
one character at a time: units that still have an i-th character probe the hashes of their substrings
ending there in the sorted keys of all pieces, and the best one is stored as backpointer.

Unigram models take the maximum of the summed piece scores. Byte-pair models merge by rank, which is no
sum of scores. There a segmentation is the model's own exactly if each two neighbours, joined and
merged again, stay those two, so the score of a piece after another is 0 if they do and minus infinity if
not; each prefix has one segmentation of score 0.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mysem.llm import texts as T

SPACE = "▁"
MODEL = "/opt/tokenizers/piece_bpe_32k.model"
# The model is broadcast.
MAX_MODEL_BYTES = 64 << 20
# Longer units are cut further, between characters that no piece holds side by side; what is still longer goes one by one.
LONG = 64
_FILTER = 1 << 21
_PAIRS_HELD = 1 << 21


@dataclass
class Pieces:
    """A model as arrays. Pieces are numbered by place in ``strings``; ``ids`` are the model's own."""

    bpe: bool
    strings: list[str]
    ids: np.ndarray
    scores: np.ndarray
    keys: np.ndarray
    numbers: np.ndarray
    near: np.ndarray
    lengths: np.ndarray
    joins: np.ndarray
    bigrams: frozenset[str]
    spaces_lead: bool
    byte_ids: np.ndarray
    unknown: int
    prefix: bool
    out_bytes: np.ndarray
    out_starts: np.ndarray
    rank: dict[str, float] = field(repr=False)
    known: dict[int, bool] = field(default_factory=dict, repr=False)
    held: list[np.ndarray] = field(default_factory=list, repr=False)

    def merge(self, text: str) -> list[str]:
        """The byte-pair segmentation by merging the best-ranked neighbours, leftmost first."""
        parts = list(text)
        while len(parts) > 1:
            ranks = [self.rank.get(a + b, np.inf) for a, b in zip(parts, parts[1:])]
            best = min(ranks)
            if best == np.inf:
                break
            at = ranks.index(best)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def stays(self, left: int, right: int) -> bool:
        """Whether two pieces side by side are their own segmentation."""
        a, b = self.strings[left], self.strings[right]
        return self.merge(a + b) == [a, b]

    def all_stay(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """``stays`` of many pairs; answers are kept."""
        keys = left * len(self.strings) + right
        if not self.held:
            self.held[:] = [np.zeros(0, np.int64), np.zeros(0, bool)]
        pairs, answers = self.held
        at = np.minimum(np.searchsorted(pairs, keys), max(len(pairs) - 1, 0))
        hit = pairs[at] == keys if len(pairs) else np.zeros(len(keys), bool)
        out = np.zeros(len(keys), bool)
        out[hit] = answers[at[hit]]
        if not hit.all():
            rest, where = np.unique(keys[~hit], return_inverse=True)
            found = []
            for key in rest.tolist():
                ok = self.known.get(key)
                if ok is None:
                    ok = self.known[key] = self.stays(*divmod(key, len(self.strings)))
                found.append(ok)
            out[~hit] = np.array(found, bool)[where]
            if len(self.known) > max(4096, len(pairs) // 4):
                merged = np.concatenate([pairs, np.fromiter(self.known, np.int64, len(self.known))])
                order = np.argsort(merged)
                merged_ok = np.concatenate([answers, np.fromiter(self.known.values(), bool, len(self.known))])[order]
                self.held[:] = [merged[order], merged_ok] if len(merged) < _PAIRS_HELD else []
                self.known.clear()
        return out


def _hashes(strings: list[str]) -> np.ndarray:
    codes, starts = T.code_points(strings)
    mask = np.ones(len(codes), bool)
    mask[np.append(starts[1:], len(codes)) - 1] = False
    return T.words(codes, mask)[2]


@lru_cache(maxsize=4)
def load(path: str = MODEL) -> Pieces:
    """Read a model file. Models that rewrite characters or white space are an error."""
    from sentencepiece import sentencepiece_model_pb2 as proto

    with open(path, "rb") as file:
        data = file.read(MAX_MODEL_BYTES + 1)
    if len(data) > MAX_MODEL_BYTES:
        raise ValueError(f"{path} is larger than {MAX_MODEL_BYTES} bytes")
    model = proto.ModelProto()
    model.ParseFromString(data)
    rules, kind = model.normalizer_spec, model.trainer_spec.model_type
    if rules.precompiled_charsmap or rules.remove_extra_whitespaces or not rules.escape_whitespaces:
        raise ValueError("only models that leave texts as they are")
    if kind not in (1, 2):
        raise ValueError("only unigram and byte-pair models")
    bpe = kind == 2
    rows = [(i, p.piece, p.score, p.type) for i, p in enumerate(model.pieces)]
    normal = [(i, s, score) for i, s, score, t in rows if t == 1]
    unknown = next(i for i, _, _, t in rows if t == 2)
    byte_ids = np.full(256, -1, np.int64)
    for i, s, _, t in rows:
        if t == 6:
            byte_ids[int(s[3:5], 16)] = i
    rank = {s: -score for _, s, score in normal if len(s) > 1} if bpe else {}
    # Characters of longer pieces that are no piece themselves take part in merges; they have no id.
    single = {s for _, s, _ in normal if len(s) == 1}
    worst = min((score for _, _, score in normal), default=0.0) - 10
    normal += [(-1, c, worst) for c in sorted({c for _, s, _ in normal if len(s) > 1 for c in s} - single)]
    strings = [s for _, s, _ in normal]
    joins = np.zeros(0x110000, bool)
    joins[[ord(c) for s in strings if len(s) > 1 for c in s]] = True
    hashes = _hashes(strings)
    made = Pieces(
        bpe, strings, np.array([i for i, _, _ in normal]), np.array([x for _, _, x in normal]), hashes, hashes, hashes,
        np.array([len(s) for s in strings]), joins, frozenset(s[j : j + 2] for s in strings for j in range(len(s) - 1)),
        not any(SPACE in s[1:] and s.strip(SPACE) for s in strings), byte_ids, unknown, rules.add_dummy_prefix, hashes, hashes, rank,
    )
    usable = np.array([not bpe or len(s) == 1 or made.merge(s) == [s] for s in strings], bool)
    order = np.argsort(hashes[usable], kind="stable")
    made.numbers = np.flatnonzero(usable)[order]
    made.keys = hashes[made.numbers]
    if len(made.keys) and not (np.diff(made.keys.view(np.uint64)) > 0).all():
        raise ValueError("two pieces have the same hash")
    made.near = np.zeros(_FILTER, bool)
    made.near[made.keys & np.uint64(_FILTER - 1)] = True
    texts = [b""] * len(rows)
    for i, s, _, t in rows:
        texts[i] = bytes([int(s[3:5], 16)]) if t == 6 else s.replace(SPACE, " ").encode() if t in (1, 4) else " ⁇ ".encode() if t == 2 else b""
    made.out_bytes = np.frombuffer(b"".join(texts), np.uint8)
    made.out_starts = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    return made


def _ragged(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Indices of the ranges ``starts[i]`` to ``starts[i] + counts[i]``, one after the other."""
    ends = np.cumsum(counts)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - counts, counts) + np.repeat(starts, counts)


def _advance(p: Pieces, codes: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Piece numbers of units of at most ``LONG`` characters, sorted by length from long to short: all, one after the other, and how many each."""
    n_units, width = len(starts), int(lengths[0])
    values = np.zeros((width, n_units), np.uint64)
    for i in range(width):
        n = np.searchsorted(-lengths, -i)
        values[i, :n] = T.mixed(codes[starts[:n] + i] + np.uint32(1))
    score = np.full((width + 1, n_units), -np.inf)
    score[0] = 0
    back = np.full((width + 1, n_units), -1, np.int64)
    longest = int(p.lengths.max())
    base, few = T.powers(2)[1], np.uint64(_FILTER - 1)
    for i in range(1, width + 1):
        n = int(np.searchsorted(-lengths, -i, side="right"))
        hashed = np.zeros(n, np.uint64)
        for size in range(1, min(i, longest) + 1):
            hashed = values[i - size, :n] + base * hashed
            keys = T.mixed(hashed + np.uint64(size))
            rows = np.flatnonzero(p.near[keys & few])
            at = np.minimum(np.searchsorted(p.keys, keys[rows]), len(p.keys) - 1)
            hit = p.keys[at] == keys[rows]
            rows, piece = rows[hit], p.numbers[at[hit]]
            if not len(rows):
                continue
            if p.bpe:
                before = back[i - size, rows]
                ok = np.full(len(rows), i == size)
                inner = np.flatnonzero(before >= 0)
                ok[inner] = p.all_stay(before[inner], piece[inner])
                gain = np.where(ok, 0.0, -np.inf)
            else:
                gain = score[i - size, rows] + p.scores[piece]
            better = gain > score[i, rows]
            score[i, rows[better]] = gain[better]
            back[i, rows[better]] = piece[better]
    at, which = lengths.copy(), np.arange(n_units)
    found, owner = [], []
    while len(which):
        piece = back[at[which], which]
        found.append(piece)
        owner.append(which)
        at[which] -= p.lengths[piece]
        which = which[at[which] > 0]
    found, owner = np.concatenate(found)[::-1], np.concatenate(owner)[::-1]
    order = np.argsort(owner, kind="stable")
    return found[order], np.bincount(owner, minlength=n_units)


def _one_by_one(p: Pieces, unit: str) -> list[int]:
    """The same for a long unit."""
    longest, index = int(p.lengths.max()), _index(p)
    score, back = [0.0], [-1]
    for i in range(1, len(unit) + 1):
        best, piece_there = -np.inf, -1
        for size in range(1, min(i, longest) + 1):
            piece = index.get(unit[i - size : i])
            if piece is None:
                continue
            if p.bpe:
                gain = 0.0 if i == size or (back[i - size] >= 0 and bool(p.all_stay(np.array([back[i - size]]), np.array([piece]))[0])) else -np.inf
            else:
                gain = score[i - size] + p.scores[piece]
            if gain > best:
                best, piece_there = gain, piece
        score.append(best)
        back.append(piece_there)
    out, i = [], len(unit)
    while i:
        out.append(back[i])
        i -= len(p.strings[back[i]])
    return out[::-1]


_indexes: dict[int, dict[str, int]] = {}


def _index(p: Pieces) -> dict[str, int]:
    if id(p) not in _indexes:
        _indexes[id(p)] = {p.strings[i]: i for i in p.numbers.tolist()}
    return _indexes[id(p)]


def _unknown_ids(p: Pieces, char: str) -> list[int]:
    return p.byte_ids[list(char.encode("utf-8", "replace"))].tolist() if p.byte_ids[0] >= 0 else [p.unknown]


def encode(p: Pieces, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts, one after the other, and how many each."""
    lead = SPACE if p.prefix else ""
    codes, starts = T.code_points([lead + t.replace(" ", SPACE) if t else "" for t in texts])
    ends = np.append(starts[1:], len(codes)) - 1
    inside = np.ones(len(codes), bool)
    inside[ends] = False
    joins = p.joins[codes] & inside
    begin = np.ones(len(codes), bool)
    begin[1:] = ~(joins[1:] & joins[:-1])
    space = codes == ord(SPACE)
    if p.spaces_lead:
        begin[1:] |= space[1:] & ~space[:-1]
    first = np.flatnonzero(begin)
    size = np.diff(np.append(first, len(codes)))
    cuts = []
    for s, n in zip(first[size > LONG].tolist(), size[size > LONG].tolist()):
        unit = codes[s : s + n].tobytes().decode("utf-32-le", "surrogatepass")
        cuts += [s + j + 1 for j in range(n - 1) if unit[j : j + 2] not in p.bigrams]
    if cuts:
        begin[cuts] = True
        first = np.flatnonzero(begin)
        size = np.diff(np.append(first, len(codes)))
    real = inside[first]
    first, size = first[real], size[real]
    if not len(first):
        return np.zeros(0, np.int64), np.zeros(len(texts), np.int64)
    place = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
    values = T.mixed(codes[inside] + np.uint32(1)) * T.powers(int(size.max()))[place]
    keys = T.mixed(np.add.reduceat(values, np.cumsum(size) - size) + size.astype(np.uint64))
    _, sample, which = np.unique(keys, return_index=True, return_inverse=True)
    start, length = first[sample], size[sample]

    n_ids = np.zeros(len(sample), np.int64)
    parts: list[np.ndarray] = []
    owners: list[np.ndarray] = []
    # Units of one character that is no piece, or that no longer piece holds.
    at = np.minimum(np.searchsorted(p.keys, keys[sample]), len(p.keys) - 1)
    whole = (p.keys[at] == keys[sample]) & (length == 1)
    parts.append(p.ids[p.numbers[at[whole]]])
    owners.append(np.flatnonzero(whole))
    lone = (length == 1) & ~whole & ~joins[start]
    for unit in np.flatnonzero(lone).tolist():
        ids = _unknown_ids(p, chr(codes[start[unit]]))
        parts.append(np.array(ids))
        owners.append(np.full(len(ids), unit))
    rest = np.flatnonzero(~whole & ~lone & (length <= LONG))
    if len(rest):
        rest = rest[np.argsort(-length[rest], kind="stable")]
        pieces, counts = _advance(p, codes, start[rest], length[rest])
        parts.append(pieces + (1 << 40))
        owners.append(np.repeat(rest, counts))
    for unit in np.flatnonzero(length > LONG).tolist():
        text = codes[start[unit] : start[unit] + length[unit]].tobytes().decode("utf-32-le", "surrogatepass")
        pieces = np.array(_one_by_one(p, text))
        parts.append(pieces + (1 << 40))
        owners.append(np.full(len(pieces), unit))
    flat, owner = np.concatenate(parts), np.concatenate(owners)
    order = np.argsort(owner, kind="stable")
    flat, owner = flat[order], owner[order]
    is_piece = flat >= 1 << 40
    flat[is_piece] = np.where(p.ids[flat[is_piece] - (1 << 40)] >= 0, p.ids[flat[is_piece] - (1 << 40)], -1 - (flat[is_piece] - (1 << 40)))
    for at in np.flatnonzero(flat < 0)[::-1].tolist():
        ids = _unknown_ids(p, p.strings[-1 - int(flat[at])])
        flat = np.concatenate([flat[:at], ids, flat[at + 1 :]])
        owner = np.concatenate([owner[:at], np.full(len(ids), owner[at]), owner[at + 1 :]])
    n_ids = np.bincount(owner, minlength=len(sample))
    where = np.cumsum(n_ids) - n_ids
    per_unit = n_ids[which]
    ids = flat[_ragged(where[which], per_unit)]
    begins = np.searchsorted(first, starts)
    return ids, T.sums_by_row(per_unit, begins, len(first))


def decode(p: Pieces, ids: np.ndarray, counts: np.ndarray) -> list[bytes]:
    """The UTF-8 bytes of each text."""
    if len(ids) and not (0 <= ids.min() and ids.max() < len(p.out_starts) - 1):
        raise ValueError("no such id")
    sizes = p.out_starts[ids + 1] - p.out_starts[ids]
    flat = p.out_bytes[_ragged(p.out_starts[ids], sizes)].tobytes()
    starts = np.cumsum(counts) - counts
    ends = np.cumsum(T.sums_by_row(sizes, starts, len(ids))).tolist()
    out, at = [], 0
    for end in ends:
        piece = flat[at:end]
        out.append(piece[1:] if p.prefix and piece[:1] == b" " else piece)
        at = end
    return out


def encode_texts(df: DataFrame, model: str = MODEL, *more: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row ``doc_id``, the columns ``more``, ``ids`` (null for a null text, none for an empty one), ``n_tokens`` and ``restored``.

    ``restored``: decoding gives the text back (U+2581 counts as the space it stands for); null for a null text.
    Rows that repeat an id each get a row.
    """
    shared = df.sparkSession.sparkContext.broadcast(load(model))
    rows = T.inputs(df, id_col, text_col, *more)
    extra = [f for f in rows.schema.fields if f.name not in ("doc_id", "text")]

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        p = shared.value
        given = batch.column("text").to_pylist()
        texts = [t or "" for t in given]
        ids, counts = encode(p, texts)
        back = decode(p, ids, counts)
        missing = np.array([t is None for t in given], bool)
        offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids.astype(np.int32)), mask=pa.array(missing))
        same = [None if g is None else t.replace(SPACE, " ").encode("utf-8", "replace") == b for g, t, b in zip(given, texts, back)]
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), *(batch.column(f.name) for f in extra), lists, pa.array(counts), pa.array(same, pa.bool_())],
            names=["doc_id", *(f.name for f in extra), "ids", "n_tokens", "restored"],
        )

    kinds = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in extra)
    return T.map_runs(rows, f"doc_id bigint, {kinds}ids array<int>, n_tokens bigint, restored boolean", run)


def decode_ids(df: DataFrame, model: str = MODEL, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """Per row ``doc_id`` and ``text`` (null for null ids). Bytes that are no UTF-8 become U+FFFD; an id the model lacks is an error."""
    shared = df.sparkSession.sparkContext.broadcast(load(model))
    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(ids_col).cast("array<int>").alias("ids"))

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                ids = batch.column("ids")[i].values
                text = None
                if ids is not None:
                    flat = ids.to_numpy(zero_copy_only=False).astype(np.int64)
                    text = decode(shared.value, flat, np.array([len(flat)]))[0].decode("utf-8", "replace")
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(i, 1), pa.array([text], pa.string())], names=["doc_id", "text"])

    T.ship(df.sparkSession)
    return rows.mapInArrow(run, "doc_id bigint, text string")
