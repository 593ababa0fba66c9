"""Secrets in texts: fixed formats, and formats inferred from the credentials that have them.

The credentials the formats find label their kind. For each kind a prefix tree of a bounded sample of
them is folded into a probabilistic automaton: states whose next characters and endings differ no more
than chance allows (Hoeffding's bound) are merged. Every other token of the texts over the credentials' characters is scored by its
likelihood under each automaton against that of ordinary tokens, an automaton whose states are the last two classes
of characters and whose counts are those of all tokens of all rows. What fits as well as the labelled ones, and so much better than ordinary tokens
that their number is outweighed, is reported too.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mysem.llm import texts as T
from mysem.session import written

# The kinds and their formats.
KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
LEAST = {"assign": 6, "access": 20, "hex": 24}
HINTS = ("passw", "secret", "token", "api")

# Classes of the characters of credentials: digits, hex letters, other small letters, capitals, and each symbol; all others end a token.
ALPHABET = "9fzA+/_.=-"
# Candidates: tokens of at least as many characters as the shortest labelled credential may have.
TOKEN_LENGTH = min(LEAST.values())
# Credentials an automaton is fitted on, and the least for which there is one.
MAX_SAMPLE = 600
MIN_SAMPLE = 20
# Chance of keeping two equal states apart.
MERGE_RISK = 0.05
# A reported candidate is at least as likely per character as all but this share of the labelled credentials of its kind.
TAIL = 0.01
# How much likelier than an ordinary token, as a logarithm, after allowing for how many more of these there are.
MARGIN = 1.0


def classes(text: str) -> str:
    """Characters as classes: digits, hex letters, other small letters, capitals, each symbol itself."""
    return "".join("9" if c.isdigit() else "f" if c in "abcdef" else "z" if c.islower() else "A" if c.isupper() else c for c in text)


class Automaton:
    """A probabilistic automaton: per state the counts of next classes and of endings."""

    def __init__(self, words: Counter[str]):
        self.next: list[dict[str, int]] = [{}]
        self.count: list[Counter[str]] = [Counter()]
        self.ends: list[int] = [0]
        for word, n in sorted(words.items()):
            state = 0
            for c in word:
                self.count[state][c] += n
                if c not in self.next[state]:
                    self.next[state][c] = len(self.next)
                    self.next.append({})
                    self.count.append(Counter())
                    self.ends.append(0)
                state = self.next[state][c]
            self.ends[state] += n
        self.alphabet = sorted({c for word in words for c in word})
        self._fold()

    def total(self, state: int) -> int:
        return self.ends[state] + sum(self.count[state].values())

    def _alike(self, a: int, b: int) -> bool:
        """Whether two states, and all that follows them, differ by no more than chance."""
        todo = [(a, b)]
        while todo:
            a, b = todo.pop()
            n, m = self.total(a), self.total(b)
            if not n or not m:
                continue
            bound = math.sqrt(0.5 * math.log(2 / MERGE_RISK)) * (1 / math.sqrt(n) + 1 / math.sqrt(m))
            if abs(self.ends[a] / n - self.ends[b] / m) > bound:
                return False
            for c in self.count[a].keys() | self.count[b].keys():
                if abs(self.count[a][c] / n - self.count[b][c] / m) > bound:
                    return False
                if c in self.next[a] and c in self.next[b]:
                    todo.append((self.next[a][c], self.next[b][c]))
        return True

    def _merge(self, parent: int, symbol: str, into: int, state: int) -> None:
        """Let ``parent`` lead to ``into`` instead of ``state``, whose tree is folded in."""
        self.next[parent][symbol] = into
        todo = [(into, state)]
        while todo:
            a, b = todo.pop()
            self.ends[a] += self.ends[b]
            for c, n in self.count[b].items():
                self.count[a][c] += n
                child = self.next[b].get(c)
                if child is None:
                    continue
                if c in self.next[a]:
                    todo.append((self.next[a][c], child))
                else:
                    self.next[a][c] = child

    def _fold(self) -> None:
        """Settle states breadth first: merge each with the first settled one it is like, else settle it."""
        settled = [0]
        queue = [(0, c) for c in sorted(self.next[0])]
        while queue:
            parent, symbol = queue.pop(0)
            state = self.next[parent][symbol]
            if state in settled:
                continue
            for other in settled:
                if self._alike(other, state):
                    self._merge(parent, symbol, other, state)
                    queue = [(s, c) for s in settled for c in sorted(self.next[s]) if self.next[s][c] not in settled]
                    break
            else:
                settled.append(state)
                queue += [(state, c) for c in sorted(self.next[state])]

    def table(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per state and class the logarithm of its probability and the next state, and per state that of an ending; unseen classes are unlikely and change no state."""
        n, size = len(self.next), len(ALPHABET) + 1
        totals = np.array([self.total(s) for s in range(n)], float) + 0.5 * size
        logs = np.array([[self.count[s][c] + 0.5 for c in ALPHABET] for s in range(n)])
        after = np.array([[self.next[s].get(c, s) for c in ALPHABET] for s in range(n)])
        return np.log(logs / totals[:, None]), after, np.log((np.array(self.ends) + 0.5) / totals)


def ordinary(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The same of ordinary tokens. States are the last two classes (one more class stands for the beginning); ``counts[state, class]``, the last class for endings."""
    k = len(ALPHABET)
    logs = np.log((counts + 0.5) / (counts.sum(axis=1, keepdims=True) + 0.5 * (k + 1)))
    state = np.arange((k + 1) ** 2)
    return logs[:, :k], (state % (k + 1))[:, None] * (k + 1) + np.arange(k)[None, :], logs[:, k]


def class_numbers(codes: np.ndarray) -> np.ndarray:
    """The class of each code point, by place in ``ALPHABET``; -1 for characters of no token."""
    out = np.full(len(codes), -1, np.int64)
    for low, high, c in (("0", "9", "9"), ("a", "f", "f"), ("g", "z", "z"), ("A", "Z", "A"), *((c, c, c) for c in ALPHABET[4:])):
        out[(codes >= ord(low)) & (codes <= ord(high))] = ALPHABET.index(c)
    return out


def likelihoods(table: tuple[np.ndarray, np.ndarray, np.ndarray], begin: int, kinds: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Log-likelihood of tokens (``kinds`` from ``starts``), sorted by length from long to short, all advancing together."""
    logs, after, ends = table
    state, total = np.full(len(starts), begin), np.zeros(len(starts))
    for i in range(int(lengths[0]) if len(lengths) else 0):
        n = int(np.searchsorted(-lengths, -i))
        c = kinds[starts[:n] + i]
        total[:n] += logs[state[:n], c]
        state[:n] = after[state[:n], c]
    return total + ends[state]


def base_spans(text: str) -> list[tuple[int, int, int, str]]:
    """Start, end, number of the kind and credential of the fixed formats, leftmost and not overlapping within a kind."""
    out = []
    low = text.lower()
    if any(hint in low for hint in HINTS) or "K" in text or "ſ" in text:
        out += [(m.start(), m.end(), 0, m.group(2)) for m in ASSIGN.finditer(text) if len(m.group(2)) >= LEAST["assign"]]
    if "AKIA" in text:
        out += [(m.start(), m.end(), 1, m.group()) for m in ACCESS.finditer(text) if len(m.group()) >= LEAST["access"]]
    return out


def found_in(texts: list[str]) -> tuple[list[list[tuple[int, int, int, str]]], np.ndarray, tuple[np.ndarray, ...]]:
    """Base spans of each text, the classes of all characters, and the other tokens: their starts among all characters and in their text, lengths and texts."""
    codes, starts = T.code_points(texts)
    found = [base_spans(t) for t in texts]
    kinds = class_numbers(codes)
    at, size, _ = _runs((kinds >= 0) & (kinds < 2))
    for s, n in zip(at[size >= LEAST["hex"]].tolist(), size[size >= LEAST["hex"]].tolist()):
        i = int(np.searchsorted(starts, s, "right")) - 1
        first = s - int(starts[i])
        found[i].append((first, first + n, 2, texts[i][first : first + n]))
    taken = np.zeros(len(codes) + 1, np.int64)
    for first, some in zip(starts.tolist(), found):
        for a, b, _, _ in some:
            taken[first + a] += 1
            taken[first + b] -= 1
    taken = np.concatenate([[0], np.cumsum(np.cumsum(taken[:-1]) > 0)])
    at, size, ends = _runs(kinds >= 0)
    free = (size >= TOKEN_LENGTH) & (taken[ends] == taken[at])
    at, size = at[free], size[free]
    owner = np.searchsorted(starts, at, "right") - 1
    return [sorted(s) for s in found], kinds, (at, at - starts[owner], size, owner)


def counted(kinds: np.ndarray, at: np.ndarray, size: np.ndarray) -> np.ndarray:
    """How often each class, or the end, follows each two classes in the tokens."""
    k = len(ALPHABET)
    total = int(size.sum())
    place = np.arange(total) - np.repeat(np.cumsum(size) - size, size)
    flat = kinds[np.repeat(at, size) + place]
    one = np.where(place >= 1, np.concatenate([[k], flat[:-1]])[:total], k)
    two = np.where(place >= 2, np.concatenate([[k, k], flat[:-2]])[:total], k)
    last = np.cumsum(size) - 1
    into = np.concatenate([(two * (k + 1) + one) * (k + 1) + flat, (one[last] * (k + 1) + flat[last]) * (k + 1) + k])
    return np.bincount(into, minlength=(k + 1) ** 3)


def _runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    change = np.diff(np.concatenate([[0], mask, [0]]).astype(np.int8))
    first, end = np.flatnonzero(change == 1), np.flatnonzero(change == -1)
    return first, end - first, end


def infer(labelled: dict[str, list[str]], numbers: dict[str, int], counts: np.ndarray) -> dict:
    """Automata of the kinds with at least ``MIN_SAMPLE`` different credentials, the least score per step and the least advantage of a hit, and that of ordinary tokens.

    Every fifth credential sets the least score only. ``numbers``: credentials of each kind in all rows; ``counts``: of all ordinary tokens.
    """
    k = len(ALPHABET)
    counts = counts.reshape((k + 1) ** 2, k + 1).astype(float)
    models: dict = {"ordinary": ordinary(counts)}
    n_tokens = counts[:, k].sum()
    for kind, words in labelled.items():
        words = sorted(set(words))
        if len(words) < MIN_SAMPLE:
            continue
        table = Automaton(Counter(classes(w) for i, w in enumerate(words) if i % 5)).table()
        scores = sorted(scored([w for i, w in enumerate(words) if i % 5 == 0], table, 0))
        models[kind] = (table, max(scores[int(TAIL * len(scores))], -10.0), MARGIN + max(0.0, float(np.log((n_tokens + 1) / numbers[kind]))))
    return models


def scored(words: list[str], table: tuple[np.ndarray, np.ndarray, np.ndarray], begin: int) -> list[float]:
    """Mean log-likelihood per step of each word and its end."""
    codes, starts = T.code_points(words)
    lengths = np.array([len(w) for w in words])
    order = np.argsort(-lengths, kind="stable")
    out = np.zeros(len(words))
    out[order] = likelihoods(table, begin, class_numbers(codes), starts[order], lengths[order]) / (lengths[order] + 1)
    return out.tolist()


def classify(kinds: np.ndarray, at: np.ndarray, size: np.ndarray, models: dict) -> np.ndarray:
    """Per token the number of the kind whose format fits it best, if it fits as well as its credentials and clearly better than ordinary tokens; else -1."""
    best, out = np.full(len(at), -np.inf), np.full(len(at), -1, np.int64)
    if len(models) == 1 or not len(at):
        return out
    order = np.argsort(-size, kind="stable")
    starts, lengths = at[order], size[order]
    k = len(ALPHABET)
    rest = likelihoods(models["ordinary"], k * (k + 1) + k, kinds, starts, lengths)
    for number, name in enumerate(KINDS):
        if name in models:
            table, least, advantage = models[name]
            total = likelihoods(table, 0, kinds, starts, lengths)
            mean = total / (lengths + 1)
            hit = (mean >= least) & (total > rest + advantage) & (mean > best)
            best[hit], out[hit] = mean[hit], number
    found = np.full(len(at), -1, np.int64)
    found[order] = out
    return found


def scan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", most: int = MAX_SAMPLE) -> DataFrame:
    """Per row ``doc_id``, counts of the fixed formats, ``base_sha256``, ``spans`` and ``n_found`` (spans beyond the fixed formats).

    Spans are ``kind:start:end`` in code points, by start, then kind as listed. Null texts count as empty. Rows that repeat an
    id each get a row; a table without rows gives none. Automata are fitted on at most ``most`` different credentials of each kind, picked by hash; a kind with fewer
    than ``MIN_SAMPLE`` has none. Tokens of any length are scored whole.
    """
    rows = T.inputs(df, id_col, text_col)
    states = (len(ALPHABET) + 1) ** 3

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Credentials by kind as they come, and at the end the counts of the task's ordinary tokens."""
        counts = np.zeros(states, np.int64)
        names = ["kind", "value", "step", "n"]
        for batch in batches:
            for first, end in T.run_ranges(batch.column("text")):
                found, kinds, (at, _, size, _) = found_in([t or "" for t in batch.column("text")[first:end].to_pylist()])
                counts += counted(kinds, at, size)
                flat = Counter((k, v) for some in found for _, _, k, v in some)
                if flat:
                    values = [[k for k, _ in flat], [v for _, v in flat], [-1] * len(flat), list(flat.values())]
                    yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(values, (pa.int32(), pa.string(), pa.int32(), pa.int64()))], names=names)
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(used), -1, np.int32)), pa.nulls(len(used), pa.string()), pa.array(used.astype(np.int32)), pa.array(counts[used])], names=names
        )

    T.ship(df.sparkSession)
    learned = written(rows.select("text").mapInArrow(learn, "kind int, value string, step int, n bigint").groupBy("kind", "value", "step").agg(F.sum("n").alias("n")), "secret-counts")
    counts = np.zeros(states, np.int64)
    for r in learned.where("kind < 0").collect():  # one row a step at most
        counts[r.step] = r.n
    numbers = {KINDS[r.kind]: r.n for r in learned.where("kind >= 0").groupBy("kind").agg(F.sum("n").alias("n")).collect()}
    pick = lambda k: learned.where(F.col("kind") == k).select("value").orderBy(F.xxhash64("value"), "value").limit(most)
    labelled = {name: [r.value for r in pick(k).collect()] for k, name in enumerate(KINDS)}
    shared = df.sparkSession.sparkContext.broadcast(infer(labelled, numbers, counts))

    def judge(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [t or "" for t in batch.column("text").to_pylist()]
        found, kinds, (at, place, size, owner) = found_in(texts)
        number = classify(kinds, at, size, shared.value)
        spans = [[(s, k, e) for s, e, k, _ in some] for some in found]
        text = lambda some: ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in sorted(some))
        counts = [[sum(1 for x in some if x[1] == k) for some in spans] for k in range(3)]
        digests = [hashlib.sha256(text(some).encode()).hexdigest() for some in spans]
        n_found = [0] * len(texts)
        for j in np.flatnonzero(number >= 0).tolist():
            spans[owner[j]].append((int(place[j]), int(number[j]), int(place[j] + size[j])))
            n_found[owner[j]] += 1
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), *(pa.array(c, pa.int64()) for c in counts), pa.array(digests, pa.string()), pa.array([text(s) for s in spans], pa.string()), pa.array(n_found, pa.int64())],
            names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_found"],
        )

    return T.map_runs(rows, "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string, n_found bigint", judge)
