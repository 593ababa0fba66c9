"""Conversation repair, periodic runs and byte pairs against brute force and the library."""

import hashlib
import itertools
import os
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from mysem.llm import bytepairs, decontaminate, dialogues, hashed, language, neardup, pii, runs, secrets, toxicity
from mysem.llm import queries as _queries  # noqa: F401
from mysem.llm.registry import QUERIES
from test_llm import LONG, ODD, SF, brute_links, table

sha = lambda t: hashlib.sha256(t.encode()).hexdigest()

# 11


def plain_damage(rows):
    """The damage of the query, row by row; ``rows`` are (conv, turn, role, text)."""
    out = []
    show = lambda v: " " if v is None else str(v)
    for conv, turn, role, text in rows:
        h = zlib.crc32(f"{show(conv)}:{show(turn)}".encode()) % 20
        role, text = show(role), show(text)
        if h == 0:
            continue
        text = "" if h == 1 else re.sub("[.!?]", "", text) if h == 2 else text
        out += [(conv, turn, "user" if h == 4 else role, text)] * (2 if h == 3 else 1)
    return out


def tie(role, text):
    return hashlib.sha256(f"{len(role)} {role}{text}".encode()).hexdigest()


def faults_of(turns):
    seen, out = set(), []
    for role, text in turns:
        bare = re.sub(r"[\x20\x09-\x0D]", "", text)
        out.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def plain_plan(turns, faults):
    """The cheapest plan by trying plans in order of cost, then letters: a search over all edits."""
    import heapq

    queue = [(0, "", 0, ())]
    while queue:
        cost, letters, i, kept = heapq.heappop(queue)
        initials = "".join(r[:1] or "-" for r, _ in kept)
        if i == len(turns) and re.fullmatch("(s?(ua)+)?", initials):
            return cost, letters, kept
        if not re.fullmatch("(s?(ua)*u?)?", initials):
            continue
        for new in ("user", "assistant"):
            heapq.heappush(queue, (cost + 3, letters + "I", i, (*kept, (new, ""))))
        if i < len(turns):
            role, text = turns[i]
            heapq.heappush(queue, (cost + 4, letters + "D", i + 1, kept))
            if faults[i] not in ("blank", "duplicate"):
                late = 3 if faults[i] == "truncated" else 0
                heapq.heappush(queue, (cost + late, letters + "K", i + 1, (*kept, (role, text))))
                for new in ("user", "assistant"):
                    heapq.heappush(queue, (cost + 3 + late, letters + "R", i + 1, (*kept, (new, text))))


def plain_report(rows):
    """conv -> the report's values, for damaged ``rows``."""
    out = {}
    for conv in {r[0] for r in rows}:
        mine = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, tie(r[2], r[3])))
        turns = [(r[2], r[3]) for r in mine]
        faults = faults_of(turns)
        numbers = {r[1] for r in mine} - {None}
        gaps = max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(turns))
        cost, letters, kept = plain_plan(turns, faults)
        text = "\n".join(f"{r}:{t}" for r, t in kept)
        out[conv] = (gaps, *(faults.count(k) for k in ("blank", "duplicate", "truncated")), illegal, cost, letters, sha(text))
    return out


CONV = "conv_id bigint, turn bigint, role string, text string, at string, conv string, kind string, edits string"
COLUMNS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def conversations(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", "z", "w") for r in rows], CONV)


def report(df):
    return {r.conv_id: tuple(r[c] for c in COLUMNS) for r in df.collect()}


def made_up(n, seed, size=7):
    rng = random.Random(seed)
    rows = []
    for conv in range(n):
        for turn in range(rng.randrange(1, size)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", None, "User", ""])
            text = rng.choice(["Hi.", "Yes!", "Why?", "so", "and then", "", " \t\n", None, " ", "x. ", "wh…"])
            rows.append((conv or None, rng.choice([turn, turn, turn, 2 * turn, None, -turn]), role, text))
    return rows


def test_repairs_are_the_cheapest(spark):
    rows = made_up(400, 11)
    spaced = [tuple(" " if v is None and i > 1 else v for i, v in enumerate(r)) for r in rows]
    assert report(dialogues.audit(conversations(spark, rows))) == plain_report(spaced)


def test_query_over_whole_conversations(spark):
    fn, _ = QUERIES["op11_conversation_repair"]
    given = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    want = plain_report(plain_damage(given))
    nothing = (0, 0, 0, 0, 0, 0, "", sha(""))
    assert report(fn(spark, SF)) == {c: want.get(c, nothing) for c in {r[0] for r in given}}


def test_damage(spark):
    rows = made_up(60, 12)
    got = sorted(map(str, ((r.conv_id, r.turn, r.role, r.text) for r in dialogues.damaged(conversations(spark, rows)).collect())))
    assert got == sorted(map(str, plain_damage(rows)))


def test_giant_conversation_in_blocks(spark, monkeypatch):
    # Workers read the shipped constant, so the stream is driven here, batch by batch.
    rng = random.Random(13)
    turns = [(rng.choice(["user", "assistant", "system"]), f"t{i}" + rng.choice([".", ""])) for i in range(5000)]
    turns = [(r, t) for i, (r, t) in enumerate(turns)]
    monkeypatch.setattr(dialogues, "BLOCK", 64)
    import pandas as pd

    at = lambda i: f"{i + (1 << 63):016X} " + "0" * 64
    faults = faults_of(turns)
    thin = pd.DataFrame({"conv": "=1", "at": [at(i) for i in range(5000)], "initial": [r[0] for r, _ in turns], "fault": faults, "copies": 1})[::-1]
    plans = pd.concat(list(dialogues._plans(thin[i : i + 300] for i in range(0, 5000, 300))))
    assert len(plans) > 70 and plans.edits.map(len).max() <= 64
    rows = pd.DataFrame({"conv": "=1", "at": thin["at"][::-1], "kind": 1, "edits": None, "role": [r for r, _ in turns], "text": [t for _, t in turns]})
    both = pd.concat([plans[["conv", "at", "edits"]].assign(kind=0, role=None, text=None), rows]).sort_values(["conv", "at", "kind"])
    found = pd.concat(list(dialogues._audits(both[i : i + 333] for i in range(0, len(both), 333))))
    assert len(found) == 1
    letters = found.audit[0]
    price = {"K": 0, "D": 4, "I": 3, "R": 3}
    late, i = 0, 0
    for c in letters:
        late += 3 * (c in "KR" and faults[i] == "truncated")
        i += c != "I"
    assert i == 5000 and sum(map(price.get, letters)) + late == plans.cost.sum()
    # The cost by a plain forward program over the four states.
    best = {0: 0}
    relax = lambda b: [b.__setitem__(n, min(b.get(n, 1 << 60), b[s] + 3)) for _ in range(3) for s in list(b) for n in [{0: 2, 1: 2, 2: 3, 3: 2}[s]]]
    relax(best)
    for (role, _), fault in zip(turns, faults):
        new = {}
        for s, c in best.items():
            late = 3 * (fault == "truncated")
            n = {0: 2, 1: 2, 2: 3, 3: 2}[s]
            options = [(s, 4), (n, 3 + late)]
            if role == "system" and s == 0:
                options.append((1, late))
            if role == {2: "user", 3: "assistant"}[n]:
                options.append((n, late))
            for t, w in options:
                new[t] = min(new.get(t, 1 << 60), c + w)
        relax(new)
        best = new
    assert plans.cost.sum() == min(best.get(0, 1 << 60), best.get(3, 1 << 60))


def test_repaired_turns(spark):
    rows = [(1, 0, "system", "Be."), (1, 1, "user", "Hi."), (1, 1, "user", "Hi."), (1, 2, "user", "Well?"), (2, 0, "user", ""), (None, 5, "tool", "x.")]
    got = sorted(map(str, ((r.conv_id, r.place, r.edit, r.role, r.text) for r in dialogues.repaired_turns(conversations(spark, rows)).collect())))
    assert got == sorted(map(str, [(1, 0, "K", "system", "Be."), (1, 1, "K", "user", "Hi."), (1, 2, "R", "assistant", "Well?")]))
    assert dialogues.repaired_turns(conversations(spark, [])).count() == dialogues.audit(conversations(spark, [])).count() == 0


# 12


def plain_runs(words, least=6, exponent=4):
    n, out = len(words), set()
    for q in range(1, n):
        for i in range(n - q):
            if i and words[i - 1] == words[i - 1 + q]:
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            size, part = j - i + q, words[i : j + q]
            smaller = any(all(part[x] == part[x + d] for x in range(size - d)) for d in range(1, q))
            if j > i and size >= max(least, exponent * q) and not smaller:
                out.add((i, size, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def test_lyndon_lengths():
    rng = random.Random(21)
    for _ in range(1500):
        w = [rng.randrange(rng.choice([1, 2, 3, 5])) for _ in range(rng.randrange(14))]
        lyndon = lambda s: all(s < s[k:] for k in range(1, len(s)))
        assert runs.lyndon_lengths(w) == [max(j - i for j in range(i + 1, len(w) + 1) if lyndon(w[i:j])) for i in range(len(w))]


def test_runs_of_made_up_words():
    rng = random.Random(22)
    n_found = 0
    for _ in range(800):
        n, k, w = rng.randrange(50), rng.choice([1, 2, 3]), []
        while len(w) < n:
            root = [b"%d" % rng.randrange(k + 1) for _ in range(rng.randrange(1, 6))]
            w += root * rng.randrange(1, 7) if rng.random() < 0.5 else root[:1]
        for least, exponent in ((6, 4), (2, 3)):
            want = plain_runs(w, least, exponent)
            assert runs.find_runs(w, least, exponent) == want
            n_found += len(want)
    assert n_found > 800


def plain_repeats(doc_id, words):
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def split(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def test_runs_query(spark):
    fn, _ = QUERIES["op12_periodic_runs"]
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}
    got = {r.doc_id: tuple(r)[1:] for r in fn(spark, SF).collect()}
    assert got.keys() == texts.keys()
    n_runs = 0
    for doc_id, text in texts.items():
        words = plain_repeats(doc_id, split(text))
        # Runs of short texts by brute force; of long ones, repeats at each period.
        want = plain_runs(words) if len(words) < 150 else runs_by_repeats(words)
        n_runs += len(want)
        best = min(want, key=lambda r: (-r[1], r[0], r[2])) if want else None
        gone = {i for s, n, q in want for i in range(s + q, s + n)}
        assert got[doc_id] == (
            len(want),
            *(best or (None, None, None)),
            1000 * best[1] // best[2] if best else None,
            sha("".join(f"{s},{n},{q}\n" for s, n, q in want)),
            sha(" ".join(w for i, w in enumerate(words) if i not in gone)),
        )
    assert n_runs > 20


def runs_by_repeats(words):
    """The runs of a long text, period by period, from where words and those a period on are the same."""
    _, codes = np.unique(np.array(words, dtype=object), return_inverse=True)
    n, found = len(codes), []
    for q in range(1, n // 4 + 1):
        same = np.concatenate([[False], codes[:-q] == codes[q:], [False]])
        edges = np.flatnonzero(same[1:] != same[:-1])
        for a, b in zip(edges[::2].tolist(), edges[1::2].tolist()):
            if b - a + q >= max(6, 4 * q) and not any(a >= s and b + q <= s + m and q % p == 0 for s, m, p in found):
                found.append((a, b - a + q, q))
    return sorted(found, key=lambda r: (r[0], r[2]))


def test_runs_of_odd_rows(spark):
    got = sorted(map(str, ((r.doc_id, r.n_words, r.collapsed, len(r.runs)) for r in runs.periodic_runs(table(spark, ODD)).collect())))
    cat = "the cat sat on the mat and saw the dog"
    want = [(1, 0, "", 0), (2, 0, "", 0), (3, 10, cat, 0), (3, 10, cat, 0), (4, 10, cat.replace("the cat", "THE CAT"), 0), (None, 10, cat, 0)]
    want += [(5, 3, "1234 %%% 77", 0), (6, len(LONG.split()), " ".join(LONG.split()[:13]), 1), (7, 1, "é", 0), (None, 0, "", 0)]
    assert got == sorted(map(str, want))
    assert runs.periodic_runs(table(spark, [])).count() == 0
    same = {r.doc_id: r.text for r in runs.with_repeats(table(spark, ODD)).collect()}
    assert {i: split(t) for i, t in same.items()} == {r[0]: plain_repeats(r[0], split(r[1])) if r[0] is not None else split(r[1]) for r in ODD}
    assert runs.find_runs([b"a"] * 50_000) == [(0, 50_000, 1)]
    with pytest.raises(ValueError):
        runs.periodic_runs(table(spark, []), exponent=2)


# 13


@pytest.fixture(scope="module")
def model():
    return bytepairs.load()


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(bytepairs.MODEL)


def test_pairs_of_odd_texts(model, library):
    rng = random.Random(31)
    pool = [*"aaabbb   \n\n\t'''sstrevld 019²½é日本語🙂\x0b\x1c\x1f\x85 　́.!?-_<|>ŉ՘Ɤ\U00010940"]
    pool += ["<|endoftext|>", "'s", "'re", "'ll", " 't", "'ve", "\r\n", "the", " the", "ing", "<|endof"]
    texts = ["".join(rng.choice(pool) for _ in range(rng.randrange(50))) for _ in range(4000)]
    texts += ["", "a" * 3000, "ab" * 900, " " * 2000, "é" * 700, "-" * 777, "x" * 64, "x" * 65, "=-" * 100, "lol" * 40, "퟿"]
    ids, counts = bytepairs.encode(model, texts)
    ends = np.cumsum(counts)
    want = library.encode_batch(texts, add_special_tokens=False)
    assert [ids[e - n : e].tolist() for e, n in zip(ends, counts)] == [w.ids for w in want]
    assert bytepairs.decode(model, ids, counts) == [library.decode(w.ids, skip_special_tokens=False) for w in want]
    broken = [[rng.randrange(50257) for _ in range(rng.randrange(9))] for _ in range(2000)]
    back = bytepairs.decode(model, np.array([i for b in broken for i in b]), np.array([len(b) for b in broken]))
    assert back == [library.decode(b, skip_special_tokens=False) for b in broken]
    for text in texts[:300]:
        cut = list(bytepairs.parts(text, 7))
        assert "".join(cut) == text and bytepairs.encode(model, cut)[0].tolist() == bytepairs.encode(model, [text])[0].tolist()
    with pytest.raises(ValueError):
        bytepairs.decode(model, np.array([50257]), np.array([1]))


def test_forced_boundaries_are_crossed_by_no_token(model):
    edges = set(zip(*[np.flatnonzero(~model.inside) // 256, np.flatnonzero(~model.inside) % 256]))
    tokens = [model.out_bytes[a:b].tolist() for a, b in itertools.pairwise(model.out_starts[:-1].tolist())]
    assert edges and not any(pair in edges for t in tokens for pair in itertools.pairwise(t))


def test_fragments_with_one_hash(model, library, monkeypatch):
    monkeypatch.setattr(bytepairs.T, "mixed", lambda v: (v.astype(np.uint64) % np.uint64(3)))
    raw = np.frombuffer(b"one two three two", np.uint8)
    first, size = np.array([0, 3, 7, 13]), np.array([3, 4, 6, 4])
    which, sample = bytepairs._distinct(raw, first, size)
    assert which[1] == which[3] and len(set(which.tolist())) == 3 and [which[s] for s in sample] == [0, 1, 2]


def test_pairs_query(spark, library):
    fn, _ = QUERIES["op13_byte_pairs"]
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}
    got = {r.doc_id: tuple(r)[1:] for r in fn(spark, SF).collect()}
    assert got.keys() == texts.keys()
    for doc_id, text in texts.items():
        ids = library.encode(text, add_special_tokens=False).ids
        assert got[doc_id] == (len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False)))


def test_pairs_of_odd_rows(spark, library):
    rows = bytepairs.encode_texts(table(spark, ODD), bytepairs.MODEL, F.col("source"))
    got = sorted(map(str, ((r.doc_id, r.source, r.ids, r.n_tokens, r.decoded) for r in rows.collect())))
    want = []
    for doc_id, text, _, source, _ in ODD:
        ids = None if text is None else library.encode(text, add_special_tokens=False).ids
        want.append((doc_id, source, ids, len(ids or []), text))
    assert got == sorted(map(str, want))
    back = bytepairs.decode_ids(bytepairs.encode_texts(table(spark, ODD)))
    assert sorted(map(str, map(tuple, back.collect()))) == sorted(str((r[0], r[1])) for r in ODD)
    assert bytepairs.encode_texts(table(spark, [])).count() == 0


# 8


def test_blocks_agree_whatever_the_splits(spark, monkeypatch):
    fn, _ = QUERIES["op8_decontaminate"]
    want = sorted(map(str, fn(spark, SF).collect()))
    sizes = [len(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    monkeypatch.setattr(decontaminate, "BLOCK_CHARS", sum(sizes) // 3)
    seen, searched = [], decontaminate.search

    def search(*args):
        # The files are split differently for each block.
        seen.append(args)
        spark.conf.set("spark.sql.files.maxPartitionBytes", f"{40 * len(seen)}k")
        return searched(*args)

    monkeypatch.setattr(decontaminate, "search", search)
    try:
        assert sorted(map(str, fn(spark, SF).collect())) == want and len(seen) >= 3
        monkeypatch.setattr(decontaminate, "MAX_TERMS", 0)
        assert sorted(map(str, fn(spark, SF).collect())) == want
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


# 5


def plain_bootstrap(texts, spans):
    """The trusted instances by sets and sums; ``spans`` are (kind, value, left, right, base)."""
    edges = Counter()
    seeds = set()
    for kind, value, left, right, base in spans:
        for side, word in (("left", left), ("right", right)):
            if word:
                edges[(kind, side, word), (kind, value.lower())] += 1
        if base:
            seeds.add((kind, value.lower()))
    occurs = Counter(w for t in texts for w in re.findall(r"[^\W\d_]+", t.lower()))
    trust = {i: 1.0 for _, i in edges if i in seeds}
    while True:
        score = {}
        for pattern in {p for p, _ in edges}:
            beside = {i: n for (p, i), n in edges.items() if p == pattern and i in trust}
            support = sum(trust[i] for i in beside)
            share = min(1, sum(n * trust[i] for i, n in beside.items()) / occurs[pattern[2]]) * support / (support + 1)
            if support >= pii.MIN_SUPPORT and share >= pii.TRUSTED_PATTERN:
                score[pattern] = min(share, 0.999)
        wrong = Counter()
        for p, i in edges:
            if i not in seeds and p in score:
                wrong[i] = wrong.get(i, 1.0) * (1 - score[p])
        now = {i: 1.0 for i in trust if i in seeds} | {i: 1 - w for i, w in wrong.items()}
        change = max((t - trust.get(i, 0) for i, t in now.items()), default=0)
        trust = now
        if change < pii.SETTLED:
            return {i for i, t in trust.items() if t >= pii.TRUSTED_INSTANCE}


def test_bootstrapping_spreads(spark):
    rows = [(i, f"some talk here phone: +49 30 1234{i:03} and more") for i in range(80)]
    rows += [(100 + i, f"other words phone: 030-76543{i:02} rufnummer") for i in range(8)]
    rows += [(200, "nothing 040-1234567 rufnummer"), (201, "phone: 030 7654321 (space)"), (202, '{"phone":"0301234567","x":1}'), (203, "it costs 030-7654329 or so")]
    got = {r.doc_id: r for r in pii.scan(table(spark, [(*r, None, None, None) for r in rows])).collect()}
    assert [got[i].n_found for i in (107, 200, 201, 202, 203)] == [1, 1, 1, 1, 0]


def test_bootstrapping_matches_plain_loops(spark):
    rng = random.Random(51)
    rows = [(i, f"some talk here phone: +49 30 1234{i:03} and more") for i in range(300)]
    for i in range(300, 390):
        word = rng.choice(["phone", "phone", "phone", "rufnummer", "mail", "costs", "bei", "", "ruf"])
        number = rng.choice([f"0{rng.randrange(10**6)} {rng.randrange(10**3)}", f"a{rng.randrange(9)}@b", f"x{rng.randrange(20)}@y.zz", f"+49{rng.randrange(10**9):09}", f"9{rng.randrange(30)}.1.2.3"])
        rows.append((i, f"{rng.choice(['', 'so '])}{word} {number} {rng.choice(['rufnummer', 'ok', '', 'ende'])}"))
    docs = table(spark, [(*r, None, None, None) for r in rows])
    numbered = docs.select("doc_id", "text")
    got = {r.doc_id: r for r in pii.scan(docs).collect()}
    # The same by plain loops over the spans before trust decides.
    searched = [(pii.EMAIL, True), (pii.IP, True), (pii.CARD, True), (pii.PHONE, True), (pii.CANDIDATE, True)]
    wide = numbered.withColumnRenamed("doc_id", "row")
    for kind, (pattern, _) in enumerate(searched):
        wide = pii.hits(wide, "text", pattern, kind, f"h{kind}", F.lit(True))
    every = pii.spans(wide.select("row", F.concat(*[F.col(f"h{k}") for k in range(5)]).alias("hits"))).collect()
    trusted = plain_bootstrap([t for _, t in rows], [(r.kind, r.value, r.left, r.right, r.base) for r in every])
    want = Counter(r.row for r in every if not r.base and (r.kind, r.value.lower()) in trusted)
    assert {i: r.n_found for i, r in got.items() if r.n_found} == dict(want) and len(want) > 1


def test_many_matches_in_one_text(spark):
    texts = ["1234 x " * 60_000, "a1@b.co, " * 40_000, "7" * 400_000, "a" * 400_000 + "1"]
    got = {r.doc_id: r for r in pii.scan(table(spark, [(i, t, None, None, None) for i, t in enumerate(texts)])).collect()}
    assert [got[i].n_email for i in range(4)] == [0, 40_000, 0, 0]
    assert got[1].spans.split(",")[-1] == f"email:{9 * 39_999}:{9 * 39_999 + 7}"


# 6


def plain_log(word, table, begin):
    logs, after, ends = table
    state, total = begin, 0.0
    for c in secrets.classes(word):
        c = secrets.ALPHABET.index(c)
        total, state = total + logs[state, c], after[state, c]
    return total + ends[state]


def test_tokens_score_as_one_by_one():
    rng = random.Random(61)
    words = ["".join(rng.choice("09afgzAZ+/_.=-") for _ in range(rng.randrange(1, 30))) for _ in range(300)] + ["a" * 5000]
    automaton = secrets.Automaton(Counter(secrets.classes(w) for w in words[:200])).table()
    codes, starts = secrets.T.code_points(words)
    counts = secrets.counted(secrets.class_numbers(codes), starts, np.array([len(w) for w in words]))
    seen = Counter()
    for w in words:
        steps = ["^", "^", *secrets.classes(w), "$"]
        seen.update(zip(steps, steps[1:], steps[2:]))
    place = {c: i for i, c in enumerate(secrets.ALPHABET)} | {"^": 10, "$": 10}
    assert {k: n for k, n in enumerate(counts.tolist()) if n} == {(place[a] * 11 + place[b]) * 11 + place[c]: n for (a, b, c), n in seen.items()}
    for table, begin in ((automaton, 0), (secrets.ordinary(counts.reshape(121, 11).astype(float)), 10 * 11 + 10)):
        assert np.allclose(table[0].min(), table[0].min()) and np.isfinite(table[0]).all() and np.isfinite(table[2]).all()
        assert np.allclose(secrets.scored(words, table, begin), [plain_log(w, table, begin) / (len(w) + 1) for w in words])


@pytest.mark.parametrize("kind", ["short", "dotted"])
def test_bare_credentials_of_any_shape(spark, kind):
    rng = random.Random(62)
    pick = lambda chars, n: "".join(rng.choice(chars) for _ in range(n))
    upper, digits = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
    code = {"short": lambda: f"{pick(upper, 4)}-{pick(digits, 6)}", "dotted": lambda: f"ey{pick(upper + digits, 9)}.{pick(digits + upper, 12)}.{pick(upper, 6)}"}[kind]
    words = [pick("abcdefghijklmnopqrstuvwxyz", rng.randrange(2, 11)) for _ in range(3000)]
    prose = lambda: " ".join(rng.choices(words, k=30)) + f" Version-{rng.randrange(9)}.{rng.randrange(90)} on 2024-01-{rng.randrange(10, 30)} at https://www.site.org/{rng.choice(words)}."
    rows = [(i, f"token={code()} {prose()}", None, None, None) for i in range(300)] + [(i, prose(), None, None, None) for i in range(300, 900)]
    rows += [(1000 + i, f"{prose()} {code()} {prose()}", None, None, None) for i in range(20)]
    got = {r.doc_id: r for r in secrets.scan(table(spark, rows)).collect()}
    assert [got[1000 + i].n_found for i in range(20)] == [1] * 20
    assert sum(got[i].n_found for i in range(900)) == 0


def test_very_long_tokens(spark):
    rows = [(1, "A" * 300_000, None, None, None), (2, "a1b2_" * 60_000, None, None, None), (3, "x" * 300_000 + "é", None, None, None)]
    got = {r.doc_id: (r.spans, r.n_found) for r in secrets.scan(table(spark, rows)).collect()}
    assert got == {1: ("", 0), 2: ("", 0), 3: ("", 0)}


# 1, 4 and 7 against plain loops


def words_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)


def test_languages_without_filters(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang").collect()
    held = lambda i: zlib.crc32(str(i).encode()) % 4 == 2

    def grams(text):
        plain = "".join(c if c.isalpha() else " " for c in f" {(text or '').lower()} ")
        plain = re.sub(" +", " ", plain)
        return [plain[i : i + 4] for i in range(len(plain) - 3)] or ([plain] if plain.strip() else [])

    seen = {}
    for r in docs:
        if not held(r.doc_id) and r.lang is not None and r.text is not None:
            seen.setdefault(r.lang, Counter()).update(grams(r.text))
    members = {k: {g for g, n in c.items() if n >= sum(c.values()) * language.MIN_SHARE} for k, c in seen.items()}
    got = {r.doc_id: r for r in language.identify(spark.read.parquet(f"{SF}/documents.parquet")).collect()}
    for r in docs:
        found = grams(r.text)
        shares = {k: sum(g in m for g in found) / max(1, len(found)) for k, m in members.items()}
        best = max(shares.values())
        if not any(c.isalpha() for c in r.text or ""):
            assert got[r.doc_id].lang_pred == "und"
        elif len(found) > 60:
            # Chance hits are taken off on average, so scores differ a little.
            assert shares[got[r.doc_id].lang_pred] > best - 0.02 and abs(got[r.doc_id].score - best) < 0.05


def test_noisy_or_over_sentences(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(80)
    rng = np.random.default_rng(4)
    weights = (rng.normal(size=hashed.SIZE) * 0.7).astype(np.float32)
    weights[-1] = -4.0
    got = {r.doc_id: (r.score, r.n_sentences) for r in toxicity.score(docs, weights).collect()}

    def places(words, salt=np.uint64(0)):
        codes, starts = hashed.T.code_points(words)
        return hashed.places(hashed.T.words(codes, hashed.T.word_mask(codes), 99)[2] ^ salt)

    def heads(words):
        codes, starts = hashed.T.code_points(words)
        return hashed.places(hashed.T.words(codes, hashed.T.word_mask(codes), toxicity.PREFIX)[3] ^ toxicity._PREFIX_SALT)

    for r in docs.collect():
        clean, n = 1.0, 0
        for sentence in re.split(r"[.!?\n]", r.text.lower() if len(r.text.lower()) == len(r.text) else r.text):
            words = words_of(sentence)
            if words:
                total = weights[-1] + sum(weights[places(words)].astype(float)) + sum(weights[heads(words)].astype(float))
                clean, n = clean * (1 - 1 / (1 + np.exp(-total))), n + 1
        assert got[r.doc_id][1] == n and abs(got[r.doc_id][0] - (1 - clean)) < 1e-3


def test_shards_by_plain_ranks(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = docs.select("doc_id", "source", "text", F.xxhash64(F.lit(17), F.col("doc_id").cast("long")).alias("lot")).collect()
    place = lambda s: (s is not None, s or "")
    ranked = []
    for source in {r.source for r in rows}:
        mine = sorted((r for r in rows if r.source == source), key=lambda r: r.lot)
        ranked += [((i + 0.5) / len(mine), place(source), r.lot, r) for i, r in enumerate(mine)]
    want = {}
    for at, (_, _, _, r) in enumerate(sorted(ranked, key=lambda x: x[:3])):
        shard = at * 24 // len(rows)
        data = (r.text or "").encode()
        want[r.doc_id] = (len(data) + 8, zlib.crc32(data), "rows", shard, at - -(-shard * len(rows) // 24), None)
    fn, _ = QUERIES["op7_sharding"]
    assert {r.doc_id: tuple(r)[1:] for r in fn(spark, SF).collect()} == want


# 3, classes alone


def alike_texts(rng, n, words, edits, first):
    """``n`` texts that each differ from one text in some words."""
    base = rng.choices([f"w{first}x{i}" for i in range(500)], k=words)
    out = []
    for i in range(n):
        own = list(base)
        for at in rng.sample(range(words), edits):
            own[at] = f"v{first}x{i}x{at}"
        out.append(" ".join(own))
    return out


def class_rows(rng):
    """Two large groups of alike texts, one so loose that many pairs are linked through others only, chains, texts with a passage in common, and copies."""
    texts = alike_texts(rng, 120, 150, 1, 0) + alike_texts(rng, 90, 200, 3, 1)
    passage = " ".join(rng.choices([f"p{i}" for i in range(99)], k=14))
    texts += [passage + " " + " ".join(rng.choices([f"q{i}" for i in range(400)], k=90)) for _ in range(60)]
    chain = rng.choices([f"c{i}" for i in range(500)], k=160)
    for i in range(60):
        chain[2 * i] = f"d{i}"
        texts.append(" ".join(chain))
    texts += texts[::25]
    rng.shuffle(texts)
    return dict(enumerate(texts))


@pytest.mark.parametrize("rounds", [1, 4])
def test_classes_without_links(spark, monkeypatch, rounds):
    rows = class_rows(random.Random(11))
    monkeypatch.setattr(neardup, "BLOCK", 8)
    monkeypatch.setattr(neardup, "SMALL", 4)
    monkeypatch.setattr(neardup, "ROUNDS", rounds)
    got = {r.doc_id: (r.class_id, r.class_size) for r in neardup.near_duplicate_classes(table(spark, [(i, t, None, None, None) for i, t in rows.items()])).collect()}
    classes = {i: c for i, (c, _) in brute_links(rows).items()}
    sizes = Counter(classes.values())
    assert got == {i: (c, sizes[c]) for i, c in classes.items()}


def test_classes_move_texts_in_proportion(spark, monkeypatch):
    """Texts that are all alike go once to their bucket in each run, the representatives to each block."""
    monkeypatch.setattr(neardup, "BLOCK", 16)
    together, moved = neardup._together, []

    def counting(*args):
        out = together(*args)
        moved.append(out.count())
        return out

    monkeypatch.setattr(neardup, "_together", counting)
    shares = []
    for n in (500, 2000):
        moved.clear()
        rows = dict(enumerate(alike_texts(random.Random(5), n, 150, 1, 2)))
        got = neardup.near_duplicate_classes(table(spark, [(i, t, None, None, None) for i, t in rows.items()])).collect()
        assert {(r.class_id, r.class_size) for r in got} == {(0, n)}
        shares.append(sum(moved) / n)
    runs_made = neardup.runs_needed(0.8, neardup.RECALL, neardup.LEVELS)
    assert max(shares) <= 1.05 * runs_made * (1 + neardup.REPRESENTATIVES / neardup.BLOCK)


def test_classes_of_odd_rows(spark):
    odd = table(spark, ODD)
    got = Counter((r.doc_id, r.class_id, r.class_size) for r in neardup.near_duplicate_classes(odd).collect())
    assert got[(3, 3, 3)] == 2 and got[(4, 3, 3)] == 1 and got[(1, 1, 1)] == 1 and got[(None, None, 1)] == 2 and sum(got.values()) == len(ODD)
    assert neardup.near_duplicate_classes(table(spark, [])).count() == 0
