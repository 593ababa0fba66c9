"""The training-data operators against brute force, round trips, held-out accuracy and odd tables."""

import hashlib
import itertools
import os
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from mysem.llm import decontaminate, dedup_exact, hashed, language, neardup, pieces, pii, quality, secrets, sharding, toxicity
from mysem.llm import queries as _queries  # noqa: F401
from mysem.llm import texts as T
from mysem.llm.registry import QUERIES

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, kept string, score string, row string, rep string, high string, size string"
LONG = "all the same words again and again until the text is very long " * 3000


def table(spark, rows):
    """Documents with extra columns whose names operators also use."""
    return spark.createDataFrame([(*r, *(["x"] * 6)) for r in rows], SCHEMA)


ODD = [
    (1, None, None, None, None),
    (2, "", "en", "a", 0),
    (3, "the cat sat on the mat and saw the dog", "en", "a", 38),
    (3, "the cat sat on the mat and saw the dog", "en", "a", 38),
    (4, "THE CAT sat on the mat and saw the dog", "en", None, 38),
    (None, "the cat sat on the mat and saw the dog", "en", "a", 38),
    (5, "1234 %%% 77", None, "b", 11),
    (6, LONG, "en", "a", len(LONG)),
    (7, "é", "fr", "b", 1),
    (None, None, None, None, None),
]


@pytest.fixture(scope="module")
def odd(spark):
    return table(spark, ODD)


@pytest.fixture(scope="module")
def none(spark):
    return table(spark, [])


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def texts(docs):
    return {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}


@pytest.mark.parametrize("name", [n for n, (_, sql) in QUERIES.items() if sql])
def test_sql(spark, name):
    fn, sql = QUERIES[name]
    con = duckdb.connect()
    for t in ("documents", "benchmark", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    want = con.execute(sql).df()
    got = fn(spark, SF).toPandas()[list(want.columns)]
    assert sorted(map(tuple, got.astype(str).values)) == sorted(map(tuple, want.astype(str).values))


# Words and hashes


def test_words_and_ascii_lower():
    codes, starts = T.code_points(["Ab-é9 İ", "", "x"])
    low = T.ascii_lower(codes)
    at, size, hashes = T.words(low, T.word_mask(low))
    assert [("".join(map(chr, low[a : a + n]))) for a, n in zip(at, size)] == ["ab", "é9", "İ", "x"]
    assert starts.tolist() == [0, 8, 9] and len(set(hashes.tolist())) == 4


# 10


def test_copies_of_odd_rows(odd, none):
    got = Counter(tuple(r) for r in dedup_exact.exact_duplicates(odd).select("doc_id", "keep_id", "group_size", "kept").collect())
    assert got[(3, 4, 4, False)] == 2 and got[(4, 4, 4, True)] == 1 and got[(None, 4, 4, False)] == 1
    assert got[(1, 2, 3, False)] == 1 and got[(2, 2, 3, True)] == 1 and got[(6, 6, 1, True)] == 1
    assert sum(got.values()) == len(ODD)
    assert dedup_exact.exact_duplicates(none).count() == 0


def test_colliding_identifiers_are_told_apart(docs, texts):
    got = {r.doc_id: r.keep_id for r in dedup_exact.exact_duplicates(docs, id_bits=3).collect()}
    last = {}
    low = lambda t: "".join(c.lower() if c < "\x80" else c for c in t)
    for i, t in texts.items():
        last[low(t)] = max(i, last.get(low(t), -1))
    assert got == {i: last[low(t)] for i, t in texts.items()}


def test_cuts_follow_content():
    rng = np.random.default_rng(1)
    data = rng.integers(0, 256, 200_000, dtype=np.uint8).tobytes()
    chunks = lambda d: {d[a:b] for a, b in itertools.pairwise([0, *dedup_exact.cuts(d, np.array([0]), len(d))[0]])}
    one, two = chunks(data), chunks(b"some words before" + data)
    assert len(one & two) >= len(one) - 3
    sizes = np.diff([0, *dedup_exact.cuts(b"a" * 300_000, np.array([0]), 300_000)[0]])
    assert sizes.max() <= dedup_exact.MAX_BYTES and sizes.sum() == 300_000


# 8


def test_contamination_of_odd_rows(spark, odd, none):
    tests = spark.createDataFrame([(1, "cat SAT on"), (2, None), (None, "the"), (1, "is very long all the same words again and again until"), (9, "--")], "item_id bigint, text string")
    got = {r.doc_id: r for r in decontaminate.contamination(odd, tests).collect()}
    assert got[3].n_hit == 3 and got[3]["items"] == ["1"] and [tuple(s) for s in got[3].spans] == [(1, 4)]
    assert got[1].n_words == 0 and got[6].n_hit == 2999 * 11 and got[5].n_hit == 0
    assert decontaminate.contamination(none, tests).count() == 0
    assert {r.n_hit for r in decontaminate.contamination(odd, tests.limit(0)).collect()} == {0}


def test_proximity_and_blocks(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "one two extra three four"), (2, "four three two one"), (3, "one two three four")], "doc_id bigint, text string")
    tests = spark.createDataFrame([("a", "one two three four"), ("b", "three four")], "item_id string, text string")
    found = lambda: sorted(map(str, decontaminate.contamination(docs, tests, slop=1).drop("spans").collect()))
    once = found()
    near = {r.doc_id: r.near for r in decontaminate.contamination(docs, tests, slop=1).collect()}
    assert near[1] == ["a", "b"] and near[3] == ["a", "b"] and near[2] == []
    monkeypatch.setattr(decontaminate, "BLOCK_CHARS", 1)
    assert found() == once


# 1


def test_language_held_out(docs):
    got = language.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert np.mean([r.lang == r.lang_pred for r in got]) > 0.95 and all(0 <= r.score <= 1 for r in got)
    assert {r.doc_id for r in got} == {r.doc_id for r in docs.select("doc_id").collect() if zlib.crc32(str(r.doc_id).encode()) % 4 == 2}


def test_language_of_odd_rows(odd, none):
    got = [(r.doc_id, r.lang_pred, r.score) for r in language.identify(odd).collect()]
    assert len(got) == len(ODD) and {p for i, p, _ in got if i in (1, 2, 5)} == {"und"} and (7, "und", 0.0) not in got
    assert language.identify(none).count() == 0
    assert {r.lang_pred for r in language.predict(odd, language.build_filters([], [])).collect()} == {"und"}


def test_grams_stay_within_texts():
    alone = [language.grams([t])[0].tolist() for t in ("a", "ab cd", "", "$$", "Straße und")]
    flat, counts = language.grams(["a", "ab cd", "", "$$", "Straße und"])
    assert counts.tolist() == [len(a) for a in alone] and flat.tolist() == sum(alone, [])


def test_more_than_64_languages():
    names = [f"l{i:03}" for i in range(70)]
    model = language.build_filters(names, [(int(h), n) for n in names for h in T.mixed(np.array([ord(c) for c in n])).view(np.int64)[1:]])
    probe = T.mixed(np.array([ord("l") for _ in range(1)]))
    assert model.slices.shape[0] == 2 and len(model.masks(probe, 1)) == 1 and (model.false_rate < 0.2).all()


# 7


def test_shards(docs, spark):
    got = sharding.interleaved(docs, 24).join(docs.select("doc_id", "source"), "doc_id").collect()
    sizes = Counter(r.shard for r in got)
    assert set(sizes) == set(range(24)) and max(sizes.values()) - min(sizes.values()) <= 1
    slots = defaultdict(set)
    for r in got:
        slots[r.shard].add(r.slot)
    assert all(s == set(range(sizes[k])) for k, s in slots.items())
    # The order is that of fractional ranks within sources.
    order = sorted(got, key=lambda r: (r.shard, r.slot))
    seen, total, last = Counter(), Counter(r.source for r in got), -1
    for r in order:
        fraction = (seen[r.source] + 0.5) / total[r.source]
        assert fraction >= last - 1e-12
        seen[r.source] += 1
        last = fraction


def test_shards_of_odd_rows(odd, none):
    got = sharding.interleaved(odd, 3).collect()
    assert sorted(Counter(r.shard for r in got).values()) == [3, 3, 4]
    by_id = {r.doc_id: r for r in got if r.doc_id}
    assert by_id[1].size == 8 and by_id[1].text_crc32 == 0 and by_id[7].size == 10 and by_id[7].text_crc32 == zlib.crc32("é".encode())
    assert sharding.interleaved(none, 3).count() == 0


# 9


def test_pieces_match_the_library(texts):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    p = pieces.load()
    rng = random.Random(3)
    odd = ["", " ", "a", "  a \n\n b\t", "aaaaaaa" * 60, "x" * 700 + " y", "日本語 한국어 😀\u0000", "function(){return 0;}" * 9, "----" * 50]
    odd += ["".join(rng.choice("ab the ing▁\n.é你") for _ in range(60)) for _ in range(50)]
    for some in (odd, list(texts.values())):
        ids, counts = pieces.encode(p, some)
        ends = np.cumsum(counts)
        assert [ids[e - n : e].tolist() for e, n in zip(ends, counts)] == model.encode(some)
        assert pieces.decode(p, ids, counts) == [t.replace("▁", " ").encode() for t in some]


def test_unigram_viterbi_matches_brute_force(tmp_path):
    from sentencepiece import sentencepiece_model_pb2 as proto

    model = proto.ModelProto()
    scores = {"▁": -2.0, "a": -3.0, "b": -3.1, "ab": -4.0, "ba": -4.3, "▁a": -3.5, "aba": -5.5, "bb": -9.0}
    for piece, score, kind in [("<unk>", 0, 2), *[(s, x, 1) for s, x in scores.items()]]:
        model.pieces.add(piece=piece, score=score, type=kind)
    model.trainer_spec.model_type = 1
    model.normalizer_spec.remove_extra_whitespaces = False
    path = tmp_path / "toy.model"
    path.write_bytes(model.SerializeToString())
    p = pieces.load(str(path))
    best = lambda s: max((sum(scores[x] for x in c) for c in _splits(s, scores)), default=None)
    for word in ("ab", "abab", "bbaba", "aababb", "b"):
        ids, _ = pieces.encode(p, [word])
        assert sum(list(scores.values())[i - 1] for i in ids) == pytest.approx(best("▁" + word))


def _splits(s, scores):
    if not s:
        yield []
    for x in scores:
        if s.startswith(x):
            for rest in _splits(s[len(x) :], scores):
                yield [x, *rest]


def test_pieces_of_odd_rows(odd, none):
    got = pieces.encode_texts(odd)
    rows = got.collect()
    assert len(rows) == len(ODD) and all(r.restored for r in rows if r.ids is not None)
    assert {r.ids is None for r in rows if r.doc_id == 1} == {True} and [r.ids for r in rows if r.doc_id == 2] == [[]]
    back = {r.doc_id: r.text for r in pieces.decode_ids(got).collect() if r.doc_id}
    assert back == {i: t for i, t, *_ in ODD if i}
    assert pieces.encode_texts(none).count() == 0


# 4


def test_toxic_sentences_are_found(spark):
    rng = random.Random(5)
    plain = ["tree", "house", "river", "walks", "green", "under", "light", "stone", "cloud", "paper"]
    rows, marks = [], []
    for i in range(400):
        sentences = [" ".join(rng.choices(plain, k=6)) for _ in range(5)]
        if i % 3 == 0:
            sentences[i % 5] += " grumblefoo"
        rows.append((i, ". ".join(sentences) + ".", None, None, None))
        marks.append((i, int(i % 3 == 0)))
    docs, labels = table(spark, rows), spark.createDataFrame(marks, "doc_id bigint, toxic int")
    got = toxicity.score(docs, toxicity.fit(docs, labels), toxicity.is_held_out("doc_id").alias("held_out")).where("held_out").collect()
    assert np.mean([r.predicted == int(r.doc_id % 3 == 0) for r in got]) > 0.95
    for r in got:
        if r.doc_id % 3 == 0:
            assert len(r.offending) == 1
            assert "grumblefoo" in rows[r.doc_id][1][r.offending[0].start : r.offending[0].end]
    assert {r.doc_id for r in got} == {i for i in range(400) if zlib.crc32(str(i).encode()) % 5 == 0}


def test_words_beside_toxic_ones_get_no_credit(spark):
    rng = random.Random(11)
    plain = ["".join(rng.choices("abcdefghij", k=7)) for _ in range(1500)]
    toxic = ["xylo" + end for end in ("one", "two")] + ["quirk", "wuzzle", "zonk", "vroom"]
    rows, marks = [], []
    for i in range(900):
        sentences = [" ".join(rng.choices(plain, k=6)) for _ in range(6)]
        for at in rng.sample(range(6), rng.randint(1, 3)) if i % 4 == 0 else []:
            sentences[at] += " " + rng.choice(toxic)
        rows.append((i, ". ".join(sentences) + ".", None, None, None))
        marks.append((i, int(i % 4 == 0)))
    docs, labels = table(spark, rows), spark.createDataFrame(marks, "doc_id bigint, toxic int")
    examples = toxicity.training_rows(docs, labels)
    weights = toxicity.fit(docs, labels)
    assert np.count_nonzero(weights) < np.count_nonzero(hashed.train(examples, bias=-5.0)) / 2
    got = toxicity.score(docs, weights, toxicity.is_held_out("doc_id").alias("held_out")).where("held_out").collect()
    assert np.mean([r.predicted for r in got if r.doc_id % 4 == 0]) > 0.9
    assert np.mean([r.predicted for r in got if r.doc_id % 4]) < 0.05


def test_toxicity_of_odd_rows(spark, odd, none):
    labels = spark.createDataFrame([(1, 1), (3, None), (None, 1), (3, 0), (3, 1), (99, 1)], "doc_id bigint, toxic int")
    weights = toxicity.fit(odd, labels)
    got = toxicity.score(odd, weights).collect()
    assert len(got) == len(ODD) and all(0 <= r.score <= 1 for r in got) and {r.score for r in got if r.doc_id in (1, 2)} == {0.0}
    assert toxicity.score(none, toxicity.fit(none, labels)).count() == 0


# 2


def test_quality_agrees_with_labels(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = {r.doc_id: r.quality for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    got = [r for r in quality.assess(docs).collect() if r.doc_id in labels]
    assert np.mean([r.predicted == labels[r.doc_id] for r in got]) > 0.95
    assert np.mean([(r.posterior >= 0.5) == labels[r.doc_id] for r in got]) > 0.95


def test_quality_of_odd_rows(odd, none):
    got = quality.assess(odd).collect()
    assert len(got) == len(ODD) and all(0 <= r.score <= 1 and len(r.votes) == len(quality.LABELLERS) for r in got)
    assert quality.assess(none).count() == 0
    assert quality.estimate({})[0] == {}


# 3


def shingles(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if c < "\x80" else c for c in text or ""))
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} - {()}


def brute_links(texts):
    """Class and number of links per id, over all pairs that share a shingle."""
    sets = {i: shingles(t) for i, t in texts.items()}
    where, common = defaultdict(list), Counter()
    for i, s in sets.items():
        for x in s:
            where[x].append(i)
    for ids in where.values():
        common.update(itertools.combinations(ids, 2))
    links, parent = Counter(), {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for (a, b), n in common.items():
        if 5 * n >= 4 * (len(sets[a]) + len(sets[b]) - n):
            links[a] += 1
            links[b] += 1
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    return {i: (find(i), links[i]) for i in sets}


def test_links_match_brute_force(docs, texts):
    got = {r.doc_id: (r.class_id, r.n_links) for r in neardup.near_duplicates(docs).collect()}
    assert got == brute_links(texts)


def test_large_groups_are_compared_in_blocks(spark, monkeypatch):
    rng = random.Random(7)
    words = [f"w{i}" for i in range(400)]
    common = " ".join(rng.choices(words, k=12))
    base = rng.choices(words, k=120)
    rows = {}
    for i in range(160):
        if i < 90:
            own = list(base)
            own[rng.randrange(120)] = f"v{i}"
            rows[i] = " ".join(own)
        else:
            # Nothing in common but a passage.
            rows[i] = common + " " + " ".join(rng.choices(words, k=100))
    docs = table(spark, [(i, t, None, None, None) for i, t in rows.items()])
    want = brute_links(rows)
    monkeypatch.setattr(neardup, "BLOCK", 16)
    monkeypatch.setattr(neardup, "SMALL", 8)
    got = {r.doc_id: (r.class_id, r.n_links) for r in neardup.near_duplicates(docs).collect()}
    assert {i: c for i, (c, _) in got.items()} == {i: c for i, (c, _) in want.items()}
    assert sum(n for _, n in got.values()) >= 0.995 * sum(n for _, n in want.values())
    assert all(n <= want[i][1] for i, (_, n) in got.items())


def test_near_duplicates_of_odd_rows(odd, none):
    got = [(r.doc_id, r.class_id, r.n_links) for r in neardup.near_duplicates(odd).collect()]
    assert Counter(got)[(3, 3, 2)] == 2 and (4, 3, 2) in got and (1, 1, 0) in got and (None, None, 0) in got and len(got) == len(ODD)
    assert neardup.near_duplicates(none).count() == 0


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 90), (95, 90), (7, 7)]
    got = {r.node: r.label for r in neardup.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {**{i: 0 for i in range(1, 41)}, 100: 90, 95: 90}


# 5 and 6


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def brute_pii(t):
    digits = lambda s: re.sub("[^0-9]", "", s)
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(x) <= 255 for x in m.group().split("."))]
    out += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t) if 12 <= len(digits(m.group())) <= 19 and luhn(digits(m.group()))]
    out += [(m.start(), 3, m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 9 <= len(digits(m.group())) <= 15]
    return ",".join(f"{pii.KINDS[k]}:{s}:{e}" for s, k, e in sorted(out))


def brute_secrets(t):
    out = [
        (m.start(), 0, m.end())
        for m in re.finditer(r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", t, re.ASCII)
        if len(m.group(1)) >= 6
    ]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m.group()) >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m.group()) >= 24]
    return ",".join(f"{secrets.KINDS[k]}:{s}:{e}" for s, k, e in sorted(out))


def noise(seed, alphabet, n):
    rng = random.Random(seed)
    return ["".join(rng.choice(alphabet) for _ in range(rng.randrange(80))) for _ in range(n)]


def test_personal_data_matches_brute_force(spark, texts):
    odd = noise(1, "ab1 2.3@-+%()é\n", 300) + noise(2, "0123456789 -", 200) + noise(3, "1.2.30 5", 200) + noise(4, "a@.b@c.d%+", 200)
    odd += ["a@b.c+d@e.f", "1.2.3.4.5.6.7.8", "999.1.1.1 0255.1.1.1", "😀 x@y.zz", "1" * 30_000, "a" * 30_000, "a@b" + ".c" * 5_000, "1 " * 5_000]
    every = dict(enumerate([*texts.values(), *odd]))
    got = pii.scan(table(spark, [(i, t, None, None, None) for i, t in every.items()])).collect()
    for r in got:
        want = brute_pii(every[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(want.encode()).hexdigest(), every[r.doc_id][:80]
        assert set(filter(None, want.split(","))) <= set(r.spans.split(","))


def test_patterns_discover_unseen_identifiers(spark):
    rows = [(i, f"some talk here phone: +49 30 1234{i:03} and more", None, None, None) for i in range(8)]
    rows += [(100, "other words phone: 030-7654321 then", None, None, None), (101, "it costs 030-7654329 or so", None, None, None), (102, "the the the the", None, None, None)]
    got = {r.doc_id: r for r in pii.scan(table(spark, rows)).collect()}
    text = rows[8][1]
    at = text.index("030")
    assert got[100].spans == f"phone:{at}:{at + 11}" and got[100].n_found == 1 and got[100].n_phone == 0 and got[101].n_found == 0


def test_secrets_match_brute_force(spark, texts):
    odd = noise(5, "tokenTOKEN=: '\"a1f", 300) + noise(6, "AKIA9Z ", 300) + noise(7, "0123456789abcdef g", 100)
    odd += ["token=abcdefg" * 50, "passwordpassword: abc123x", "api_key='abcdef' API-KEY=abcdef apiKey : abcdef", "é token=ab12cd34", "f" * 50_000]
    every = dict(enumerate([*texts.values(), *odd]))
    got = secrets.scan(table(spark, [(i, t, None, None, None) for i, t in every.items()])).collect()
    for r in got:
        want = brute_secrets(every[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(want.encode()).hexdigest(), every[r.doc_id][:80]
        assert set(filter(None, want.split(","))) <= set(r.spans.split(","))


def test_inferred_format_finds_more(spark):
    rng = random.Random(9)
    code = lambda: "xq_" + "".join(rng.choice("0123456789") for _ in range(12)) + "".join(rng.choice("ABCDEFGH") for _ in range(4))
    rows = [(i, f"token={code()} is set", None, None, None) for i in range(200)]
    rows += [(1000, f"we saw {code()} in a log", None, None, None), (1001, "see version-2-of-the-long-named-file now", None, None, None), (1002, "id 20240101120000abcdefgh x", None, None, None)]
    got = {r.doc_id: r for r in secrets.scan(table(spark, rows)).collect()}
    assert got[1000].spans == "assign:7:26" and got[1000].n_found == 1
    assert got[1001].n_found == 0 and got[1002].n_found == 0


def test_scans_of_odd_rows(odd, none):
    for scan in (pii.scan, secrets.scan):
        got = scan(odd).collect()
        assert len(got) == len(ODD) and {r.spans for r in got} == {""} and scan(none).count() == 0


# Pipeline


def test_pipeline(spark, docs, texts):
    kept = {}
    for i, t in sorted(texts.items(), reverse=True):
        if any(c.isalpha() for c in t):
            kept.setdefault("".join(c.lower() if c < "\x80" else c for c in t), (i, t))
    left = dict(kept.values())
    classes = brute_links(left)
    left = {i: t for i, t in left.items() if classes[i][0] == i}
    windows = set()
    for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect():
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", r.text.lower())
        windows |= {tuple(words[i : i + 10]) for i in range(max(1, len(words) - 9))}
    clean = lambda t: not {tuple(w[i : i + 10]) for w in [re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if c < "\x80" else c for c in t))] for i in range(len(w))} & windows
    got = corpus_pipeline.run(spark, SF).collect()
    assert {r.doc_id for r in got} == {i for i, t in left.items() if clean(t)} and all(r.restored for r in got)
    assert [n for n, _ in corpus_pipeline.STAGES][-1].startswith("SentencePiece")


def test_stages_keep_the_columns_and_take_odd_rows(spark, odd, none):
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, odd, SF).columns == odd.columns and stage(spark, none, SF).count() == 0
    assert corpus_pipeline.known_language(spark, odd, SF).where("text IS NULL").count() == 0


UNLEARNED = [
    "Il vecchio pescatore camminava lentamente lungo la riva del mare, pensando alla giornata che stava per finire.",
    "O velho pescador caminhava devagar ao longo da praia, pensando no dia que estava a acabar e nos barcos.",
    "De oude visser liep langzaam langs het strand en dacht aan de dag die bijna voorbij was en aan de boten.",
    "Den gamle fiskaren gick sakta längs stranden och tänkte på dagen som snart var slut och på båtarna.",
    "Senex piscator lente per litus ambulabat, de die qui iam finiebatur cogitans et de navibus.",
]


def test_unlearned_languages_are_dropped(spark, docs, none):
    foreign = spark.createDataFrame([(10**9 + i, t) for i, t in enumerate(UNLEARNED)], "doc_id bigint, text string")
    both = docs.unionByName(foreign, allowMissingColumns=True)
    got = {r.doc_id for r in corpus_pipeline.known_language(spark, both, SF).collect()}
    assert got == {r.doc_id for r in docs.collect() if any(c.isalpha() for c in r.text)}
    assert language.least_score(none) is None
    assert 0.3 < language.least_score(docs.withColumn("lang", F.lit("x"))) < 0.5


def test_decisions_hold_for_rows_not_ids(spark):
    item = spark.read.parquet(f"{SF}/benchmark.parquet").first().text
    prose = lambda seed: " ".join(random.Random(seed).choices([f"w{i}" for i in range(500)], k=60))
    near = lambda seed: prose(seed) + " end"
    rows = [
        # Copies: without ids, one of them with an id, identical rows, and other texts under the ids of dropped rows.
        (None, prose(1)), (None, prose(1)), (None, prose(2)), (5, prose(2)), (6, prose(3)), (6, prose(3)),
        (7, prose(4)), (8, prose(4)), (7, prose(5)), (-1, prose(6)), (-2, prose(6)),
    ]
    texts = lambda stage, rows: Counter((r.doc_id, r.text) for r in stage(spark, table(spark, [(*r, "en", "a", 1) for r in rows]), SF).collect())
    want = Counter([(None, prose(1)), (5, prose(2)), (6, prose(3)), (8, prose(4)), (7, prose(5)), (-1, prose(6))])
    assert texts(corpus_pipeline.one_of_each_copy, rows) == want
    rows = [
        (None, prose(1)), (None, near(1)), (None, prose(2)), (5, near(2)), (6, prose(3)), (6, prose(3)),
        (8, prose(4)), (7, near(4)), (8, prose(5)),
    ]
    got = texts(corpus_pipeline.one_of_each_class, rows)
    assert sum(got[None, t] for t in (prose(1), near(1))) == 1 and sum(got.values()) == 5
    assert all(got[r] == 1 for r in [(5, near(2)), (6, prose(3)), (7, near(4)), (8, prose(5))])
    rows = [(None, item), (1, item), (1, prose(1)), (None, prose(2))]
    assert texts(corpus_pipeline.free_of_benchmark, rows) == Counter([(1, prose(1)), (None, prose(2))])


def test_row_keys(spark, tmp_path, odd, none):
    odd.unionByName(odd).repartition(5).write.parquet(f"{tmp_path}/odd")
    stored = spark.read.parquet(f"{tmp_path}/odd")
    for rows, n in ((odd, len(ODD)), (stored, 2 * len(ODD)), (none, 0)):
        keyed, key = corpus_pipeline._keyed(rows)
        assert keyed.drop(key).columns == rows.columns and keyed.count() == keyed.select(key).distinct().count() == n
    keyed, key = corpus_pipeline._keyed(stored)
    # Other splits of the files give the same keys.
    first = sorted(map(str, keyed.select(key, "doc_id", "text").collect()))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1k")
    try:
        assert first == sorted(map(str, keyed.select(key, "doc_id", "text").collect()))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_samples_are_bounded(spark):
    ids = spark.range(5000).withColumnRenamed("id", "doc_id")
    assert hashed.sampled(ids, 10_000).count() == 5000 and 300 < hashed.sampled(ids, 500).count() <= 1000


def test_held_out_rows(spark):
    rows = spark.createDataFrame([(12,), (None,)], "doc_id bigint")
    got = [r[0] for r in rows.select(language.held_out().alias("h")).collect()]
    assert got == [zlib.crc32(b"12") % 4 == 2, True]
    assert rows.select(F.lit(1)).count() == 2
