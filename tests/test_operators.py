import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from mysem.operators import grouping, mutate, numbering, ordering, relational
from mysem.operators.components import components
from mysem.plans import jobs, profile


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows share one key, some values and keys are NULL."""
    rng = random.Random(3)
    data = []
    for i in range(3000):
        key = "hot" if i % 3 == 0 else rng.choice([None, "a", "b", "c", f"k{i % 50}"])
        data.append((i, key, rng.choice([None, "x", "y", f"v{i}"]), rng.randint(0, 20)))
    data.append((3000, "empty", None, 1))
    return spark.createDataFrame(data, "id int, k string, v string, o int").repartition(7).cache()


# --- grouping: both plans give the same answer ---


@pytest.mark.parametrize("order", [["o desc", "id"], ["v nulls first", "id desc"], [F.col("o") % 3, ("id", "desc")]])
def test_group_concat_hot(skewed, order):
    order = [(F.col(o[0]), o[1]) if isinstance(o, tuple) else o for o in order]
    plain = grouping.group_concat(skewed, ["k"], "v", "|", order, hot_rows=10**9)
    split = grouping.group_concat(skewed, ["k"], "v", "|", order, hot_rows=10)
    assert rows(plain) == rows(split)
    assert [r for r in rows(split) if r[0] == "empty"] == [("empty", None)]


def test_group_concat_brute_force(skewed):
    want = {}
    for r in sorted(skewed.collect(), key=lambda r: (-r.o, r.id)):
        want.setdefault(r.k, []).append(r.v)
    want = {k: ";".join(v for v in vs if v is not None) if any(v is not None for v in vs) else None for k, vs in want.items()}
    got = grouping.group_concat(skewed, ["k"], "v", ";", ["o desc", "id"], hot_rows=10)
    assert {r.k: r.group_concat for r in got.collect()} == want


def test_group_concat_unordered_hot(skewed):
    split = grouping.group_concat(skewed, ["k"], "v", hot_rows=10)
    plain = grouping.group_concat(skewed, ["k"], "v", hot_rows=10**9)
    assert {r.k: sorted((r[1] or "").split(",")) for r in split.collect()} == {
        r.k: sorted((r[1] or "").split(",")) for r in plain.collect()
    }


@pytest.mark.parametrize("hot_rows", [5, 10**9])
def test_group_concat_distinct(skewed, hot_rows):
    want = {}
    for r in skewed.collect():
        want.setdefault(r.k, set()).add(r.v)
    got = grouping.group_concat_distinct(skewed, ["k"], "v", "'\\", "desc", hot_rows=hot_rows)
    assert {r.k: r[1] for r in got.collect()} == {
        k: "'\\".join(sorted(vs - {None}, reverse=True)) or None for k, vs in want.items()
    }


@pytest.mark.parametrize("hot_rows", [0, 10, 10**9])
def test_array_agg(skewed, hot_rows):
    want = {}
    for r in sorted(skewed.collect(), key=lambda r: (r.o, -r.id)):
        want.setdefault(r.k, []).append(r.v)
    got = grouping.array_agg(skewed, ["k"], "v", ["o", "id desc"], hot_rows=hot_rows)
    assert {r.k: r.array_agg for r in got.collect()} == want


def test_rollup(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1)], "x string, y int")
    got = grouping.with_rollup(df, ["x", "y"], F.count("*").alias("n"))
    assert rows(got) == rows(spark.createDataFrame(
        [("a", 1, 1), ("a", 2, 1), ("b", 1, 1), ("a", None, 2), ("b", None, 1), (None, None, 3)], "x string, y int, n long"
    ))


# --- numbering ---


def test_seq_in_group_hot(skewed):
    order = ["o desc", "id"]
    split = numbering.seq_in_group(skewed, ["k"], order, "n", hot_rows=10)
    w = Window.partitionBy("k").orderBy(*ordering.columns(order))
    assert rows(split) == rows(skewed.withColumn("n", F.row_number().over(w)))


def test_number_rows(skewed):
    got = numbering.number_rows(skewed, ["o", "id desc"], "n", start=100).orderBy("n").collect()
    assert [r.n for r in got] == list(range(100, 3101))
    assert [r.id for r in got] == [r.id for r in sorted(skewed.collect(), key=lambda r: (r.o, -r.id))]


def test_auto_increment(spark):
    target = spark.createDataFrame([(4, "x"), (9, "y")], "id long, s string")
    new = spark.createDataFrame([("b",), ("a",), ("a",)], "s string")
    assert rows(mutate.auto_increment(target, new, "id", "s")) == [(10, "a"), (11, "a"), (12, "b"), (4, "x"), (9, "y")]
    assert mutate.next_auto_increment(target, "id").first()[0] == 10
    empty = target.where("id < 0")
    assert rows(mutate.auto_increment(empty, new.limit(1), "id", "s"))[0][0] == 1


# --- sorting and paging ---


def test_null_order(spark):
    df = spark.createDataFrame([(2,), (None,), (1,)], "x int")
    assert [r.x for r in relational.order_by(df, "x").collect()] == [1, 2, None]
    assert [r.x for r in relational.order_by(df, "x DESC").collect()] == [None, 2, 1]
    assert [r.x for r in relational.order_by(df, "x desc nulls last").collect()] == [2, 1, None]
    got = relational.order_by_field(df, "x", [2, 1]).collect()
    assert [r.x for r in got] == [2, 1, None]


def test_limit_and_found_rows(spark):
    df = spark.range(50).toDF("id")
    got = relational.limit_offset(relational.found_rows(df), "id", 10, 3)
    assert [tuple(r) for r in got.collect()] == [(10, 50), (11, 50), (12, 50)]
    assert [tuple(r) for r in relational.limit_offset(df, "id desc", 10, 3, deep=5).collect()] == [(39,), (38,), (37,)]
    sample = relational.random_sample_order(df, 7, seed=1)
    assert sample.distinct().count() == 7


# --- table changes ---

T_ROWS = [(1, "a", 10), (2, "b", 20), (None, "n", 30)]


@pytest.fixture
def target(spark):
    return spark.createDataFrame(T_ROWS, "k int, s string, q int")


def test_insert_ignore(spark, target):
    source = spark.createDataFrame(
        [(2, "x", 1), (3, "second", 2), (3, "first", 1), (None, "m", 0), (None, "m", 0)], "k int, s string, q int"
    )
    assert rows(mutate.insert_ignore(target, source, [["k"]], order="q")) == sorted(
        [*T_ROWS, (3, "first", 1), (None, "m", 0), (None, "m", 0)], key=str
    )


def _insert_ignore_one_by_one(have, new, keys):
    seen = [{tuple(r[i] for i in k) for r in have} for k in keys]
    out = list(have)
    for r in new:
        vals = [tuple(r[i] for i in k) for k in keys]
        if any(None not in v and v in s for v, s in zip(vals, seen)):
            continue
        out.append(r)
        for v, s in zip(vals, seen):
            s.add(v)
    return out


@pytest.mark.parametrize("seed", range(3))
def test_insert_ignore_several_keys(spark, seed):
    rng = random.Random(seed)
    pick = lambda n: rng.choice([None, *range(n)]) if rng.random() < 0.9 else None
    have = [(100, 100, -2), (101, 3, -1)]
    new = [(pick(25), pick(25), i) for i in range(80)]
    want = _insert_ignore_one_by_one(have, new, [(0,), (1,)])
    schema = "a int, b int, o int"
    got = mutate.insert_ignore(
        spark.createDataFrame(have, schema), spark.createDataFrame(new, schema), [["a"], ["b"]], order="o"
    )
    assert rows(got) == sorted(want, key=str)


@pytest.mark.parametrize("settled", [200_000, 3])
def test_insert_ignore_chains(spark, monkeypatch, settled):
    # a1 and b1 share one key, b1 and a2 the other, and so on; and short chains, single rows and rows without a key.
    n = 800 if settled > 3 else 24
    new = [((i + 1) // 2, i // 2, i) for i in range(n)]
    rng = random.Random(7)
    new += [(rng.choice([None, *range(10_000, 10_300)]), rng.choice([None, *range(20_000, 20_300)]), n + i) for i in range(200)]
    want = _insert_ignore_one_by_one([], new, [(0,), (1,)])
    monkeypatch.setattr(mutate, "SETTLED", settled)
    tables, write = [], mutate.written
    monkeypatch.setattr(mutate, "written", lambda df, name: tables.append(name) or write(df, name))
    source = spark.createDataFrame(new, "a int, b int, q int")
    got = mutate.insert_ignore(source.limit(0), source.repartition(4), [["a"], ["b"]], order="q")
    assert rows(got) == sorted(want, key=str)
    if settled > 3:
        # One row a round would take 400 rounds.
        assert len(tables) < 12


def test_components(spark):
    rng = random.Random(9)
    edges = [(i, i + 1) for i in range(700)] + [(5000, 5000 + i) for i in range(300)] + [(9, 9)] + [(rng.randrange(8000, 9000), rng.randrange(8000, 9000)) for _ in range(400)]
    rng.shuffle(edges)
    label = {x: x for e in edges for x in e}

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for a, b in edges:
        a, b = sorted((root(a), root(b)))
        label[b] = a
    want = {x: root(x) for e in edges if e[0] != e[1] for x in e}
    got = components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()
    assert len(got) == len(want) and {r.node: r.label for r in got} == want
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_insert_ignore_hot_key(spark, target):
    source = spark.range(5000).selectExpr("cast(7 as int) as k", "cast(id as string) as s", "cast(id as int) as q")
    got = mutate.insert_ignore(target, source, [["k"], ["s"]], order="q")
    assert rows(got) == sorted([*T_ROWS, (7, "0", 0)], key=str)


def test_upsert(spark, target):
    source = spark.createDataFrame([(2, "x", 5), (3, "y", 6), (None, "z", 7)], "k int, s string, q int")
    got = mutate.upsert(target, source, ["k"], set={"q": "t.q + s.q", "s": F.lit("done")})
    assert rows(got) == sorted([(1, "a", 10), (2, "done", 25), (3, "y", 6), (None, "n", 30), (None, "z", 7)], key=str)
    assert (2, "x", 5) in rows(mutate.upsert(target, source, ["k"]))


def test_upsert_duplicates(spark, target):
    source = spark.createDataFrame([(2, "x", 5), (2, "y", 6)], "k int, s string, q int")
    with pytest.raises(Exception, match="duplicate source key 2"):
        mutate.upsert(target, source, ["k"]).collect()
    assert (2, "y", 6) in rows(mutate.upsert(target, source, ["k"], keep="last", order="q"))
    assert (2, "x", 5) in rows(mutate.upsert(target, source, ["k"], keep="first", order="q"))
    with pytest.raises(ValueError):
        mutate.upsert(target, source, ["k"], keep="last", order="q desc")


def test_upsert_null_values(spark, target):
    source = spark.createDataFrame([(1, None, None)], "k int, s string, q int")
    assert (1, None, None) in rows(mutate.upsert(target, source, ["k"]))


def test_replace_into(spark, target):
    source = spark.createDataFrame([(2, "x", 5), (None, "z", 7)], "k int, s string, q int")
    assert rows(mutate.replace_into(target, source, ["k"])) == sorted(
        [(1, "a", 10), (2, "x", 5), (None, "n", 30), (None, "z", 7)], key=str
    )
    assert mutate.replace_into(target, source, None).count() == 5
    keys_only = target.select("k")
    assert rows(mutate.replace_into(keys_only, source.select("k"), ["k"])) == sorted([(1,), (2,), (None,), (None,)], key=str)


def test_update_join(spark, target):
    source = spark.createDataFrame([(1, 5), (2, 6), (2, 4), (None, 9)], "id int, v int")
    got = mutate.update_join(target, source, on={"k": "id"}, set={"q": "s.v"}, order="v")
    assert rows(got) == sorted([(1, "a", 5), (2, "b", 4), (None, "n", 30)], key=str)
    with pytest.raises(Exception, match="several source rows"):
        mutate.update_join(target, source, on={"k": "id"}, set={"q": "s.v"}).collect()
    one = mutate.update_join(target, source.where("v <> 4"), on={"k": "id"}, set={"q": "t.q + s.v"}, where="t.q > 15")
    assert rows(one) == sorted([(1, "a", 10), (2, "b", 26), (None, "n", 30)], key=str)


def test_delete_join(spark, target):
    source = spark.createDataFrame([(1, 5), (2, 60), (None, 9)], "id int, v int")
    assert rows(mutate.delete_join(target, source, on={"k": "id"})) == [(None, "n", 30)]
    assert len(rows(mutate.delete_join(target, source, on={"k": "id"}, where="s.v > t.q"))) == 2


def test_append_named(spark, target):
    got = mutate.append_named(target, spark.createDataFrame([("new",)], "s string"), defaults={"q": 1})
    assert (None, "new", 1) in rows(got)
    with pytest.raises(ValueError, match="no such column"):
        mutate.append_named(target, spark.range(1).toDF("zz"))


def test_columns(spark):
    df = spark.createDataFrame([("1",), ("x",), (None,)], "c string")
    assert mutate.unconvertible(df, "c", "int").first()[:] == (3, 1)
    assert rows(mutate.modify_column(df, "c", "int", on_error="null")) == [(1,), (None,), (None,)]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        mutate.modify_column(df, "c", "int").collect()
    doubles = spark.createDataFrame([(2.5,), (3.5,)], "c double")
    changed = mutate.change_column(doubles, "c", "n", "bigint")
    assert (changed.columns, rows(changed)) == (["n"], [(2,), (4,)])


# --- jobs and profiles ---


def test_checksum(spark):
    a = spark.createDataFrame([(1, None, "x"), (None, 1, "y")], "a int, b int, c string")
    swapped = a.selectExpr("b as a", "a as b", "c")
    report = jobs.validate_checksums({"t": a, "u": a}, {"t": a.repartition(5).select("c", "b", "a"), "u": swapped})
    assert {r.table_name: r.match for r in report.collect()} == {"t": True, "u": False}
    with pytest.raises(ValueError):
        jobs.validate_checksums({"t": a}, {"t": a.withColumn("a", F.col("a").cast("long"))})


def test_counts_missing_table(spark):
    a = spark.range(3)
    got = {r.table_name: tuple(r)[1:] for r in jobs.validate_counts({"t": a, "u": a}, {"t": a}).collect()}
    assert got == {"t": (3, 3, True), "u": (3, None, False)}


def test_fk_orphans_null_keys(spark):
    child = spark.createDataFrame([(1, 1), (1, None), (2, 2), (2, 2)], "a int, b int")
    parent = spark.createDataFrame([(1, 1)], "x int, y int")
    assert rows(jobs.fk_orphans(child, ["a", "b"], parent, ["x", "y"])) == [(2, 2, 2)]


def test_parents_first():
    assert jobs.parents_first(["a", "b", "c"], None) == ["a", "b", "c"]
    assert jobs.parents_first(["a", "b", "c"], {"a": ["c"], "c": ["b"]}) == ["b", "c", "a"]
    assert sorted(jobs.parents_first(["a", "b"], {"a": ["b"], "b": ["a"]})) == ["a", "b"]


def test_migrate_force_and_modes(spark, tmp_path):
    base = str(tmp_path / "wh")
    t = spark.createDataFrame([(1, "a"), (2, "b")], "k int, s string")
    jobs.migrate_tables(spark, {"t": t}, base)
    more = spark.createDataFrame([(2, "B"), (3, "c")], "k int, s string")
    report = jobs.migrate_tables(spark, {"t": more}, base, mode="replace", keys={"t": ["k"]}).first()
    assert (report.source_rows, report.target_rows, report.match) == (2, 3, True)
    assert rows(spark.read.parquet(f"{base}/t")) == [(1, "a"), (2, "B"), (3, "c")]
    first = jobs.migrate_tables(spark, {"new": more}, base, mode="ignore", keys={"new": ["k"]}).first()
    assert (first.source_rows, first.target_rows, first.match) == (2, 2, True)
    report = jobs.migrate_tables(spark, {"t": more}, base, mode="append").first()
    assert (report.source_rows, report.target_rows, report.match) == (2, 5, True)
    broken = more.withColumn("k", F.raise_error(F.lit("damaged")).cast("int"))
    report = jobs.migrate_tables(spark, {"bad": broken, "t": more}, base, force=True)
    got = {r.table_name: (r.match, r.error is None) for r in report.collect()}
    assert got == {"bad": (False, False), "t": (True, True)}
    with pytest.raises(Exception, match="damaged"):
        jobs.migrate_tables(spark, {"bad": broken}, base)


def test_describe(spark):
    df = spark.range(2000).selectExpr(
        "id", "cast(id % 7 as int) as few", "if(id = 5, null, id) as u", "id + (id % 2) as pairs", "cast(null as string) as none"
    )
    got = {r.Field: (r.Type, r.Null, r.Key, r.Extra) for r in profile.describe_columns(df, auto="id").collect()}
    assert got == {
        "id": ("bigint(20)", "NO", "PRI", "auto_increment"),
        "few": ("int(11)", "NO", "", ""),
        "u": ("bigint(20)", "YES", "UNI", ""),
        "pairs": ("bigint(20)", "NO", "", ""),
        "none": ("text", "YES", "", ""),
    }


def test_key_cardinality(spark):
    df = spark.createDataFrame([(1, 1), (1, 2), (2, None), (2, None)], "a int, b int")
    assert rows(profile.key_cardinality(df, ["a", "b"])) == [(1, 1, "a", "", 2), (1, 2, "b", "YES", 3)]
    assert rows(profile.key_cardinality(df, ["a", "b"], approximate=True)) == [(1, 1, "a", "", 2), (1, 2, "b", "YES", 3)]


def test_enum(spark):
    df = spark.createDataFrame([("a",), ("a",), ("z",), (None,)], "e string")
    assert rows(profile.enum_domain(df, "e", ["a", "b"])) == [("a", 2, True), ("b", 0, True), ("z", 1, False)]
    assert rows(profile.enum_violations(df, "e", "enum('a','b')")) == [("z",)]


def test_table_status_empty(spark):
    got = profile.table_status({"e": spark.range(0), "t": spark.createDataFrame([(1, "é", [1])], "i int, s string, a array<int>")})
    assert rows(got) == [("e", 0, 0, 0), ("t", 1, 6, 6)]


def test_hot_key_joins_can_be_split(spark):
    """The join of a hot target with its reduced source reads two shuffles of its own."""
    target = spark.range(1000).selectExpr("cast(least(id, 3) as int) as k", "id as v")
    source = spark.range(10).selectExpr("cast(id as int) as k", "id as w").repartition(3)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for df in (
            mutate.update_join(target, source, {"k": "k"}, {"v": "s.w"}),
            mutate.delete_join(target, source, {"k": "k"}),
        ):
            plan = df._jdf.queryExecution().executedPlan().toString()
            assert plan.count("Exchange hashpartitioning") == 3, plan
            sorts = plan[plan.index("SortMergeJoin") :].split(" Sort [")[1:]
            direct = [part.splitlines()[1] for part in sorts]
            assert sum("Exchange hashpartitioning" in line for line in direct) >= 2, plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_hot_key_joins_are_split(spark):
    """With a third of the target on one key, adaptive execution cuts that key's partition."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "50kb",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50kb",
    }
    target = spark.range(0, 300_000, 1, 8).selectExpr("cast(if(id % 3 = 0, 1, id) as int) as k", "id as v")
    source = spark.range(0, 5000).selectExpr("cast(id as int) as k", "id as w").repartition(3)
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        for df in (
            mutate.update_join(target, source, {"k": "k"}, {"v": "s.w"}),
            mutate.delete_join(target, source, {"k": "k"}),
            mutate.replace_into(target.selectExpr("k", "v as w"), source, ["k"]),
        ):
            df.collect()
            assert "skew=true" in df._jdf.queryExecution().executedPlan().toString()
    finally:
        for k in settings:
            spark.conf.unset(k)


@pytest.mark.parametrize("seed", range(2))
def test_key_cardinality_of_hot_and_null_keys(spark, seed):
    rng = random.Random(seed)
    data = [("hot" if rng.random() < 0.5 else rng.choice([None, "a", "b"]), rng.choice([None, 1, 2, 3]), rng.choice([None, 0.5, float(rng.randrange(90))])) for _ in range(900)]
    df = spark.createDataFrame(data, "a string, b int, c double").repartition(5)
    want = []
    for i, name in enumerate("abc"):
        prefixes = {r[: i + 1] for r in data}
        want.append((1, i + 1, name, "YES", len(prefixes)))
    assert rows(profile.key_cardinality(df, ["a", "b", "c"])) == want
    assert rows(profile.key_cardinality(df.limit(0), ["a", "b"])) == [(0, 1, "a", "", 0), (0, 2, "b", "", 0)]
    unique = spark.createDataFrame([(i // 7, i) for i in range(500)], "a int, b int").repartition(6)
    assert rows(profile.key_cardinality(unique, ["a", "b"])) == [(0, 1, "a", "", 72), (0, 2, "b", "", 500)]


def test_rollup_from_the_finest_groups(spark, skewed):
    import datetime as dt

    df = skewed.withColumn("d", F.expr("date_add(date'2024-01-01', o)"))
    aggs = {"n": ("count", "*"), "vs": ("count", "v"), "s": ("sum", "o"), "low": ("min", F.col("id") + 1), "high": ("max", "d"), "mean": ("avg", "o")}
    plain = grouping.with_rollup(
        df, ["k", "o"], F.count("*").alias("n"), F.count("v").alias("vs"), F.sum("o").alias("s"), F.min(F.col("id") + 1).alias("low"), F.max("d").alias("high"), F.avg("o").alias("mean")
    )
    levels = grouping.rollup_levels(df, ["k", "o"], **aggs)
    assert rows(levels) == rows(plain) and any(isinstance(r.high, dt.date) for r in levels.collect())
    assert rows(grouping.rollup_levels(df.limit(0), ["k"], n=("count", "*"), s=("sum", "o"))) == rows(grouping.with_rollup(df.limit(0), ["k"], F.count("*").alias("n"), F.sum("o").alias("s")))
    # Rows are taken once for each level only after they have been summed up.
    steps = [x.strip(" +-:") for x in levels._jdf.queryExecution().optimizedPlan().toString().splitlines()]
    assert [s.split()[0] for s in steps if s.startswith(("Expand", "Aggregate"))][:3] == ["Aggregate", "Expand", "Aggregate"]


def test_large_random_samples(spark):
    df = spark.range(3000).withColumn("x", F.col("id") % 7)
    whole = [r.id for r in relational.random_sample_order(df, 3000, seed=3, deep=0).collect()]
    assert sorted(whole) == list(range(3000)) and whole != sorted(whole)
    some = [r.id for r in relational.random_sample_order(df, 1234, seed=3, deep=0).collect()]
    assert len(some) == len(set(some)) == 1234 and some == whole[:1234] and abs(sum(some) / 1234 - 1500) < 120
    assert relational.random_sample_order(df, 5000, seed=3, deep=0).count() == 3000
    assert relational.random_sample_order(df, 10, seed=3, deep=0).columns == df.columns


def test_tied_pages_do_not_depend_on_the_plan(spark):
    df = spark.createDataFrame([(i, i % 3) for i in range(60)], "id int, k int").repartition(4)
    for offset in (0, 7, 33):
        assert rows(relational.limit_offset(df, "k", offset, 9)) == rows(relational.limit_offset(df, "k", offset, 9, deep=0))
