"""Tables replaced as a whole, rejected rows, and where tables differ."""

import os

import pytest
from pyspark.sql import functions as F

from mysem.operators import mutate
from mysem.plans import jobs
from mysem.sources import dump_write, snapshots


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def names(path):
    return sorted(os.listdir(path))


def test_read_and_replace(spark, tmp_path):
    path = f"{tmp_path}/t"
    mutate.truncate_reload(spark.range(5), path)
    got = mutate.truncate_reload(spark.read.parquet(path).select((F.col("id") * 10).alias("id")), path)
    assert rows(got) == [(0,), (10,), (20,), (30,), (40,)] and names(tmp_path) == ["t"]
    assert snapshots.replace_table(spark.read.parquet(path).where("id > 10"), path, F.count("*").alias("n"))["n"] == 3


def test_failed_run_leaves_the_old_table(spark, tmp_path):
    path = f"{tmp_path}/t"
    mutate.truncate_reload(spark.range(3), path)
    with pytest.raises(Exception, match="damaged"):
        mutate.truncate_reload(spark.range(9).select(F.when(F.col("id") < 8, F.col("id")).otherwise(F.raise_error(F.lit("damaged"))).alias("id")), path)
    assert rows(spark.read.parquet(path)) == [(0,), (1,), (2,)] and names(tmp_path) == ["t"]


def test_failed_swap_leaves_the_old_table(spark, tmp_path, monkeypatch):
    path = f"{tmp_path}/t"
    mutate.truncate_reload(spark.range(3), path)
    rename, calls = snapshots._rename, []

    def once(fs, make, old, new):
        calls.append(old)
        if len(calls) == 2:
            raise OSError("no space")
        rename(fs, make, old, new)

    monkeypatch.setattr(snapshots, "_rename", once)
    with pytest.raises(OSError):
        mutate.truncate_reload(spark.range(9), path)
    monkeypatch.undo()
    assert rows(spark.read.parquet(path)) == [(0,), (1,), (2,)]


def test_a_run_killed_in_the_swap(spark, tmp_path):
    path = f"{tmp_path}/t"
    mutate.truncate_reload(spark.range(3), path)
    os.rename(path, f"{tmp_path}/.t.old-1")
    assert rows(snapshots.read_table(spark, path, spark.range(0).schema)) == [(0,), (1,), (2,)]
    # Killed after the swap: the old folder goes.
    os.mkdir(f"{tmp_path}/.t.old-2")
    mutate.truncate_reload(spark.range(2), path)
    assert rows(spark.read.parquet(path)) == [(0,), (1,)] and names(tmp_path) == ["t"]
    assert snapshots.read_table(spark, f"{tmp_path}/none", spark.range(0).schema).count() == 0


def test_migration_keeps_rejects(spark, tmp_path):
    text = spark.createDataFrame([("1", "2024-01-01", "a"), ("x", "0000-00-00", "b"), ("3", "soon", "c"), (None, None, None)], "i string, d string, s string")
    dump_write.export_inserts(text, f"{tmp_path}/dump", "t")
    declared = {"t": {"i": "int(11)", "d": "date", "s": "varchar(9)"}}
    for mode, total in (("truncate", 2), ("append", 4), ("replace", 4)):
        report = jobs.migrate_tables(spark, f"{tmp_path}/dump", f"{tmp_path}/wh", declared=declared, mode=mode, keys={"t": ["i"]}).first()
        assert (report.source_rows, report.rejected_rows, report.target_rows, report.match) == (2, 2, total, False)
        rejects = spark.read.parquet(f"{tmp_path}/wh/_rejects/t")
        assert rows(rejects) == [("3", "soon", "c", ["d"]), ("x", "0000-00-00", "b", ["i"])]
    with pytest.raises(ValueError):
        jobs.migrate_tables(spark, f"{tmp_path}/dump", f"{tmp_path}/wh", declared=declared, mode="merge")


def test_where_tables_differ(spark):
    kinds = "k int, j string, a int, b string"
    one = [(1, "x", 1, "a"), (2, "x", 2, "b"), (3, None, 3, "c"), (None, "y", 4, None), (5, "d", 5, "e"), (5, "d", 6, "f"), (6, "z", None, "g")]
    two = [(1, "x", 1, "a"), (2, "x", 9, "b"), (3, None, 3, "C"), (None, "y", 4, None), (5, "d", 6, "e"), (5, "d", 5, "f"), (7, "z", None, "g"), (6, "z", 0, None)]
    s, t = spark.createDataFrame(one, kinds), spark.createDataFrame(two, kinds).select("b", "a", "j", "k")
    for buckets in (1, 3, 4096):
        got = rows(jobs.table_diff(s, t, ["k", "j"], buckets))
        # The two rows of the key 5 hold the same values column by column but not row by row.
        want = [(2, "x", "changed", ["a"]), (3, None, "changed", ["b"]), (5, "d", "changed", []), (6, "z", "changed", ["a", "b"]), (7, "z", "extra", [])]
        assert got == want
    assert rows(jobs.table_diff(t, s, ["k", "j"]))[-1][2] == "missing"
    assert rows(jobs.table_diff(s, s, ["k"])) == []
    with pytest.raises(ValueError):
        jobs.table_diff(s, t.drop("a"), ["k"])
