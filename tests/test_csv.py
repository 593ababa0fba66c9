"""Delimited files whose quotes hold line feeds, cut anywhere."""

import csv
import io
import random

import pytest
from pyspark.sql import functions as F

from mysem.sources import tables


def test_records_over_any_cut(spark, tmp_path):
    rng = random.Random(5)
    field = lambda: "".join(rng.choices(["a", "\n", '"', ",", ";", "é", "\n\n", "\r\n", " "], k=rng.randrange(5)))
    want = []
    for i in range(6):
        rows = [[str(i), field(), field()] for _ in range(rng.randrange(1, 12))]
        text = io.StringIO(newline="")
        csv.writer(text, quoting=csv.QUOTE_ALL, lineterminator=rng.choice(["\n", "\r\n"])).writerows([["i", "a", "b"], *rows])
        (tmp_path / f"{i}.csv").write_bytes(text.getvalue().encode())
        want += [(int(r[0]), r[1], r[2]) for r in rows]
    schema = spark.createDataFrame([], "i int, a string, b string").schema
    for size in ("60b",):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", "1b")
        try:
            got = [tuple(r) for r in tables.load_data(spark, str(tmp_path), schema, multi_line=True).collect()]
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
            spark.conf.unset("spark.sql.files.openCostInBytes")
        # The parser reads the line feeds between quotes as they are.
        assert sorted(map(str, got)) == sorted(map(str, want))


def test_missing_and_empty_fields(spark, tmp_path):
    (tmp_path / "a.csv").write_text('i,a\n1,""\n2,\n3,"x\n\n"\n\n4,y')
    schema = spark.createDataFrame([], "i int, a string").schema
    got = sorted(tuple(r) for r in tables.load_data(spark, str(tmp_path), schema, multi_line=True).select("i", F.coalesce("a", F.lit("?"))).collect())
    assert got == [(1, ""), (2, "?"), (3, "x\n\n"), (4, "y")]


def test_bad_rows_are_errors(spark, tmp_path):
    schema = spark.createDataFrame([], "i int, a string").schema
    for text in ("i,b\n1,x\n", "i,a\nz,x\n"):
        path = tmp_path / f"{len(text)}.csv"
        path.write_text(text)
        with pytest.raises(Exception):
            tables.load_data(spark, str(path), schema, multi_line=True).collect()


def test_tsv_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, "a\nb\tc"), (2, None), (3, '"'), (4, "NUL\n\nL")], "i int, a string")
    tables.write_tsv(df, str(tmp_path / "t"))
    back = tables.read_tsv(spark, str(tmp_path / "t"), df.schema, multi_line=True)
    assert sorted(map(tuple, back.collect()), key=str) == sorted(map(tuple, df.collect()), key=str)
