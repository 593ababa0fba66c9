"""Table and column metadata computed from the data."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mysem.session import written
from mysem.sources.types import enum_labels, mysql_type

# A unique column's estimate stays above this share of its values; at a
# relative error of 2 % that leaves more than seven standard deviations.
_UNIQUE_SHARE = 0.85
_RSD = 0.02


def describe_columns(df: DataFrame, defaults: dict[str, str] | None = None, auto: str | None = None) -> DataFrame:
    """``Field, Type, Null, Key, Default, Extra`` of each column.

    Null and Key come from the data: PRI for the first column that is unique
    without NULLs, UNI for other unique columns. One pass counts values and
    estimates distinct ones; all columns that may be unique are then counted
    together by hashes of 128 bits, in a second one.
    """
    spark = df.sparkSession
    cols = df.columns
    stats = []
    for i, c in enumerate(cols):
        stats.append(F.count(F.col(f"`{c}`")).alias(f"n{i}"))
        stats.append(F.approx_count_distinct(F.xxhash64(F.col(f"`{c}`")), _RSD).alias(f"d{i}"))
    row = df.agg(F.count("*").alias("n"), *stats).first()
    likely = [i for i in range(len(cols)) if row[f"n{i}"] and row[f"d{i}"] >= _UNIQUE_SHARE * row[f"n{i}"]]
    unique = _unique_columns(df, likely)
    primary = next((i for i in unique if row[f"n{i}"] == row["n"]), None)
    out = []
    for i, f in enumerate(df.schema.fields):
        key = "PRI" if i == primary else "UNI" if i in unique else ""
        default = (defaults or {}).get(f.name, "NULL")
        null = "NO" if row[f"n{i}"] == row["n"] else "YES"
        out.append((f.name, mysql_type(f.dataType), null, key, default, "auto_increment" if f.name == auto else ""))
    return spark.createDataFrame(
        out, "Field string, Type string, Null string, Key string, Default string, Extra string"
    )


def _unique_columns(df: DataFrame, numbers: list[int]) -> list[int]:
    """Which of the columns, by number, hold no value twice."""
    if not numbers:
        return []
    cols = [F.col(f"`{df.columns[i]}`") for i in numbers]
    hashed = [F.when(c.isNotNull(), F.struct(F.lit(i).alias("c"), F.xxhash64(c).alias("a"), F.xxhash64(F.lit(i), c).alias("b"))) for i, c in zip(numbers, cols)]
    values = df.select(F.explode(F.array_compact(F.array(*hashed))).alias("v")).select("v.*")
    # A value that fills a column costs one row per task; the result has a row a column at most.
    again = values.groupBy("c", "a", "b").agg(F.count("*").alias("n")).where("n > 1").select("c").distinct()
    repeated = {r.c for r in again.collect()}
    return [i for i in numbers if i not in repeated]


def table_status(tables: dict[str, DataFrame]) -> DataFrame:
    """``Name, Rows, Avg_row_length, Data_length``; lengths are bytes of the values as text."""
    out = []
    for n, df in tables.items():
        size = reduce(Column.__add__, [F.coalesce(F.octet_length(_text(df, c)), F.lit(0)) for c in df.columns])
        sums = df.agg(F.count("*").alias("Rows"), F.coalesce(F.sum(size), F.lit(0)).alias("Data_length"))
        mean = F.when(F.col("Rows") > 0, F.floor(F.col("Data_length") / F.col("Rows"))).otherwise(0).cast("bigint")
        out.append(sums.select(F.lit(n).alias("Name"), "Rows", mean.alias("Avg_row_length"), "Data_length"))
    return reduce(DataFrame.unionByName, out)


def _text(df: DataFrame, c: str) -> Column:
    kind = df.schema[c].dataType.typeName()
    return F.to_json(F.col(f"`{c}`")) if kind in ("array", "map", "struct") else F.col(f"`{c}`").cast("string")


def key_cardinality(df: DataFrame, key: list[str], approximate: bool = False) -> DataFrame:
    """``Non_unique, Seq_in_index, Column_name, Null, Cardinality`` of a candidate key.

    Cardinality counts the distinct values of each leading part of the key.
    """
    if approximate:
        counts = [F.approx_count_distinct(F.struct(*key[: i + 1])).alias(f"c{i}") for i in range(len(key))]
        nulls = [F.count_if(F.col(f"`{k}`").isNull()).alias(f"z{i}") for i, k in enumerate(key)]
        one = df.agg(F.count("*").alias("n"), *counts, *nulls)
        unique = F.col(f"c{len(key) - 1}") >= F.col("n")
        parts = [one.select(*_key_row(i, k, unique, F.col(f"c{i}"), F.col(f"z{i}"))) for i, k in enumerate(key)]
        return reduce(DataFrame.unionByName, parts)
    last = len(key) - 1
    one = written(_prefix_counts(df, key), "prefix-counts")
    unique = F.col(f"c{last}") >= F.col("n")
    parts = [one.select(*_key_row(i, k, unique, F.col(f"c{i}"), F.col(f"z{i}"))) for i, k in enumerate(key)]
    return reduce(DataFrame.unionByName, parts)


def _prefix_counts(df: DataFrame, key: list[str]) -> DataFrame:
    """One row: ``n`` rows, and for each leading part of the key its distinct values ``c0, c1, ...`` and NULLs ``z0, z1, ...`` of its last column.

    Rows are sorted once by hashes (128 bits) of all leading parts. In a sorted partition a part has as many values as it changes; where a partition begins
    with the value the one before it ended with, one is too many. Equal keys are spread over partitions, so no value is too frequent.
    """
    cols = [F.col(f"`{k}`") for k in key]
    named = []
    for i in range(len(key)):
        part = [x for c in cols[: i + 1] for x in (c, c.isNull())]
        named += [F.xxhash64(*part).alias(f"a{i}"), F.xxhash64(F.lit(i), *part).alias(f"b{i}")]
    hashes = [x for i in range(len(key)) for x in (f"a{i}", f"b{i}")]
    rows = df.select(*named, *[c.isNull().alias(f"z{i}") for i, c in enumerate(cols)], F.xxhash64(F.monotonically_increasing_id()).alias("tie"))
    placed = rows.repartitionByRange(*hashes, "tie").sortWithinPartitions(*hashes)
    width = len(key)

    def changes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np
        from pyspark import TaskContext

        first, last, n, counts, nulls = None, None, 0, np.zeros(width, np.int64), np.zeros(width, np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            flat = np.stack([batch.column(c).to_numpy() for c in hashes], axis=1)
            first = flat[0] if first is None else first
            whole = flat if last is None else np.concatenate([last[None, :], flat])
            other = (whole[1:] != whole[:-1]).reshape(-1, width, 2).any(axis=2)
            counts += other.sum(axis=0)
            nulls += [batch.column(f"z{i}").to_numpy(zero_copy_only=False).sum() for i in range(width)]
            n, last = n + batch.num_rows, flat[-1]
        if n:
            values = [TaskContext.get().partitionId(), n, first.tolist(), last.tolist(), counts.tolist(), nulls.tolist()]
            kinds = [pa.int32(), pa.int64(), *[pa.list_(pa.int64())] * 4]
            yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds)], names=["part", "n", "first", "last", "counts", "nulls"])

    kinds = "part int, n bigint, first array<bigint>, last array<bigint>, counts array<bigint>, nulls array<bigint>"
    edges = written(placed.mapInArrow(changes, kinds), "partitions-of-keys")
    # One row per partition.
    before = edges.withColumn("before", F.lag("last").over(Window.orderBy("part")))
    fresh = [(F.col("before").isNull() | (F.col("first")[2 * i] != F.col("before")[2 * i]) | (F.col("first")[2 * i + 1] != F.col("before")[2 * i + 1])).cast("long") for i in range(width)]
    zero = lambda c: F.coalesce(F.sum(c), F.lit(0))
    return before.agg(
        zero("n").alias("n"), *[zero(F.col("counts")[i] + fresh[i]).alias(f"c{i}") for i in range(width)], *[zero(F.col("nulls")[i]).alias(f"z{i}") for i in range(width)]
    )


def _key_row(i: int, name: str, unique: Column, distinct: Column, nulls: Column) -> list[Column]:
    return [
        F.when(unique, 0).otherwise(1).alias("Non_unique"),
        F.lit(i + 1).alias("Seq_in_index"),
        F.lit(name).alias("Column_name"),
        F.when(nulls > 0, "YES").otherwise("").alias("Null"),
        distinct.alias("Cardinality"),
    ]


def enum_domain(df: DataFrame, c: str, labels: list[str] | str) -> DataFrame:
    """``label, n_rows, declared``: every value of ``c``, and the labels without rows.

    ``labels`` is a list or a declaration such as ``"enum('a','b')"``.
    """
    labels = enum_labels(labels) if isinstance(labels, str) else labels
    found = df.where(F.col(f"`{c}`").isNotNull()).groupBy(F.col(f"`{c}`").alias("label")).agg(F.count("*").alias("n_rows"))
    wanted = df.sparkSession.createDataFrame([(v,) for v in labels], "label string").withColumn("d", F.lit(True))
    return found.join(wanted, "label", "full").select(
        "label", F.coalesce("n_rows", F.lit(0)).alias("n_rows"), F.coalesce("d", F.lit(False)).alias("declared")
    )


def enum_violations(df: DataFrame, c: str, labels: list[str] | str) -> DataFrame:
    """The rows whose value of ``c`` is outside the declared labels; NULL is allowed."""
    labels = enum_labels(labels) if isinstance(labels, str) else labels
    return df.where(~F.col(f"`{c}`").isin(*labels))
