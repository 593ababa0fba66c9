"""Sorting, paging, sampling and counting over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mysem.functions.conditional import field_rank
from mysem.operators import ordering
from mysem.operators.numbering import number_rows
from mysem.session import written


def order_by(df: DataFrame, order) -> DataFrame:
    """``ORDER BY``; NULLs last ascending, first descending."""
    return df.orderBy(*ordering.columns(order))


def order_by_field(df: DataFrame, c: str, items: list, then=None) -> DataFrame:
    """``ORDER BY FIELD(c, items...)``; values outside the list come last."""
    return df.orderBy(field_rank(c, *items).asc_nulls_last(), *ordering.columns(then))


def limit_offset(df: DataFrame, order, offset: int, count: int, deep: int = 1_000_000) -> DataFrame:
    """``ORDER BY order LIMIT offset, count``.

    The first rows are found by keeping the best ``offset + count`` of every
    task. Past ``deep`` that would be too many for one task, so the sorted
    rows are numbered instead. Rows the order leaves tied are taken by a hash
    of their values either way.
    """
    if offset + count <= deep:
        tie = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
        return df.orderBy(*ordering.columns(order), tie).offset(offset).limit(count)
    numbered = number_rows(df, order, "__n", start=0)
    page = numbered.where((F.col("__n") >= offset) & (F.col("__n") < offset + count))
    return page.orderBy("__n").drop("__n")


def found_rows(df: DataFrame, alias: str = "found_rows") -> DataFrame:
    """Add the number of rows of ``df`` before any limit.

    The count is a scalar subquery: no window over the whole table, no join.
    """
    return df.withColumn(alias, df.agg(F.count("*")).scalar())


# The first cut of a large sample is made between this many ranges of random keys.
_RANGES = 1 << 16


def random_sample_order(df: DataFrame, n: int, seed: int | None = None, deep: int = 1_000_000) -> DataFrame:
    """``ORDER BY RAND() LIMIT n``.

    Every task keeps at most ``n`` rows. Past ``deep`` that would be too many for one task: random keys are written with the rows, a count of keys
    by range shows in which range the ``n``-th lies, rows of that range alone are cut exactly, and what is left is sorted by range.
    """
    if n <= deep:
        return df.orderBy(F.rand(seed)).limit(n)
    keyed = written(df.withColumns({"__key": F.rand(seed), "__tie": F.monotonically_increasing_id()}), "random-keys")
    place = F.floor(F.col("__key") * _RANGES).cast("int")
    counts = sorted((r.place, r.n) for r in keyed.groupBy(place.alias("place")).agg(F.count("*").alias("n")).collect())
    before = 0
    for at, size in counts:
        if before + size >= n:
            last = keyed.where(place == at).orderBy("__key", "__tie").limit(n - before)
            keyed = keyed.where(place < at).unionByName(last)
            break
        before += size
    return keyed.orderBy("__key", "__tie").drop("__key", "__tie")


def minus_except(a: DataFrame, b: DataFrame) -> DataFrame:
    """``a MINUS b``, without duplicates.

    Repeated rows are dropped before the sides meet, so none fills a task.
    """
    return a.distinct().subtract(b.distinct())
