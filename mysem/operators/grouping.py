"""GROUP_CONCAT, ordered arrays and ROLLUP.

A group's text or array is one value in the end. Small groups use the
built-in aggregates. When the largest group exceeds ``hot_rows``, rows are
sorted across many partitions, each partition joins its share of a group and
only finished parts meet, so a group that holds most of the table is never
sorted or held row by row in one task. ``hot_rows=0`` does so without measuring.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mysem.functions.conditional import col
from mysem.operators import ordering

HOT_ROWS = 1_000_000


def largest_group(df: DataFrame, by: list[str]) -> int:
    """Rows of the largest group; counts are combined before they are shuffled."""
    return df.groupBy(*by).agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0


def group_concat(
    df: DataFrame,
    by: list[str],
    value,
    sep: str = ",",
    order=None,
    alias: str = "group_concat",
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """``GROUP_CONCAT(value [ORDER BY order] SEPARATOR sep)`` per group.

    NULLs are skipped; a group with nothing left gives NULL.
    """
    df = df.withColumn("__v", col(value).cast("string"))
    if hot_rows and largest_group(df, by) <= hot_rows:
        sort = ordering.items(order)
        df = df.select(*by, "__v", *[s.expr.alias(f"__o{i}") for i, s in enumerate(sort)])
        if not sort:
            return df.groupBy(*by).agg(F.listagg("__v", F.lit(sep)).alias(alias))
        inner = ", ".join(s.sql(f"__o{i}") for i, s in enumerate(sort))
        text = F.expr(f"listagg(__v, {_quoted(sep)}) within group (order by {inner})")
        return df.groupBy(*by).agg(text.alias(alias))
    parts = _parts(df.where("__v is not null"), by, order, lambda v: F.array_join(v, sep))
    text = parts.select(*by, F.array_join("__parts", sep).alias(alias))
    # Groups whose values are all NULL have no part.
    empty = df.groupBy(*by).agg(F.count("__v").alias("__n")).where("__n = 0").select(*by)
    return text.unionByName(empty.withColumn(alias, F.lit(None).cast("string")))


def group_concat_distinct(
    df: DataFrame,
    by: list[str],
    value,
    sep: str = ",",
    direction: str = "asc",
    alias: str = "group_concat",
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """``GROUP_CONCAT(DISTINCT value ORDER BY value direction SEPARATOR sep)`` per group.

    Duplicates are dropped before anything meets in a group.
    """
    values = df.select(*by, col(value).cast("string").alias("__v")).distinct()
    return group_concat(values, by, "__v", sep, (F.col("__v"), direction), alias, hot_rows)


def array_agg(
    df: DataFrame, by: list[str], value, order, alias: str = "array_agg", hot_rows: int = HOT_ROWS
) -> DataFrame:
    """All values of a group, NULLs included, as an array in ``order``."""
    df = df.withColumn("__v", col(value))
    if not hot_rows or largest_group(df, by) > hot_rows:
        parts = _parts(df, by, order, lambda v: v)
        return parts.select(*by, F.flatten("__parts").alias(alias))
    # The place in a sorted partition stands for the sort order of its rows;
    # groups meet whole in one partition, so it also orders the group.
    whole = (
        df.repartition(*by)
        .sortWithinPartitions(*ordering.columns(order))
        .select(*by, "__v", F.monotonically_increasing_id().alias("__at"))
    )
    return whole.groupBy(*by).agg(_in_order("__at", "__v").alias(alias))


def with_rollup(df: DataFrame, by: list[str], *aggs: Column) -> DataFrame:
    """``GROUP BY by WITH ROLLUP`` with any aggregates; every row is taken once for each level."""
    return df.rollup(*by).agg(*aggs)


# Per aggregate of rollup_levels: what is kept of each of the finest groups, and how that of several groups is put together.
_LEVELS = {
    "sum": ([F.sum], lambda p: F.sum(p)),
    "count": ([F.count], lambda p: F.coalesce(F.sum(p), F.lit(0))),
    "min": ([F.min], lambda p: F.min(p)),
    "max": ([F.max], lambda p: F.max(p)),
    "avg": ([lambda c: F.sum(c.cast("double")), F.count], lambda p, n: F.try_divide(F.sum(p), F.sum(n))),
}


def rollup_levels(df: DataFrame, by: list[str], **aggs: tuple[str, Column | str]) -> DataFrame:
    """``GROUP BY by WITH ROLLUP`` of sums, counts, minima, maxima and averages, as ``name=("sum", column)``; ``"*"`` counts rows.

    Rows are summed up once, by all columns of ``by``; the levels above are put together from those groups alone.
    """
    parts, merged = [], []
    for name, (kind, c) in aggs.items():
        keep, merge = _LEVELS[kind]
        c = F.lit(1) if isinstance(c, str) and c == "*" else F.col(c) if isinstance(c, str) else c
        names = [f"__{name}_{i}" for i in range(len(keep))]
        parts += [k(c).alias(n) for k, n in zip(keep, names)]
        merged.append(merge(*[F.col(f"`{n}`") for n in names]).alias(name))
    return df.groupBy(*by).agg(*parts).rollup(*by).agg(*merged)


def _in_order(at: str, v: str) -> Column:
    return F.transform(F.array_sort(F.collect_list(F.struct(at, v))), lambda s: s[v])


def _parts(df: DataFrame, by: list[str], order, build) -> DataFrame:
    """Each group's ``__parts``: what ``build`` makes of consecutive runs of its values."""
    if order is None:
        placed = df.select(*by, "__v", F.monotonically_increasing_id().alias("__at"))
    else:
        # The value spreads rows the order leaves tied.
        sort = [*[F.col(f"`{c}`") for c in by], *ordering.columns(order), F.col("__v")]
        placed = (
            df.repartitionByRange(*sort)
            .sortWithinPartitions(*sort)
            .select(*by, "__v", F.monotonically_increasing_id().alias("__at"))
        )
    runs = (
        placed.withColumn("__part", F.spark_partition_id())
        .groupBy(*by, "__part")
        .agg(build(_in_order("__at", "__v")).alias("__run"))
    )
    return runs.groupBy(*by).agg(_in_order("__part", "__run").alias("__parts"))


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"
