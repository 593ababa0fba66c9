"""Consecutive numbers over a whole table or a hot group, without one big task.

Rows are range-partitioned by the requested order, so any group, however
large, is spread over many sorted partitions. A row's number is its place in
its partition plus the rows before that partition. The sorted rows are
written once to the shared folder, so every later pass sees the same places
even when executors are lost.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mysem.operators import ordering
from mysem.operators.grouping import largest_group
from mysem.session import written

PART = "__part"
PLACE = "__place"
BEFORE = "__before"

_EARLIER = (Window.unboundedPreceding, -1)


def sorted_places(df: DataFrame, order: list[Column]) -> DataFrame:
    """``df`` sorted by ``order``, with each row's partition and 0-based place inside it."""
    # The content hash spreads rows the order leaves tied.
    order = [*order, F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])]
    placed = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn(PLACE, F.monotonically_increasing_id())
    )
    # The id holds the partition in its upper 31 bits and the place in the lower 33.
    part = F.shiftright(PLACE, 33).cast("int")
    place = F.col(PLACE).bitwiseAND(F.lit((1 << 33) - 1))
    return written(placed.select(*df.columns, part.alias(PART), place.alias(PLACE)), "sorted")


def number_rows(df: DataFrame, order, alias: str, start: Column | int = 1) -> DataFrame:
    """Add ``alias``: start, start+1, ... over the whole table in ``order``."""
    placed = sorted_places(df, ordering.columns(order))
    sizes = placed.groupBy(PART).agg(F.count("*").alias("n"))
    # One row per partition, so this window and the broadcast stay small.
    earlier = F.sum("n").over(Window.orderBy(PART).rowsBetween(*_EARLIER))
    before = sizes.select(PART, F.coalesce(earlier, F.lit(0)).alias(BEFORE))
    start = start if isinstance(start, Column) else F.lit(start)
    number = (start + F.col(BEFORE) + F.col(PLACE)).cast("bigint")
    return placed.join(F.broadcast(before), PART).select(*df.columns, number.alias(alias))


def seq_in_group(df: DataFrame, by: list[str], order, alias: str, hot_rows: int = 5_000_000) -> DataFrame:
    """``row_number() over (partition by ... order by ...)`` that stands a huge group.

    The largest group is measured first. Up to ``hot_rows`` the plain window
    is used; beyond it, groups are cut along the sorted partitions.
    ``hot_rows=0`` does so without measuring.
    """
    order = ordering.columns(order)
    if hot_rows and largest_group(df, by) <= hot_rows:
        return df.withColumn(alias, F.row_number().over(Window.partitionBy(*by).orderBy(*order)))

    placed = sorted_places(df, [*[F.col(f"`{c}`") for c in by], *order])
    first = placed.withColumn("__first", F.min(PLACE).over(Window.partitionBy(*by, PART)))
    sizes = placed.groupBy(*by, PART).agg(F.count("*").alias("n"))
    earlier = F.sum("n").over(Window.partitionBy(*by).orderBy(PART).rowsBetween(*_EARLIER))
    # Only a partition's first group can have begun in an earlier partition,
    # so at most one row per partition is left to broadcast.
    begun = (
        sizes.withColumn(BEFORE, earlier)
        .where(F.col(BEFORE) > 0)
        .select(F.col(PART).alias("__bpart"), BEFORE, *[F.col(f"`{c}`").alias(f"__b{i}") for i, c in enumerate(by)])
    )
    same = F.col(PART) == F.col("__bpart")
    for i, c in enumerate(by):
        same = same & F.col(f"`{c}`").eqNullSafe(F.col(f"__b{i}"))
    number = F.col(PLACE) - F.col("__first") + 1 + F.coalesce(F.col(BEFORE), F.lit(0))
    return first.join(F.broadcast(begun), same, "left").select(*df.columns, number.cast("int").alias(alias))
