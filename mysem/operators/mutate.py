"""Key-based table changes as functions from DataFrames to a new DataFrame.

Nothing is changed in place: each function returns the table's next snapshot.
A NULL in a key never conflicts with anything, as in a unique index.
Duplicate keys in a source are an error unless the caller says which row wins.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mysem.functions.conditional import to_integral
from mysem.operators import ordering
from mysem.operators.components import components
from mysem.operators.numbering import number_rows
from mysem.session import written
from mysem.sources.snapshots import replace_table

_ROW = "__row"


def _has_null(keys: list[str]) -> Column:
    out = F.lit(False)
    for k in keys:
        out = out | F.col(f"`{k}`").isNull()
    return out


def _row(df: DataFrame) -> Column:
    return F.struct(*[F.col(f"`{c}`") for c in df.columns])


def _winner(df: DataFrame, keep: str, order) -> Column:
    """Aggregate that picks the first or last row; the row itself breaks ties.

    An aggregate is combined before the shuffle, so a key that fills the
    source is reduced to one row per task instead of meeting in one window.
    """
    items = ordering.items(order)
    if any(i.desc for i in items):
        raise ValueError("give an ascending order and choose keep='first' or keep='last'")
    ranked = F.struct(*[i.expr for i in items], _row(df).alias(_ROW))
    return (F.min if keep == "first" else F.max)(ranked)[_ROW]


def one_per_key(df: DataFrame, keys: list[str], keep: str | None = None, order=None) -> DataFrame:
    """One row for each key without NULLs, every row for the others.

    ``keep`` is ``first`` or ``last`` by ``order``; None makes a duplicate an error.
    """
    return _one_per_known_key(df, keys, keep, order).unionByName(df.where(_has_null(keys)))


def _one_per_known_key(df: DataFrame, keys: list[str], keep: str | None = None, order=None) -> DataFrame:
    known = df.where(~_has_null(keys))
    if keep is None:
        grouped = known.groupBy(*keys).agg(F.count("*").alias("n"), F.first(_row(df)).alias(_ROW))
        message = F.concat_ws(" ", F.lit("duplicate source key"), *[F.col(f"`{k}`").cast("string") for k in keys])
        grouped = grouped.withColumn(_ROW, F.when(F.col("n") > 1, F.raise_error(message)).otherwise(F.col(_ROW)))
    else:
        grouped = known.groupBy(*keys).agg(_winner(df, keep, order).alias(_ROW))
    return _unpacked(grouped, df.columns, keys)


def _unpacked(grouped: DataFrame, columns: list[str], keys: list[str]) -> DataFrame:
    # The keys come from the grouping, so a join on them needs no new shuffle.
    return grouped.select(*[F.col(f"`{c}`") if c in keys else F.col(f"{_ROW}.`{c}`").alias(c) for c in columns])


def _on(keys: list[str], left: str = "t", right: str = "s") -> Column:
    cond = F.lit(True)
    for k in keys:
        cond = cond & (F.col(f"{left}.`{k}`") == F.col(f"{right}.`{k}`"))
    return cond


def _distinct_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """The keys of ``df`` once each, without the partitioning they were counted in.

    The join that follows shuffles them anew, which is little, and so stays a
    plain join of two shuffles. Only such a join is split at run time when
    one key fills the other side.
    """
    return df.select(F.struct(*[F.col(f"`{k}`") for k in keys]).alias("k")).distinct().select("k.*")


def insert_ignore(target: DataFrame, source: DataFrame, keys: list[list[str]], order=None) -> DataFrame:
    """``INSERT IGNORE``: add source rows that conflict on none of the unique ``keys``.

    Within the source the first row by ``order`` wins.
    """
    fresh = source.select(*target.columns)
    if len(keys) == 1:
        # Both sides are down to one row per key before they meet, and rows
        # without a key go around the join.
        (k,) = keys
        known = _one_per_known_key(fresh, k, "first", order)
        new = known.join(target.select(*k).distinct(), k, "left_anti").select(*target.columns)
        return target.unionByName(new).unionByName(fresh.where(_has_null(k)))
    for k in keys:
        fresh = fresh.join(_distinct_keys(target, k), k, "left_anti")
    return target.unionByName(_first_without_conflict(fresh.select(*target.columns), keys, order))


# Rounds over all rows before connected rows are settled together, and the most rows of a connected part that one task settles.
ROUNDS = 2
SETTLED = 200_000


def _first_without_conflict(df: DataFrame, keys: list[list[str]], order) -> DataFrame:
    """Rows kept when rows arrive in order and each must differ in every key from those kept.

    In each round the rows that lead all their keys are kept and the rows that share a key with them are dropped; rows in between wait, because
    the row before them may itself be dropped. What still waits after some rounds are chains of conflicts. Their connected parts do not touch each other, so
    each is settled by one task in the order of its rows; only the rows of a part too large for that go on in rounds.
    """
    rank = F.struct(*[i.expr for i in ordering.items(order)], F.xxhash64(*df.columns), _row(df).alias(_ROW))
    held = F.lit(0)
    for k in keys:
        held = held + F.when(_has_null(k), 0).otherwise(1)
    kept = [df.where(held == 0)]
    # Equal rows conflict with each other, so one of them stands for all.
    waiting = written(df.where(held > 0).distinct(), "waiting")
    n_rounds = 0
    while not waiting.isEmpty():
        if n_rounds == ROUNDS:
            settled, waiting = _settle_parts(waiting, keys, rank)
            kept.append(settled)
            n_rounds += 1
            continue
        # The first row of each key comes from an aggregate, so a key that
        # fills the table costs one row per task.
        first = [waiting.where(~_has_null(k)).groupBy(*k).agg(F.min(rank).alias("r")).select("r") for k in keys]
        leads = reduce(DataFrame.union, first).groupBy("r").agg(F.count("*").alias("__leads"))
        leads = leads.select(f"r.{_ROW}.*", "__leads").where(F.col("__leads") == held)
        now = written(leads.select(*df.columns), "kept")
        kept.append(now)
        for k in keys:
            waiting = waiting.join(_distinct_keys(now, k), k, "left_anti")
        waiting = written(waiting.select(*df.columns), "waiting")
        n_rounds += 1
    return reduce(DataFrame.unionByName, kept)


def _settle_parts(waiting: DataFrame, keys: list[list[str]], rank: Column) -> tuple[DataFrame, DataFrame]:
    """The rows kept of all connected parts of at most ``SETTLED`` rows, and the rows of larger parts."""
    columns, number, part, at = waiting.columns, "__number", "__part_of", "__rank"
    rows = written(waiting.withColumn(number, F.monotonically_increasing_id()), "numbered")
    links = []
    for k in keys:
        known = rows.where(~_has_null(k))
        first = known.groupBy(*k).agg(F.min(number).alias("__least"))
        links.append(known.join(first, k).select(F.col(number).alias("a"), F.col("__least").alias("b")))
    parts = written(components(reduce(DataFrame.union, links)), "parts")
    large = written(parts.groupBy("label").agg(F.count("*").alias("n")).where(F.col("n") > SETTLED).select("label"), "large-parts")
    rows = rows.join(parts.withColumnsRenamed({"node": number, "label": part}), number, "left").withColumn(part, F.coalesce(part, number))
    rows = written(rows, "rows-of-parts")
    small = rows.join(large.withColumnRenamed("label", part), part, "left_anti")
    # A key as text, none if it has a NULL.
    texts = [F.when(~_has_null(k), F.to_json(F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(k)]))).alias(f"k{j}") for j, k in enumerate(keys)]
    n_keys = len(keys)

    def settle(batches):
        import pandas as pd

        here, used = None, [set() for _ in range(n_keys)]
        for batch in batches:
            out = []
            for place, label, *values in batch.itertuples(index=False):
                if label != here:
                    here, used = label, [set() for _ in range(n_keys)]
                if not any(v is not None and v in u for v, u in zip(values, used)):
                    out.append(place)
                    for v, u in zip(values, used):
                        if v is not None:
                            u.add(v)
            yield pd.DataFrame({number: pd.Series(out, dtype="int64")})

    thin = small.select(number, part, *texts, rank.alias(at)).repartition(part).sortWithinPartitions(part, at).drop(at)
    chosen = written(thin.mapInPandas(settle, f"{number} bigint"), "settled")
    settled = rows.join(chosen, number, "left_semi").select(*columns)
    return settled, written(rows.join(large.withColumnRenamed("label", part), part, "left_semi").select(*columns), "waiting")


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: list[str],
    set: dict[str, Column | str] | None = None,
    keep: str | None = None,
    order=None,
) -> DataFrame:
    """``INSERT ... ON DUPLICATE KEY UPDATE``.

    ``set`` maps columns to expressions over ``t`` (old row) and ``s`` (new
    row), such as ``"t.qty + s.qty"``; by default all non-key columns are taken
    from the source.
    """
    if set is None:
        set = {c: F.col(f"s.`{c}`") for c in target.columns if c not in keys}
    source = source.select(*target.columns)
    # Rows with a NULL key match nothing. They go around the join, which would
    # send all of them to one task.
    known, loose = ~_has_null(keys), _has_null(keys)
    t = target.where(known).withColumn("__t", F.lit(True)).alias("t")
    s = _one_per_known_key(source, keys, keep, order).withColumn("__s", F.lit(True)).alias("s")
    joined = t.join(s, _on(keys), "full")
    old, new = F.col("t.__t").isNotNull(), F.col("s.__s").isNotNull()
    out = []
    for c in target.columns:
        value = F.when(~old, F.col(f"s.`{c}`"))
        if c in set:
            changed = F.expr(set[c]) if isinstance(set[c], str) else set[c]
            value = value.when(new, changed.cast(target.schema[c].dataType))
        out.append(value.otherwise(F.col(f"t.`{c}`")).alias(c))
    return joined.select(*out).unionByName(target.where(loose)).unionByName(source.where(loose))


def replace_into(
    target: DataFrame, source: DataFrame, keys: list[str] | None, keep: str | None = None, order=None
) -> DataFrame:
    """``REPLACE INTO``: source rows take the place of target rows with their key."""
    source = source.select(*target.columns)
    if not keys:
        return target.unionByName(source)
    if all(c in keys for c in target.columns):
        return insert_ignore(target, source, [keys])
    kept = target.join(_distinct_keys(source, keys), keys, "left_anti").select(*target.columns)
    return kept.unionByName(one_per_key(source, keys, keep, order))


def update_join(
    target: DataFrame,
    source: DataFrame,
    on: dict[str, str],
    set: dict[str, Column | str],
    where: Column | str | None = None,
    source_where: Column | str | None = None,
    order=None,
) -> DataFrame:
    """``UPDATE t JOIN s ON ... SET ... WHERE ...``.

    ``on`` maps target to source columns; ``set`` and ``where`` are
    expressions over ``t`` and ``s``. Several source rows for one key are an
    error, unless ``order`` names the first one to take.
    """
    if order is not None and where is not None:
        raise ValueError("with an order, put the condition on the source alone (source_where)")
    if source_where is not None:
        source = source.where(source_where)
    keys = list(on.values())
    source = source.where(~_has_null(keys))
    if order is None:
        rows = source.groupBy(*keys).agg(F.count("*").alias("__n"), F.first(_row(source)).alias(_ROW))
    else:
        rows = source.groupBy(*keys).agg(F.lit(1).alias("__n"), _winner(source, "first", order).alias(_ROW))
    # As in _distinct_keys, the join must not inherit this partitioning.
    s = rows.select(f"{_ROW}.*", "__n").alias("s")
    t = target.alias("t")
    cond = F.lit(True)
    for tc, sc in on.items():
        cond = cond & (F.col(f"t.`{tc}`") == F.col(f"s.`{sc}`"))
    hit = F.col("s.__n").isNotNull()
    if where is not None:
        hit = hit & F.coalesce(F.expr(where) if isinstance(where, str) else where, F.lit(False))
    several = F.raise_error(F.lit("several source rows match one target row; give an order"))
    out = []
    for c in target.columns:
        old = F.col(f"t.`{c}`")
        if c in set:
            new = (F.expr(set[c]) if isinstance(set[c], str) else set[c]).cast(target.schema[c].dataType)
            out.append(F.when(F.col("s.__n") > 1, several).when(hit, new).otherwise(old).alias(c))
        else:
            out.append(old.alias(c))
    return t.join(s, cond, "left").select(*out)


def delete_join(
    target: DataFrame,
    source: DataFrame,
    on: dict[str, str],
    where: Column | str | None = None,
    source_where: Column | str | None = None,
) -> DataFrame:
    """``DELETE t FROM t JOIN s ON ... WHERE ...``: the target rows that stay.

    ``where`` is an expression over ``t`` and ``s``.
    """
    if source_where is not None:
        source = source.where(source_where)
    if where is None:
        source = _distinct_keys(source, list(dict.fromkeys(on.values())))
    cond = F.lit(True)
    for tc, sc in on.items():
        cond = cond & (F.col(f"t.`{tc}`") == F.col(f"s.`{sc}`"))
    if where is not None:
        cond = cond & (F.expr(where) if isinstance(where, str) else where)
    return target.alias("t").join(source.alias("s"), cond, "left_anti")


def append_named(target: DataFrame, rows: DataFrame, defaults: dict | None = None) -> DataFrame:
    """``INSERT ... SET``: append rows that give some columns; the others get their default or NULL."""
    unknown = [c for c in rows.columns if c not in target.columns]
    if unknown:
        raise ValueError(f"no such column: {', '.join(unknown)}")
    defaults = defaults or {}
    full = []
    for f in target.schema.fields:
        if f.name in rows.columns:
            value = F.col(f"`{f.name}`")
        else:
            value = defaults.get(f.name)
            value = value if isinstance(value, Column) else F.lit(value)
        full.append(value.cast(f.dataType).alias(f.name))
    return target.unionByName(rows.select(*full))


def insert_select(target: DataFrame, rows: DataFrame) -> DataFrame:
    """``INSERT INTO target SELECT ...``: columns are matched by position and cast."""
    if len(rows.columns) != len(target.columns):
        raise ValueError(f"{len(rows.columns)} values for {len(target.columns)} columns")
    names = zip(rows.columns, target.schema.fields)
    return target.unionByName(rows.select(*[F.col(f"`{r}`").cast(f.dataType).alias(f.name) for r, f in names]))


def truncate_reload(df: DataFrame, path: str) -> DataFrame:
    """``TRUNCATE`` and load: ``df``, which may read the table, becomes the whole content of the parquet table at ``path``."""
    replace_table(df, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def auto_increment(target: DataFrame, rows: DataFrame, id_col: str, order) -> DataFrame:
    """Append ``rows`` with ids that go on after the target's largest, in ``order``."""
    last = target.agg(F.coalesce(F.max(id_col), F.lit(0)).cast("bigint")).first()[0]
    numbered = number_rows(rows, order, id_col, start=last + 1)
    return append_named(target, numbered)


def next_auto_increment(target: DataFrame, id_col: str) -> DataFrame:
    """The id the next row would get."""
    return target.agg((F.coalesce(F.max(id_col), F.lit(0)) + 1).cast("bigint").alias("auto_increment"))


def modify_column(df: DataFrame, c: str, to: str, on_error: str = "raise") -> DataFrame:
    """``ALTER TABLE ... MODIFY c type`` for a Spark type name; numbers round into integer columns.

    With ``on_error="null"`` values that do not fit become NULL.
    """
    return df.withColumn(c, _cast(c, to, on_error == "raise"))


def _cast(c: str, to: str, strict: bool) -> Column:
    value = F.col(f"`{c}`")
    if to.lower() in ("tinyint", "smallint", "int", "bigint"):
        return to_integral(value, to, strict)
    return value.cast(to) if strict else value.try_cast(to)


def unconvertible(df: DataFrame, c: str, to: str) -> DataFrame:
    """How many values of ``c`` do not convert."""
    bad = F.col(f"`{c}`").isNotNull() & _cast(c, to, strict=False).isNull()
    return df.agg(F.count("*").alias("n_rows"), F.count_if(bad).alias("n_bad"))


def change_column(df: DataFrame, old: str, new: str, to: str) -> DataFrame:
    """``ALTER TABLE ... CHANGE old new type``."""
    return modify_column(df, old, to).withColumnRenamed(old, new)
