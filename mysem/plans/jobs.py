"""Moving and validating sets of tables."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mysem.operators import mutate
from mysem.session import new_path, written
from mysem.sources.dump_read import load_dump, read_dump
from mysem.sources.dump_write import export_inserts, export_schema
from mysem.sources.snapshots import read_table, recover, replace_table, row_count
from mysem.sources.types import split_by_schema


def _union(dfs: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, dfs)


def row_counts(tables: dict[str, DataFrame], total: bool = False) -> DataFrame:
    """``table_name, n_rows`` for each table; ``total`` adds a row named ``total``."""
    counts = _union(
        [df.agg(F.count("*").alias("n_rows")).select(F.lit(n).alias("table_name"), "n_rows") for n, df in tables.items()]
    )
    if not total:
        return counts
    summed = counts.rollup("table_name").agg(F.sum("n_rows").alias("n_rows"))
    return summed.fillna("total", ["table_name"])


def validate_counts(source: dict[str, DataFrame], target: dict[str, DataFrame]) -> DataFrame:
    """Row counts of both sides with a ``match`` flag; a table missing on one side does not match."""
    s = row_counts(source).withColumnRenamed("n_rows", "source_rows")
    t = row_counts(target).withColumnRenamed("n_rows", "target_rows")
    return s.join(t, "table_name", "full").withColumn("match", F.col("source_rows").eqNullSafe(F.col("target_rows")))


def checksum(df: DataFrame) -> list[Column]:
    """Row count and a checksum that does not depend on row or column order.

    Hashes skip NULLs, so the positions of the NULLs are hashed as well.
    """
    cols = [F.col(f"`{c}`") for c in sorted(df.columns)]
    row = F.xxhash64(*cols, *[c.isNull() for c in cols])
    total = F.coalesce(F.sum(row.cast("decimal(38,0)")), F.lit(0).cast("decimal(38,0)"))
    return [F.count("*").alias("n_rows"), total.alias("checksum")]


def checksums(tables: dict[str, DataFrame]) -> DataFrame:
    """``table_name, n_rows, checksum`` for each table."""
    return _union([df.agg(*checksum(df)).select(F.lit(n).alias("table_name"), "*") for n, df in tables.items()])


def validate_checksums(source: dict[str, DataFrame], target: dict[str, DataFrame]) -> DataFrame:
    """Checksums of both sides, of tables with equal column types, with a ``match`` flag."""
    for n in source.keys() & target.keys():
        types = [{f.name: f.dataType for f in side[n].schema.fields} for side in (source, target)]
        if types[0] != types[1]:
            raise ValueError(f"column types of {n} differ, checksums cannot be compared")
    s = checksums(source).withColumnsRenamed({"n_rows": "source_rows", "checksum": "source_sum"})
    t = checksums(target).withColumnsRenamed({"n_rows": "target_rows", "checksum": "target_sum"})
    same = F.col("source_rows").eqNullSafe(F.col("target_rows")) & F.col("source_sum").eqNullSafe(F.col("target_sum"))
    return s.join(t, "table_name", "full").withColumn("match", same)


def table_diff(source: DataFrame, target: DataFrame, keys: list[str], buckets: int = 4096) -> DataFrame:
    """Where two tables differ: the ``keys``, ``difference`` (missing, extra or changed) and ``changed_columns``.

    Rows are summed up by a hash of their key into ``buckets`` first, so equal tables cost a scan each; only rows of buckets that differ are compared
    by key. Rows may repeat a key: then the rows of a key are compared as a whole, and the columns named are those whose values differ, in any order.
    NULL is a key like any other.
    """
    if sorted(source.columns) != sorted(target.columns):
        raise ValueError("the tables have other columns")
    others = [c for c in source.columns if c not in keys]
    wide = lambda c: F.sum(c.cast("decimal(38,0)"))
    # Hashes skip NULLs, so that a value is one is hashed as well.
    value = {c: F.xxhash64(F.lit(c), F.col(f"`{c}`"), F.col(f"`{c}`").isNull()) for c in source.columns}
    bucket = F.pmod(F.xxhash64(*[value[k] for k in keys]), F.lit(buckets)).alias("__bucket")

    def summed(df: DataFrame, side: str) -> DataFrame:
        row = F.xxhash64(*[value[c] for c in sorted(source.columns)])
        return df.groupBy(bucket).agg(F.struct(F.count(F.lit(1)).alias("n"), wide(row).alias("sum")).alias(side))

    apart = summed(source, "s").join(summed(target, "t"), "__bucket", "full").where(~F.col("s").eqNullSafe(F.col("t"))).select("__bucket")
    apart = written(apart, "buckets")

    def by_key(df: DataFrame, side: str) -> DataFrame:
        # At most ``buckets`` numbers.
        rows = df.withColumn("__bucket", bucket).join(F.broadcast(apart), "__bucket", "left_semi")
        row = F.xxhash64(*[value[c] for c in sorted(source.columns)])
        whole = F.struct(F.count(F.lit(1)).alias("n"), wide(row).alias("sum"), *[wide(value[c]).alias(f"c{i}") for i, c in enumerate(others)])
        named = [F.col(f"`{k}`").alias(f"{side}{i}") for i, k in enumerate(keys)]
        return rows.groupBy(*named).agg(whole.alias(side))

    same = reduce(Column.__and__, [F.col(f"s{i}").eqNullSafe(F.col(f"t{i}")) for i in range(len(keys))])
    both = by_key(source, "s").join(by_key(target, "t"), same, "full")
    kind = F.when(F.col("t").isNull(), "missing").when(F.col("s").isNull(), "extra").otherwise("changed")
    changed = F.array_compact(F.array(*[F.when(F.col(f"s.c{i}") != F.col(f"t.c{i}"), F.lit(c)) for i, c in enumerate(others)], F.lit(None).cast("string")))
    shown = [F.when(F.col("s").isNotNull(), F.col(f"s{i}")).otherwise(F.col(f"t{i}")).alias(k) for i, k in enumerate(keys)]
    found = both.where(~F.col("s").eqNullSafe(F.col("t")))
    return found.select(*shown, kind.alias("difference"), F.when(kind == "changed", changed).otherwise(F.array().cast("array<string>")).alias("changed_columns"))


def fk_orphans(child: DataFrame, fk: list[str], parent: DataFrame, pk: list[str]) -> DataFrame:
    """Foreign key values without a parent row, and how many child rows hold them.

    Child rows are counted per value before the join, so a value that fills
    the child table costs one row per task. Keys with a NULL pass.
    """
    held = child.dropna("any", subset=fk).groupBy(*fk).agg(F.count("*").alias("n_rows"))
    same = reduce(Column.__and__, [F.col(f"c.`{f}`") == F.col(f"p.`{p}`") for f, p in zip(fk, pk)])
    return held.alias("c").join(parent.select(*pk).distinct().alias("p"), same, "left_anti")


def parents_first(tables: list[str], parents: dict[str, list[str]] | None) -> list[str]:
    """Table names by name, each after the tables it refers to; cycles are cut."""
    out: list[str] = []

    def visit(t: str, path: tuple[str, ...]) -> None:
        if t in out or t in path or t not in tables:
            return
        for p in sorted((parents or {}).get(t, [])):
            visit(p, (*path, t))
        out.append(t)

    for t in sorted(tables):
        visit(t, ())
    return out


def _each(names: list[str], job: Callable, spark: SparkSession, parallel: int) -> list:
    """Run ``job`` per table, a few at a time, so small tables do not leave executors idle."""
    with ThreadPoolExecutor(max(parallel, 1)) as pool:
        return list(pool.map(inheritable_thread_target(spark)(job), names))


def _selected(names: list[str], only: list[str] | None, ignore: list[str] | None) -> list[str]:
    return [n for n in names if (not only or n in only) and n not in (ignore or [])]


def dump_all_tables(
    tables: dict[str, DataFrame],
    path: str,
    only: list[str] | None = None,
    ignore: list[str] | None = None,
    where: str | None = None,
    schema: bool = True,
    data: bool = True,
    parents: dict[str, list[str]] | None = None,
    parallel: int = 4,
    **options,
) -> list[str]:
    """Export tables as dump folders ``path/NNN-table-schema`` and ``path/NNN-table-data``.

    Folder names sort parents first. Returns the exported names.
    """
    names = parents_first(_selected(list(tables), only, ignore), parents)

    def dump(n: str) -> None:
        place = f"{path}/{names.index(n):03d}-{n}"
        if schema:
            export_schema(tables[n], f"{place}-schema", n)
        if data:
            export_inserts(tables[n], f"{place}-data", n, where=where, **options)

    if names:
        _each(names, dump, tables[names[0]].sparkSession, parallel)
    return names


def by_table(statements: DataFrame) -> DataFrame:
    """Data statements written once, one folder per table, so each table reads only its own."""
    path = new_path(statements.sparkSession, "statements")
    statements.where("category = 'data' and table is not null").write.partitionBy("table").parquet(path)
    return statements.sparkSession.read.schema(statements.schema).parquet(path)


def migrate_tables(
    spark: SparkSession,
    source: str | dict[str, DataFrame],
    target: str,
    schemas: dict[str, T.StructType] | None = None,
    declared: dict[str, dict[str, str]] | None = None,
    keys: dict[str, list[str]] | None = None,
    tables: list[str] | None = None,
    exclude: list[str] | None = None,
    mode: str = "truncate",
    validate: bool = True,
    force: bool = False,
    parallel: int = 4,
) -> DataFrame:
    """Load tables into parquet tables ``target/<table>``.

    ``source`` is a dump path or a dict of DataFrames. A dump needs, per
    table, a Spark schema or MySQL declarations. ``mode`` is ``truncate``
    (replace the table), ``append``, ``ignore`` or ``replace``; the last two
    apply the rows by ``keys`` to the table. Tables are swapped as a whole, so a
    run that fails leaves the old one. Rows with a value that does not fit its
    declaration go, as texts with the names of the failing columns, to
    ``target/_rejects/<table>``, which is replaced each time. A dump's rows are
    parsed once. With ``force`` a failing table is reported and the others go on.

    Returns ``table_name, source_rows, target_rows, rejected_rows, match, error``.
    """
    if mode not in ("truncate", "append", "ignore", "replace"):
        raise ValueError(f"no mode {mode}")
    schemas, declared, keys = schemas or {}, declared or {}, keys or {}
    if isinstance(source, dict):
        names = list(source)
    else:
        names = list(dict.fromkeys([*schemas, *declared]))
        source = by_table(read_dump(spark, source))

    def load(n: str) -> tuple:
        try:
            rows, counts = _source_rows(spark, source, n, schemas, declared, f"{target}/_rejects/{n}")
            return (n, *_load_one(rows, counts, f"{target}/{n}", mode, keys.get(n), validate), None)
        except Exception as e:
            if not force:
                raise
            return (n, None, None, None, False, str(e)[:500])

    report = _each(_selected(names, tables, exclude), load, spark, parallel)
    return spark.createDataFrame(
        report,
        "table_name string, source_rows bigint, target_rows bigint, rejected_rows bigint, match boolean, error string",
    )


def _count() -> Column:
    return F.count(F.lit(1)).alias("n")


def _source_rows(spark, source, name: str, schemas, declared, rejects_path: str) -> tuple[DataFrame, dict | None]:
    """The rows to load, and if they were counted as they were written, how many there are and how many were rejected."""
    if isinstance(source, dict):
        return source[name], None
    if name not in declared:
        return load_dump(spark, None, name, schemas[name], statements=source), None
    text = T.StructType([T.StructField(c, T.StringType()) for c in declared[name]])
    # Accepted and rejected rows are written in one pass, a folder each.
    split = split_by_schema(load_dump(spark, None, name, text, statements=source), declared[name])
    seen, path = Observation(), new_path(spark, "typed")
    bad = F.size("rejected_columns") > 0
    split.observe(seen, _count(), F.count_if(bad).alias("rejected")).withColumn("bad", bad).write.partitionBy("bad").parquet(path)
    both = spark.read.schema(T.StructType([*split.schema.fields, T.StructField("bad", T.BooleanType())])).parquet(path)
    counts = seen.get
    replace_table(both.where("bad").select("given.*", "rejected_columns"), rejects_path)
    return both.where("not bad").select("typed.*"), {"n": counts["n"] - counts["rejected"], "rejected": counts["rejected"]}


def _load_one(rows: DataFrame, counts: dict | None, path: str, mode: str, keys: list[str] | None, validate: bool):
    spark = rows.sparkSession
    rejected = counts["rejected"] if counts else 0
    if mode == "truncate":
        source_rows = expected = replace_table(rows, path, _count())["n"]
    elif mode == "append":
        recover(spark, path)
        expected, seen = row_count(spark, path), Observation()
        rows.observe(seen, _count()).write.mode("append").parquet(path)
        source_rows = seen.get["n"]
        expected += source_rows
    else:
        # Several branches of the plan read the rows, so they are written and counted first.
        if counts is None:
            seen, staged = Observation(), new_path(spark, "rows")
            rows.observe(seen, _count()).write.parquet(staged)
            rows, counts = spark.read.schema(rows.schema).parquet(staged), seen.get
        source_rows = counts["n"]
        old = read_table(spark, path, rows.schema)
        new = mutate.insert_ignore(old, rows, [keys]) if mode == "ignore" else mutate.replace_into(old, rows, keys)
        expected = replace_table(new, path, _count())["n"]
    if not validate:
        return source_rows, None, rejected, None
    after = row_count(spark, path)
    return source_rows, after, rejected, after == expected and rejected == 0
