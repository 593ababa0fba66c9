"""Tables replaced as a whole: written beside the old one, then swapped by renaming folders.

Until the swap readers see the old table, and an interrupted run leaves it in place. The old folder goes only when the new one has its name. A run
that ends between the two renames leaves the old folder under a hidden name; the next call for that table puts it back. A table has one writer at
a time. Where the file system copies to rename (object stores), the swap takes as long as the copy.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _files(spark: SparkSession, path: str):
    """The Hadoop file system of ``path``, a maker of its paths, and the parent and name of ``path``."""
    make = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    at = make(path.rstrip("/"))
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), make, str(at.getParent()), at.getName()


def _rename(fs, make, old: str, new: str) -> None:
    if not fs.rename(make(old), make(new)):
        raise OSError(f"cannot rename {old} to {new}")


def recover(spark: SparkSession, path: str) -> None:
    """Put the old table back if a run ended in the middle of a swap; drop what is left of finished ones."""
    fs, make, parent, name = _files(spark, path)
    held = [str(s.getPath()) for s in fs.globStatus(make(f"{parent}/.{name}.old-*")) or []]
    if held and not fs.exists(make(path)):
        _rename(fs, make, held.pop(), path)
    for old in held:
        fs.delete(make(old), True)


def replace_table(df: DataFrame, path: str, *counts: Column) -> dict:
    """Make ``df``, which may read the table, the content of the Parquet table at ``path``. Gives the values of ``counts``, taken as the rows are written."""
    spark = df.sparkSession
    recover(spark, path)
    fs, make, parent, name = _files(spark, path)
    run = uuid.uuid4().hex
    new, old = f"{parent}/.{name}.new-{run}", f"{parent}/.{name}.old-{run}"
    seen = Observation()
    try:
        (df.observe(seen, *counts) if counts else df).write.parquet(new)
        if fs.exists(make(path)):
            _rename(fs, make, path, old)
    except BaseException:
        fs.delete(make(new), True)
        raise
    try:
        _rename(fs, make, new, path)
    except BaseException:
        recover(spark, path)
        raise
    fs.delete(make(old), True)
    spark.catalog.refreshByPath(path)
    return seen.get if counts else {}


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The table at ``path``, without rows if there is none yet."""
    recover(spark, path)
    try:
        spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def row_count(spark: SparkSession, path: str) -> int:
    return read_table(spark, path, T.StructType()).agg(F.count(F.lit(1))).first()[0]
