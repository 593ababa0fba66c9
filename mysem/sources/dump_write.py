"""Tables as INSERT statements."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mysem.functions.strings import escape_string
from mysem.sources.types import mysql_type

# Export mode -> statement head.
HEADS = {"insert": "INSERT INTO", "ignore": "INSERT IGNORE INTO", "replace": "REPLACE INTO"}

# Fixed value: rows in one INSERT statement.
ROWS_PER_STATEMENT = 100


def _quoted(c: Column) -> Column:
    return F.concat(F.lit("'"), c, F.lit("'"))


def _clock(c: Column) -> Column:
    """A day-time interval as ``[-]HH:mm:ss``."""
    part = lambda unit: F.abs(F.extract(F.lit(unit), c).cast("bigint"))
    hours = part("DAY") * 24 + part("HOUR")
    two = lambda n: F.when(n < 10, F.concat(F.lit("0"), n.cast("string"))).otherwise(n.cast("string"))
    sign = F.when(c < F.expr("interval '0' second"), F.lit("-")).otherwise(F.lit(""))
    return F.concat(sign, two(hours), F.lit(":"), two(part("MINUTE")), F.lit(":"), two(part("SECOND")))


def sql_literal(c: Column, t: T.DataType, hex_blob: bool = False) -> Column:
    """The SQL literal of a value of type ``t``."""
    text = c.cast("string")
    if isinstance(t, T.BooleanType):
        out = F.when(c, "1").otherwise("0")
    elif isinstance(t, (T.IntegralType, T.DecimalType)):
        out = text
    elif isinstance(t, (T.FloatType, T.DoubleType)):
        # NaN and the infinities have no bare form.
        out = F.when(F.isnan(c) | (F.abs(c) == float("inf")), _quoted(text)).otherwise(text)
    elif isinstance(t, T.BinaryType):
        digits = F.lower(F.hex(c))
        out = F.concat(F.lit("X"), _quoted(digits))
        if hex_blob:
            out = F.when(F.length(c) > 0, F.concat(F.lit("0x"), digits)).otherwise(out)
    elif isinstance(t, T.DayTimeIntervalType):
        out = _quoted(_clock(c))
    elif isinstance(t, (T.DateType, T.TimestampType, T.TimestampNTZType, T.YearMonthIntervalType)):
        out = _quoted(text)
    elif isinstance(t, T.ArrayType):
        out = _quoted(escape_string(F.to_json(c)))
    elif isinstance(t, T.StringType):
        out = _quoted(escape_string(text))
    elif t.simpleString().startswith("time("):
        out = _quoted(text)
    else:
        raise ValueError(f"no SQL literal for {t.simpleString()}")
    return F.when(c.isNull(), F.lit("NULL")).otherwise(out)


def insert_statements(
    df: DataFrame,
    table: str,
    mode: str = "insert",
    complete: bool = False,
    rows_per_stmt: int = ROWS_PER_STATEMENT,
    hex_blob: bool = False,
    quote_names: bool = True,
) -> DataFrame:
    """One row ``value`` per INSERT statement of up to ``rows_per_stmt`` rows.

    Literals are built by Spark expressions; Arrow only strings finished
    tuples together, batch by batch, without a shuffle. For tables of very
    long texts lower ``spark.sql.execution.arrow.maxRecordsPerBatch``.
    """
    name = (lambda n: f"`{n}`") if quote_names else str
    head = f"{HEADS[mode]} {name(table)}"
    if complete:
        head += f" ({', '.join(name(c) for c in df.columns)})"
    head += " VALUES "
    literals = [sql_literal(F.col(f"`{f.name}`"), f.dataType, hex_blob) for f in df.schema.fields]
    rows = df.select(F.concat(F.lit("("), F.concat_ws(",", *literals), F.lit(")")).alias("value"))
    if rows_per_stmt == 1:
        return rows.select(F.concat(F.lit(head), "value", F.lit(";")).alias("value"))

    def join_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting = None
        for batch in batches:
            rows = batch.column(0)
            rows = rows if waiting is None else pa.concat_arrays([waiting, rows])
            full = len(rows) - len(rows) % rows_per_stmt
            if full:
                yield statements(rows[:full])
            waiting = rows[full:]
        if waiting is not None and len(waiting):
            yield statements(waiting)

    def statements(rows: pa.Array) -> pa.RecordBatch:
        starts = pa.array([*range(0, len(rows), rows_per_stmt), len(rows)], pa.int32())
        joined = pc.binary_join(pa.ListArray.from_arrays(starts, rows), ",")
        return pa.RecordBatch.from_arrays([pc.binary_join_element_wise(head, joined, ";", "")], ["value"])

    return rows.mapInArrow(join_rows, "value string")


def create_table(df: DataFrame, table: str) -> str:
    """The CREATE TABLE statement of the exported columns."""
    cols = ",\n".join(f"  `{f.name}` {mysql_type(f.dataType)}" for f in df.schema.fields)
    return f"CREATE TABLE `{table}` (\n{cols}\n);"


def export_inserts(
    df: DataFrame,
    path: str,
    table: str,
    where: str | None = None,
    compression: str | None = None,
    **options,
) -> None:
    """Write ``df`` as a folder of dump files, one per task.

    ``options`` are those of :func:`insert_statements`.
    """
    if where:
        df = df.where(where)
    writer = insert_statements(df, table, **options).write
    if compression:
        writer = writer.option("compression", compression)
    writer.text(path)


def export_schema(df: DataFrame, path: str, table: str) -> None:
    """Write the CREATE TABLE statement as a dump file."""
    df.sparkSession.range(1).select(F.lit(create_table(df, table)).alias("value")).coalesce(1).write.text(path)
