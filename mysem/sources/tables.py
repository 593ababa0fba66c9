"""Tables and delimited files."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mysem.session import written
from mysem.sources.dump_lex import joined


def scan(spark: SparkSession, path: str, where: str | None = None) -> DataFrame:
    """``SELECT * FROM table [WHERE ...]`` over a parquet table; the predicate reaches the scan."""
    df = spark.read.parquet(path)
    return df.where(F.expr(where)) if where else df


# Stands for "" between quotes while a file is read.
_EMPTY = "\x01empty\x01"


def load_data(
    spark: SparkSession, path: str, schema: T.StructType, sep: str = ",", multi_line: bool = False
) -> DataFrame:
    """``LOAD DATA INFILE``: delimited text with a header; a malformed row is an error.

    An empty field without quotes is NULL, one in quotes is an empty text.
    ``multi_line`` allows line feeds between quotes; a file is still read by many tasks.
    """
    options = {"mode": "FAILFAST", "sep": sep, "quote": '"', "escape": '"', "nullValue": "", "emptyValue": _EMPTY}
    if multi_line:
        df = _parsed(quoted_records(spark, path), schema, options, header=True)
    else:
        df = spark.read.schema(schema).options(header=True, enforceSchema=False, **options).csv(path)
    texts = [f.name for f in schema.fields if isinstance(f.dataType, T.StringType)]
    return df.withColumns({c: F.when(F.col(f"`{c}`") == _EMPTY, "").otherwise(F.col(f"`{c}`")) for c in texts})


def quoted_records(spark: SparkSession, path: str) -> DataFrame:
    """The records of delimited files whose quotes may hold line feeds: ``file, block, seq, text``, in the order of ``block, seq`` of a file.

    Between quotes or not is the parity of the quotes before. Parities of the stretches of a file that tasks read, summed from its beginning, give
    each stretch its first one; records that reach over stretches are put together from their pieces.
    """
    lines = spark.read.text(path, lineSep="\n").select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("seq"),
        F.col("value"),
    )
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    sums = lines.groupBy("file", "block").agg(F.sum(quotes).alias("n"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    # One row a stretch, some 100 bytes; the join must not move the lines.
    inside = written(sums.select("file", "block", (F.coalesce(F.sum("n").over(before), F.lit(0)) % 2).cast("int").alias("inside")), "parities")
    pieces = lines.join(F.broadcast(inside), ["file", "block"]).select("file", "block", "seq", "value", "inside")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, out, held, place, any_end, odd = None, [], [], 0, False, 0
        names = ["file", "block", "seq", "part", "edge", "text"]
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.string()]

        def batch_of() -> pa.RecordBatch:
            done = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)
            out.clear()
            return done

        for batch in batches:
            counts = pc.count_substring(batch.column("value"), '"').to_pylist()
            for file, block, seq, value, inside, n in zip(*(batch.column(c).to_pylist() for c in ("file", "block", "seq", "value", "inside")), counts):
                if (file, block) != here:
                    if here is not None:
                        out.append((*here, place, 0, 2, "".join(held)))
                    here, held, any_end, odd = (file, block), [], False, inside
                if not held:
                    place = seq
                odd ^= n & 1
                held.append(value + "\n" if odd else value)
                if not odd:
                    out.append((*here, place, 0, 0 if any_end else 1, "".join(held)))
                    held, any_end = [], True
            if out:
                yield batch_of()
        if here is not None:
            out.append((*here, place, 0, 2, "".join(held)))
            yield batch_of()

    cuts = written(pieces.mapInArrow(cut, "file string, block bigint, seq bigint, part int, edge int, text string"), "csv-pieces")
    # A last line feed outside quotes leaves nothing open.
    return joined(cuts).where("text <> '' and text <> '\r'").select("file", "block", "seq", F.regexp_replace("text", r"\r\z", "").alias("text"))


def _parsed(records: DataFrame, schema: T.StructType, options: dict, header: bool) -> DataFrame:
    """The fields of each record. The first record of a file must name the columns, if there is a header."""
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    rows = records
    if header:
        first = records.groupBy("file").agg(F.min(F.struct("block", "seq")).alias("first"))
        rows = records.join(first, "file").withColumn("is_first", F.struct("block", "seq") == F.col("first"))
        names = ", ".join(f"`{i}` string" for i in range(len(schema.fields)))
        found = F.from_csv("text", names, options)
        same = F.concat_ws("\x01", *[found[str(i)] for i in range(len(schema.fields))]) == "\x01".join(schema.names)
        wrong = F.raise_error(F.concat(F.lit("the header does not name the columns: "), F.substring("text", 1, 200)))
        rows = rows.where(F.when(F.col("is_first"), F.when(same, F.lit(False)).otherwise(wrong)).otherwise(F.lit(True)))
    return rows.select(F.from_csv("text", ddl, options).alias("row")).select("row.*")


def write_tsv(df: DataFrame, path: str, header: bool = True) -> None:
    """Tab-separated text with a header and the word NULL for NULLs.

    Texts with a tab, quote or line feed, and empty ones, stand in quotes.
    """
    # As text a moment shows its fraction only when there is one.
    moments = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType))]
    (
        df.withColumns({c: F.col(f"`{c}`").cast("string") for c in moments})
        .write.option("sep", "\t")
        .option("header", header)
        .option("nullValue", "NULL")
        .option("emptyValue", '""')
        .option("quote", '"')
        .option("escape", '"')
        .csv(path)
    )


def read_tsv(
    spark: SparkSession, path: str, schema: T.StructType, header: bool = True, multi_line: bool = False
) -> DataFrame:
    """Read what :func:`write_tsv` wrote; ``multi_line`` as in :func:`load_data`."""
    options = {"mode": "FAILFAST", "sep": "\t", "nullValue": "NULL", "emptyValue": "", "quote": '"', "escape": '"'}
    if multi_line:
        return _parsed(quoted_records(spark, path), schema, options, header)
    return spark.read.schema(schema).options(header=header, **options).csv(path)
