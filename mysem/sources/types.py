"""MySQL column types and the Spark types that hold them."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mysem.functions.conditional import zero_date_to_null

# Type name -> signed Spark type, unsigned Spark type.
INTEGERS = {
    "tinyint": (T.ShortType(), T.ShortType()),
    "smallint": (T.ShortType(), T.IntegerType()),
    "mediumint": (T.IntegerType(), T.IntegerType()),
    "int": (T.IntegerType(), T.LongType()),
    "integer": (T.IntegerType(), T.LongType()),
    "bigint": (T.LongType(), T.DecimalType(20, 0)),
    "year": (T.ShortType(), T.ShortType()),
}

# Type name -> Spark type, for types without a size of meaning.
PLAIN = {
    "float": T.FloatType(),
    "double": T.DoubleType(),
    "real": T.DoubleType(),
    "bool": T.BooleanType(),
    "boolean": T.BooleanType(),
    "varchar": T.StringType(),
    "char": T.StringType(),
    "tinytext": T.StringType(),
    "text": T.StringType(),
    "mediumtext": T.StringType(),
    "longtext": T.StringType(),
    "enum": T.StringType(),
    "set": T.StringType(),
    "json": T.StringType(),
    "time": T.StringType(),
    "tinyblob": T.BinaryType(),
    "blob": T.BinaryType(),
    "mediumblob": T.BinaryType(),
    "longblob": T.BinaryType(),
    "binary": T.BinaryType(),
    "varbinary": T.BinaryType(),
    "datetime": T.TimestampNTZType(),
    "timestamp": T.TimestampNTZType(),
    "date": T.DateType(),
}

# Spark type name -> type shown for a column.
SHOWN = {
    "boolean": "tinyint(1)",
    "tinyint": "smallint(6)",
    "smallint": "smallint(6)",
    "int": "int(11)",
    "bigint": "bigint(20)",
    "float": "float",
    "double": "double",
    "string": "text",
    "binary": "blob",
    "date": "date",
    "timestamp": "datetime",
    "timestamp_ntz": "datetime",
    "variant": "json",
}

# How hexadecimal and bit literals begin.
HEX_STARTS = ("0x", "0X", "x'", "X'")
BIT_STARTS = ("0b", "0B", "b'", "B'")

_DECLARED = re.compile(r"(?is)^\s*(\w+)\s*(?:\((.*)\))?\s*((?:unsigned|signed|zerofill|\s)*)$")


def spark_type(declared: str) -> T.DataType:
    """The Spark type for a MySQL declaration such as ``"int(10) unsigned"``."""
    m = _DECLARED.match(declared)
    if not m:
        raise ValueError(f"not a column type: {declared!r}")
    name, args, flags = m.group(1).lower(), m.group(2), m.group(3).lower()
    unsigned = "unsigned" in flags or "zerofill" in flags
    if name in INTEGERS:
        return INTEGERS[name][unsigned]
    if name in ("decimal", "numeric"):
        size = [int(a) for a in (args or "10,0").split(",")]
        return T.DecimalType(size[0], size[1] if len(size) > 1 else 0)
    if name == "bit":
        return T.BooleanType() if int(args or 1) == 1 else T.LongType()
    if name in PLAIN:
        return PLAIN[name]
    raise ValueError(f"no Spark type for {declared!r}")


def schema_of(declared: dict[str, str]) -> T.StructType:
    """Column name -> MySQL declaration, as a Spark schema."""
    return T.StructType([T.StructField(c, spark_type(d)) for c, d in declared.items()])


def enum_labels(declared: str) -> list[str]:
    """The labels of an ``enum(...)`` or ``set(...)`` declaration."""
    m = _DECLARED.match(declared)
    if not m or m.group(1).lower() not in ("enum", "set"):
        raise ValueError(f"not an enum or set: {declared!r}")
    return [q.replace("''", "'") for q in re.findall(r"'((?:[^']|'')*)'", m.group(2) or "")]


def mysql_type(t: T.DataType) -> str:
    """The MySQL name of a Spark type."""
    if isinstance(t, (T.CharType, T.VarcharType)):
        return f"{t.typeName()}({t.length})"
    if isinstance(t, T.DecimalType):
        return f"decimal({t.precision},{t.scale})"
    if isinstance(t, T.ArrayType):
        return f"{mysql_type(t.elementType)} /* array */"
    if isinstance(t, (T.DayTimeIntervalType, T.YearMonthIntervalType)):
        return "varchar(255)"
    name = t.simpleString()
    if name.startswith("time("):
        return "time"
    if name not in SHOWN:
        raise ValueError(f"no MySQL type for {name}")
    return SHOWN[name]


def typed(text: Column, to: T.DataType, strict: bool = True) -> Column:
    """Column text as ``to``: zero dates are NULL, booleans may be 0/1, bits and hex are read.

    With ``strict`` a bad value is an error, else it is NULL.
    """
    cast = (lambda c: c.cast(to)) if strict else (lambda c: c.try_cast(to))
    if isinstance(to, T.StringType):
        return text
    if isinstance(to, T.BinaryType):
        start = F.substring(text, 1, 2)
        digits = F.regexp_replace(F.substring(text, 3, 1 << 30), "'$", "")
        return F.when(start.isin(*HEX_STARTS), F.unhex(digits)).otherwise(F.encode(text, "UTF-8"))
    if isinstance(to, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return cast(zero_date_to_null(text))
    if isinstance(to, T.ArrayType):
        return F.from_json(text, to, {"mode": "FAILFAST" if strict else "PERMISSIVE"})
    if isinstance(to, (T.BooleanType, T.IntegralType, T.DecimalType)):
        # The closing quote of b'1' may have been stripped already.
        start = F.substring(text, 1, 2)
        digits = F.regexp_replace(F.substring(text, 3, 1 << 30), "'$", "")
        coded = F.when(start.isin(*HEX_STARTS), F.conv(digits, 16, 10)).otherwise(F.conv(digits, 2, 10))
        return F.when(start.isin(*HEX_STARTS, *BIT_STARTS), cast(coded)).otherwise(cast(text))
    return cast(text)


def split_by_schema(df: DataFrame, declared: dict[str, str], defaults: dict[str, str] | None = None) -> DataFrame:
    """``typed``, the text columns of ``df`` cast to their MySQL declarations, ``given``, the rows as they are if a value does not fit, and
    ``rejected_columns``, the names of the failing columns. ``defaults`` are texts that stand in for NULL.
    """
    schema = schema_of(declared)
    defaults = defaults or {}
    values, failing = [], []
    for f in schema.fields:
        raw = F.col(f"`{f.name}`").cast("string")
        if f.name in defaults:
            raw = F.coalesce(raw, F.lit(defaults[f.name]))
        value = typed(raw, f.dataType, strict=False)
        values.append(value.alias(f.name))
        wanted = zero_date_to_null(raw) if isinstance(f.dataType, (T.DateType, T.TimestampNTZType)) else raw
        failing.append(F.when(wanted.isNotNull() & value.isNull(), F.lit(f.name)))
    bad = F.array_compact(F.array(*failing))
    given = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    return df.select(F.struct(*values).alias("typed"), F.when(F.size(bad) > 0, given).alias("given"), bad.alias("rejected_columns"))


def apply_mysql_schema(
    df: DataFrame, declared: dict[str, str], defaults: dict[str, str] | None = None
) -> tuple[DataFrame, DataFrame]:
    """Cast the text columns of ``df`` to their MySQL declarations.

    Returns the typed rows, and the rows with a value that does not fit,
    unchanged and with the names of the failing columns. ``defaults`` are
    texts that stand in for NULL.
    """
    split = split_by_schema(df, declared, defaults)
    good = split.where(F.size("rejected_columns") == 0).select("typed.*")
    return good, split.where(F.size("rejected_columns") > 0).select("given.*", "rejected_columns")
