"""Date and time functions.

Moments are wall-clock times without a zone (``timestamp_ntz``); zoned
columns are read in the session time zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from mysem.functions import formats
from mysem.functions.conditional import col, lit

# Interval units.
UNITS = ("MICROSECOND", "SECOND", "MINUTE", "HOUR", "DAY", "WEEK", "MONTH", "QUARTER", "YEAR")


def date_format(c, fmt: str) -> Column:
    """``DATE_FORMAT(c, fmt)``; ``fmt`` is compiled once, names are not padded."""
    c = col(c)
    pieces = []
    for kind, pattern in formats.output_pieces(fmt):
        if kind == "week":
            pieces.append(F.lpad(F.weekofyear(c).cast("string"), 2, "0"))
        else:
            pieces.append(F.date_format(c, pattern))
    if not pieces:
        return F.when(c.isNotNull(), F.lit(""))
    return pieces[0] if len(pieces) == 1 else F.concat(*pieces)


def str_to_date(c, fmt: str, on_error: str = "raise") -> Column:
    """``STR_TO_DATE(c, fmt)``; ``on_error`` is ``raise`` or ``null``."""
    parse = {"raise": F.to_timestamp, "null": F.try_to_timestamp}[on_error]
    pattern = formats.parse_pattern(fmt)
    return parse(col(c), pattern if on_error == "raise" else F.lit(pattern)).cast("timestamp_ntz")


def curdate() -> Column:
    return F.current_date()


def curtime() -> Column:
    return F.date_format(F.current_timestamp(), "HH:mm:ss")


def sysdate() -> Column:
    return F.localtimestamp()


def unix_timestamp(c) -> Column:
    """Seconds since 1970, rounded half away from zero."""
    micros = F.unix_micros(col(c).cast("timestamp"))
    half = F.when(micros < 0, F.lit(499999)).otherwise(F.lit(500000))
    return F.unix_seconds(F.timestamp_micros(micros + half))


def unix_timestamp_now() -> Column:
    return unix_timestamp(F.current_timestamp())


def from_unixtime(c) -> Column:
    return F.timestamp_seconds(col(c)).cast("timestamp_ntz")


def datediff(a, b) -> Column:
    """Days from ``b`` to ``a``."""
    return F.datediff(col(a).cast("date"), col(b).cast("date"))


def date_add(c, n, unit: str) -> Column:
    """``DATE_ADD(c, INTERVAL n unit)``; month ends clamp."""
    unit = unit.upper()
    if unit not in UNITS:
        raise ValueError(f"unsupported interval unit {unit}")
    return F.timestamp_add(unit, lit(n), col(c).cast("timestamp_ntz"))


def date_sub(c, n, unit: str) -> Column:
    """``DATE_SUB(c, INTERVAL n unit)``."""
    return date_add(c, -lit(n), unit)


def year(c) -> Column:
    return F.year(col(c))


def month(c) -> Column:
    return F.month(col(c))


def day(c) -> Column:
    return F.day(col(c))


def hour(c) -> Column:
    return F.hour(col(c))


def minute(c) -> Column:
    return F.minute(col(c))


def second(c) -> Column:
    """Seconds of the minute with their fraction, as decimal(8,6)."""
    return F.extract(F.lit("SECOND"), col(c).cast("timestamp_ntz"))


def dayofweek(c) -> Column:
    """1 is Sunday."""
    return F.dayofweek(col(c))


def dayofmonth(c) -> Column:
    return F.dayofmonth(col(c))


def dayofyear(c) -> Column:
    return F.dayofyear(col(c))


def week(c) -> Column:
    """ISO week number."""
    return F.weekofyear(col(c))


weekofyear = week


def last_day(c) -> Column:
    return F.last_day(col(c).cast("date"))


def date_part(c) -> Column:
    """``DATE(c)``."""
    return col(c).cast("date")


def time_part(c) -> Column:
    """``TIME(c)`` as text ``HH:mm:ss``, with the fraction when there is one."""
    return F.substring_index(col(c).cast("timestamp_ntz").cast("string"), " ", -1)
