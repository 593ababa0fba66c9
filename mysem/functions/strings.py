"""String functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from mysem.functions.conditional import col, lit

# Characters written as an escape, in the order they are escaped.
ESCAPES = (
    ("\\", "\\\\"),
    ("'", "''"),
    ("\n", "\\n"),
    ("\r", "\\r"),
    ("\t", "\\t"),
    ("\x00", "\\0"),
    ("\x1a", "\\Z"),
)


def locate(sub, s) -> Column:
    """``LOCATE(sub, s)``: 1-based position, 0 if absent. ``sub`` may be a literal."""
    return F.call_function("position", lit(sub), col(s))


def instr(s, sub) -> Column:
    """``INSTR(s, sub)``: :func:`locate` with the arguments swapped."""
    return locate(sub, s)


def char_fn(n) -> Column:
    """``CHAR(n)``: the character with code point ``n``."""
    n = lit(n)
    wide = F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32")
    return F.when(n > 127, wide).otherwise(F.char(n))


def space(n) -> Column:
    return F.repeat(F.lit(" "), lit(n))


def hex_str(c) -> Column:
    """Lower-case hexadecimal of the bytes of ``c``."""
    return F.lower(F.hex(col(c)))


def unhex_str(c) -> Column:
    """Bytes of a hexadecimal text; a malformed text is an error."""
    c = col(c)
    bad = c.isNotNull() & ((F.length(c) % 2 != 0) | F.unhex(c).isNull())
    return F.when(bad, F.raise_error(F.concat(F.lit("invalid hexadecimal data: "), c))).otherwise(F.unhex(c))


def escape_string(c) -> Column:
    """Escape a text for use between single quotes."""
    out = col(c)
    for raw, written in ESCAPES:
        out = F.replace(out, F.lit(raw), F.lit(written))
    return out


def unescape_string(c) -> Column:
    """Undo the escapes of a text that stood between single quotes.

    Splitting on doubled backslashes first leaves pieces in which every
    backslash starts an escape, so the replacements cannot interfere.
    """
    c = col(c)

    def piece(p: Column) -> Column:
        p = F.replace(p, F.lit("''"), F.lit("'"))
        p = F.replace(p, F.lit("\\'"), F.lit("'"))
        for raw, written in ESCAPES[2:]:
            p = F.replace(p, F.lit(written), F.lit(raw))
        p = F.replace(p, F.lit("\\b"), F.lit("\b"))
        return F.regexp_replace(p, r"(?s)\\([^%_])", "$1")

    full = F.array_join(F.transform(F.split(c, r"\\\\"), piece), "\\")
    return F.when(F.contains(c, F.lit("\\")), full).otherwise(F.replace(c, F.lit("''"), F.lit("'")))
