"""Predicates, conditionals, set lookups and casts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The date literals that mean "no date".
ZERO_DATES = ("0000-00-00", "0000-00-00 00:00:00")

# The phonetic code of each letter A to Z.
SOUNDEX_CODES = "01230120022455012623010202"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def lit(v) -> Column:
    return v if isinstance(v, Column) else F.lit(v)


def null_safe_eq(a, b) -> Column:
    """``a <=> b``."""
    return col(a).eqNullSafe(col(b))


def like_ci(c, pattern: str) -> Column:
    """``c LIKE pattern``, ignoring case."""
    return col(c).ilike(pattern)


def not_like_ci(c, pattern: str) -> Column:
    return ~like_ci(c, pattern)


def regexp_ci(c, pattern) -> Column:
    """``c REGEXP pattern``, ignoring case; a dot also matches a line feed."""
    flags = "(?isu)"
    p = F.concat(F.lit(flags), pattern) if isinstance(pattern, Column) else F.lit(flags + pattern)
    return F.regexp_like(col(c), p)


def not_regexp_ci(c, pattern) -> Column:
    return ~regexp_ci(c, pattern)


def soundex(c) -> Column:
    """Four-character code; letters equal to the character just before them are skipped."""
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    digits = "0123456789"
    stand_in = "abcdefghij"
    s = F.upper(F.regexp_replace(col(c), "^[^A-Za-z]+", ""))
    codes = F.translate(s, letters + digits, SOUNDEX_CODES + stand_in)
    repeats = "|".join(f"(?<=[{d}{a}]){d}+" for d, a in zip(digits[:7], stand_in))
    tail = F.substring(F.regexp_replace(F.substring(F.regexp_replace(codes, repeats, "x"), 2, 1 << 30),
                                        "[^1-6]", ""), 1, 3)
    return F.when(s == "", F.lit("")).otherwise(
        F.concat(F.substring(s, 1, 1), F.rpad(tail, 3, "0")))


def sounds_like(a, b) -> Column:
    """``a SOUNDS LIKE b``."""
    return soundex(a) == soundex(b)


def if_expr(cond, a, b) -> Column:
    """``IF(cond, a, b)``; a NULL condition counts as false."""
    return F.when(cond, a).otherwise(b)


def ifnull(a, b) -> Column:
    return F.coalesce(col(a), lit(b))


def isnull(c) -> Column:
    return col(c).isNull()


def zero_date_to_null(c) -> Column:
    return F.when(~F.coalesce(col(c).isin(*ZERO_DATES), F.lit(False)), col(c))


def zero_dates_to_null(df: DataFrame, cols: list[str]) -> DataFrame:
    """Replace zero dates by NULL in the named string columns."""
    return df.withColumns({c: zero_date_to_null(c) for c in cols})


def find_in_set(v, csv) -> Column:
    """Is ``v`` one of the comma-separated items of ``csv``? ``v`` may be a literal."""
    csv = col(csv)
    return F.when(csv == "", F.lit(False)).otherwise(F.find_in_set(lit(v), csv) > 0)


def field_rank(v, *items) -> Column:
    """``FIELD(v, items...)``: 1-based position of the first equal item, else NULL."""
    v = col(v)
    first, *rest = enumerate(items, 1)
    out = F.when(v.eqNullSafe(lit(first[1])), F.lit(first[0]))
    for i, item in rest:
        out = out.when(v.eqNullSafe(lit(item)), F.lit(i))
    return out


def elt(n, *items) -> Column:
    """``ELT(n, items...)``: the nth item, NULL out of range."""
    return F.get(F.array(*[lit(i) for i in items]), col(n) - 1)


def strcmp(a, b) -> Column:
    """-1, 0 or 1; NULL operands give 0."""
    a, b = col(a), col(b)
    return F.when(a < b, -1).when(a > b, 1).otherwise(0)


def to_integral(c, to: str, strict: bool = True) -> Column:
    """Cast to an integer type; floats round half to even, decimals half up.

    With ``strict`` a value that does not fit is an error, else it is NULL.
    """
    c = col(c)
    cast = Column.cast if strict else Column.try_cast
    # typeof() folds at planning time, so only one branch is left in the plan.
    kind = F.typeof(c)
    return (
        F.when(kind.isin("double", "float"), cast(F.rint(c), to))
        .when(kind.startswith("decimal"), cast(F.round(c, 0), to))
        .otherwise(cast(c, to))
    )


def cast_unsigned(c) -> Column:
    """``CAST(c AS UNSIGNED)``: 64-bit, rounding (half to even for floats, half up for decimals)."""
    return to_integral(c, "bigint")


def cast_signed(c) -> Column:
    """``CAST(c AS SIGNED)``: 32-bit, rounding as :func:`cast_unsigned`."""
    return to_integral(c, "int")


def cast_char(c, n: int | None = None) -> Column:
    s = col(c).cast("string")
    return s if n is None else F.substring(s, 1, n)


def cast_datetime(c) -> Column:
    return col(c).cast("timestamp_ntz")


# The type names CONVERT() gives a meaning of its own.
_CONVERT = {
    "UNSIGNED": cast_unsigned,
    "SIGNED": cast_signed,
    "CHAR": cast_char,
    "DATETIME": cast_datetime,
}


def convert_type(c, type_name: str) -> Column:
    """``CONVERT(c, type)``; other type names are passed to ``cast``."""
    special = _CONVERT.get(type_name.strip().upper())
    return special(c) if special else col(c).cast(type_name)
