import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from mysem import functions as M
from mysem.functions import formats
from mysem.functions.sql import register

L = F.lit
TS = L(dt.datetime(2024, 1, 5, 15, 4, 9, 70000)).cast("timestamp_ntz")


def null(kind="string"):
    return L(None).cast(kind)


# --- formats ---


@pytest.mark.parametrize(
    "fmt, expected",
    [
        ("%Y-%m-%d %H:%i:%s", "2024-01-05 15:04:09"),
        ("%Y-%m-%d", "2024-01-05"),
        ("%M %d, %Y", "January 05, 2024"),
        ("%b %e, %Y", "Jan 5, 2024"),
        ("%h:%i %p", "03:04 PM"),
        ("%H:%i:%s.%f", "15:04:09.070000"),
        ("%W %a %j", "Friday Fri 005"),
        ("%c/%e/%y", "1/5/24"),
        ("%T|%r", "15:04:09|03:04:09 PM"),
        ("week %V", "week 01"),
        ("%I o'clock, day 'd'", "03 o'clock, day 'd'"),
        ("100%% [y]", "100% [y]"),
        ("", ""),
    ],
)
def test_date_format(one, fmt, expected):
    assert one(M.date_format(TS, fmt)) == expected


@pytest.mark.parametrize("fmt", ["%k", "%D", "%u", "%X", "%Y %"])
def test_unsupported_specifier(fmt):
    with pytest.raises(ValueError):
        formats.output_pieces(fmt)


@pytest.mark.parametrize(
    "text, fmt, expected",
    [
        ("2024-01-15", "%Y-%m-%d", dt.datetime(2024, 1, 15)),
        ("5/1/2024 7:08:09", "%d/%m/%Y %H:%i:%s", dt.datetime(2024, 1, 5, 7, 8, 9)),
        ("20240115", "%Y%m%d", dt.datetime(2024, 1, 15)),
        ("January 9, 2024", "%M %e, %Y", dt.datetime(2024, 1, 9)),
        ("03:04 PM 2024-01-02", "%h:%i %p %Y-%m-%d", dt.datetime(2024, 1, 2, 15, 4)),
    ],
)
def test_str_to_date(one, text, fmt, expected):
    assert one(M.str_to_date(L(text), fmt)) == expected


def test_str_to_date_errors(one):
    assert one(M.str_to_date(L("nope"), "%Y-%m-%d", on_error="null")) is None
    with pytest.raises(Exception, match="CANNOT_PARSE_TIMESTAMP"):
        one(M.str_to_date(L("nope"), "%Y-%m-%d"))
    with pytest.raises(ValueError):
        M.str_to_date(L("x"), "%W")


# --- conditionals ---


def test_predicates_with_null(one):
    assert one(M.null_safe_eq(null(), null()), M.null_safe_eq(null(), L("a"))) == (True, False)
    assert one(M.if_expr(null("boolean"), 1, 2), M.ifnull(null(), "x"), M.isnull(null())) == (2, "x", True)
    assert one(M.strcmp(null(), L("a")), M.strcmp(L("b"), L("a")), M.strcmp(L("a"), L("a"))) == (0, 1, 0)


def test_patterns(one):
    assert one(M.like_ci(L("Foo_Bar"), "foo\\_%"), M.like_ci(L("FooxBar"), "foo\\_%")) == (True, False)
    assert one(M.regexp_ci(L("ÀB\nC"), "àb.c$"), M.not_regexp_ci(L("abc"), "B")) == (True, False)


@pytest.mark.parametrize(
    "word, code",
    [("Robert", "R163"), ("Rupert", "R163"), ("Ashcraft", "A226"), ("Lee", "L000"), ("  'tt x1b", "T200"), ("12", ""), ("A1B", "A000"), ("Tymczak", "T522")],
)
def test_soundex(one, word, code):
    assert one(M.soundex(L(word))) == code


def test_find_in_set(one):
    cases = [
        ("b", "a,b", True),
        ("c", "a,b", False),
        ("", "", False),
        ("", "a,,b", True),
        ("a,b", "a,b", False),
        (None, "a", None),
        ("a", None, None),
    ]
    got = one(*[M.find_in_set(null() if v is None else v, null() if s is None else L(s)) for v, s, _ in cases])
    assert list(got) == [e for *_, e in cases]


def test_field_and_elt(one):
    assert one(M.field_rank(L("b"), "a", "b"), M.field_rank(L("z"), "a", "b"), M.field_rank(null(), "a", null())) == (2, None, 2)
    assert one(M.elt(L(1), "x", "y"), M.elt(L(3), "x", "y"), M.elt(L(0), "x"), M.elt(null("int"), "x")) == ("x", None, None, None)


def test_casts(one):
    assert one(*[M.cast_unsigned(L(x)) for x in (2.5, 3.5, -2.5, 2.4)]) == (2, 4, -2, 2)
    half = L(Decimal("2.5")), L(Decimal("-2.5")), L(Decimal("0.49999999999999"))
    assert one(*[M.cast_unsigned(x) for x in half]) == (3, -3, 0)
    assert one(M.cast_signed(L("12")), M.convert_type(L(1.5), "signed"), M.cast_char(L(12345), 3)) == (12, 2, "123")
    with pytest.raises(Exception, match="OVERFLOW"):
        one(M.cast_signed(L(3e9)))


def test_zero_dates(spark):
    df = spark.createDataFrame([("0000-00-00", "x"), ("2024-01-01", "0000-00-00"), (None, "y")], "a string, b string")
    assert [tuple(r) for r in M.zero_dates_to_null(df, ["a"]).collect()] == [
        (None, "x"),
        ("2024-01-01", "0000-00-00"),
        (None, "y"),
    ]


# --- strings and numbers ---


def test_strings(one):
    assert one(M.locate("b", L("abc")), M.instr(L("abc"), "z"), M.locate("", L("abc"))) == (2, 0, 1)
    assert one(M.char_fn(65), M.char_fn(233), M.char_fn(8364), M.space(3)) == ("A", "é", "€", "   ")
    assert one(M.hex_str(L("Az")), M.unhex_str(L("417a"))) == ("417a", bytearray(b"Az"))
    for bad in ("zz", "abc"):
        with pytest.raises(Exception, match="invalid hexadecimal"):
            one(M.unhex_str(L(bad)))


def test_numbers(one):
    cases = [(12.349, 2), (-12.349, 2), (1255.0, -2), (-1255.0, -2), (0.999, 0)]
    assert [float(v) for v in one(*[M.truncate_num(L(x), d) for x, d in cases])] == [12.34, -12.34, 1200, -1200, 0]
    assert one(M.log_natural(L(0.0)), M.log2(L(8.0)), M.log10(L(1000.0)), M.log_base(3, L(9.0))) == pytest.approx(
        (None, 3, 3, 2)
    )


# --- dates ---


@pytest.mark.parametrize(
    "micros, expected",
    [(1_500_000, 2), (1_499_999, 1), (-1_500_000, -2), (-1_400_000, -1), (-1_600_000, -2), (0, 0), (-500_000, -1), (-499_999, 0)],
)
def test_unix_timestamp_rounds(one, micros, expected):
    assert one(M.unix_timestamp(F.timestamp_micros(L(micros)))) == expected


def test_date_parts(one):
    assert one(M.second(TS), M.time_part(TS), M.date_part(TS)) == (Decimal("9.070000"), "15:04:09.07", dt.date(2024, 1, 5))
    sunday = L(dt.date(2024, 1, 7))
    assert one(M.dayofweek(sunday), M.dayofweek(TS), M.last_day(TS)) == (1, 6, dt.date(2024, 1, 31))
    # The first of January can belong to the last week of the year before.
    assert one(M.week(L(dt.date(2021, 1, 1))), M.week(L(dt.date(2024, 12, 30)))) == (53, 1)
    assert one(M.time_part(L(dt.date(2024, 1, 1)))) == "00:00:00"


def test_date_arithmetic(one):
    month_end = L(dt.date(2024, 1, 31))
    assert one(M.date_add(month_end, 1, "month"), M.date_sub(month_end, 2, "MONTH")) == (
        dt.datetime(2024, 2, 29),
        dt.datetime(2023, 11, 30),
    )
    assert one(M.date_add(TS, 3, "WEEK"), M.date_add(TS, -1, "QUARTER")) == (
        dt.datetime(2024, 1, 26, 15, 4, 9, 70000),
        dt.datetime(2023, 10, 5, 15, 4, 9, 70000),
    )
    assert one(M.datediff(L("2024-03-01"), L("2024-02-28")), M.from_unixtime(L(86400))) == (2, dt.datetime(1970, 1, 2))
    with pytest.raises(ValueError):
        M.date_add(TS, 1, "FORTNIGHT")


def test_sql_functions(spark):
    names = register(spark)
    assert "my_hex" in names
    row = spark.sql(
        "select my_find_in_set('b', 'a,b'), my_strcmp('a', 'b'), my_cast_signed(2.5), my_time(timestamp'2024-01-01 10:00:00'),"
        " my_space(2), my_ifnull(null, 'x'), my_log2(8), my_cast_unsigned(-3.5), my_regexp('A\\nB', 'a.b')"
    ).first()
    assert tuple(row) == (True, -1, 2, "10:00:00", "  ", "x", 3.0, -4, True)
