import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mysem.sources import types as M


@pytest.mark.parametrize(
    "declared, expected",
    [
        ("int(11)", "int"),
        ("int", "int"),
        ("tinyint(1)", "smallint"),
        ("tinyint(4)", "smallint"),
        ("smallint(6)", "smallint"),
        ("smallint(5) unsigned", "int"),
        ("mediumint(8)", "int"),
        ("int(10) unsigned", "bigint"),
        ("bigint(20)", "bigint"),
        ("bigint(20) unsigned", "decimal(20,0)"),
        ("float", "float"),
        ("double", "double"),
        ("decimal(10,2)", "decimal(10,2)"),
        ("decimal", "decimal(10,0)"),
        ("numeric(5)", "decimal(5,0)"),
        ("varchar(255)", "string"),
        ("char(36)", "string"),
        ("text", "string"),
        ("tinytext", "string"),
        ("mediumtext", "string"),
        ("longtext", "string"),
        ("blob", "binary"),
        ("tinyblob", "binary"),
        ("mediumblob", "binary"),
        ("longblob", "binary"),
        ("datetime", "timestamp_ntz"),
        ("datetime(6)", "timestamp_ntz"),
        ("timestamp", "timestamp_ntz"),
        ("date", "date"),
        ("time", "string"),
        ("year", "smallint"),
        ("year(4)", "smallint"),
        ("json", "string"),
        ("enum('a','b')", "string"),
        ("set('x','y')", "string"),
        ("bit(1)", "boolean"),
        ("bit(16)", "bigint"),
        ("binary(16)", "binary"),
        ("varbinary(255)", "binary"),
    ],
)
def test_spark_type(declared, expected):
    assert M.spark_type(declared).simpleString() == expected


@pytest.mark.parametrize("declared", ["geometry", "point", ""])
def test_unknown_type(declared):
    with pytest.raises(ValueError):
        M.spark_type(declared)


@pytest.mark.parametrize(
    "spark_type, expected",
    [
        (T.IntegerType(), "int(11)"),
        (T.ShortType(), "smallint(6)"),
        (T.LongType(), "bigint(20)"),
        (T.BooleanType(), "tinyint(1)"),
        (T.FloatType(), "float"),
        (T.DoubleType(), "double"),
        (T.DecimalType(19, 2), "decimal(19,2)"),
        (T.StringType(), "text"),
        (T.VarcharType(255), "varchar(255)"),
        (T.CharType(36), "char(36)"),
        (T.BinaryType(), "blob"),
        (T.TimestampType(), "datetime"),
        (T.TimestampNTZType(), "datetime"),
        (T.DateType(), "date"),
        (T.DayTimeIntervalType(), "varchar(255)"),
        (T.ArrayType(T.LongType()), "bigint(20) /* array */"),
    ],
)
def test_mysql_type(spark_type, expected):
    assert M.mysql_type(spark_type) == expected


def test_no_mysql_type_for_maps():
    with pytest.raises(ValueError):
        M.mysql_type(T.MapType(T.StringType(), T.StringType()))


def test_enum_labels():
    assert M.enum_labels("ENUM('a','it''s','x,y')") == ["a", "it's", "x,y"]
    with pytest.raises(ValueError):
        M.enum_labels("varchar(5)")


def test_apply_schema(spark):
    df = spark.createDataFrame(
        [
            ("1", "65535", "0000-00-00", "1", "0x6869", "b'101'", "x"),
            ("2", "70000000000", "2024-02-29", "0", "X'ff'", "7", None),
            ("3", "-1", "2024-02-30", "true", None, "0b11", "y"),
            (None, "12", None, None, "plain", None, "z"),
        ],
        "id string, u string, d string, b string, raw string, flags string, s string",
    )
    declared = {
        "id": "int(11)",
        "u": "smallint(5) unsigned",
        "d": "date",
        "b": "bit(1)",
        "raw": "blob",
        "flags": "bit(16)",
        "s": "enum('x','y')",
    }
    good, rejects = M.apply_mysql_schema(df, declared, defaults={"s": "none", "id": "0"})
    rows = [tuple(r) for r in good.orderBy("id").collect()]
    assert [(r[0], r[1], r[2], r[3], bytes(r[4]), r[5], r[6]) for r in rows] == [
        (0, 12, None, None, b"plain", None, "z"),
        (1, 65535, None, True, b"hi", 5, "x"),
    ]
    failing = {r["id"]: r["rejected_columns"] for r in rejects.collect()}
    assert failing == {"2": ["u"], "3": ["d"]}
    assert rejects.where("id = '2'").select("u").first()[0] == "70000000000"


def test_typed_strict(one):
    assert one(M.typed(F.lit("0000-00-00 00:00:00"), T.TimestampNTZType())) is None
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        one(M.typed(F.lit("abc"), T.IntegerType()))
