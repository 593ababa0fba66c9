import datetime as dt
import gzip
import random
import re
from decimal import Decimal

import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mysem.functions import escape_string, unescape_string
from mysem.plans import jobs
from mysem.sources import dump_lex
from mysem.sources import dump_read as R
from mysem.sources import dump_write as W
from mysem.sources import tables
from mysem.sources.dump_lex import whole_statements


@pytest.fixture
def dump(spark, tmp_path):
    """Read a dump text: its statements in order as (category, table, body)."""

    def read(text, name="d.sql", **options):
        path = tmp_path / name
        path.write_bytes(text.encode())
        df = R.read_dump(spark, str(path), **options)
        return [tuple(r) for r in df.orderBy("block", "seq", "part").select("category", "table", "body").collect()]

    return read


@pytest.fixture
def load(spark, tmp_path):
    def read(text, table, schema, **options):
        path = tmp_path / "l.sql"
        path.write_bytes(text.encode())
        schema = T._parse_datatype_string(schema)
        return [tuple(r) for r in R.load_dump(spark, str(path), table, schema, **options).collect()]

    return read


# --- literals ---


@pytest.mark.parametrize(
    "value, kind, expected",
    [
        (None, "string", "NULL"),
        (True, "boolean", "1"),
        (False, "boolean", "0"),
        (42, "int", "42"),
        (3.14, "double", "3.14"),
        (float("nan"), "double", "'NaN'"),
        (Decimal("0.0000001"), "decimal(20,10)", "0.0000001000"),
        ("hello", "string", "'hello'"),
        ("it's", "string", "'it''s'"),
        ("a\\b", "string", "'a\\\\b'"),
        ("line1\nline2", "string", "'line1\\nline2'"),
        ("a\rb\tc\x00d\x1ae", "string", "'a\\rb\\tc\\0d\\Ze'"),
        (dt.datetime(2024, 1, 15, 10, 30), "timestamp_ntz", "'2024-01-15 10:30:00'"),
        (dt.datetime(2024, 1, 15, 10, 30, 0, 5000), "timestamp", "'2024-01-15 10:30:00.005'"),
        (dt.date(2024, 1, 15), "date", "'2024-01-15'"),
        (b"\xca\xfe", "binary", "X'cafe'"),
        ([1, 2], "array<int>", "'[1,2]'"),
        (dt.timedelta(hours=1, minutes=30), "interval day to second", "'01:30:00'"),
        (-dt.timedelta(days=4, seconds=5), "interval day to second", "'-96:00:05'"),
    ],
)
def test_literal(spark, value, kind, expected):
    df = spark.createDataFrame([(value,)], f"v {kind}")
    assert df.select(W.sql_literal(F.col("v"), df.schema[0].dataType)).first()[0] == expected


def test_hex_blob(spark):
    df = spark.createDataFrame([(b"\xca\xfe",), (b"",)], "v binary")
    out = df.select(W.sql_literal(F.col("v"), T.BinaryType(), hex_blob=True)).collect()
    assert [r[0] for r in out] == ["0xcafe", "X''"]


def test_no_literal_for_maps(spark):
    with pytest.raises(ValueError):
        W.insert_statements(spark.sql("select map('a', 1) as m"), "t")


def test_escape_fuzz(spark):
    rng = random.Random(5)
    texts = ["".join(rng.choices("\\'\"nrtbZ0%_\n\r\t\x00\x1a;,()x", k=rng.randint(0, 14))) for _ in range(20000)]
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    back = df.select("s", unescape_string(escape_string("s")).alias("b"))
    assert back.where("s <> b").count() == 0


def _reference_unescape(s):
    known = {"n": "\n", "r": "\r", "t": "\t", "0": "\x00", "Z": "\x1a", "b": "\b"}
    out, i = "", 0
    while i < len(s):
        if s[i] == "\\":
            c = s[i + 1]
            out += "\\" + c if c in "%_" else known.get(c, c)
            i += 2
        elif s[i : i + 2] == "''":
            out += "'"
            i += 2
        else:
            out += s[i]
            i += 1
    return out


def test_unescape_matches_state_machine(spark):
    rng = random.Random(6)
    tokens = ["\\\\", "\\'", "''", "\\n", "\\0", "\\Z", "\\b", "\\%", "\\_", '\\"', "\\q", "n", "x", "%", "\n"]
    texts = ["".join(rng.choices(tokens, k=rng.randint(0, 10))) for _ in range(20000)]
    df = spark.createDataFrame([(t, _reference_unescape(t)) for t in texts], "s string, want string")
    assert df.where(unescape_string("s") != F.col("want")).count() == 0


# --- splitting ---


def test_basic_split(dump):
    assert [b for *_, b in dump("SELECT 1; SELECT 2; SELECT 3;")] == ["SELECT 1", "SELECT 2", "SELECT 3"]


def test_keeps_strings(dump):
    got = dump("INSERT INTO t VALUES ('hello; world'); SELECT 1;")
    assert got == [("data", "t", "INSERT INTO t VALUES ('hello; world')"), ("other", None, "SELECT 1")]


def test_comments(dump):
    assert [b for *_, b in dump("-- it's; a comment\nSELECT 1;\n-- another\n/* x; */SELECT 2;\n")] == ["SELECT 1", "SELECT 2"]
    assert dump("SELECT '-- no' /* yes */ FROM t;\n")[0][2] == "SELECT '-- no'  FROM t"


def test_conditional_comments(dump):
    got = dump("/*!40101 SET NAMES utf8mb4 */;\n/*!40000 ALTER TABLE `t` DISABLE KEYS */;\nSELECT 1;")
    assert got == [
        ("control", None, "SET NAMES utf8mb4"),
        ("schema", "t", "ALTER TABLE `t` DISABLE KEYS"),
        ("other", None, "SELECT 1"),
    ]


@pytest.mark.parametrize("whole", [False, True])
@pytest.mark.parametrize("mark", [";;", "//", "$$"])
def test_delimiter(dump, whole, mark):
    body = "CREATE TRIGGER g AFTER INSERT ON t FOR EACH ROW BEGIN\n  INSERT INTO log VALUES (1);\n  SET x = 2;\nEND"
    text = (
        f"SELECT 0;\nDELIMITER {mark}\nCREATE FUNCTION f() RETURNS INT BEGIN RETURN 1; END{mark}\n{body} {mark}\n"
        "DELIMITER ;\nINSERT INTO t VALUES (1);\nSELECT 2;\n"
    )
    assert dump(text, whole_files=whole) == [
        ("other", None, "SELECT 0"),
        ("routine", None, "CREATE FUNCTION f() RETURNS INT BEGIN RETURN 1; END"),
        ("routine", None, body),
        ("data", "t", "INSERT INTO t VALUES (1)"),
        ("other", None, "SELECT 2"),
    ]


def test_trigger_in_conditional_comments(dump):
    text = (
        "DELIMITER ;;\n/*!50003 CREATE*/ /*!50017 DEFINER=`a`@`b`*/ /*!50003 TRIGGER g BEFORE INSERT ON t FOR EACH ROW BEGIN\n"
        "SET NEW.a = 'x;y';\nEND */;;\nDELIMITER ;\nINSERT INTO t VALUES (1);\n"
    )
    got = dump(text)
    assert [c for c, *_ in got] == ["other", "data"]
    assert got[0][2].startswith("CREATE DEFINER=`a`@`b` TRIGGER g") and got[0][2].endswith("SET NEW.a = 'x;y';\nEND")


def test_delimiter_word_in_a_text(dump):
    text = "INSERT INTO t VALUES ('a\nDELIMITER //\nb');\nINSERT INTO t VALUES (2);\n"
    assert [c for c, *_ in dump(text)] == ["data", "data"]


def test_cut_comment(dump):
    text = "/* old;\nrows */ INSERT INTO t VALUES (1);\n"
    with pytest.raises(Exception, match="does not end"):
        dump(text, delimiters=False)
    assert dump(text) == dump(text, whole_files=True) == [("data", "t", "INSERT INTO t VALUES (1)")]
    text = "SELECT 1;\n-- old;\nINSERT INTO t -- new;\nVALUES (1);\n"
    assert [b for *_, b in dump(text)] == ["SELECT 1", "INSERT INTO t VALUES (1)"]


def _plain_split(text):
    """Statements, one character at a time; comments stay as they are."""
    out, now, i, quote, delimiter = [], "", 0, "", ";"
    while i < len(text):
        c, two = text[i], text[i : i + 2]
        if quote == "*":
            n = 2 if two == "*/" else 1
            quote = "" if n == 2 else quote
        elif quote:
            n = 2 if (c == "\\" and quote != "`") or (two == 2 * quote and quote != "`") else 1
            quote = "" if n == 1 and c == quote else quote
        elif (i == 0 or text[i - 1] == "\n") and (named := re.compile(r"(?i)DELIMITER[ \t]+(\S+)[^\n]*\n?").match(text, i)):
            delimiter, i = named[1], named.end()
            continue
        elif text.startswith(delimiter, i):
            out.append(now)
            now, i = "", i + len(delimiter)
            continue
        elif two == "--":
            n = (text + "\n").index("\n", i) - i
        else:
            quote, n = ("*", 2) if two == "/*" else (c if c in "'\"`" else "", 1)
        now += text[i : i + n]
        i += n
    return [s.strip(" \t\r\n") for s in [*out, now] if s.strip(" \t\r\n;")]


def _random_dump(rng):
    inside = ["a;\nb", ";\n", "\n", "x", "''", "\\'", "\\\\", '"', "`", "--", "/*", "*/", "\nDELIMITER //\n", " ", "é", "//", "$$"]
    literal = lambda: "'" + "".join(rng.choices(inside, k=rng.randrange(6))) + "'"
    comment = lambda: "/* " + rng.choice([";\n", "it's", '"', "x", "\n\n"]) + " */"
    other = lambda: rng.choice([" ", "\n", "y", "1", "-", "/", '"a;\n\'b"', "`c;\nd`", "-- e;\n", "-- f'\n", comment()])
    out, delimiter = "", ";"
    for _ in range(rng.randrange(1, 25)):
        if rng.random() < 0.1:
            delimiter = rng.choice([";;", "//", "$$", ";"])
            out += f"\nDELIMITER {delimiter}\n"
        body = "S" + "".join(rng.choice([literal, other])() for _ in range(rng.randrange(8)))
        # A slash before a star would begin a comment.
        out += body.replace("//*", "/ /*") + " " + delimiter + rng.choice(["\n", "\n", " ", ""])
    return out


def test_any_cut_of_any_dump(spark, tmp_path):
    rng = random.Random(8)
    texts = [_random_dump(rng) for _ in range(12)]
    for i, text in enumerate(texts):
        (tmp_path / f"{i:03d}.sql").write_bytes(text.encode())
    for size in ("150b",):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", "1b")
        try:
            records = R._records(spark, str(tmp_path), ";\n", False)
            rows = whole_statements(records, ";\n").collect()
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
            spark.conf.unset("spark.sql.files.openCostInBytes")
        got = {}
        for r in sorted(rows, key=lambda r: (r.block, r.seq, r.part)):
            got.setdefault(r.file[-7:-4], []).append(r.text.strip(" \t\r\n"))
        for i, text in enumerate(texts):
            assert [s for s in got.get(f"{i:03d}", []) if s.strip(" \t\r\n;")] == _plain_split(text), (size, text)


def test_two_delimiter_sections(dump):
    section = "DELIMITER ;;\nCREATE PROCEDURE p%d() BEGIN SELECT 1;\nSELECT 2; END ;;\nDELIMITER ;\n"
    text = "SELECT 0;\n" + section % 1 + "INSERT INTO t VALUES (1);\n" + section % 2 + "SELECT 3;\n"
    assert [c for c, *_ in dump(text)] == ["other", "routine", "data", "routine", "other"]


def test_empty_and_open_ended(dump):
    assert dump("") == []
    assert dump("   \n") == []
    assert [b for *_, b in dump("SELECT 1")] == ["SELECT 1"]


def test_escaped_quotes_and_lines(dump):
    assert len(dump(r"INSERT INTO t VALUES ('it\'s'); SELECT 2;")) == 2
    got = dump("INSERT INTO t VALUES\n(1, 'hello'),\n(2, 'world');")
    assert len(got) == 1 and "(1, 'hello')" in got[0][2]


def test_cut_literal(dump):
    text = "INSERT INTO t VALUES ('a;\nb');\nSELECT 1;\n"
    with pytest.raises(Exception, match="does not end"):
        dump(text, delimiters=False)
    assert [b for *_, b in dump(text)] == [b for *_, b in dump(text, whole_files=True)] == ["INSERT INTO t VALUES ('a;\nb')", "SELECT 1"]
    with pytest.raises(Exception, match="does not end"):
        dump("SELECT 1;\nINSERT INTO t VALUES ('a;\nb);\n")


def test_crlf(dump):
    text = "INSERT INTO t VALUES (1);\r\nSELECT 1;\r\n"
    want = ["INSERT INTO t VALUES (1)", "SELECT 1"]
    assert [b for *_, b in dump(text, line_sep=";\r\n")] == want
    assert [b for *_, b in dump(text)] == want


@pytest.mark.parametrize(
    "stmt, category, table",
    [
        ("CREATE TABLE IF NOT EXISTS `db`.`t` (id INT)", "schema", "t"),
        ("CREATE INDEX idx ON t(col)", "schema", "t"),
        ("ALTER TABLE t ADD COLUMN col INT", "schema", "t"),
        ("DROP TABLE IF EXISTS t", "schema", "t"),
        ("insert ignore into `t`(a) VALUES (1)", "data", "t"),
        ("REPLACE INTO t VALUES (1)", "data", "t"),
        ("CREATE DATABASE mydb", "database", None),
        ("USE mydb", "database", None),
        ("SET NAMES utf8mb4", "control", None),
        ("LOCK TABLES t WRITE", "control", "t"),
        ("CREATE FUNCTION f() RETURNS INT", "routine", None),
        ("SELECT 1", "other", None),
    ],
)
def test_category(dump, stmt, category, table):
    assert dump(stmt + ";\n") == [(category, table, stmt)]


def test_select_tables(spark, tmp_path):
    (tmp_path / "s.sql").write_text(
        "CREATE TABLE a (x int);\nINSERT INTO a VALUES (1);\nINSERT INTO ab VALUES ('a');\nSET NAMES x;\nUSE d;\n"
    )
    s = R.read_dump(spark, str(tmp_path / "s.sql"))

    def kept(**options):
        return sorted(r.body[:12] for r in R.select_tables(s, **options).collect())

    assert kept(tables=["a"]) == ["CREATE TABLE", "INSERT INTO ", "SET NAMES x", "USE d"]
    assert kept(exclude=["a"], data_only=True) == ["INSERT INTO ", "SET NAMES x"]
    assert kept(schema_only=True) == ["CREATE TABLE", "SET NAMES x", "USE d"]


# --- rows ---


def test_load_literals(load):
    text = (
        "INSERT INTO `t` VALUES (1,'a,b)(',NULL,0x6869,b'101','2024-01-05 10:00:00.5'),\n"
        "(-2, 'it\\'s ''q'' \\\\n' , +1.5e2,X'FF', 0b11 , '0000-00-00 00:00:00');\n"
        "REPLACE INTO other VALUES (9);\n"
        'INSERT IGNORE INTO t VALUES (3,"dq \'x\' ""y""",null,_binary \'z\\0\',7,NULL);\n'
    )
    got = load(text, "t", "i int, s string, d double, b binary, f bigint, ts timestamp_ntz")
    assert sorted(got) == [
        (-2, "it's 'q' \\n", 150.0, bytearray(b"\xff"), 3, None),
        (1, "a,b)(", None, bytearray(b"hi"), 5, dt.datetime(2024, 1, 5, 10, 0, 0, 500000)),
        (3, "dq 'x' \"y\"", None, bytearray(b"z\x00"), 7, None),
    ]


def test_load_by_name(load):
    text = "INSERT INTO t (`b`, `a`) VALUES ('x', 1);\nINSERT INTO t VALUES (2, 'y', 0b1);\n"
    assert sorted(load(text, "t", "a int, b string, c boolean")) == [(1, "x", None), (2, "y", True)]


def test_load_errors(load):
    with pytest.raises(Exception, match="wrong number of values"):
        load("INSERT INTO t VALUES (1,2);\n", "t", "a int")
    with pytest.raises(Exception, match="wrong number of values"):
        load("INSERT INTO t VALUES (1,2),(3,4,5,6);\n", "t", "a int, b int, c int")
    with pytest.raises(Exception, match="not a list of literal rows"):
        load("INSERT INTO t VALUES (NOW(),2);\n", "t", "a string, b int")
    with pytest.raises(Exception, match="not a list of literal rows"):
        load("INSERT INTO t VALUES (1,2) ON DUPLICATE KEY UPDATE b=VALUES(b);\n", "t", "a int, b int")
    with pytest.raises(Exception, match="not a list of literal rows"):
        load("INSERT INTO t SELECT * FROM s;\n", "t", "a int")


def test_long_literals(spark, tmp_path):
    texts = ["x" * 200_000, "\\'\n;" * 50_000, "'" * 100_000]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(texts)], "i int, s string")
    W.export_inserts(df, str(tmp_path / "long"), "t")
    back = R.load_dump(spark, str(tmp_path / "long"), "t", df.schema)
    assert {r.i: r.s for r in back.collect()} == dict(enumerate(texts))


EDGE = [
    (1, "quote ' double \" back \\ tick `", b"\x00\xff'", True, 1.5, Decimal("12.30"), dt.date(2024, 2, 29), dt.datetime(2024, 1, 1, 0, 0, 0, 1), [1, None]),
    (2, "semi;\nline\r\n\ttab\x00nul\x1asub", b"", False, -0.0, Decimal("-0.01"), dt.date(1970, 1, 1), dt.datetime(1999, 12, 31, 23, 59, 59), []),
    (3, "", None, None, float("inf"), None, None, None, None),
    (4, None, b"x", None, 1e300, Decimal("0.00"), dt.date(9999, 12, 31), dt.datetime(2024, 1, 1), [7]),
    (5, "NULL", b"NULL", True, 5e-324, None, None, None, None),
    (6, "),('x", b"),(", True, float("-inf"), None, None, None, None),
    (7, "/* no */ -- no\n/*!40101 no */", b"--", True, 1.0, None, None, None, None),
    (-8, "0x41", b"0x41", True, 1.0, None, None, None, None),
]
EDGE_SCHEMA = "i bigint, s string, b binary, f boolean, d double, n decimal(12,2), day date, ts timestamp_ntz, a array<int>"


@pytest.mark.parametrize(
    "options",
    [{}, {"rows_per_stmt": 1}, {"complete": True, "mode": "replace"}, {"mode": "ignore", "hex_blob": True}, {"compression": "gzip"}, {"quote_names": False}],
)
def test_round_trip(spark, tmp_path, options):
    df = spark.createDataFrame(EDGE, EDGE_SCHEMA).repartition(3)
    W.export_inserts(df, str(tmp_path / "rt"), "t", **options)
    back = R.load_dump(spark, str(tmp_path / "rt"), "t", df.schema)
    assert sorted(map(str, back.collect())) == sorted(map(str, df.collect()))


def test_round_trip_whole_files(spark, tmp_path):
    df = spark.createDataFrame(EDGE, EDGE_SCHEMA)
    W.export_inserts(df, str(tmp_path / "rt"), "t", where="i < 5")
    back = R.load_dump(spark, str(tmp_path / "rt"), "t", df.schema, whole_files=True)
    assert sorted(r.i for r in back.collect()) == [-8, 1, 2, 3, 4]


def test_statement_shape(spark):
    df = spark.range(250).repartition(1).selectExpr("id", "'x' as s")
    lines = [r.value for r in W.insert_statements(df, "t", complete=True).collect()]
    assert [line.count("),(") + 1 for line in lines] == [100, 100, 50]
    assert all(line.startswith("INSERT INTO `t` (`id`, `s`) VALUES (") and line.endswith(");") for line in lines)
    single = W.insert_statements(df, "t", mode="replace", rows_per_stmt=1, quote_names=False).first()[0]
    assert single.startswith("REPLACE INTO t VALUES (") and single.count("(") == 1


def test_gzip_dump(spark, tmp_path):
    with gzip.open(tmp_path / "d.sql.gz", "wt") as f:
        f.write("INSERT INTO t VALUES (1),(2);\nINSERT INTO t VALUES (3);\n")
    schema = T._parse_datatype_string("i int")
    assert sorted(r.i for r in R.load_dump(spark, str(tmp_path / "d.sql.gz"), "t", schema).collect()) == [1, 2, 3]


def test_many_splits(spark, tmp_path):
    """A statement that crosses a split boundary is read once."""
    df = spark.range(20000).repartition(1).selectExpr("id", "repeat('ab;', 20) as s")
    W.export_inserts(df, str(tmp_path / "big"), "t")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "50000")
    try:
        back = R.load_dump(spark, str(tmp_path / "big"), "t", df.schema)
        assert back.rdd.getNumPartitions() > 8
        assert back.agg(F.count("*"), F.sum("id"), F.max("s")).first()[:] == (20000, sum(range(20000)), "ab;" * 20)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


# --- delimited files ---


def test_load_data_nulls_and_quotes(spark, tmp_path):
    (tmp_path / "x.csv").write_text('id,s\n1,"a ""q"", b"\n2,\n3,""\n')
    got = tables.load_data(spark, str(tmp_path / "x.csv"), T._parse_datatype_string("id int, s string"))
    assert sorted(map(tuple, got.collect())) == [(1, 'a "q", b'), (2, None), (3, "")]


def test_load_data_bad_row(spark, tmp_path):
    (tmp_path / "x.csv").write_text("id,s\nx,y\n")
    with pytest.raises(Exception, match="MALFORMED|FAILFAST"):
        tables.load_data(spark, str(tmp_path / "x.csv"), T._parse_datatype_string("id int, s string")).collect()


def test_tsv(spark, tmp_path):
    df = spark.createDataFrame([(1, "Alice"), (2, None)], "id int, name string").coalesce(1)
    tables.write_tsv(df, str(tmp_path / "t"))
    assert sorted(r.value for r in spark.read.text(str(tmp_path / "t")).collect()) == ["1\tAlice", "2\tNULL", "id\tname"]


def test_tsv_round_trip(spark, tmp_path):
    df = spark.createDataFrame(
        [
            (1, "tab\there", dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 1, 0, 0, 0, 5)),
            (2, 'q "x"\nline', dt.datetime(1999, 12, 31, 23, 59, 59), None),
            (3, "", None, None),
        ],
        "id int, s string, a timestamp, b timestamp_ntz",
    )
    tables.write_tsv(df, str(tmp_path / "t"))
    assert "2024-01-01 00:00:00\t2024-01-01 00:00:00.000005" in "".join(
        r.value for r in spark.read.text(str(tmp_path / "t")).collect()
    )
    back = tables.read_tsv(spark, str(tmp_path / "t"), df.schema, multi_line=True)
    assert sorted(back.collect()) == sorted(df.collect())


# --- whole dumps ---


def test_dump_and_migrate(spark, tmp_path):
    parents = spark.createDataFrame([(1, "a"), (2, "it's")], "id int, name string")
    children = spark.createDataFrame([(10, 1, "0000-00-00"), (11, 3, "2024-01-01")], "id int, pid int, d string")
    out = str(tmp_path / "dump")
    names = jobs.dump_all_tables({"a_child": children, "parent": parents}, out, parents={"a_child": ["parent"]})
    assert names == ["parent", "a_child"]
    declared = {
        "parent": {"id": "int(11)", "name": "varchar(20)"},
        "a_child": {"id": "int(11)", "pid": "int(11)", "d": "date"},
    }
    report = jobs.migrate_tables(spark, f"{out}/*", str(tmp_path / "wh"), declared=declared)
    assert sorted((r.table_name, r.source_rows, r.target_rows, r.match) for r in report.collect()) == [
        ("a_child", 2, 2, True),
        ("parent", 2, 2, True),
    ]
    moved = spark.read.parquet(str(tmp_path / "wh" / "a_child"))
    assert sorted(map(tuple, moved.collect())) == [(10, 1, None), (11, 3, dt.date(2024, 1, 1))]
    orphans = jobs.fk_orphans(moved, ["pid"], spark.read.parquet(str(tmp_path / "wh" / "parent")), ["id"])
    assert [tuple(r) for r in orphans.collect()] == [(3, 1)]


# --- large dumps ---


class _Here:
    """Records whose batches are mapped in this process."""

    def __init__(self, batches):
        self.batches = batches

    def select(self, *_):
        return self

    def mapInArrow(self, run, _):
        return [r for b in run(iter(self.batches)) for r in b.to_pylist()]


def _batch(values, file="a", block=0):
    n = len(values)
    return pa.RecordBatch.from_pydict({"file": [file] * n, "block": pa.array([block] * n, pa.int64()), "value": pa.array(values, pa.string())})


def test_records_are_walked_together(monkeypatch):
    walks, make = [], dump_lex.walker

    def counting():
        walk = make()

        def counted(text, state, delimiter):
            walks.append(len(text))
            return walk(text, state, delimiter)

        return counted

    monkeypatch.setattr(dump_lex, "walker", counting)
    values = ["INSERT INTO t VALUES (1,'a", "\nb')", "-- it's", "\nINSERT INTO t VALUES (2, NULL)"] * 500
    got = dump_lex.state_maps(_Here([_batch(values), _batch(["x", "'y"]), _batch(["z"], block=9)]), ";\n")
    assert [(r["file"], r["block"]) for r in got] == [("a", 0), ("a", 9)] and got[0]["states"][0] == 1 and got[1]["states"] == [0, 1, 2, 3, 4]
    # At most once for each state and batch, not for each record.
    assert len(walks) <= 15


@pytest.mark.parametrize("line_sep", [";\n", "\n", ";"])
def test_texts_hold_every_record(monkeypatch, line_sep):
    monkeypatch.setattr(dump_lex, "CHARACTERS", 20)
    values = ["", "é", "abc\n", "x" * 50, "", "y"] * 3
    batch = pa.Table.from_batches([_batch(values), _batch(values, block=7), _batch(values, "b", 7)]).combine_chunks().to_batches()[0]
    got, every = list(dump_lex.texts(batch, line_sep)), values * 3
    assert "".join(text for *_, text in got) == "".join(v + line_sep for v in every)
    for file, block, rows, starts, text in got:
        assert {(batch["file"][i].as_py(), batch["block"][i].as_py()) for i in range(rows.start, rows.stop)} == {(file, block)}
        assert [text[at : at + len(every[i])] for at, i in zip(starts.tolist(), range(rows.start, rows.stop))] == every[rows]
        assert line_sep.endswith("\n") or len(starts) == 1


def test_small_texts_cut_alike(spark, tmp_path, monkeypatch):
    rng = random.Random(9)
    for i in range(6):
        (tmp_path / f"{i}.sql").write_bytes(_random_dump(rng).encode())
    read = lambda: sorted(tuple(r) for r in whole_statements(R._records(spark, str(tmp_path), ";\n", False), ";\n").collect())
    whole = read()
    monkeypatch.setattr(dump_lex, "CHARACTERS", 1)
    assert read() == whole and len({r[:4] for r in whole}) == len(whole)


def test_filters_find_the_table_once(spark, tmp_path):
    (tmp_path / "d.sql").write_text("INSERT INTO t VALUES (1);\nINSERT INTO u VALUES (2);\n/* it's;\n */ INSERT INTO t VALUES (3);\n")
    rows = R.load_dump(spark, str(tmp_path), "t", T._parse_datatype_string("a int"))
    plan = rows._jdf.queryExecution().executedPlan().toString()
    # The dump, all of it cut by the lexer, is not read again for plain files.
    assert plan.count("LOW_PRIORITY") == 1 and "FileScan text" not in plan
    assert sorted(r.a for r in rows.collect()) == [1, 3]
    (tmp_path / "e.sql").write_text("INSERT INTO t VALUES (4);\n")
    rows = R.load_dump(spark, str(tmp_path), "t", T._parse_datatype_string("a int"))
    assert rows._jdf.queryExecution().executedPlan().toString().count("LOW_PRIORITY") <= 2
    assert sorted(r.a for r in rows.collect()) == [1, 3, 4]


def test_comments_left_open(spark):
    texts = ["a -- it's\n", "/* it's */", "a/b", "a - b", "'--' x", "'/*'", "/* x", "-- a\n'", "'a", "a-", "a/", '"', "`", "//* x */*", "- -- \"\n'x'"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    old, new = F.regexp_like(R.strip_comments(F.col("t")), F.lit(R._BALANCED)), F.regexp_like("t", F.lit(R._CLOSED))
    # A slash that a comment kept from a star is an error in either reading of a dump.
    assert [r.t for r in df.where(old != new).collect()] == ["//* x */*"]


def test_bare_numbers(spark):
    df = spark.createDataFrame([(t,) for t in ["1", "-2", "3.50", "'4'", "0x1F", "NULL", "_utf8'5'", "b'1'"]], "t string")
    got = df.select(*[R.decode_literal(F.col("t"), T._parse_datatype_string(k), strict=False).alias(k) for k in ("int", "double", "boolean")]).collect()
    assert [r[0] for r in got] == [1, -2, None, 4, 31, None, 5, 1] and [r[1] for r in got][:4] == [1.0, -2.0, 3.5, 4.0] and got[0][2] is True
