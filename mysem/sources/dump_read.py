"""SQL dumps as DataFrames of statements and of rows.

A dump is split at ``;`` + line feed by the text source itself, so one large
file is read by many tasks. Statements on one line, quotes and comments are
then resolved with expressions. Files in which that would cut a literal or a
comment, or which have ``DELIMITER`` lines, are cut by a lexer whose states
are composed over the tasks (:mod:`mysem.sources.dump_lex`).

Patterns use possessive quantifiers throughout: a plain repeated alternation
recurses once per character and overflows the stack on a long literal.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mysem.functions.strings import unescape_string
from mysem.session import written
from mysem.sources.dump_lex import whole_statements
from mysem.sources.types import HEX_STARTS, typed

_SINGLE = r"'[^'\\]*+(?:(?:\\.|'')[^'\\]*+)*+'"
_DOUBLE = r'"[^"\\]*+(?:(?:\\.|"")[^"\\]*+)*+"'
_TICKED = r"`[^`]*+`"
_STRING = f"{_SINGLE}|{_DOUBLE}|{_TICKED}"

# A comment goes, what a conditional comment holds stays.
_COMMENTS = rf"(?s)({_STRING})|/\*!\d*\s*((?:[^*]++|\*(?!/))*+)\*/|/\*(?:[^*]++|\*(?!/))*+\*/|--[^\n]*+\n?"
# Neither a quoted text nor a comment is left open.
_BALANCED = rf"(?s)^(?:[^'\"`/]++|/(?!\*)|{_STRING})*+$"
# The same where comments are still there, none of them conditional.
_CLOSED = rf"(?s)^(?:[^'\"`/\-]++|-(?!-)|--[^\n]*+|/(?!\*)|/\*(?:[^*]++|\*(?!/))*+\*/|{_STRING})*+\z"
_PLAIN = r"^(?:[^'\"`]*+`[^'\"`]*+`)*+[^\"`\\]*+$"
_STATEMENT = rf"(?s)((?:[^;'\"`]++|{_STRING})++)"
_MARKER = r"(?i)(?:^|\n)DELIMITER[ \t]"
# How a statement begins -> its category.
CATEGORIES = (
    ("data", ("INSERT", "REPLACE")),
    ("schema", ("CREATE TABLE", "CREATE INDEX", "CREATE UNIQUE INDEX", "CREATE TYPE", "ALTER TABLE", "DROP TABLE",
                "DROP INDEX", "DROP TYPE", "CREATE VIEW", "DROP VIEW")),
    ("database", ("CREATE DATABASE", "USE ", "DROP DATABASE")),
    ("control", ("SET ", "LOCK ", "UNLOCK", "DELIMITER")),
    ("routine", ("CREATE FUNCTION", "CREATE PROCEDURE", "CREATE TRIGGER", "CREATE OR REPLACE FUNCTION")),
)

_NAME = r"`?(?:[^`\s(;]+`?\.`?)?([^`\s(;.]+)`?"
_TABLE = (
    r"(?is)^(?:(?:INSERT|REPLACE)\s+(?:(?:LOW_PRIORITY|DELAYED|HIGH_PRIORITY|IGNORE)\s+)*(?:INTO\s+)?"
    r"|(?:CREATE|ALTER|DROP)\s+TABLE\s+(?:IF\s+(?:NOT\s+)?EXISTS\s+)?"
    r"|LOCK\s+TABLES?\s+"
    r"|CREATE\s+(?:UNIQUE\s+)?INDEX\s+\S+\s+ON\s+)" + _NAME
)

_HEAD = r"(?is)^(?:INSERT|REPLACE)\s[^('\"]*?(?:\(([^()'\"]*+)\)\s*)?VALUES?\s*(?=\()"
_TUPLE = rf"(?s)\(((?:[^'\"()]++|{_SINGLE}|{_DOUBLE})*+)\)"
# A value, after the parenthesis or comma before it and with the parenthesis
# that closes its row.
_VALUE = rf"(?s)[(,]\s*+((?:[^,'\"()\s]++(?=\s*+[,)])|(?:\w++\s*+)?+(?:{_SINGLE}|{_DOUBLE}))(?:\s*+\))?+)"
_BLANKS = " \t\r\n"
_NUMBER = r"^-?+[0-9]++(?:\.[0-9]++)?+\z"
_EMPTY = r"^[ \t\r\n;]*+\z"

PLACE = ["file", "block", "seq"]

def strip_comments(c: Column) -> Column:
    """Drop comments outside quotes and unwrap ``/*!NNNNN ... */``."""
    stripped = F.regexp_replace(c, _COMMENTS, "$1$2")
    return F.when(F.contains(c, F.lit("--")) | F.contains(c, F.lit("/*")), stripped).otherwise(c)


def category_of(body: Column) -> Column:
    out = None
    for name, starts in CATEGORIES:
        hit = F.regexp_like(body, F.lit(f"(?iu)^(?:{'|'.join(starts)})"))
        out = F.when(hit, name) if out is None else out.when(hit, name)
    return out.otherwise("other")


def table_of(body: Column) -> Column:
    """The table a data or schema statement is about, else NULL."""
    return F.nullif(F.regexp_extract(F.substring(body, 1, 400), _TABLE, 1), F.lit(""))


def _records(spark: SparkSession, path, line_sep: str, whole_files: bool) -> DataFrame:
    texts = spark.read.text(path, wholetext=True) if whole_files else spark.read.text(path, lineSep=line_sep)
    return texts.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("seq"),
        F.col("value"),
    )


def _broken(body: Column) -> Column:
    return F.raise_error(F.concat(F.lit("a quoted text or comment does not end where its statement does: "), F.substring(body, 1, 80)))


def _checked(body: Column) -> Column:
    return F.when(F.regexp_like(body, F.lit(_BALANCED)), body).otherwise(_broken(body))


def _explode_statements(df: DataFrame, text: str, keep: list[str]) -> DataFrame:
    """``keep``, part and body of each statement of ``text``, which holds no DELIMITER line."""
    df = df.select(*keep, strip_comments(F.col(text)).alias("__text"))
    body = F.col("__text")
    # Most records are one statement already.
    parts = F.when(F.contains(body, F.lit(";")), F.regexp_extract_all(body, F.lit(_STATEMENT), F.lit(1))).otherwise(
        F.array(body)
    )
    whole = F.when(F.regexp_like(body, F.lit(_BALANCED)), parts).otherwise(_broken(body))
    # Trimmed here, where each body is made once; filters repeat what follows.
    bodies = F.transform(whole, lambda b: F.trim(b, F.lit(_BLANKS)))
    return df.select(*keep, F.posexplode(bodies).alias("part", "body"))


def read_dump(
    spark: SparkSession,
    path,
    line_sep: str = ";\n",
    whole_files: bool = False,
    delimiters: bool = True,
) -> DataFrame:
    """The statements of a dump: file, block, seq, part, category, table, body.

    ``file, block, seq, part`` order the statements of a file. Compressed files
    are read whole by one task each; ``whole_files`` does so for all files.
    ``delimiters=False`` saves a pass over dumps known to hold no routines and
    no ``;`` + line feed inside quotes or comments; such a cut is an error then.
    """
    records = _records(spark, path, line_sep, whole_files)
    if not delimiters:
        plain = _explode_statements(records, "value", PLACE)
    else:
        # A file is some bytes here, however large it is. Text that no file of a kind needs is not read for that kind.
        files = written(_kinds_of_files(records), "kinds-of-files")
        odd = files.where("odd").select("file")
        no_odd, all_odd = odd.isEmpty(), files.where("not odd").isEmpty()
        plain = None if all_odd and not no_odd else _explode_statements(records if no_odd else records.join(odd, "file", "left_anti"), "value", PLACE)
        if not no_odd:
            lexed = whole_statements(records if all_odd else records.join(odd, "file", "left_semi"), line_sep)
            # Exploded, so that what follows reads each body and does not make it again.
            body = F.trim(_checked(strip_comments(F.col("text"))), F.lit(_BLANKS))
            lexed = lexed.select(*PLACE, "part", F.explode(F.array(body)).alias("body"))
            plain = lexed if plain is None else plain.unionByName(lexed)
    body = F.col("body")
    about = F.struct(category_of(body).alias("category"), table_of(body).alias("table"), "body")
    # Exploded, so that filters by category and table do not make them again.
    return plain.where(~F.regexp_like(body, F.lit(_EMPTY))).select(*PLACE, "part", F.inline(F.array(about)))


def _kinds_of_files(records: DataFrame) -> DataFrame:
    """``file, odd``: odd are files with a DELIMITER line, or with a record that ends inside quotes or a comment.

    In all other files each record begins, as the first does, outside of both.
    """
    value = F.col("value")
    named = F.contains(F.upper(value), F.lit("DELIMITER")) & F.regexp_like(value, F.lit(_MARKER))
    in_comment = F.contains(value, F.lit("--")) & F.regexp_like(value, F.lit(r"--[^\n]*\z"))
    # Most records are names in backquotes, then text with no other quote than an even number of single ones: that is quicker to see.
    plain = ~F.contains(value, F.lit("/*")) & ~F.contains(value, F.lit("--")) & F.regexp_like(value, F.lit(_PLAIN))
    even = (F.length(value) - F.length(F.replace(value, F.lit("'"), F.lit("")))) % 2 == 0
    # Without conditional comments nothing need be made to see it.
    closed = F.when(F.contains(value, F.lit("/*!")), F.regexp_like(strip_comments(value), F.lit(_BALANCED))).otherwise(F.regexp_like(value, F.lit(_CLOSED)))
    is_open = F.when(plain & even, False).otherwise(~closed)
    return records.select("file", (named | in_comment | is_open).alias("odd")).groupBy("file").agg(F.bool_or("odd").alias("odd"))


def select_tables(
    statements: DataFrame,
    tables: list[str] | None = None,
    exclude: list[str] | None = None,
    schema_only: bool = False,
    data_only: bool = False,
) -> DataFrame:
    """Keep or drop schema and data statements by table, by exact name."""
    about = F.col("category").isin("schema", "data")
    out = statements
    if schema_only:
        out = out.where(~F.col("category").isin("data", "routine"))
    elif data_only:
        out = out.where(~F.col("category").isin("schema", "database"))
    if tables:
        out = out.where(~about | F.coalesce(F.col("table").isin(*tables), F.lit(False)))
    if exclude:
        out = out.where(~about | ~F.coalesce(F.col("table").isin(*exclude), F.lit(False)))
    return out


def dump_rows(statements: DataFrame, table: str, columns: list[str]) -> DataFrame:
    """Rows of the INSERT and REPLACE statements of one table.

    Gives the place of each row and ``values``, its raw literals in the
    order of ``columns``. A statement with a column list is matched by name,
    and columns it does not list are NULL.
    """
    data = statements.where((F.col("category") == "data") & (F.col("table") == table))
    head = F.regexp_extract("body", f"({_HEAD})", 1)
    names = F.split(F.regexp_replace(F.regexp_extract("body", _HEAD, 1), r"[`\s\"]", ""), ",")
    # A head without a parenthesis lists no names.
    names = F.when(F.contains("head", F.lit("(")), names).otherwise(F.array(F.lit("")))
    cut = data.withColumn("head", head).withColumns({"names": names, "rest": F.substr("body", F.length("head") + 1)})
    listed = F.element_at("names", 1) != ""
    at = F.transform(F.array(*[F.lit(c) for c in columns]), lambda c: F.array_position("names", c).cast("int") - 1)
    cut = cut.withColumns(
        {
            "flat": F.regexp_extract_all("rest", F.lit(_VALUE), F.lit(1)),
            "listed": listed,
            "at": F.when(listed, at),
            "width": F.when(listed, F.size("names")).otherwise(F.lit(len(columns))),
        }
    )
    # One pass gives the values of all rows; each row is the next ``width`` of
    # them. Array functions keep this short: one expression per column would
    # make a method too long for the JVM to compile.
    n = (F.size("flat") / F.col("width")).cast("int")
    # The values, what precedes each and the commas between rows make up the
    # text. If not, what the rows leave over must be blank.
    exact = F.octet_length(F.array_join("flat", "")) + F.size("flat") + n - 1 == F.octet_length("rest")
    left = F.regexp_replace("rest", _TUPLE, "")
    literal = exact | (F.regexp_like("rest", F.lit(_TUPLE)) & F.regexp_like(left, F.lit(r"^[\s,]*$")))
    # A row ends where a parenthesis closes and nowhere else.
    misplaced = F.array_contains(F.transform("flat", lambda v, i: v.endswith(")") != ((i + 1) % F.col("width") == 0)), True)
    whole = (n > 0) & (n * F.col("width") == F.size("flat")) & ~misplaced
    bare = F.transform(
        "flat", lambda v: F.when(v.endswith(")"), F.rtrim(F.substr(v, F.lit(1), F.length(v) - 1))).otherwise(v)
    )
    start = F.substring("body", 1, 80)
    checked = (
        F.when(
            ~F.coalesce(literal, F.lit(False)),
            F.raise_error(F.concat(F.lit("not a list of literal rows: "), start)),
        )
        .when(~whole, F.raise_error(F.concat(F.lit(f"wrong number of values for {table}: "), start)))
        .otherwise(bare)
    )
    cut = cut.select(*PLACE, "part", "listed", "at", "width", n.alias("n"), checked.alias("flat"))
    each = F.transform(
        F.sequence(F.lit(0), F.col("n") - 1), lambda i: F.slice("flat", i * F.col("width") + 1, F.col("width"))
    )
    rows = cut.select(*PLACE, "part", "listed", "at", F.posexplode(each).alias("row", "fields"))
    named = F.transform("at", lambda i: F.when(i >= 0, F.get("fields", i)))
    return rows.select(*PLACE, "part", "row", F.when(F.col("listed"), named).otherwise(F.col("fields")).alias("values"))


def decode_literal(raw: Column, to: T.DataType, strict: bool = True) -> Column:
    """The value of an SQL literal, without blanks around it, as type ``to``."""
    # A character set introducer (_utf8mb4'...') says nothing about the value.
    given = raw
    raw = F.when(raw.startswith("_"), F.regexp_replace(raw, r"^_\w+\s*", "")).otherwise(raw)
    single, double = raw.startswith("'"), raw.startswith('"')
    inner = F.substr(raw, F.lit(2), F.length(raw) - 2)
    if isinstance(to, (T.StringType, T.BinaryType)):
        doubled = unescape_string(F.replace(inner, F.lit('""'), F.lit('"')))
        if isinstance(to, T.BinaryType):
            quoted, bare = lambda c: F.encode(c, "UTF-8"), typed(raw, to, strict)
        else:
            hexed = F.substring(raw, 1, 2).isin(*HEX_STARTS)
            quoted, bare = lambda c: c, F.when(hexed, F.decode(typed(raw, T.BinaryType()), "UTF-8")).otherwise(raw)
        value = F.when(single, quoted(unescape_string(inner))).when(double, quoted(doubled)).otherwise(bare)
    else:
        value = F.when(single | double, typed(inner, to, strict)).otherwise(typed(raw, to, strict))
    value = F.when(~raw.isin("NULL", "null", "Null"), value)
    if isinstance(to, (T.BooleanType, T.NumericType)):
        # Most numbers stand bare: one look saves them the others.
        return F.when(F.regexp_like(given, F.lit(_NUMBER)), given.cast(to) if strict else given.try_cast(to)).otherwise(value)
    return value


def load_dump(
    spark: SparkSession, path, table: str, schema: T.StructType, statements: DataFrame | None = None, **options
) -> DataFrame:
    """The rows of one table of a dump with the given schema.

    A statement with a column list is matched by name; columns it does not
    list are NULL.
    """
    if statements is None:
        statements = read_dump(spark, path, **options)
    rows = dump_rows(statements, table, schema.names)
    out = []
    for i, f in enumerate(schema.fields):
        out.append(decode_literal(F.col("values")[i], f.dataType).alias(f.name))
    return rows.select(*out)
