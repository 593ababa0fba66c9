"""Queries that show each expression over a whole table."""

from __future__ import annotations

from pyspark.sql import functions as F

from mysem import functions as M
from mysem.functions.sql import register
from mysem.plans.registry import query

# --- predicates and conditionals ---


@query(
    "null_safe_eq",
    """select o_orderkey, nullif(o_orderstatus, 'F') is not distinct from nullif(o_orderstatus, 'P') as same
    from orders""",
)
def _(t):
    a, b = (F.nullif("o_orderstatus", F.lit(v)) for v in ("F", "P"))
    return t.orders.select("o_orderkey", M.null_safe_eq(a, b).alias("same"))


@query("like_ci", "select c_custkey, c_mktsegment from customer where c_mktsegment ilike '%build%'")
def _(t):
    return t.customer.where(M.like_ci("c_mktsegment", "%build%")).select("c_custkey", "c_mktsegment")


@query("not_like_ci", "select c_custkey, c_mktsegment from customer where c_mktsegment not ilike 'auto_OBILE'")
def _(t):
    return t.customer.where(M.not_like_ci("c_mktsegment", "auto_OBILE")).select("c_custkey", "c_mktsegment")


@query("regexp_ci", "select p_partkey, p_name from part where regexp_matches(p_name, '^(SMALL|RED).*[gt]$', 'is')")
def _(t):
    return t.part.where(M.regexp_ci("p_name", "^(SMALL|RED).*[gt]$")).select("p_partkey", "p_name")


@query("not_regexp_ci", "select p_partkey, p_name from part where not regexp_matches(p_name, 'ING|^BL', 'is')")
def _(t):
    return t.part.where(M.not_regexp_ci("p_name", "ING|^BL")).select("p_partkey", "p_name")


_SOUNDEX = """(select p_partkey, word, substr(word, 1, 1) || rpad(substr(replace(substr(code, 2), '0', ''), 1, 3), 3, '0') as code
  from (select p_partkey, word, regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(
      regexp_replace(translate(word, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', '01230120022455012623010202'),
      '0+', '0', 'g'), '1+', '1', 'g'), '2+', '2', 'g'), '3+', '3', 'g'), '4+', '4', 'g'), '5+', '5', 'g'), '6+', '6', 'g') as code
    from (select p_partkey, upper(split_part(p_name, ' ', 1)) as word from part)))"""


@query("sounds_like", f"select p_partkey, code, code = 'R300' as sounds from {_SOUNDEX}")
def _(t):
    word = F.split_part("p_name", F.lit(" "), F.lit(1))
    return t.part.select(
        "p_partkey", M.soundex(word).alias("code"), M.sounds_like(word, F.lit("Reddy")).alias("sounds")
    )


@query("if_expr", "select o_orderkey, case when o_totalprice > 150000 then 'big' else 'small' end as size from orders")
def _(t):
    return t.orders.select("o_orderkey", M.if_expr(F.col("o_totalprice") > 150000, "big", "small").alias("size"))


@query("ifnull", "select c_custkey, coalesce(nullif(c_mktsegment, 'BUILDING'), 'none') as segment from customer")
def _(t):
    return t.customer.select("c_custkey", M.ifnull(F.nullif("c_mktsegment", F.lit("BUILDING")), "none").alias("segment"))


@query("isnull", "select c_custkey, nullif(c_mktsegment, 'BUILDING') is null as missing from customer")
def _(t):
    return t.customer.select("c_custkey", M.isnull(F.nullif("c_mktsegment", F.lit("BUILDING"))).alias("missing"))


@query(
    "zero_date_to_null",
    """select o_orderkey, case when o_orderstatus in ('P', 'F') then null else cast(o_orderdate as date) end as d
    from orders""",
)
def _(t):
    text = (
        F.when(F.col("o_orderstatus") == "P", "0000-00-00")
        .when(F.col("o_orderstatus") == "F", "0000-00-00 00:00:00")
        .otherwise(F.col("o_orderdate").cast("string"))
    )
    dirty = t.orders.select("o_orderkey", text.alias("d"))
    return M.zero_dates_to_null(dirty, ["d"]).withColumn("d", F.col("d").cast("timestamp").cast("date"))


@query(
    "find_in_set",
    """select o_orderkey, list_contains(string_split(replace(o_orderpriority, '-', ','), ','), 'LOW') as low,
      case when o_orderstatus = 'F' then false
        else list_contains(string_split(o_orderstatus || ',,' || o_orderpriority, ','), '') end as blank
    from orders""",
)
def _(t):
    csv = F.translate("o_orderpriority", "-", ",")
    other = F.when(F.col("o_orderstatus") == "F", "").otherwise(F.concat_ws(",,", "o_orderstatus", "o_orderpriority"))
    return t.orders.select(
        "o_orderkey", M.find_in_set("LOW", csv).alias("low"), M.find_in_set("", other).alias("blank")
    )


@query(
    "field_rank",
    """select o_orderkey, cast(list_position(['3-MEDIUM', '1-URGENT', '5-LOW'], o_orderpriority) as integer) as pos
    from orders""",
)
def _(t):
    return t.orders.select("o_orderkey", M.field_rank("o_orderpriority", "3-MEDIUM", "1-URGENT", "5-LOW").alias("pos"))


@query("elt", "select p_partkey, list_extract(['one', 'two', 'three'], p_size) as word from part")
def _(t):
    return t.part.select("p_partkey", M.elt("p_size", "one", "two", "three").alias("word"))


@query(
    "strcmp",
    """select c_custkey, case when s < 'FURNITURE' then -1 when s > 'FURNITURE' then 1 else 0 end as cmp
    from (select c_custkey, nullif(c_mktsegment, 'MACHINERY') as s from customer)""",
)
def _(t):
    s = F.nullif("c_mktsegment", F.lit("MACHINERY"))
    return t.customer.select("c_custkey", M.strcmp(s, F.lit("FURNITURE")).alias("cmp"))


@query(
    "cast_unsigned",
    """select o_orderkey, cast(round_even(o_totalprice, 0) as bigint) as price,
      cast(round(cast(o_totalprice as decimal(14,1)), 0) as bigint) as dec_price from orders""",
)
def _(t):
    return t.orders.select(
        "o_orderkey",
        M.cast_unsigned("o_totalprice").alias("price"),
        M.cast_unsigned(F.col("o_totalprice").cast("decimal(14,1)")).alias("dec_price"),
    )


@query(
    "cast_signed",
    """select p_partkey, cast(round_even(p_size / 2.0::double, 0) as integer) as half,
      cast(round_even(0 - p_retailprice, 0) as integer) as price from part""",
)
def _(t):
    return t.part.select(
        "p_partkey", M.cast_signed(F.col("p_size") / 2).alias("half"), M.cast_signed(-F.col("p_retailprice")).alias("price")
    )


@query(
    "cast_char",
    "select o_orderkey, cast(o_custkey as varchar) as cust, substr(cast(o_orderdate as varchar), 1, 10) as day from orders",
)
def _(t):
    return t.orders.select("o_orderkey", M.cast_char("o_custkey").alias("cust"), M.cast_char("o_orderdate", 10).alias("day"))


@query("cast_datetime", "select o_orderkey, o_orderdate as at from orders")
def _(t):
    return t.orders.select("o_orderkey", M.cast_datetime(F.col("o_orderdate").cast("string")).alias("at"))


@query(
    "convert_type",
    """select o_orderkey, cast(round_even(o_totalprice, 0) as bigint) as u, cast(o_custkey as varchar) as c,
      cast(o_orderdate as date) as d from orders""",
)
def _(t):
    return t.orders.select(
        "o_orderkey",
        M.convert_type("o_totalprice", "UNSIGNED").alias("u"),
        M.convert_type("o_custkey", "CHAR").alias("c"),
        M.convert_type("o_orderdate", "DATE").alias("d"),
    )


# --- strings ---


@query("locate", "select doc_id, cast(position('on' in text) as integer) as at from documents")
def _(t):
    return t.documents.select("doc_id", M.locate("on", "text").alias("at"))


@query("instr", "select page_id, cast(instr(html, '</p>') as integer) as at from pages")
def _(t):
    return t.pages.select("page_id", M.instr("html", "</p>").alias("at"))


@query("char_fn", "select p_partkey, chr(64 + p_size) as a, chr(200 + p_size * 40) as b from part")
def _(t):
    size = F.col("p_size")
    return t.part.select("p_partkey", M.char_fn(size + 64).alias("a"), M.char_fn(size * 40 + 200).alias("b"))


@query("space", "select p_partkey, '[' || repeat(' ', p_size) || ']' as pad from part")
def _(t):
    return t.part.select("p_partkey", F.concat(F.lit("["), M.space(F.col("p_size")), F.lit("]")).alias("pad"))


@query("hex_str", "select doc_id, lower(hex(text)) as h from documents")
def _(t):
    return t.documents.select("doc_id", M.hex_str("text").alias("h"))


@query("unhex_str", "select item_id, decode(unhex(hex(text))) as text from benchmark")
def _(t):
    return t.benchmark.select("item_id", M.unhex_str(M.hex_str("text")).cast("string").alias("text"))


@query(
    "escape_string",
    r"""select doc_id, replace(replace(replace(replace(replace(replace(replace(text, '\', '\\'), '''', ''''''),
      chr(10), '\n'), chr(13), '\r'), chr(9), '\t'), chr(0), '\0'), chr(26), '\Z') as escaped from documents""",
)
def _(t):
    return t.documents.select("doc_id", M.escape_string("text").alias("escaped"))


@query("unescape_string", "select page_id, html from pages")
def _(t):
    return t.pages.select("page_id", M.unescape_string(M.escape_string("html")).alias("html"))


# --- numbers ---


@query(
    "rand_fn",
    "select count(*) as n, true as at_least_zero, true as below_one, true as spread from lineitem",
)
def _(t):
    return t.lineitem.select(M.rand_fn(7).alias("r")).agg(
        F.count("*").alias("n"),
        (F.min("r") >= 0).alias("at_least_zero"),
        (F.max("r") < 1).alias("below_one"),
        (F.avg("r").between(0.45, 0.55)).alias("spread"),
    )


@query(
    "truncate_num",
    """select c_custkey, cast(trunc(cast(c_acctbal as decimal(18,4)) * 10) / 10 as decimal(18,2)) as one,
      cast(trunc(cast(0 - c_acctbal as decimal(18,4)) / 100) * 100 as decimal(18,2)) as hundreds from customer""",
)
def _(t):
    return t.customer.select(
        "c_custkey",
        M.truncate_num("c_acctbal", 1).cast("decimal(18,2)").alias("one"),
        M.truncate_num(-F.col("c_acctbal"), -2).cast("decimal(18,2)").alias("hundreds"),
    )


@query("log_natural", "select p_partkey, round(ln(p_retailprice), 9) as v from part")
def _(t):
    return t.part.select("p_partkey", F.round(M.log_natural("p_retailprice"), 9).alias("v"))


@query("log_base", "select p_partkey, round(ln(p_retailprice) / ln(3), 9) as v from part")
def _(t):
    return t.part.select("p_partkey", F.round(M.log_base(3, "p_retailprice"), 9).alias("v"))


@query("log2", "select p_partkey, round(log2(p_retailprice), 9) as v from part")
def _(t):
    return t.part.select("p_partkey", F.round(M.log2("p_retailprice"), 9).alias("v"))


@query("log10", "select p_partkey, round(log10(p_retailprice), 9) as v from part")
def _(t):
    return t.part.select("p_partkey", F.round(M.log10("p_retailprice"), 9).alias("v"))


# --- dates and times ---

_FORMATS = {
    "full": ("%Y-%m-%d %H:%i:%s", "%Y-%m-%d %H:%M:%S"),
    "names": ("%W, %M %e, %Y", "%A, %B %-d, %Y"),
    "short": ("%a %b %d %y", "%a %b %d %y"),
    "clock": ("%h:%i:%S %p", "%I:%M:%S %p"),
    "micros": ("%T.%f", "%H:%M:%S.%f"),
    "daynum": ("%c/%e/%y day %j", "%-m/%-d/%y day %j"),
    "half": ("at %r o'clock", "at %I:%M:%S %p o''clock"),
}


@query(
    "date_format",
    "select event_id, "
    + ", ".join(f"strftime(ts, '{duck}') as {name}" for name, (_, duck) in _FORMATS.items())
    + ", 'W' || lpad(cast(week(ts) as varchar), 2, '0') as weeknum from events",
)
def _(t):
    texts = [M.date_format("ts", fmt).alias(name) for name, (fmt, _) in _FORMATS.items()]
    return t.events.select("event_id", *texts, M.date_format("ts", "W%V").alias("weeknum"))


@query(
    "str_to_date",
    """select event_id, date_trunc('second', ts) as a, cast(cast(ts as date) as timestamp) as b,
      date_trunc('second', ts) as c, cast(null as timestamp) as d from events""",
)
def _(t):
    def parsed(fmt, **options):
        return M.str_to_date(M.date_format("ts", fmt), fmt, **options)

    return t.events.select(
        "event_id",
        parsed("%d/%c/%Y %T").alias("a"),
        parsed("%M %e, %Y").alias("b"),
        parsed("%Y%m%d%H%i%s").alias("c"),
        M.str_to_date("event_type", "%Y-%m-%d", on_error="null").alias("d"),
    )


@query(
    "curdate",
    """select count(*) as n, true as one_date, true as one_time, true as one_moment, true as same_day from orders""",
)
def _(t):
    now = t.orders.select(M.curdate().alias("d"), M.curtime().alias("c"), M.sysdate().alias("s"))
    return now.agg(
        F.count("*").alias("n"),
        (F.min("d") == F.max("d")).alias("one_date"),
        (F.min("c") == F.max("c")).alias("one_time"),
        (F.min("s") == F.max("s")).alias("one_moment"),
        (F.min(F.to_date("s")) == F.min("d")).alias("same_day"),
    )


@query("unix_timestamp", "select event_id, cast(round(epoch(ts)) as bigint) as sec from events")
def _(t):
    return t.events.select("event_id", M.unix_timestamp("ts").alias("sec"))


@query("unix_timestamp_now", "select count(*) as n, true as one_value, true as recent from orders")
def _(t):
    return t.orders.select(M.unix_timestamp_now().alias("u")).agg(
        F.count("*").alias("n"),
        (F.min("u") == F.max("u")).alias("one_value"),
        (F.min("u") > 1_600_000_000).alias("recent"),
    )


@query("from_unixtime", "select o_orderkey, make_timestamp(o_orderkey * 86413 * 1000000) as at from orders")
def _(t):
    return t.orders.select("o_orderkey", M.from_unixtime(F.col("o_orderkey") * 86413).alias("at"))


@query(
    "datediff",
    "select event_id, cast(date_diff('day', date '2023-12-31', cast(ts as date)) as integer) as days from events",
)
def _(t):
    return t.events.select("event_id", M.datediff("ts", F.lit("2023-12-31").cast("date")).alias("days"))


@query(
    "date_add",
    """select o_orderkey, o_orderdate + to_months(1) as a_month, o_orderdate + to_hours(36) as hours,
      o_orderdate + to_days(7 * cast(o_custkey as integer)) as weeks, cast(o_orderdate as date) + to_years(1) as a_year,
      o_orderdate + to_months(3) as a_quarter from orders""",
)
def _(t):
    day = F.col("o_orderdate").cast("date")
    return t.orders.select(
        "o_orderkey",
        M.date_add("o_orderdate", 1, "MONTH").alias("a_month"),
        M.date_add("o_orderdate", 36, "HOUR").alias("hours"),
        M.date_add("o_orderdate", F.col("o_custkey").cast("int"), "WEEK").alias("weeks"),
        M.date_add(day, 1, "YEAR").alias("a_year"),
        M.date_add("o_orderdate", 1, "QUARTER").alias("a_quarter"),
    )


@query(
    "date_sub",
    """select event_id, ts - to_days(45) as days, ts - to_months(2) as months, ts - to_seconds(90) as secs from events""",
)
def _(t):
    return t.events.select(
        "event_id",
        M.date_sub("ts", 45, "DAY").alias("days"),
        M.date_sub("ts", 2, "MONTH").alias("months"),
        M.date_sub("ts", 90, "SECOND").alias("secs"),
    )


@query(
    "year_month_day_hour_minute",
    """select event_id, cast(extract(year from ts) as integer) as y, cast(extract(month from ts) as integer) as mo,
      cast(extract(day from ts) as integer) as d, cast(extract(hour from ts) as integer) as h,
      cast(extract(minute from ts) as integer) as mi from events""",
)
def _(t):
    parts = {"y": M.year, "mo": M.month, "d": M.day, "h": M.hour, "mi": M.minute}
    return t.events.select("event_id", *[fn("ts").alias(n) for n, fn in parts.items()])


@query("second", "select event_id, extract(microsecond from ts) / 1000000.0::double as s from events")
def _(t):
    return t.events.select("event_id", M.second("ts").cast("double").alias("s"))


@query(
    "dayofweek",
    "select o_orderkey, cast(extract(dow from o_orderdate) + 1 as integer) as dow from orders",
)
def _(t):
    return t.orders.select("o_orderkey", M.dayofweek("o_orderdate").alias("dow"))


@query(
    "dayofmonth_dayofyear",
    """select o_orderkey, cast(dayofmonth(o_orderdate) as integer) as dom, cast(dayofyear(o_orderdate) as integer) as doy
    from orders""",
)
def _(t):
    return t.orders.select(
        "o_orderkey", M.dayofmonth("o_orderdate").alias("dom"), M.dayofyear("o_orderdate").alias("doy")
    )


@query(
    "week_weekofyear",
    "select o_orderkey, cast(week(o_orderdate) as integer) as w, cast(week(o_orderdate) as integer) as woy from orders",
)
def _(t):
    return t.orders.select("o_orderkey", M.week("o_orderdate").alias("w"), M.weekofyear("o_orderdate").alias("woy"))


@query("last_day", "select o_orderkey, last_day(cast(o_orderdate as date)) as d from orders")
def _(t):
    return t.orders.select("o_orderkey", M.last_day("o_orderdate").alias("d"))


@query(
    "date_part_time_part",
    """select event_id, cast(ts as date) as d, strftime(ts, '%H:%M:%S') as c, extract(microsecond from ts) as us
    from events""",
)
def _(t):
    clock = M.time_part("ts")
    micros = F.rpad(F.regexp_extract(clock, r"\.(\d+)", 1), 6, "0").cast("bigint") + F.substring(clock, 7, 2).cast("int") * 1000000
    return t.events.select(
        "event_id", M.date_part("ts").alias("d"), F.substring(clock, 1, 8).alias("c"), micros.alias("us")
    )


@query(
    "sql_functions",
    """select event_id, lower(hex(event_type)) as h, cast(round(epoch(ts)) as bigint) as sec,
      event_type ilike '%li%' as m, cast(date_diff('day', date '2024-01-01', cast(ts as date)) as integer) as days
    from events""",
)
def _(t):
    register(t.spark)
    return t.events.selectExpr(
        "event_id",
        "my_hex(event_type) as h",
        "my_unix_timestamp(ts) as sec",
        "my_regexp(event_type, 'LI') as m",
        "my_datediff(ts, date'2024-01-01') as days",
    )
