"""Queries for files, dumps, validation and metadata."""

from __future__ import annotations

from pyspark.sql import functions as F

from mysem.operators import mutate
from mysem.operators.relational import order_by
from mysem.plans import jobs, profile
from mysem.plans.registry import query
from mysem.session import new_path
from mysem.sources import dump_read, dump_write, tables, types

# --- scans and files ---


@query("scan_where", "select * from orders where o_totalprice > 250000 and o_orderstatus = 'F'")
def _(t):
    return tables.scan(t.spark, f"{t.path}/orders.parquet", "o_totalprice > 250000 and o_orderstatus = 'F'")


@query("load_csv", "select * from customer")
def _(t):
    path = new_path(t.spark, "customer-csv")
    t.customer.write.option("header", True).csv(path)
    return tables.load_data(t.spark, path, t.customer.schema)


@query("load_csv_line_feeds", """select doc_id, text || chr(10) || '"' || chr(10) || coalesce(lang, '') as text, source from documents""")
def _(t):
    text = F.concat("text", F.lit('\n"\n'), F.coalesce("lang", F.lit("")))
    docs = t.documents.select("doc_id", text.alias("text"), "source")
    path = new_path(t.spark, "documents-csv")
    docs.write.options(header=True, quote='"', escape='"').csv(path)
    return tables.load_data(t.spark, path, docs.schema, multi_line=True)


@query(
    "write_batch_tsv",
    "select c_custkey, c_name, nullif(c_mktsegment, 'BUILDING') as seg, c_acctbal from customer",
)
def _(t):
    df = t.customer.select("c_custkey", "c_name", F.nullif("c_mktsegment", F.lit("BUILDING")).alias("seg"), "c_acctbal")
    path = new_path(t.spark, "customer-tsv")
    tables.write_tsv(df, path)
    return tables.read_tsv(t.spark, path, df.schema)


@query(
    "write_batch_tsv_lines",
    """select c_custkey || chr(9) || c_name || chr(9) || coalesce(nullif(c_mktsegment, 'BUILDING'), 'NULL') as line from customer""",
)
def _(t):
    df = t.customer.select("c_custkey", "c_name", F.nullif("c_mktsegment", F.lit("BUILDING")).alias("seg"))
    path = new_path(t.spark, "customer-tsv")
    tables.write_tsv(df, path, header=False)
    return t.spark.read.text(path).withColumnRenamed("value", "line")


# --- dumps ---


def _dump(t, names, **options):
    path = new_path(t.spark, "dump")
    jobs.dump_all_tables({n: getattr(t, n) for n in names}, path, **options)
    return f"{path}/*"


@query(
    "export_inserts",
    """select 'REPLACE INTO `orders` (`o_orderkey`, `o_orderstatus`, `o_totalprice`, `o_orderdate`) VALUES (' || o_orderkey || ',''' ||
      o_orderstatus || ''',' || o_totalprice || ',''' || strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') || ''');' as line from orders""",
)
def _(t):
    df = t.orders.select("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate")
    path = new_path(t.spark, "orders-dump")
    dump_write.export_inserts(df, path, "orders", mode="replace", complete=True, rows_per_stmt=1)
    return t.spark.read.text(path).withColumnRenamed("value", "line")


@query(
    "export_inserts_batches",
    "select count(*) as n_rows, true as full_batches from lineitem",
)
def _(t):
    lines = dump_write.insert_statements(t.lineitem, "lineitem", mode="ignore")
    rows = F.size(F.split("value", r"\),\("))
    return lines.agg(F.sum(rows).alias("n_rows"), (F.max(rows) <= 100).alias("full_batches"))


@query(
    "sql_literal",
    r"""select event_id, cast(event_id as varchar) as l_event_id, '''' || strftime(ts, '%Y-%m-%d %H:%M:%S') as l_ts,
      cast(user_id as varchar) as l_user_id, '''' || event_type || '''' as l_event_type,
      case when value > 50 then '1' when value <= 50 then '0' else 'NULL' end as l_big,
      'X''' || lower(hex(event_type)) || '''' as l_bytes, '0x' || lower(hex(event_type)) as l_hex,
      coalesce('''' || strftime(case when event_type = 'error' then null else ts end, '%Y-%m-%d') || '''', 'NULL') as l_day,
      '''' || props || '''' as l_props
    from events""",
)
def _(t):
    df = t.events.select(
        "event_id",
        "ts",
        "user_id",
        "event_type",
        (F.col("value") > 50).alias("big"),
        F.encode("event_type", "UTF-8").alias("bytes"),
        F.when(F.col("event_type") != "error", F.to_date("ts")).alias("day"),
        "props",
    )
    lits = {f.name: dump_write.sql_literal(F.col(f.name), f.dataType) for f in df.schema.fields}
    lits["hex"] = dump_write.sql_literal(F.col("bytes"), df.schema["bytes"].dataType, hex_blob=True)
    # The fraction has its own test; engines trim it differently.
    lits["ts"] = F.substring(lits["ts"], 1, 20)
    return df.select("event_id", *[c.alias(f"l_{n}") for n, c in lits.items()])


@query(
    "read_dump",
    """select 'customer' as "table", 'data' as category, count(*) as n from customer
    union all select 'supplier', 'data', count(*) from supplier
    union all select 'customer', 'schema', 1 union all select 'supplier', 'schema', 1""",
)
def _(t):
    path = _dump(t, ["customer", "supplier"], rows_per_stmt=1)
    return dump_read.read_dump(t.spark, path).groupBy("table", "category").agg(F.count("*").alias("n"))


@query("load_dump_rows", "select * from documents")
def _(t):
    return dump_read.load_dump(t.spark, _dump(t, ["documents", "labels"]), "documents", t.documents.schema)


@query("load_dump_pages", "select * from pages")
def _(t):
    return dump_read.load_dump(t.spark, _dump(t, ["pages"], complete=True), "pages", t.pages.schema)


@query("load_dump_lineitem", "select * from lineitem")
def _(t):
    return dump_read.load_dump(t.spark, _dump(t, ["lineitem"]), "lineitem", t.lineitem.schema)


_RAW = r"""case l_linenumber % 4 when 0 then l_linestatus || ';' || chr(10) || 'it''s' when 1 then l_linestatus || chr(10) || '-- "' || l_returnflag
      when 2 then '/* ' || l_linestatus || ';' || chr(10) when 3 then chr(10) || 'DELIMITER //' || chr(10) || l_linestatus || chr(92) end"""


@query("load_dump_raw_newlines", f"select l_orderkey, l_linenumber, {_RAW} as note from lineitem")
def _(t):
    rows = t.lineitem.select("l_orderkey", "l_linenumber", F.expr(_RAW).alias("note"))
    # Written raw: only quotes and backslashes are escaped, so statements hold ; + line feed in quotes, comments and routines.
    literal = F.concat(F.lit("'"), F.replace(F.replace("note", F.lit("\\"), F.lit("\\\\")), F.lit("'"), F.lit("''")), F.lit("'"))
    kind = F.col("l_orderkey") % 5
    before = F.when(kind == 0, "/* it's;\n \"old */ ").when(kind == 1, "-- it's;\n").when(
        kind == 2, "DELIMITER //\nCREATE PROCEDURE p() BEGIN SELECT 'a;\n'; SELECT 2;\nEND//\nDELIMITER ;\n"
    )
    insert = F.concat(F.coalesce(before, F.lit("")), F.lit("INSERT INTO `notes` VALUES ("), F.concat_ws(",", "l_orderkey", "l_linenumber", literal), F.lit(");"))
    path = new_path(t.spark, "notes-dump")
    rows.select(insert.alias("value")).write.text(path)
    return dump_read.load_dump(t.spark, path, "notes", rows.schema)


@query("load_dump_events", "select * from events")
def _(t):
    path = _dump(t, ["events"], mode="replace", compression="gzip")
    return dump_read.load_dump(t.spark, path, "events", t.events.schema)


@query(
    "dump_select_tables",
    """select 'part' as "table", count(*) as n from part union all select 'supplier', count(*) from supplier""",
)
def _(t):
    path = _dump(t, ["part", "supplier", "nation"], rows_per_stmt=1)
    kept = dump_read.select_tables(
        dump_read.read_dump(t.spark, path), tables=["part", "supplier", "nation"], exclude=["nation"], data_only=True
    )
    return kept.groupBy("table").agg(F.count("*").alias("n"))


@query(
    "dump_conditional_comments",
    """select p_partkey, 'SET ' || p_name || ' = ''' || p_type || ' -- kept /* too */''' || p_size as body from part""",
)
def _(t):
    text = F.format_string(
        "/*!40101 SET %s */ -- gone\n/* it's gone */= '%s -- kept /* too */'/*!50003 %d*/",
        "p_name",
        "p_type",
        "p_size",
    )
    body = F.regexp_replace(dump_read.strip_comments(text), r"\s+=", " =")
    return t.part.select("p_partkey", body.alias("body"))


# --- jobs ---

_MOVED = ("customer", "orders", "supplier", "labels")


@query(
    "migrate_tables",
    " union all ".join(
        f"select '{n}' as table_name, count(*) as source_rows, count(*) as target_rows, cast(0 as bigint) as rejected_rows, true as match from {n}"
        for n in _MOVED
    ),
)
def _(t):
    schemas = {n: getattr(t, n).schema for n in _MOVED}
    report = jobs.migrate_tables(t.spark, _dump(t, _MOVED), new_path(t.spark, "migrated"), schemas=schemas)
    return report.drop("error")


@query(
    "migrate_rejects",
    """select cast(o_orderkey as varchar) as o_orderkey, cast(o_custkey as varchar) as o_custkey, 'n/a' as o_totalprice, 'o_totalprice' as failing,
      (select count(*) from orders where o_orderstatus <> 'P') as kept, (select count(*) from orders where o_orderstatus = 'P') as rejected
    from orders where o_orderstatus = 'P'""",
)
def _(t):
    path, target = new_path(t.spark, "orders-text"), new_path(t.spark, "migrated")
    dump_write.export_inserts(_orders_as_text(t), path, "orders")
    report = jobs.migrate_tables(t.spark, path, target, declared={"orders": _ORDERS_AS_MYSQL})
    rejects = t.spark.read.parquet(f"{target}/_rejects/orders").select("o_orderkey", "o_custkey", "o_totalprice", F.array_join("rejected_columns", ",").alias("failing"))
    # The report is one row.
    counts = report.first()
    return rejects.select("*", F.lit(counts.target_rows).alias("kept"), F.lit(counts.rejected_rows).alias("rejected"))


@query(
    "replace_snapshot",
    """select o_orderkey, o_orderstatus, case when o_orderstatus = 'F' then o_totalprice * 2 else o_totalprice end as o_totalprice from orders""",
)
def _(t):
    path = new_path(t.spark, "orders")
    orders = t.orders.select("o_orderkey", "o_orderstatus", "o_totalprice")
    mutate.truncate_reload(orders, path)
    read = t.spark.read.schema(orders.schema).parquet(path)
    # The table is read and replaced in one call.
    doubled = F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice") * 2).otherwise(F.col("o_totalprice"))
    return mutate.truncate_reload(read.withColumn("o_totalprice", doubled), path)


@query(
    "table_diff",
    """select o_orderkey, case when o_orderkey % 50 = 7 then 'missing' else 'changed' end as difference,
      case when o_orderkey % 50 = 7 then '' when o_orderkey % 70 = 3 then 'o_orderstatus,o_totalprice' else 'o_totalprice' end as columns
    from orders where o_orderkey % 50 = 7 or o_orderkey % 70 in (3, 4)
    union all select -1 - c_custkey, 'extra', '' from customer where c_custkey % 100 = 5""",
)
def _(t):
    orders = t.orders.select("o_orderkey", "o_orderstatus", "o_totalprice")
    part = F.col("o_orderkey") % 70
    target = orders.where("o_orderkey % 50 <> 7").withColumns(
        {"o_totalprice": F.when(part.isin(3, 4), F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")), "o_orderstatus": F.when(part == 3, "?").otherwise(F.col("o_orderstatus"))}
    )
    extra = t.customer.where("c_custkey % 100 = 5").select((-1 - F.col("c_custkey")).alias("o_orderkey"), F.lit("N").alias("o_orderstatus"), F.lit(0.0).alias("o_totalprice"))
    found = jobs.table_diff(orders, target.unionByName(extra), ["o_orderkey"])
    return found.select("o_orderkey", "difference", F.array_join("changed_columns", ",").alias("columns"))


@query(
    "row_counts",
    """with c as (select 'nation' as table_name, count(*) as n_rows from nation union all select 'events', count(*) from events
      union all select 'pages', count(*) from pages)
    select * from c union all select 'total', cast(sum(n_rows) as bigint) from c""",
)
def _(t):
    return jobs.row_counts({n: getattr(t, n) for n in ("nation", "events", "pages")}, total=True)


@query(
    "validate_counts",
    "select 'orders' as table_name, count(*) as source_rows, count(*) filter (where o_orderstatus <> 'P') as target_rows, false as match from orders"
    " union all select 'customer', count(*), count(*), true from customer",
)
def _(t):
    source = {"orders": t.orders, "customer": t.customer}
    target = {"orders": t.orders.where("o_orderstatus <> 'P'"), "customer": t.customer}
    return jobs.validate_counts(source, target)


@query(
    "validate_checksums",
    "select 'part' as table_name, count(*) as source_rows, true as match from part"
    " union all select 'customer', count(*), false from customer",
)
def _(t):
    schema = t.part.schema
    back = dump_read.load_dump(t.spark, _dump(t, ["part"]), "part", schema)
    changed = F.when(F.col("c_custkey") == 7, "x").otherwise(F.col("c_name"))
    source = {"part": t.part, "customer": t.customer}
    target = {"part": back, "customer": t.customer.withColumn("c_name", changed)}
    return jobs.validate_checksums(source, target).select("table_name", "source_rows", "match")


@query(
    "fk_orphans",
    """select o_custkey, count(*) as n_rows from orders
    where not exists (select 1 from customer where c_custkey = o_custkey and c_acctbal > 2000) group by o_custkey""",
)
def _(t):
    return jobs.fk_orphans(t.orders, ["o_custkey"], t.customer.where("c_acctbal > 2000"), ["c_custkey"])


_DUMPED = ("region", "nation", "customer", "supplier", "part", "orders", "events", "documents", "embeddings", "labels", "conversations", "benchmark")


@query(
    "dump_all_tables",
    " union all ".join(f"select '{n}' as table_name, count(*) as n_rows from {n}" for n in _DUMPED if n != "benchmark"),
)
def _(t):
    parents = {"customer": ["nation"], "nation": ["region"], "orders": ["customer"]}
    path = _dump(t, _DUMPED, ignore=["benchmark"], parents=parents)
    statements = jobs.by_table(dump_read.read_dump(t.spark, path))
    names = [n for n in _DUMPED if n != "benchmark"]
    back = {n: dump_read.load_dump(t.spark, None, n, getattr(t, n).schema, statements=statements) for n in names}
    return jobs.row_counts(back)


# --- schema and metadata ---

_ORDERS_AS_MYSQL = {
    "o_orderkey": "bigint(20) unsigned",
    "o_custkey": "int(10) unsigned",
    "o_orderstatus": "enum('F','O','P')",
    "o_totalprice": "decimal(12,2)",
    "o_orderdate": "date",
}


def _orders_as_text(t):
    orders = t.orders.select(*[F.col(c).cast("string").alias(c) for c in _ORDERS_AS_MYSQL])
    # Dates of open orders are unknown, prices of pending ones are damaged.
    return orders.withColumns(
        {
            "o_orderdate": F.when(F.col("o_orderstatus") == "O", "0000-00-00").otherwise(F.substring("o_orderdate", 1, 10)),
            "o_totalprice": F.when(F.col("o_orderstatus") == "P", "n/a").otherwise(F.col("o_totalprice")),
        }
    )


@query(
    "apply_mysql_schema",
    """select o_orderkey, o_custkey, o_orderstatus, cast(round(o_totalprice, 2) as double) as o_totalprice,
      case when o_orderstatus = 'O' then null else cast(o_orderdate as date) end as o_orderdate
    from orders where o_orderstatus <> 'P'""",
)
def _(t):
    good, _ = types.apply_mysql_schema(_orders_as_text(t), _ORDERS_AS_MYSQL)
    return good.withColumns(
        {"o_orderkey": F.col("o_orderkey").cast("bigint"), "o_totalprice": F.col("o_totalprice").cast("double")}
    )


@query(
    "apply_mysql_schema_rejects",
    "select cast(o_orderkey as varchar) as o_orderkey, 'n/a' as o_totalprice, 'o_totalprice' as failing from orders where o_orderstatus = 'P'",
)
def _(t):
    _, rejects = types.apply_mysql_schema(_orders_as_text(t), _ORDERS_AS_MYSQL)
    return rejects.select("o_orderkey", "o_totalprice", F.array_join("rejected_columns", ",").alias("failing"))


def _described(table, columns):
    parts, first = [], None
    for name, shown in columns:
        unique = f"count(distinct {name}) = count({name}) and count({name}) > 0"
        key = f"case when {unique} and count({name}) = count(*) then 'K' when {unique} then 'UNI' else '' end"
        parts.append(
            f"""select '{name}' as "Field", '{shown}' as "Type", case when count({name}) = count(*) then 'NO' else 'YES' end as "Null",
            {key} as "Key", 'NULL' as "Default", '' as "Extra" from {table}"""
        )
    return " union all ".join(parts)


@query(
    "describe_columns",
    'select "Field", "Type", "Null", case when "Key" <> \'K\' then "Key" when "Field" = \'s_suppkey\' then \'PRI\' else \'UNI\' end as "Key", "Default", "Extra" from ('
    + _described(
        "(select s_suppkey, s_name, s_nationkey, s_acctbal, nullif(s_nationkey, 3) as maybe from supplier)",
        [
            ("s_suppkey", "bigint(20)"),
            ("s_name", "text"),
            ("s_nationkey", "int(11)"),
            ("s_acctbal", "double"),
            ("maybe", "int(11)"),
        ],
    )
    + ")",
)
def _(t):
    return profile.describe_columns(t.supplier.withColumn("maybe", F.nullif("s_nationkey", F.lit(3))))


@query(
    "table_status",
    """select 'customer' as "Name", count(*) as "Rows", cast(floor(sum(s) / count(*)) as bigint) as "Avg_row_length", cast(sum(s) as bigint) as "Data_length"
    from (select strlen(c_custkey::varchar) + strlen(c_name) + strlen(c_nationkey::varchar) + strlen(c_acctbal::varchar) + strlen(c_mktsegment) as s from customer)
    union all select 'documents', count(*), cast(floor(sum(s) / count(*)) as bigint), cast(sum(s) as bigint)
    from (select strlen(doc_id::varchar) + strlen(text) + strlen(lang) + strlen(source) + strlen(n_chars::varchar) as s from documents)""",
)
def _(t):
    return order_by(profile.table_status({"customer": t.customer, "documents": t.documents}), "Name")


@query(
    "key_cardinality",
    """select case when (select max(n) from (select count(*) as n from lineitem group by l_orderkey, l_linenumber)) > 1 then 1 else 0 end as "Non_unique",
      1 as "Seq_in_index", 'l_orderkey' as "Column_name", '' as "Null", count(distinct l_orderkey) as "Cardinality" from lineitem
    union all select case when (select max(n) from (select count(*) as n from lineitem group by l_orderkey, l_linenumber)) > 1 then 1 else 0 end,
      2, 'l_linenumber', '', (select count(*) from (select distinct l_orderkey, l_linenumber from lineitem))""",
)
def _(t):
    return profile.key_cardinality(t.lineitem, ["l_orderkey", "l_linenumber"])


@query(
    "enum_domain",
    """select c_mktsegment as label, count(*) as n_rows, c_mktsegment in ('BUILDING', 'MACHINERY', 'SPACE') as declared
    from customer group by c_mktsegment union all select 'SPACE', 0, true""",
)
def _(t):
    return profile.enum_domain(t.customer, "c_mktsegment", "enum('BUILDING','MACHINERY','SPACE')")


@query(
    "enum_violations",
    "select c_custkey, c_mktsegment from customer where c_mktsegment not in ('BUILDING', 'MACHINERY')",
)
def _(t):
    return profile.enum_violations(t.customer, "c_mktsegment", ["BUILDING", "MACHINERY"]).select("c_custkey", "c_mktsegment")
