"""Queries for joins, aggregates, windows, sorting, sets and table changes."""

from __future__ import annotations

from pyspark.sql import functions as F

from mysem import functions as M
from mysem.operators import grouping, mutate, numbering, relational
from mysem.plans.registry import query
from mysem.session import new_path

# --- projection, joins ---


@query("distinct_rows", "select distinct o_custkey, o_orderpriority from orders")
def _(t):
    return t.orders.select("o_custkey", "o_orderpriority").distinct()


@query(
    "filter_project",
    """select l_orderkey, l_linenumber, l_extendedprice * (1 - l_discount) as net from lineitem
    where l_quantity < 24 and l_returnflag = 'R'""",
)
def _(t):
    net = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    return t.lineitem.where("l_quantity < 24 and l_returnflag = 'R'").select("l_orderkey", "l_linenumber", net.alias("net"))


@query(
    "inner_join",
    """select o_orderkey, c_name, l_linenumber, l_quantity from lineitem
    join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey where l_returnflag = 'A'""",
)
def _(t):
    lines = t.lineitem.where("l_returnflag = 'A'")
    joined = lines.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).join(
        t.customer, F.col("o_custkey") == F.col("c_custkey")
    )
    return joined.select("o_orderkey", "c_name", "l_linenumber", "l_quantity")


@query(
    "null_safe_join",
    """select c_custkey, n_name from customer join nation
    on nullif(c_nationkey, 3) is not distinct from nullif(n_nationkey, 3)""",
)
def _(t):
    same = M.null_safe_eq(F.nullif("c_nationkey", F.lit(3)), F.nullif("n_nationkey", F.lit(3)))
    return t.customer.join(t.nation, same).select("c_custkey", "n_name")


@query("left_join", "select d.doc_id, quality, toxic from documents d left join labels l on d.doc_id = l.doc_id")
def _(t):
    return t.documents.join(t.labels, "doc_id", "left").select("doc_id", "quality", "toxic")


@query(
    "right_join",
    """select s_suppkey, c_custkey from supplier right join customer on s_suppkey = c_custkey and s_acctbal > 500""",
)
def _(t):
    return (
        t.supplier.where("s_acctbal > 500")
        .join(t.customer, F.col("s_suppkey") == F.col("c_custkey"), "right")
        .select("s_suppkey", "c_custkey")
    )


@query(
    "semi_anti",
    """select doc_id, lang, true as labelled from documents d where exists (select 1 from labels l where l.doc_id = d.doc_id)
    union all select doc_id, lang, false from documents d where not exists (select 1 from labels l where l.doc_id = d.doc_id)""",
)
def _(t):
    docs = t.documents.select("doc_id", "lang")
    semi = docs.join(t.labels, "doc_id", "left_semi").withColumn("labelled", F.lit(True))
    anti = docs.join(t.labels, "doc_id", "left_anti").withColumn("labelled", F.lit(False))
    return semi.unionByName(anti)


# --- aggregates ---


@query(
    "group_concat",
    "select l_orderkey, string_agg(cast(l_linenumber as varchar), ',' order by cast(l_linenumber as varchar)) as lines from lineitem group by l_orderkey",
)
def _(t):
    # The order inside a group is free, so it is settled afterwards to compare.
    out = grouping.group_concat(t.lineitem, ["l_orderkey"], "l_linenumber", alias="lines")
    return out.withColumn("lines", F.array_join(F.array_sort(F.split("lines", ",")), ","))


@query(
    "group_concat_sep",
    "select o_custkey, string_agg(o_orderstatus, ' | ' order by o_orderstatus) as statuses from orders group by o_custkey",
)
def _(t):
    out = grouping.group_concat(t.orders, ["o_custkey"], "o_orderstatus", sep=" | ", alias="statuses")
    return out.withColumn("statuses", F.array_join(F.array_sort(F.split("statuses", r" \| ")), " | "))


@query(
    "group_concat_ordered",
    """select user_id, string_agg(event_type, '>' order by ts desc, event_id) as path from events
    group by user_id""",
)
def _(t):
    return grouping.group_concat(t.events, ["user_id"], "event_type", ">", order=["ts desc", "event_id"], alias="path")


@query(
    "group_concat_distinct",
    """select o_custkey, string_agg(p, ';' order by p desc) as priorities
    from (select distinct o_custkey, o_orderpriority as p from orders) group by o_custkey""",
)
def _(t):
    return grouping.group_concat_distinct(
        t.orders, ["o_custkey"], "o_orderpriority", ";", direction="desc", alias="priorities"
    )


@query(
    "group_concat_ordered_split",
    """select event_type, string_agg(cast(event_id as varchar), ',' order by value, event_id desc) as ids from events
    group by event_type""",
)
def _(t):
    # The plan for groups too large for one task.
    order = ["value", "event_id desc"]
    return grouping.group_concat(t.events, ["event_type"], "event_id", order=order, alias="ids", hot_rows=0)


@query(
    "array_agg_ordered_split",
    """select o_orderstatus, array_to_string(list(o_orderkey order by o_totalprice desc, o_orderkey), ' ') as keys from orders
    group by o_orderstatus""",
)
def _(t):
    order = ["o_totalprice desc", "o_orderkey"]
    out = grouping.array_agg(t.orders, ["o_orderstatus"], "o_orderkey", order, alias="keys", hot_rows=0)
    return out.select("o_orderstatus", F.array_join(F.transform("keys", lambda k: k.cast("string")), " ").alias("keys"))


@query(
    "rollup_levels",
    """select l_returnflag, l_linestatus, l_linenumber, count(*) as n, count(nullif(l_linenumber, 3)) as n_other, cast(sum(l_suppkey) as bigint) as suppliers,
      min(l_shipdate) as first_day, max(l_shipdate) as last_day, round(avg(l_quantity), 6) as mean_quantity
    from lineitem group by rollup (l_returnflag, l_linestatus, l_linenumber)""",
)
def _(t):
    return grouping.rollup_levels(
        t.lineitem,
        ["l_returnflag", "l_linestatus", "l_linenumber"],
        n=("count", "*"),
        n_other=("count", F.nullif("l_linenumber", F.lit(3))),
        suppliers=("sum", "l_suppkey"),
        first_day=("min", "l_shipdate"),
        last_day=("max", "l_shipdate"),
        mean_quantity=("avg", "l_quantity"),
    ).withColumn("mean_quantity", F.round("mean_quantity", 6))


@query(
    "with_rollup",
    """select o_orderstatus, o_orderpriority, count(*) as n, cast(sum(cast(o_totalprice as decimal(18,2))) as double) as total
    from orders group by rollup(o_orderstatus, o_orderpriority)""",
)
def _(t):
    total = F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double")
    return grouping.with_rollup(
        t.orders, ["o_orderstatus", "o_orderpriority"], F.count("*").alias("n"), total.alias("total")
    )


@query(
    "count_sum_group",
    """select l_returnflag, l_linestatus, count(*) as n, sum(l_quantity) as qty,
      cast(sum(cast(l_extendedprice as decimal(18,2))) as double) as price from lineitem group by l_returnflag, l_linestatus""",
)
def _(t):
    return t.lineitem.groupBy("l_returnflag", "l_linestatus").agg(
        F.count("*").alias("n"),
        F.sum("l_quantity").alias("qty"),
        F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).cast("double").alias("price"),
    )


@query(
    "array_agg_ordered",
    """select conv_id, cast(count(*) as integer) as n, array_to_string(list(role || ':' || turn order by turn desc), ' ') as roles
    from conversations group by conv_id""",
)
def _(t):
    value = F.concat_ws(":", "role", F.col("turn").cast("string"))
    out = grouping.array_agg(t.conversations, ["conv_id"], value, order="turn desc", alias="roles")
    return out.select("conv_id", F.size("roles").alias("n"), F.array_join("roles", " ").alias("roles"))


@query(
    "orders_rollup_report",
    """select yr, c_mktsegment, count(*) as n, string_agg(distinct o_orderpriority, ',' order by o_orderpriority) as priorities
    from (select cast(year(o_orderdate) as integer) as yr, c_mktsegment, o_orderpriority from orders join customer on o_custkey = c_custkey
      where c_mktsegment ilike '%i%')
    group by rollup(yr, c_mktsegment)""",
)
def orders_rollup_report(t):
    joined = (
        t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
        .where(M.like_ci("c_mktsegment", "%i%"))
        .select(M.year("o_orderdate").alias("yr"), "c_mktsegment", "o_orderpriority")
    )
    # A few values are left per group once orders of one priority are counted together.
    counted = joined.groupBy("yr", "c_mktsegment", "o_orderpriority").agg(F.count("*").alias("n"))
    text = F.expr("listagg(distinct o_orderpriority, ',') within group (order by o_orderpriority)")
    out = grouping.with_rollup(counted, ["yr", "c_mktsegment"], F.sum("n").alias("n"), text.alias("priorities"))
    return relational.order_by(out, ["yr", "c_mktsegment"])


# --- windows, sorting, sets ---


@query(
    "seq_in_group",
    "select event_id, user_id, cast(row_number() over (partition by user_id order by ts, event_id) as integer) as seq from events",
)
def _(t):
    events = t.events.select("event_id", "user_id", "ts")
    return numbering.seq_in_group(events, ["user_id"], ["ts", "event_id"], "seq").drop("ts")


@query(
    "seq_in_group_split",
    """select o_orderkey, o_orderstatus,
      cast(row_number() over (partition by o_orderstatus order by o_totalprice desc, o_orderkey) as integer) as seq from orders""",
)
def _(t):
    # The plan for groups too large for one task.
    orders = t.orders.select("o_orderkey", "o_orderstatus", "o_totalprice")
    order = ["o_totalprice desc", "o_orderkey"]
    return numbering.seq_in_group(orders, ["o_orderstatus"], order, "seq", hot_rows=0).drop("o_totalprice")


@query(
    "found_rows",
    """select o_orderkey, o_totalprice, count(*) over () as found_rows from orders where o_orderstatus = 'F'
    order by o_totalprice desc, o_orderkey limit 10""",
)
def _(t):
    found = relational.found_rows(t.orders.where("o_orderstatus = 'F'").select("o_orderkey", "o_totalprice"))
    return relational.limit_offset(found, ["o_totalprice desc", "o_orderkey"], 0, 10)


@query(
    "limit_offset",
    "select l_orderkey, l_linenumber, l_extendedprice from lineitem order by l_extendedprice desc, l_orderkey, l_linenumber, l_partkey limit 25 offset 100",
)
def _(t):
    order = ["l_extendedprice desc", "l_orderkey", "l_linenumber", "l_partkey"]
    return relational.limit_offset(t.lineitem, order, 100, 25).select("l_orderkey", "l_linenumber", "l_extendedprice")


@query(
    "limit_offset_deep",
    "select o_orderkey, o_totalprice from orders order by o_totalprice, o_orderkey limit 50 offset 700",
)
def _(t):
    df = t.orders.select("o_orderkey", "o_totalprice")
    return relational.limit_offset(df, ["o_totalprice", "o_orderkey"], 700, 50, deep=0)


@query(
    "order_by",
    "select c_custkey, nullif(c_mktsegment, 'BUILDING') as seg from customer order by seg nulls last, c_custkey desc",
)
def _(t):
    df = t.customer.select("c_custkey", F.nullif("c_mktsegment", F.lit("BUILDING")).alias("seg"))
    return relational.order_by(df, ["seg", "c_custkey desc"])


@query(
    "order_by_field",
    """select o_orderkey, o_orderpriority from orders
    order by list_position(['3-MEDIUM', '1-URGENT'], o_orderpriority) nulls last, o_orderkey""",
)
def _(t):
    df = t.orders.select("o_orderkey", "o_orderpriority")
    return relational.order_by_field(df, "o_orderpriority", ["3-MEDIUM", "1-URGENT"], then="o_orderkey")


@query(
    "random_sample_large",
    "select cast(count(*) * 2 // 3 as bigint) as n, cast(count(*) * 2 // 3 as bigint) as n_known from lineitem",
)
def _(t):
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey")
    # Two thirds of all rows, by the plan for samples beyond one task.
    sample = relational.random_sample_order(rows, rows.count() * 2 // 3, seed=11, deep=0)
    known = sample.join(rows.distinct().withColumn("known", F.lit(1)), rows.columns, "left")
    return known.agg(F.count("*").alias("n"), F.count("known").alias("n_known"))


@query("random_sample_order", "select cast(least(100, count(*)) as integer) as n, cast(least(100, count(*)) as integer) as n_known from orders")
def _(t):
    sample = relational.random_sample_order(t.orders.select("o_orderkey"), 100, seed=11)
    known = t.orders.select("o_orderkey", F.lit(1).alias("k"))
    return sample.join(known, "o_orderkey", "left").agg(
        F.count_distinct("o_orderkey").cast("int").alias("n"), F.sum("k").cast("int").alias("n_known")
    )


@query("minus_except", "select o_custkey as k from orders except select c_custkey from customer where c_acctbal < 5000")
def _(t):
    return relational.minus_except(
        t.orders.select(F.col("o_custkey").alias("k")), t.customer.where("c_acctbal < 5000").select("c_custkey")
    )


@query(
    "union_all",
    "select s_suppkey as k, s_name as name from supplier union all select c_custkey, c_name from customer",
)
def _(t):
    return t.supplier.select(F.col("s_suppkey").alias("k"), F.col("s_name").alias("name")).unionByName(
        t.customer.select(F.col("c_custkey").alias("k"), F.col("c_name").alias("name"))
    )


# --- table changes ---

_AS_SUPPLIER = "select c_custkey as s_suppkey, c_name as s_name, c_nationkey as s_nationkey, c_acctbal as s_acctbal from customer"


def _customers_as_suppliers(t):
    names = {"s_suppkey": "c_custkey", "s_name": "c_name", "s_nationkey": "c_nationkey", "s_acctbal": "c_acctbal"}
    return t.customer.select(*[F.col(c).alias(s) for s, c in names.items()])


@query(
    "insert_ignore",
    """with s as (select p_partkey // 2 as doc_id, min(p_size) as quality from part group by p_partkey // 2)
    select doc_id, quality, toxic from labels
    union all select doc_id, quality, 0 from s where not exists (select 1 from labels l where l.doc_id = s.doc_id)""",
)
def _(t):
    source = t.part.select(
        F.floor(F.col("p_partkey") / 2).cast("bigint").alias("doc_id"),
        F.col("p_size").alias("quality"),
        F.lit(0).alias("toxic"),
    )
    return mutate.insert_ignore(t.labels, source, [["doc_id"]], order="quality")


@query(
    "insert_ignore_two_keys",
    """select s_suppkey, s_name from supplier
    union all select c_custkey, c_name from customer c where not exists (select 1 from supplier s where s.s_suppkey = c.c_custkey)""",
)
def _(t):
    target = t.supplier.select("s_suppkey", "s_name")
    source = _customers_as_suppliers(t).select("s_suppkey", "s_name")
    return mutate.insert_ignore(target, source, [["s_suppkey"], ["s_name"]], order="s_suppkey")


@query(
    "upsert",
    f"""select coalesce(t.s_suppkey, s.s_suppkey) as s_suppkey, coalesce(t.s_name, s.s_name) as s_name,
      case when t.s_suppkey is null or s.s_suppkey is not null then s.s_nationkey else t.s_nationkey end as s_nationkey,
      case when t.s_suppkey is null then s.s_acctbal when s.s_suppkey is null then t.s_acctbal
        else t.s_acctbal + s.s_acctbal end as s_acctbal
    from supplier t full join ({_AS_SUPPLIER} where c_acctbal > 1000) s on t.s_suppkey = s.s_suppkey""",
)
def _(t):
    source = _customers_as_suppliers(t).where("s_acctbal > 1000")
    changes = {"s_acctbal": "t.s_acctbal + s.s_acctbal", "s_nationkey": "s.s_nationkey"}
    return mutate.upsert(t.supplier, source, ["s_suppkey"], set=changes)


@query(
    "replace_into",
    f"""with s as ({_AS_SUPPLIER} where c_acctbal > 1000) select * from s
    union all select * from supplier t where not exists (select 1 from s where s.s_suppkey = t.s_suppkey)""",
)
def _(t):
    return mutate.replace_into(t.supplier, _customers_as_suppliers(t).where("s_acctbal > 1000"), ["s_suppkey"])


@query(
    "update_join",
    """select o_orderkey, o_custkey, case when c_custkey is not null then 'B' else o_orderstatus end as o_orderstatus,
      case when c_custkey is not null then o_totalprice + c_acctbal else o_totalprice end as o_totalprice,
      o_orderdate, o_orderpriority
    from orders left join customer on o_custkey = c_custkey and c_mktsegment = 'BUILDING' and o_totalprice > c_acctbal""",
)
def _(t):
    return mutate.update_join(
        t.orders,
        t.customer,
        on={"o_custkey": "c_custkey"},
        set={"o_totalprice": "t.o_totalprice + s.c_acctbal", "o_orderstatus": F.lit("B")},
        where="t.o_totalprice > s.c_acctbal",
        source_where="c_mktsegment = 'BUILDING'",
    )


@query(
    "update_join_ordered",
    """select c_custkey, c_name, c_nationkey, coalesce(first_price, c_acctbal) as c_acctbal, c_mktsegment from customer
    left join (select o_custkey, min_by(o_totalprice, o_orderkey) as first_price from orders group by o_custkey)
      on c_custkey = o_custkey""",
)
def _(t):
    return mutate.update_join(
        t.customer, t.orders, on={"c_custkey": "o_custkey"}, set={"c_acctbal": "s.o_totalprice"}, order="o_orderkey"
    )


@query(
    "delete_join",
    """select o.* from orders o where not exists (
      select 1 from customer c where c_custkey = o_custkey and c_mktsegment = 'BUILDING' and o_totalprice > c_acctbal * 10)""",
)
def _(t):
    return mutate.delete_join(
        t.orders,
        t.customer,
        on={"o_custkey": "c_custkey"},
        where="t.o_totalprice > s.c_acctbal * 10",
        source_where="c_mktsegment = 'BUILDING'",
    )


@query(
    "insert_set",
    """select * from supplier union all select c_custkey + 1000000, c_name, -1, null from customer""",
)
def _(t):
    rows = t.customer.select((F.col("c_custkey") + 1000000).alias("s_suppkey"), F.col("c_name").alias("s_name"))
    return mutate.append_named(t.supplier, rows, defaults={"s_nationkey": -1})


@query("insert_select", f"select * from supplier union all {_AS_SUPPLIER}")
def _(t):
    return mutate.insert_select(t.supplier, t.customer.select("c_custkey", "c_name", "c_nationkey", "c_acctbal"))


@query("truncate_reload", "select * from orders where o_orderstatus = 'F'")
def _(t):
    path = new_path(t.spark, "orders")
    mutate.truncate_reload(t.orders, path)
    return mutate.truncate_reload(t.orders.where("o_orderstatus = 'F'"), path)


@query(
    "auto_increment",
    """select * from supplier union all select (select max(s_suppkey) from supplier) + row_number() over (order by c_acctbal desc, c_name),
      c_name, c_nationkey, c_acctbal from customer""",
)
def _(t):
    rows = _customers_as_suppliers(t).drop("s_suppkey")
    return mutate.auto_increment(t.supplier, rows, "s_suppkey", ["s_acctbal desc", "s_name"])


@query("next_auto_increment", "select max(l_orderkey) + 1 as auto_increment from lineitem")
def _(t):
    return mutate.next_auto_increment(t.lineitem, "l_orderkey")


@query(
    "modify_column",
    """select o_orderkey, o_custkey, o_orderstatus, cast(round_even(o_totalprice, 0) as integer) as o_totalprice, o_orderdate,
      o_orderpriority from orders""",
)
def _(t):
    return mutate.modify_column(t.orders, "o_totalprice", "int")


@query("modify_column_check", "select count(*) as n_rows, count(*) as n_bad from orders")
def _(t):
    return mutate.unconvertible(t.orders, "o_orderpriority", "int")


@query(
    "change_column",
    "select s_suppkey, s_name, s_nationkey, cast(s_acctbal as varchar) as balance from supplier",
)
def _(t):
    return mutate.change_column(t.supplier, "s_acctbal", "balance", "string")
