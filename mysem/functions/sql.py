"""The expressions as temporary SQL functions that Catalyst inlines."""

from __future__ import annotations

from pyspark.sql import SparkSession

# name -> parameters, return type, expression
FUNCTIONS = {
    "my_ifnull": ("a string, b string", "string", "coalesce(a, b)"),
    "my_find_in_set": ("v string, s string", "boolean", "case when s = '' then false else find_in_set(v, s) > 0 end"),
    "my_strcmp": ("a string, b string", "int", "case when a < b then -1 when a > b then 1 else 0 end"),
    "my_regexp": ("s string, p string", "boolean", "regexp_like(s, concat('(?isu)', p))"),
    "my_hex": ("s string", "string", "lower(hex(s))"),
    "my_space": ("n int", "string", "repeat(' ', n)"),
    "my_cast_unsigned": ("x double", "bigint", "cast(rint(x) as bigint)"),
    "my_cast_signed": ("x double", "int", "cast(rint(x) as int)"),
    "my_log2": ("x double", "double", "log2(x)"),
    "my_unix_timestamp": (
        "t timestamp",
        "bigint",
        "unix_seconds(timestamp_micros(unix_micros(t) + case when unix_micros(t) < 0 then 499999 else 500000 end))",
    ),
    "my_from_unixtime": ("n bigint", "timestamp", "timestamp_seconds(n)"),
    "my_datediff": ("a date, b date", "int", "datediff(a, b)"),
    "my_time": ("t timestamp", "string", "substring_index(cast(t as string), ' ', -1)"),
}


def register(spark: SparkSession) -> list[str]:
    """Create the functions in the session and return their names."""
    for name, (params, returns, body) in FUNCTIONS.items():
        spark.sql(f"create or replace temporary function {name}({params}) returns {returns} return {body}")
    return list(FUNCTIONS)
