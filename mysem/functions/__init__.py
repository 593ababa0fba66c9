"""MySQL expressions as native Spark columns.

Every function takes column names or ``Column`` objects and returns a
``Column`` made of built-in expressions, so Catalyst can push, fold and
compile it. Plain Python values are literals where noted.
"""

from mysem.functions.conditional import (
    cast_char,
    cast_datetime,
    cast_signed,
    cast_unsigned,
    convert_type,
    elt,
    field_rank,
    find_in_set,
    if_expr,
    ifnull,
    isnull,
    like_ci,
    not_like_ci,
    not_regexp_ci,
    null_safe_eq,
    regexp_ci,
    sounds_like,
    soundex,
    strcmp,
    zero_date_to_null,
    zero_dates_to_null,
)
from mysem.functions.datetimes import (
    curdate,
    curtime,
    date_add,
    date_format,
    date_part,
    date_sub,
    datediff,
    day,
    dayofmonth,
    dayofweek,
    dayofyear,
    from_unixtime,
    hour,
    last_day,
    minute,
    month,
    second,
    str_to_date,
    sysdate,
    time_part,
    unix_timestamp,
    unix_timestamp_now,
    week,
    weekofyear,
    year,
)
from mysem.functions.numeric import log_base, log_natural, log2, log10, rand_fn, truncate_num
from mysem.functions.strings import (
    char_fn,
    escape_string,
    hex_str,
    instr,
    locate,
    space,
    unescape_string,
    unhex_str,
)

__all__ = [name for name in dir() if not name.startswith("_")]
