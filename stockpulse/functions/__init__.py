"""Column-level helpers.  All return JVM-side Column expressions (no UDFs)."""

from stockpulse.functions.dates import date_lit, try_date, ts_lit, us_week
from stockpulse.functions.numeric import (
    money,
    ratio_half_up,
    to_decimal_or_zero,
    trunc_ratio,
    try_decimal,
)
from stockpulse.functions.text import (
    blank_to_null,
    clean_order,
    collated,
    first_non_blank,
    group_by_keys,
    norm_key,
    not_like_prefix,
    str_eq,
    text_max,
    varchar,
)

__all__ = [
    "blank_to_null", "clean_order", "collated", "date_lit", "first_non_blank", "group_by_keys", "money",
    "norm_key", "not_like_prefix", "ratio_half_up", "str_eq", "text_max", "to_decimal_or_zero", "try_date",
    "trunc_ratio", "try_decimal", "ts_lit", "us_week", "varchar",
]
