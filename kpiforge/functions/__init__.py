"""Column expressions and fixed values shared by the operators."""

from kpiforge.functions.expr import (  # noqa: F401
    channel_id,
    double_or_zero,
    int_or_zero,
    iso_state_code,
    mmddyy_date,
    mmddyy_valid,
    money_merge,
    money_parts,
    money_sum,
    month_start,
    safe_ratio,
    strip_ws,
    unknown_if_empty,
)
