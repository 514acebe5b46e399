"""Column expressions shared by the analyses."""

from tillpoint.functions.measures import (
    as_double,
    dated,
    div_or_null,
    exact_stddev_samp,
    exact_var_samp,
    month_start,
    net_sales,
    profit,
    ratio,
    revenue,
    round_half_up,
)

__all__ = [
    "as_double",
    "dated",
    "div_or_null",
    "exact_stddev_samp",
    "exact_var_samp",
    "month_start",
    "net_sales",
    "profit",
    "ratio",
    "revenue",
    "round_half_up",
]
