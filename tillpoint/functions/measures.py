"""Business measures and dialect-safe arithmetic as Spark Column expressions.

Everything here is a built-in expression, so it stays inside whole-stage codegen.
Rules kept throughout (SQL dialects differ on each):
* money stays DECIMAL while it is summed, so totals are exact;
* a ratio casts both operands to DOUBLE before dividing and guards a zero divisor;
* NULL ordering is always stated explicitly at the call site.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def revenue(price="product_price", qty="order_quantity") -> Column:
    """price * quantity (exact decimal)."""
    return _c(price) * _c(qty)


def profit(price="product_price", cost="product_cost", qty="order_quantity") -> Column:
    """(price - cost) * quantity (exact decimal)."""
    return (_c(price) - _c(cost)) * _c(qty)


def net_sales(price="product_price", qty="order_quantity", discount="product_discount") -> Column:
    """quantity * price - discount (exact decimal)."""
    return _c(qty) * _c(price) - _c(discount)


def as_double(x) -> Column:
    return _c(x).cast("double")


def div_or_null(num, den) -> Column:
    """num / den in double; NULL when den is 0 or NULL (NULLIF guard, ANSI-safe)."""
    d = as_double(den)
    return F.when(d != 0, as_double(num) / d)


def ratio(num, den) -> Column:
    return div_or_null(num, den)


def round_half_up(x, digits: int = 2) -> Column:
    return F.round(_c(x), digits)


def month_start(d) -> Column:
    """First day of the month as DATE."""
    return F.trunc(_c(d), "MM")


def exact_var_samp(n, s1, s2) -> Column:
    """Sample variance from count, sum and sum of squares of integer values.

    (n*s2 - s1^2) / (n*(n-1)) is formed in exact decimal integer arithmetic and
    divided once in double, so the result does not depend on summation order.
    NULL for fewer than two values.
    """
    n_, s1_, s2_ = (_c(v).cast("decimal(38,0)") for v in (n, s1, s2))
    num = n_ * s2_ - s1_ * s1_
    den = n_ * (n_ - F.lit(1))
    return F.when(_c(n) > 1, num.cast("double") / den.cast("double"))


def exact_stddev_samp(n, s1, s2) -> Column:
    return F.sqrt(exact_var_samp(n, s1, s2))


def dated(df, start=None, end=None, col: str = "order_date", year_col: str = "order_year"):
    """Rows with ``start <= col <= end`` (either bound optional). When the frame carries
    the stored year partition column, the same bounds are stated on it too, so the
    Parquet scan prunes the year folders outside the range."""
    if start is not None:
        df = df.where(F.col(col) >= F.lit(start).cast("date"))
        if year_col in df.columns:
            df = df.where(F.col(year_col) >= F.year(F.lit(start).cast("date")))
    if end is not None:
        df = df.where(F.col(col) <= F.lit(end).cast("date"))
        if year_col in df.columns:
            df = df.where(F.col(year_col) <= F.year(F.lit(end).cast("date")))
    return df
