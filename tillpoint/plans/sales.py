"""Revenue and profit analyses: rankings, trends, shares and rolling sums.

Fact rows are reduced by their grouping key with map-side partial aggregation
*before* they meet a dimension, so the dimension join sees one row per key
instead of one per fact row (the source joins first and aggregates after; the
results are the same because the dimension key is unique).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillpoint.functions.measures import as_double, month_start, profit, revenue
from tillpoint.tables import Tables


def _per_key(t: Tables, key: str, **measures) -> DataFrame:
    return t["fact_orders"].groupBy(key).agg(*[expr.alias(name) for name, expr in measures.items()])


def top_products(t: Tables, k: int = 10) -> DataFrame:
    """q01: revenue per product name, top ``k`` (ties broken by name)."""
    by_sku = _per_key(t, "product_sku", revenue=F.sum(revenue()))
    named = by_sku.join(t["dim_products"].select("product_sku", "product_name"), "product_sku")
    out = named.groupBy("product_name").agg(F.sum("revenue").alias("revenue"))
    return out.orderBy(F.col("revenue").desc_nulls_last(), F.col("product_name").asc_nulls_last()).limit(k)


def top_categories(t: Tables, k: int = 3) -> DataFrame:
    """q07: profit per category, top ``k``."""
    by_sku = _per_key(t, "product_sku", profit=F.sum(profit()))
    cat = by_sku.join(t["dim_products"].select("product_sku", "product_category"), "product_sku")
    out = cat.groupBy("product_category").agg(F.sum("profit").alias("profit"))
    return out.orderBy(F.col("profit").desc_nulls_last(), F.col("product_category").asc_nulls_last()).limit(k)


def monthly_profit(t: Tables) -> DataFrame:
    """q16: profit per calendar month."""
    fo = t["fact_orders"]
    out = fo.groupBy(month_start("order_date").alias("month")).agg(F.sum(profit()).alias("profit"))
    return out.orderBy(F.col("month").asc_nulls_last())


def top_retailers(t: Tables, k: int = 5) -> DataFrame:
    """q17: revenue per retailer, 0 for retailers without orders, top ``k``."""
    by_ret = _per_key(t, "retailer_id", revenue=F.sum(revenue()))
    r = t["dim_retailers"].select("retailer_id", "retailer_name")
    out = r.join(by_ret, "retailer_id", "left").select(
        "retailer_id", "retailer_name", F.coalesce(F.col("revenue"), F.lit(0)).alias("revenue")
    )
    return out.orderBy(F.col("revenue").desc_nulls_last(), F.col("retailer_id").asc_nulls_last()).limit(k)


def quantity_by_region(t: Tables) -> DataFrame:
    """q20: ordered quantity per retailer region, 0 where a region has no orders."""
    by_ret = _per_key(t, "retailer_id", qty=F.sum("order_quantity"))
    r = t["dim_retailers"].select("retailer_id", "region")
    out = r.join(by_ret, "retailer_id", "left").groupBy("region").agg(
        F.coalesce(F.sum("qty"), F.lit(0)).cast("long").alias("total_quantity")
    )
    return out.orderBy(F.col("total_quantity").desc_nulls_last())


def pct_orders_by_channel(t: Tables) -> DataFrame:
    """q21: share of order rows per retailer channel, in percent, 2 decimals."""
    by_ret = _per_key(t, "retailer_id", n=F.count(F.lit(1)))
    r = t["dim_retailers"].select("retailer_id", "retailer_channel")
    per = by_ret.join(r, "retailer_id").groupBy("retailer_channel").agg(F.sum("n").alias("n"))
    # A handful of channels: the window over the aggregate is tiny.
    total = F.sum("n").over(Window.partitionBy())
    out = per.select(
        "retailer_channel", F.round(F.lit(100.0) * as_double("n") / as_double(total), 2).alias("pct_orders")
    )
    return out.orderBy(F.col("pct_orders").desc_nulls_last())


def best_product_per_category(t: Tables) -> DataFrame:
    """q25: the most profitable SKU(s) of each category, ties kept."""
    by_sku = _per_key(t, "product_sku", profit=F.sum(profit()))
    pp = by_sku.join(t["dim_products"].select("product_sku", "product_category"), "product_sku")
    w = Window.partitionBy("product_category").orderBy(F.col("profit").desc_nulls_last())
    out = pp.withColumn("rk", F.rank().over(w)).where(F.col("rk") == 1)
    return out.select("product_category", "product_sku", "profit").orderBy(F.col("product_category").asc_nulls_last())


def avg_profit_per_order(t: Tables) -> DataFrame:
    """q28: mean profit of an order id, 2 decimals."""
    per_order = _per_key(t, "order_id", profit=F.sum(profit()))
    return per_order.agg(
        F.round(as_double(F.sum("profit")) / F.count("profit"), 2).alias("avg_profit_per_order")
    )


def worst_product_per_month(t: Tables) -> DataFrame:
    """q30: the lowest-revenue SKU(s) of each month, ties kept."""
    fo = t["fact_orders"]
    pr = fo.groupBy(month_start("order_date").alias("order_month"), "product_sku").agg(
        F.sum(revenue()).alias("revenue")
    )
    w = Window.partitionBy("order_month").orderBy(F.col("revenue").asc_nulls_last())
    out = pr.withColumn("rk", F.rank().over(w)).where(F.col("rk") == 1)
    return out.orderBy(F.col("order_month").asc_nulls_last())


def revenue_share_by_region(t: Tables) -> DataFrame:
    """q32: revenue per retailer region and its share of the total."""
    by_ret = _per_key(t, "retailer_id", revenue=F.sum(revenue()))
    r = t["dim_retailers"].select("retailer_id", "region")
    per = by_ret.join(r, "retailer_id").groupBy("region").agg(F.sum("revenue").alias("revenue"))
    total = F.sum("revenue").over(Window.partitionBy())
    out = per.select("region", "revenue", (as_double("revenue") / as_double(total)).alias("revenue_rate"))
    return out.orderBy(F.col("revenue_rate").desc_nulls_last())


def _monthly_revenue(t: Tables, name: str = "month") -> DataFrame:
    return t["fact_orders"].groupBy(month_start("order_date").alias(name)).agg(F.sum(revenue()).alias("revenue"))


def month_over_month_growth(t: Tables) -> DataFrame:
    """q37: monthly revenue minus the previous present month's (NULL for the first)."""
    # One row per month: the unpartitioned window runs over a calendar-bounded set.
    w = Window.orderBy("month")
    m = _monthly_revenue(t)
    return m.select("month", "revenue", (F.col("revenue") - F.lag("revenue").over(w)).alias("mom_growth"))


def rolling_revenue_daily(t: Tables, days: int = 365) -> DataFrame:
    """q41a: daily revenue summed over the trailing ``days`` days plus the day itself."""
    daily = t["fact_orders"].groupBy(F.col("order_date").alias("order_day")).agg(F.sum(revenue()).alias("revenue"))
    w = Window.orderBy(F.unix_date("order_day")).rangeBetween(-days, 0)
    out = daily.select("order_day", F.sum("revenue").over(w).alias("rolling_12m_revenue"))
    return out.orderBy("order_day")


def rolling_revenue_monthly(t: Tables, months: int = 12) -> DataFrame:
    """q41b: monthly revenue summed over the trailing ``months`` months plus the month."""
    m = _monthly_revenue(t, "order_month")
    idx = F.year("order_month") * 12 + F.month("order_month")
    w = Window.orderBy(idx).rangeBetween(-months, 0)
    out = m.select("order_month", F.sum("revenue").over(w).alias("rolling_12m_revenue"))
    return out.orderBy("order_month")


def demand_sma(t: Tables, window: int = 3) -> DataFrame:
    """q48: monthly quantity and its mean over the current and previous ``window-1`` rows."""
    m = t["fact_orders"].groupBy(month_start("order_date").alias("month")).agg(
        F.sum("order_quantity").cast("long").alias("qty")
    )
    w = Window.orderBy("month").rowsBetween(-(window - 1), 0)
    return m.select("month", "qty", F.avg(as_double("qty")).over(w).alias("sma_3_month"))
