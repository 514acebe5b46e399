"""Promotion analyses: coverage flag, ratios, uplift, campaigns, discount buckets.

All promotion tests go through (SKU, day) keys (operators.promotions): facts are
first reduced to one row per SKU and day, carrying the sums each analysis needs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillpoint.functions.measures import as_double, month_start, profit, revenue
from tillpoint.operators.promotions import flag_days, flag_rows, matching_promotions
from tillpoint.tables import Tables

FLAG = "is_promotion_active"


def _sku_days(t: Tables, **measures) -> DataFrame:
    fo = t["fact_orders"]
    return fo.groupBy("product_sku", "order_date").agg(*[e.alias(n) for n, e in measures.items()])


def _flagged_sku_days(t: Tables, **measures) -> DataFrame:
    return flag_days(_sku_days(t, **measures), t["dim_promotions"])


def orders_with_promo(t: Tables) -> DataFrame:
    """v01: every order row plus ``is_promotion_active``, in one pass over the facts
    (a left range join against each SKU's disjoint covered intervals)."""
    # the year folder of stored tables is no column of the order rows
    return flag_rows(t["fact_orders"].drop("order_year"), t["dim_promotions"])


def promo_ratio(t: Tables) -> DataFrame:
    """q04: percent of order rows covered by a promotion."""
    d = _flagged_sku_days(t, n=F.count(F.lit(1)))
    flagged = F.sum(F.when(F.col(FLAG), F.col("n")).otherwise(F.lit(0)))
    return d.agg((F.lit(100) * as_double(flagged) / F.sum("n")).alias("promo_ratio"))


def revenue_by_promo(t: Tables) -> DataFrame:
    """q11: revenue with and without an active promotion."""
    d = _flagged_sku_days(t, revenue=F.sum(revenue()))
    return d.groupBy(FLAG).agg(F.sum("revenue").alias("revenue"))


def avg_discount_by_category(t: Tables) -> DataFrame:
    """q13: mean discount per category over products left-joined to orders;
    a product without orders counts as one row with discount 0."""
    per = t["fact_orders"].groupBy("product_sku").agg(
        F.sum(F.coalesce(F.col("product_discount"), F.lit(0))).alias("_d"), F.count(F.lit(1)).alias("_n")
    )
    p = t["dim_products"].select("product_sku", "product_category")
    j = p.join(per, "product_sku", "left")
    return j.groupBy("product_category").agg(
        (as_double(F.sum(F.coalesce(F.col("_d"), F.lit(0)))) / F.sum(F.coalesce(F.col("_n"), F.lit(1)))).alias(
            "avg_discount"
        )
    )


def promotions_without_uplift(t: Tables, integer_division: bool = True) -> DataFrame:
    """q24: per SKU, quantity per active day with and without a promotion; keep SKUs
    where the promotion rate is not above the other. ``integer_division`` keeps the
    source's truncating bigint division; False gives exact rates."""
    d = _flagged_sku_days(t, qty=F.sum("order_quantity"))
    sales = d.groupBy("product_sku", FLAG).agg(
        F.count(F.lit(1)).alias("active_days"), F.sum("qty").cast("long").alias("total_qty")
    )
    if integer_division:
        rate = F.expr("total_qty div nullif(active_days, 0)")
    else:
        rate = as_double("total_qty") / as_double(F.when(F.col("active_days") != 0, F.col("active_days")))
    pivoted = sales.groupBy("product_sku").agg(
        F.sum(F.when(F.col(FLAG), rate)).alias("promo_daily_qty"),
        F.sum(F.when(~F.col(FLAG), rate)).alias("nonpromo_daily_qty"),
    )
    return pivoted.where(F.col("promo_daily_qty") <= F.col("nonpromo_daily_qty"))


def promotions_per_campaign(t: Tables) -> DataFrame:
    """q27: promotions per campaign name."""
    return t["dim_promotions"].groupBy("campaign_name").agg(F.count(F.lit(1)).alias("promotions"))


def promotions_per_month(t: Tables, mode: str = "started") -> DataFrame:
    """q34: promotions by start month (``mode='started'``), or by every month a
    promotion is active in (``mode='active'``)."""
    p = t["dim_promotions"]
    if mode == "started":
        m = p.select(month_start("start_date").alias("month"))
    elif mode == "active":
        m = p.where(F.col("end_date") >= F.col("start_date")).select(
            F.explode(
                F.sequence(month_start("start_date"), month_start("end_date"), F.expr("interval 1 month"))
            ).alias("month")
        )
    else:
        raise ValueError(mode)
    return m.groupBy("month").agg(F.count(F.lit(1)).alias("promotions"))


# Bucket edges of the discount analysis.
DISCOUNT_EDGES = (0, 10, 20, 30, 50)


def discount_bucket(col: F.Column, edges=DISCOUNT_EDGES, suffix: str = "%") -> F.Column:
    """'0%' at the first edge, '<lo+1>-<hi>%' for (lo, hi], '<last>%+' otherwise (NULL included);
    ``suffix`` replaces '%' when the edges are amounts rather than percentages."""
    e = list(edges)
    expr = F.when(col == e[0], F.lit(f"{e[0]}{suffix}"))
    for lo, hi in zip(e, e[1:]):
        expr = expr.when((col > lo) & (col <= hi), F.lit(f"{lo + 1}-{hi}{suffix}"))
    return expr.otherwise(F.lit(f"{e[-1]}{suffix}+"))


def avg_discount_by_bucket(t: Tables, edges=DISCOUNT_EDGES, suffix: str = "%") -> DataFrame:
    """q39: mean discount per discount bucket, 2 decimals."""
    b = discount_bucket(F.col("product_discount"), edges, suffix)
    fo = t["fact_orders"].select("product_discount", b.alias("b"))
    out = fo.groupBy(F.col("b").alias("discount_bucket")).agg(
        F.round(as_double(F.sum("product_discount")) / F.count("product_discount"), 2).alias("avg_discount")
    )
    return out.orderBy("discount_bucket")


def top_campaigns_by_profit(t: Tables, k: int = 1) -> DataFrame:
    """q44: profit of order rows matched to a promotion (same SKU, date in range),
    per campaign; an order row under two promotions counts for both."""
    d = _sku_days(t, profit=F.sum(profit()))
    m = matching_promotions(d, t["dim_promotions"], by=["campaign_name"])
    out = m.groupBy("campaign_name").agg(F.sum(F.col("profit") * F.col("promotions")).alias("profit"))
    return out.orderBy(F.col("profit").desc_nulls_last(), F.col("campaign_name").asc_nulls_last()).limit(k)
