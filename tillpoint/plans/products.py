"""Product analyses: unsold products, seasonality, outliers, baskets, lifecycle."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillpoint.functions.measures import dated, exact_stddev_samp, exact_var_samp, month_start
from tillpoint.operators.baskets import top_pairs
from tillpoint.tables import Tables

DateLike = str | dt.date


def products_without_sales(t: Tables, start: DateLike | None = None, end: DateLike | None = None) -> DataFrame:
    """q08: products with no order row (in ``[start, end]`` when given)."""
    fo = dated(t["fact_orders"], start, end)
    p = t["dim_products"].select("product_sku", "product_name")
    # one row per SKU and task: a left-anti join cannot split a hot SKU of its right side
    return p.join(fo.select("product_sku").distinct(), "product_sku", "left_anti")


def product_monthly_quantity(t: Tables) -> DataFrame:
    """v03: quantity per SKU and month."""
    return t["fact_orders"].groupBy("product_sku", month_start("order_date").alias("month")).agg(
        F.sum("order_quantity").cast("long").alias("monthly_quantity")
    )


def most_seasonal_product(t: Tables, k: int = 1) -> DataFrame:
    """q12: SKU(s) with the largest sample variance of monthly quantity
    (rounded to 6 decimals; a SKU with one month has NULL variance and sorts last)."""
    m = product_monthly_quantity(t)
    q = F.col("monthly_quantity").cast("decimal(19,0)")
    v = m.groupBy("product_sku").agg(
        F.count(q).alias("_n"), F.sum(q).alias("_s1"), F.sum(q * q).alias("_s2")
    ).select("product_sku", F.round(exact_var_samp("_n", "_s1", "_s2"), 6).alias("variance"))
    return v.orderBy(F.col("variance").desc_nulls_last(), F.col("product_sku").asc_nulls_last()).limit(k)


def quantity_outliers(t: Tables, k: float = 2.0) -> DataFrame:
    """q45: order rows whose quantity exceeds mean + k * sample standard deviation.

    The threshold is a one-row aggregate used as a scalar subquery."""
    fo = t["fact_orders"]
    q = F.col("order_quantity").cast("decimal(19,0)")
    stats = fo.agg(F.count(q).alias("_n"), F.sum(q).alias("_s1"), F.sum(q * q).alias("_s2"))
    threshold = stats.select(
        (F.col("_s1").cast("double") / F.col("_n") + F.lit(float(k)) * exact_stddev_samp("_n", "_s1", "_s2")).alias(
            "_thr"
        )
    ).scalar()
    return fo.where(q > threshold).select("order_id", "order_quantity")


def bought_together(t: Tables, min_freq: int = 10, k: int = 20, block: int = 1000) -> DataFrame:
    """q47: SKU pairs bought in the same order, counted in distinct orders,
    pairs seen in at least ``min_freq`` orders, top ``k``."""
    return top_pairs(t["fact_orders"], "order_id", "product_sku", k=k, min_freq=min_freq, block=block)


def product_lifecycle(t: Tables, min_orders: int = 2) -> DataFrame:
    """q50: per SKU with at least ``min_orders`` rows: rows, units, first and last sale, days between."""
    out = t["fact_orders"].groupBy("product_sku").agg(
        F.count(F.lit(1)).alias("total_orders"),
        F.sum("order_quantity").cast("long").alias("total_units"),
        F.min("order_date").alias("first_sale"),
        F.max("order_date").alias("last_sale"),
    )
    return out.where(F.col("total_orders") >= min_orders).withColumn(
        "lifecycle_days", F.datediff("last_sale", "first_sale")
    )
