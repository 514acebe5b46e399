"""Return analyses.

Several source queries join returns to order rows on ``order_id`` alone. With
many rows per order id that join pairs every return of an order with every row
of the order. The literal forms below reproduce those sums exactly from per-order
aggregates (sum and count of each side), so no row pairs are ever formed:
joining an order's r returns (sum R) with its o rows (sum O) yields sums R*o and O*r.
The ``fixed`` forms compute what the analysis means instead.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillpoint.functions.measures import as_double, div_or_null
from tillpoint.tables import Tables


def _returns_per_order(t: Tables) -> DataFrame:
    return t["fact_returns"].groupBy("order_id").agg(
        F.sum("return_quantity").cast("long").alias("_r"), F.count(F.lit(1)).alias("_nr")
    )


def monthly_return_rate(t: Tables, fixed: bool = False) -> DataFrame:
    """q03: returned / ordered quantity by order year and month.

    Literal: over returns joined to order rows (only orders with returns; sums
    multiplied as the join multiplies them). Fixed: all orders, each return counted once.
    """
    days = t["dim_date"].select(F.col("date").alias("order_date"), "year", "month")
    rows = t["fact_orders"].select("order_id", "order_date", "order_quantity")
    r = _returns_per_order(t)
    if fixed:
        fo = rows.join(days, "order_date")
        # an order's returns count once, in the month of its first row
        first = fo.groupBy("order_id").agg(F.min(F.struct("order_date", "year", "month")).alias("_m"))
        ordered = fo.groupBy("year", "month").agg(F.sum("order_quantity").alias("_den"))
        returned = first.join(r, "order_id").groupBy("_m.year", "_m.month").agg(F.sum("_r").alias("_num"))
        return ordered.join(returned, ["year", "month"], "left").select(
            "year", "month", (as_double(F.coalesce(F.col("_num"), F.lit(0))) / F.col("_den")).alias("return_rate")
        )
    j = rows.join(r, "order_id").join(days, "order_date")  # by order first, as the rows may be stored
    num, den = F.sum("_r"), F.sum(F.col("order_quantity") * F.col("_nr"))
    out = j.groupBy("year", "month").agg(
        (as_double(num) / den).alias("return_rate")
    )
    return out


def orders_vs_returns(t: Tables, fixed: bool = False) -> DataFrame:
    """q14: ordered and returned quantity per SKU.

    Literal: order rows left-joined to returns on order_id (a row's quantity
    repeats once per return of its order; every return of the order is added to
    each row), computed from per-order return totals. Fixed: returns matched on
    (order_id, SKU), each counted once.
    """
    fo = t["fact_orders"]
    if fixed:
        per = fo.groupBy("order_id", "product_sku").agg(F.sum("order_quantity").cast("long").alias("_o"))
        r = t["fact_returns"].groupBy("order_id", "product_sku").agg(F.sum("return_quantity").cast("long").alias("_r"))
        j = per.join(r, ["order_id", "product_sku"], "left")
        ordered, returned = F.sum("_o"), F.sum(F.coalesce(F.col("_r"), F.lit(0)))
    else:
        # Each order row meets its order's per-order return totals once (one row per
        # order on that side), then rows are summed per SKU with partial aggregation.
        rows = fo.select("order_id", "product_sku", "order_quantity")
        j = rows.join(_returns_per_order(t), "order_id", "left")
        ordered = F.sum(F.col("order_quantity") * F.greatest(F.coalesce(F.col("_nr"), F.lit(0)), F.lit(1)))
        returned = F.sum(F.coalesce(F.col("_r"), F.lit(0)))
    return j.groupBy("product_sku").agg(ordered.cast("long").alias("ordered"), returned.cast("long").alias("returned"))


def top_returned_products(t: Tables, k: int = 10) -> DataFrame:
    """q18: returned quantity per SKU, top ``k``."""
    out = t["fact_returns"].groupBy("product_sku").agg(F.sum("return_quantity").cast("long").alias("total_returns"))
    return out.orderBy(F.col("total_returns").desc_nulls_last(), F.col("product_sku").asc_nulls_last()).limit(k)


def customer_return_rate(t: Tables) -> DataFrame:
    """q33: ordered and returned quantity and their ratio per customer.

    Returns are pre-aggregated per order as in the source; each order row then
    carries its order's returned total, as the source's join does."""
    fo = t["fact_orders"].select("order_id", "customer_id", F.col("order_quantity").cast("long").alias("_o"))
    j = fo.join(_returns_per_order(t), "order_id", "left")
    out = j.groupBy("customer_id").agg(
        F.sum("_o").alias("total_order_qty"),
        F.coalesce(F.sum("_r"), F.lit(0)).cast("long").alias("total_return_qty"),
    )
    out = out.withColumn("return_rate", div_or_null("total_return_qty", "total_order_qty"))
    return out.orderBy(F.col("return_rate").desc_nulls_last())


def skus_more_returned_than_sold(t: Tables, min_ratio: float = 1.0, fixed: bool = True) -> DataFrame:
    """q36: SKUs whose returned quantity exceeds ``min_ratio`` x ordered quantity.

    Fixed: both sides pre-aggregated per SKU. Literal (``fixed=False``): products
    left-joined to order rows and to returns on SKU, which multiplies each side by
    the other's row count."""
    o = t["fact_orders"].groupBy("product_sku").agg(
        F.sum("order_quantity").cast("long").alias("_o"), F.count(F.lit(1)).alias("_no")
    )
    r = t["fact_returns"].groupBy("product_sku").agg(
        F.sum("return_quantity").cast("long").alias("_r"), F.count(F.lit(1)).alias("_nr")
    )
    j = t["dim_products"].select("product_sku").join(o, "product_sku", "left").join(r, "product_sku", "left")
    if fixed:
        ordered, returned = F.col("_o"), F.col("_r")
    else:
        ordered = F.col("_o") * F.greatest(F.coalesce(F.col("_nr"), F.lit(0)), F.lit(1))
        returned = F.col("_r") * F.greatest(F.coalesce(F.col("_no"), F.lit(0)), F.lit(1))
    out = j.select("product_sku", ordered.cast("long").alias("ordered"), returned.cast("long").alias("returned"))
    return out.where(as_double("returned") > F.lit(float(min_ratio)) * as_double("ordered"))
