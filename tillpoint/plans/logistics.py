"""Shipping and delivery analyses."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillpoint.functions.measures import as_double, div_or_null, month_start
from tillpoint.tables import Tables

# Fixed value: the delivery status that meets the service level in the data.
ON_TIME = "on-time"


def _mean(col: str) -> F.Column:
    return as_double(F.sum(col)) / F.count(col)


def avg_delivery_by_carrier(t: Tables) -> DataFrame:
    """q05: mean delivery duration per carrier."""
    return t["fact_shippings"].groupBy("carrier").agg(_mean("delivery_duration").alias("average_delivery"))


def orders_per_warehouse(t: Tables) -> DataFrame:
    """q09: shipment rows per warehouse id, ascending."""
    per = t["fact_shippings"].groupBy("warehouse_id").agg(F.count(F.lit(1)).alias("orders"))
    w = t["dim_warehouses"].select("warehouse_id")
    return per.join(w, "warehouse_id").orderBy(F.col("orders").asc_nulls_last())


def on_time_rate(t: Tables, ok: str = ON_TIME) -> DataFrame:
    """q15: share of shipment rows whose status is ``ok``."""
    s = t["fact_shippings"]
    hit = F.sum(F.when(F.col("delivery_status") == ok, 1).otherwise(0))
    return s.agg((as_double(hit) / F.count(F.lit(1))).alias("on_time_rate"))


def avg_delivery_by_region(t: Tables) -> DataFrame:
    """q23: mean delivery duration per retailer region, 2 decimals.

    The source joins order rows to shipment rows on order_id. With several rows
    per order id on both sides that join pairs them all; the same mean comes from
    per-order shipment totals: each order row meets its order's n shipments with
    total duration D, contributing D and n. Rows are summed per retailer (partial
    aggregation) before the retailer dimension is joined, so the only large
    shuffle is the order rows by order_id."""
    ship = t["fact_shippings"].groupBy("order_id").agg(
        F.sum("delivery_duration").cast("long").alias("_d"), F.count("delivery_duration").alias("_n")
    )
    rows = t["fact_orders"].select("order_id", "retailer_id").join(ship, "order_id")
    per_ret = rows.groupBy("retailer_id").agg(F.sum("_d").alias("_d"), F.sum("_n").alias("_n"))
    r = t["dim_retailers"].select("retailer_id", "region")
    out = per_ret.join(r, "retailer_id").groupBy("region").agg(
        F.round(as_double(F.sum("_d")) / F.sum("_n"), 2).alias("avg_delivery")
    )
    return out.orderBy(F.col("avg_delivery").desc_nulls_last())


def shipments_by_method_month(t: Tables) -> DataFrame:
    """q29: shipment rows per ship month and method."""
    s = t["fact_shippings"]
    out = s.groupBy(month_start("ship_date").alias("shipping_month"), "shipping_method").agg(
        F.count(F.lit(1)).alias("shipments")
    )
    return out.orderBy(F.col("shipping_month").asc_nulls_last(), F.col("shipping_method").asc_nulls_last())


def delivery_deviation(t: Tables) -> DataFrame:
    """q31: each shipment's duration minus the overall mean, 2 decimals.

    The mean is one aggregate evaluated once (scalar subquery) instead of a
    window over the whole table in one partition."""
    s = t["fact_shippings"]
    mean = s.agg(_mean("delivery_duration")).scalar()
    return s.select(
        "order_id", "delivery_duration", F.round(as_double("delivery_duration") - mean, 2).alias("deviation")
    )


def orders_by_location(t: Tables, k: int | None = None) -> DataFrame:
    """q35: shipment rows per warehouse location, descending (top ``k`` if given)."""
    per = t["fact_shippings"].groupBy("warehouse_id").agg(F.count(F.lit(1)).alias("orders"))
    w = t["dim_warehouses"].select("warehouse_id", "warehouse_location")
    out = per.join(w, "warehouse_id").groupBy("warehouse_location").agg(F.sum("orders").alias("orders"))
    out = out.orderBy(F.col("orders").desc_nulls_last(), F.col("warehouse_location").asc_nulls_last())
    return out.limit(k) if k else out


def weighted_shipping_cost(t: Tables) -> DataFrame:
    """q46: shipping cost weighted by delivery duration, per carrier (NULL when all durations are 0)."""
    s = t["fact_shippings"]
    return s.groupBy("carrier").agg(
        div_or_null(F.sum(F.col("shipping_cost") * F.col("delivery_duration")), F.sum("delivery_duration")).alias(
            "weighted_cost"
        )
    )


def sla_violation_rate(t: Tables, ok: str = ON_TIME) -> DataFrame:
    """q49: share of shipment rows whose status is not ``ok``."""
    s = t["fact_shippings"]
    miss = F.sum(F.when(F.col("delivery_status") != ok, 1).otherwise(0))
    return s.agg((as_double(miss) / F.count(F.lit(1))).alias("violation_rate"))
