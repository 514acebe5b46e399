"""Every registered analysis, view, preparation and quality job by key.

Each entry maps a key to ``fn(tables) -> DataFrame`` with its parameters bound.
Defaults are the source's; a second key with other parameters exists where the
default gives an empty result on the test data.
"""

from __future__ import annotations

import os
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillpoint.plans import customers, logistics, prep, products, promotions, quality, returns, sales
from tillpoint.session import scratch_path
from tillpoint.schemas import SPECS
from tillpoint.sources.by_order import arrange
from tillpoint.sources.keyed_load import load_batch, load_report, raw_violations
from tillpoint.tables import Tables

# Analysis date standing in for CURRENT_DATE (the day after the last order in the test data).
AS_OF = "2001-08-02"


def _p02(t: Tables) -> DataFrame:
    fo = t["fact_orders"].select("order_id", "product_sku", "order_date", "product_price", "order_quantity")
    return prep.with_discount(fo, 0.1)


def _p04(t: Tables) -> DataFrame:
    s = t["fact_shippings"].select(
        "order_id", "order_date", "delivery_duration", F.datediff("ship_date", "order_date").alias("ship_lag_days")
    )
    return prep.derive_delivery_dates(s).select("order_id", "order_date", "ship_date", "delivery_duration", "delivery_date")


def _p05(t: Tables) -> DataFrame:
    r = t["fact_returns"]
    parts = r.select(
        "order_id", "product_sku", "return_quantity", "return_year", "return_month", "return_day",
        F.hour("returndate").alias("hour"), F.minute("returndate").alias("minute"), F.second("returndate").alias("second"),
    )
    return prep.return_timestamp(parts).drop("hour", "minute", "second")


def _p08(t: Tables) -> DataFrame:
    """Round trip: export the bound tables as CSV, ingest them into typed Parquet
    tables under the shared checkpoint folder, and read the order facts back."""
    spark = t["fact_orders"].sparkSession
    root = scratch_path(spark, "ingest")
    names = ["dim_products", "dim_customers", "fact_orders"]
    schemas = prep.export_csv(t, os.path.join(root, "csv"), names)
    stored = prep.ingest(spark, os.path.join(root, "csv"), os.path.join(root, "tables"), names=names, schemas=schemas)
    return stored["fact_orders"].select(*t["fact_orders"].columns)


def _faulty_csv(t: Tables, root: str) -> dict:
    """All nine tables as CSV with faults by rule: names of every 50th customer are too long, prices of
    every 97th order are no numbers, every 89th order names a retailer that is not there."""
    customer, order, retailer = F.col("customer_id"), F.col("order_id"), F.col("retailer_id")
    faulty = t.with_table(
        "dim_customers",
        t["dim_customers"].withColumn(
            "customer_name", F.when(customer % 50 == 0, F.repeat("customer_name", 5)).otherwise(F.col("customer_name"))
        ),
    ).with_table(
        "fact_orders",
        t["fact_orders"]
        .withColumn("product_price", F.when(order % 97 == 0, "n/a").otherwise(F.col("product_price").cast("string")))
        .withColumn("retailer_id", F.when(order % 89 == 0, retailer + 900_000_000).otherwise(retailer)),
    )
    prep.export_csv(faulty, root, list(SPECS), compression="gzip")
    return {n: t[n].schema for n in SPECS}


def _p08_checked(t: Tables) -> DataFrame:
    """The faulty files of all nine tables loaded twice: rows by load, table and outcome."""
    spark = t["fact_orders"].sparkSession
    root = scratch_path(spark, "load")
    schemas = _faulty_csv(t, os.path.join(root, "csv"))
    for _ in range(2):
        load_batch(spark, os.path.join(root, "csv"), os.path.join(root, "tables"), schemas=schemas)
    return load_report(spark, os.path.join(root, "tables"))


def _dq3_raw(t: Tables) -> DataFrame:
    """Violations of declared types, lengths and domains in the text of the faulty files."""
    spark = t["fact_orders"].sparkSession
    root = scratch_path(spark, "raw")
    _faulty_csv(t, root)
    return reduce(DataFrame.unionByName, [raw_violations(spark, n, root) for n in SPECS])


# Analyses that meet or group facts by order, so that copies of the facts by order spare their shuffles.
BY_ORDER = {"q03_monthly_return_rate", "q14_orders_vs_returns", "q23_avg_delivery_by_region", "q33_customer_return_rate"}


def _by_order(analysis: Callable[[Tables], DataFrame], *facts: str) -> Callable[[Tables], DataFrame]:
    """The analysis on facts stored by order under the shared checkpoint folder."""

    def run(t: Tables) -> DataFrame:
        root = scratch_path(t["fact_orders"].sparkSession, "by-order")
        return analysis(arrange(t, root, names=facts))

    return run


def build_registry(as_of=AS_OF) -> dict[str, Callable[[Tables], DataFrame]]:
    """All keys with their parameters bound; ``as_of`` is the analysis date (None = today)."""
    return {
        # stored views
        "v01_orders_with_promo": promotions.orders_with_promo,
        "v02_customer_rfm": lambda t: customers.customer_rfm(t, as_of),
        "v03_product_monthly_quantity": products.product_monthly_quantity,
        # analyses
        "q01_top_products": sales.top_products,
        "q02_customer_revenue": customers.customer_ltv,
        "q03_monthly_return_rate": returns.monthly_return_rate,
        "q03_monthly_return_rate_fixed": lambda t: returns.monthly_return_rate(t, fixed=True),
        "q04_promo_ratio": promotions.promo_ratio,
        "q05_avg_delivery_by_carrier": logistics.avg_delivery_by_carrier,
        "q06_rfm": lambda t: customers.rfm_rank(t, as_of),
        "q06_rfm_all": lambda t: customers.rfm_rank(t, as_of, k=None),
        "q07_top_categories_profit": sales.top_categories,
        "q08_products_without_sales": products.products_without_sales,
        "q08_products_without_sales_2000q1": lambda t: products.products_without_sales(t, "2000-01-01", "2000-03-31"),
        "q09_orders_per_warehouse": logistics.orders_per_warehouse,
        "q10_repeat_rate": customers.repeat_purchase_rate,
        "q10_repeat_rate_2001q1": lambda t: customers.repeat_purchase_rate(t, "2001-01-01", "2001-03-31"),
        "q11_revenue_by_promo": promotions.revenue_by_promo,
        "q12_seasonal_product": products.most_seasonal_product,
        "q13_avg_discount_by_category": promotions.avg_discount_by_category,
        "q14_orders_vs_returns": returns.orders_vs_returns,
        "q14_orders_vs_returns_fixed": lambda t: returns.orders_vs_returns(t, fixed=True),
        "q15_on_time_rate": logistics.on_time_rate,
        "q16_monthly_profit": sales.monthly_profit,
        "q17_top_retailers": sales.top_retailers,
        "q18_top_returned": returns.top_returned_products,
        "q19_churn_risk": lambda t: customers.churn_risk(t, as_of),
        "q20_retailer_region_qty": sales.quantity_by_region,
        "q21_pct_orders_by_channel": sales.pct_orders_by_channel,
        "q22_top_customers_profit": customers.top_customers_by_profit,
        "q23_avg_delivery_by_region": logistics.avg_delivery_by_region,
        "q24_promo_no_uplift": promotions.promotions_without_uplift,
        "q24_promo_no_uplift_exact": lambda t: promotions.promotions_without_uplift(t, integer_division=False),
        "q25_best_product_per_category": sales.best_product_per_category,
        "q26_customers_by_age": customers.customers_by_age_group,
        "q27_promos_per_campaign": promotions.promotions_per_campaign,
        "q28_avg_profit_per_order": sales.avg_profit_per_order,
        "q29_shipments_by_method_month": logistics.shipments_by_method_month,
        "q30_worst_product_per_month": sales.worst_product_per_month,
        "q31_delivery_deviation": logistics.delivery_deviation,
        "q32_revenue_share_by_region": sales.revenue_share_by_region,
        "q33_customer_return_rate": returns.customer_return_rate,
        "q34_promos_per_month": promotions.promotions_per_month,
        "q34_promos_per_month_active": lambda t: promotions.promotions_per_month(t, mode="active"),
        "q35_warehouse_most_orders": logistics.orders_by_location,
        "q36_more_returns_than_sales": returns.skus_more_returned_than_sold,
        "q36_more_returns_than_sales_half": lambda t: returns.skus_more_returned_than_sold(t, min_ratio=0.5),
        "q36_more_returns_than_sales_literal": lambda t: returns.skus_more_returned_than_sold(t, fixed=False),
        "q37_mom_growth": sales.month_over_month_growth,
        "q38_order_frequency": customers.order_frequency,
        "q39_discount_buckets": promotions.avg_discount_by_bucket,
        "q39_discount_buckets_money": lambda t: promotions.avg_discount_by_bucket(t, (0, 1000, 3000), suffix=""),
        "q40_single_order_customers": customers.single_order_customers,
        "q40_single_order_customers_2001": lambda t: customers.single_order_customers(t, "2001-01-01"),
        "q41a_rolling_365d": sales.rolling_revenue_daily,
        "q41b_rolling_12m": sales.rolling_revenue_monthly,
        "q42_customer_cohort": customers.customer_cohort,
        "q43_cohort_retention": customers.cohort_retention,
        "q44_best_campaign": promotions.top_campaigns_by_profit,
        "q45_outlier_quantity": products.quantity_outliers,
        "q45_outlier_quantity_k15": lambda t: products.quantity_outliers(t, k=1.5),
        "q46_weighted_shipping_cost": logistics.weighted_shipping_cost,
        "q47_bought_together": products.bought_together,
        "q47_bought_together_min3": lambda t: products.bought_together(t, min_freq=3),
        "q48_sma_demand": sales.demand_sma,
        "q49_sla_violation": logistics.sla_violation_rate,
        "q50_product_lifecycle": products.product_lifecycle,
        # joins on order_id between facts that are stored by order
        "q03_monthly_return_rate_by_order": _by_order(returns.monthly_return_rate, "fact_orders", "fact_returns"),
        "q14_orders_vs_returns_by_order": _by_order(returns.orders_vs_returns, "fact_orders", "fact_returns"),
        "q23_avg_delivery_by_region_by_order": _by_order(logistics.avg_delivery_by_region, "fact_orders", "fact_shippings"),
        "q33_customer_return_rate_by_order": _by_order(returns.customer_return_rate, "fact_orders", "fact_returns"),
        # preparation jobs
        "p01_calendar": prep.order_calendar,
        "p02_order_discount": _p02,
        "p03_promo_date_repair": lambda t: prep.repair_promo_dates(t["dim_promotions"], 30),
        "p04_derive_shippings": _p04,
        "p05_return_timestamp": _p05,
        "p06_return_id": lambda t: prep.with_return_id(t["fact_returns"]),
        "p07_enrich_returns": lambda t: prep.enrich_returns(t["fact_returns"].drop("product_sku"), t["fact_orders"]),
        "p08_ingest": _p08,
        "p08_ingest_checked": _p08_checked,
        # data-quality jobs
        "dq1_primary_key": quality.pk_report,
        "dq2_foreign_key": quality.fk_report,
        "dq3_domain": quality.domain_report,
        "dq3_domain_raw": _dq3_raw,
    }


REGISTRY = build_registry(AS_OF)
