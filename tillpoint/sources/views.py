"""Named tables and stored views for Spark SQL users (S5).

``register_views`` exposes every retail table under its own name and adds the
three stored views as temporary views, so a query written against the star
schema runs unchanged through ``spark.sql``.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from tillpoint.tables import Tables


def register_views(spark: SparkSession, t: Tables, as_of: str | None = None) -> list[str]:
    from tillpoint.plans.customers import customer_rfm
    from tillpoint.plans.products import product_monthly_quantity
    from tillpoint.plans.promotions import orders_with_promo

    names = []
    for name in t:
        t[name].createOrReplaceTempView(name)
        names.append(name)
    views = {
        "fact_orders_with_promo": lambda: orders_with_promo(t),
        "product_monthly_quantity": lambda: product_monthly_quantity(t),
        "customer_rfm": lambda: customer_rfm(t, as_of),
    }
    for name, build in views.items():
        build().createOrReplaceTempView(name)
        names.append(name)
    return names
