from __future__ import annotations

import datetime as dt
import os
import sys
from decimal import Decimal

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from tillpoint.session import ensure_checkpoint_dir

    s = (
        SparkSession.builder.master("local[4]")
        .appName("tillpoint-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(s)
    yield s


D = dt.date


def money(x) -> Decimal:
    return Decimal(str(x)).quantize(Decimal("0.01"))


def make_tables(spark, **rows):
    """Retail tables from lists of dicts; missing columns are NULL, missing tables empty."""
    from tillpoint.schemas import SPECS
    from tillpoint.tables import Tables

    frames = {}
    if "dim_date" not in rows:  # the days that have orders
        days = sorted({o["order_date"] for o in rows.get("fact_orders", []) if o.get("order_date")})
        rows["dim_date"] = [
            dict(date=d, year=d.year, month=d.month, quarter=(d.month + 2) // 3, weekday=d.strftime("%A"), is_holiday=False)
            for d in days
        ]
    for name, spec in SPECS.items():
        data = rows.get(name, [])
        tuples = [tuple(r.get(c, None) for c in spec.names) for r in data]
        frames[name] = spark.createDataFrame(tuples, spec.struct)
    return Tables(**frames)


def order(order_id, sku, qty=1, price=10, cost=5, day=D(2021, 1, 1), customer=1, retailer=1, discount=0):
    return dict(
        order_id=order_id, order_date=day, retailer_id=retailer, product_sku=sku, product_price=money(price),
        product_cost=money(cost), order_quantity=qty, customer_id=customer, product_discount=money(discount),
    )
