"""Rows that Spark's estimate leaves out, the months of promotions, do not pass through the driver."""

from __future__ import annotations

import datetime as dt

import pytest

from tests.conftest import D, make_tables, money, order
from tillpoint.plans import promotions


@pytest.fixture
def tables(spark):
    promos = [
        dict(promotion_id=i, product_sku=i % 3, start_date=D(2021, 1, 1 + i), end_date=D(2021, 6, 1 + i), discount_percentage=money(5), campaign_name=f"c{i % 2}")
        for i in range(6)
    ]
    sold = [order(i, i % 4, price=10 + i, day=D(2020, 12, 28) + dt.timedelta(days=9 * i)) for i in range(24)]
    t = make_tables(spark, fact_orders=sold, dim_promotions=promos)
    # a limit is a table that Spark takes for small
    return t.with_table("dim_promotions", t["dim_promotions"].limit(100)), sold, promos


def _covers(p, o):
    return p["product_sku"] == o["product_sku"] and p["start_date"] <= o["order_date"] <= p["end_date"]


def test_months_of_covered_intervals_are_not_broadcast(tables):
    t, sold, promos = tables
    out = promotions.orders_with_promo(t)
    assert "BroadcastHashJoin" not in out._jdf.queryExecution().executedPlan().toString()
    got = sorted((r["order_id"], r["is_promotion_active"]) for r in out.collect())
    assert got == [(o["order_id"], any(_covers(p, o) for p in promos)) for o in sold]


def test_months_of_promotions_are_not_broadcast(tables):
    t, sold, promos = tables
    out = promotions.top_campaigns_by_profit(t, k=5)
    assert "BroadcastHashJoin" not in out._jdf.queryExecution().executedPlan().toString()
    want = {}
    for p in promos:
        for o in sold:
            if _covers(p, o):
                want[p["campaign_name"]] = want.get(p["campaign_name"], 0) + o["product_price"] - o["product_cost"]
    assert {r["campaign_name"]: r["profit"] for r in out.collect()} == want
