"""Results stay exact when one SKU holds a third of the rows and AQE splits the
skewed join partitions (broadcast disabled, skew thresholds forced low)."""

from __future__ import annotations

import datetime as dt
import random
from decimal import Decimal

import pytest

from tests.conftest import make_tables, order
from tillpoint.plans import promotions, sales

SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
}


@pytest.fixture
def skew_conf(spark):
    old = {k: spark.conf.get(k, None) for k in SETTINGS}
    for k, v in SETTINGS.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def test_hot_sku(spark, skew_conf):
    rnd = random.Random(11)
    base = dt.date(2021, 1, 1)
    rows = []
    for i in range(3000):
        sku = 1 if i % 3 == 0 else rnd.randint(2, 40)
        rows.append(order(i, sku, qty=rnd.randint(1, 5), price=rnd.randint(1, 50), cost=1,
                          day=base + dt.timedelta(days=rnd.randint(0, 200))))
    promos = [dict(promotion_id=j, product_sku=rnd.choice([1, 1, 1, rnd.randint(2, 40)]),
                   start_date=base + dt.timedelta(days=(s := rnd.randint(0, 200))),
                   end_date=base + dt.timedelta(days=s + rnd.randint(0, 30)),
                   discount_percentage=Decimal("5.0"), campaign_name=f"c{j % 4}") for j in range(40)]
    products = [dict(product_sku=s, product_name=f"p{s % 7}", product_category=f"cat{s % 3}") for s in range(1, 41)]
    t = make_tables(spark, fact_orders=rows, dim_promotions=promos, dim_products=products)

    def covered(sku, day):
        return any(p["product_sku"] == sku and p["start_date"] <= day <= p["end_date"] for p in promos)

    want = sorted((r["order_id"], covered(r["product_sku"], r["order_date"])) for r in rows)
    v01 = promotions.orders_with_promo(t)
    got = sorted((r["order_id"], r["is_promotion_active"]) for r in v01.collect())
    assert got == want

    flagged = sum(f for _, f in want)
    assert promotions.promo_ratio(t).first()[0] == pytest.approx(100 * flagged / len(rows))

    per_cat = {}
    for r in rows:
        cat = f"cat{r['product_sku'] % 3}"
        per_cat[cat] = per_cat.get(cat, 0) + (r["product_price"] - r["product_cost"]) * r["order_quantity"]
    got_cat = {r["product_category"]: r["profit"] for r in sales.top_categories(t, k=3).collect()}
    assert got_cat == per_cat
