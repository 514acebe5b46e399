"""The literal forms of fan-out joins are computed from per-order sums and counts;
here they are compared with the row-pair joins they stand for, on random data with
several rows and several returns per order id."""

from __future__ import annotations

import datetime as dt
import random
from collections import defaultdict

import pytest

from tests.conftest import make_tables, order
from tillpoint.plans import logistics, returns


def _data(seed):
    rnd = random.Random(seed)
    orders, rets, ships = [], [], []
    for oid in range(1, 40):
        day = dt.date(2021, rnd.randint(1, 4), rnd.randint(1, 28))
        cust = rnd.randint(1, 6)
        for _ in range(rnd.randint(1, 4)):
            orders.append(order(oid, rnd.randint(1, 8), qty=rnd.randint(1, 9), day=day, customer=cust,
                                retailer=rnd.randint(1, 5)))
        for _ in range(rnd.choice([0, 0, 1, 2, 3])):
            rets.append(dict(order_id=oid, product_sku=rnd.randint(1, 8), return_quantity=rnd.randint(1, 5),
                             return_year=2021, return_month=6, return_day=1, returndate=dt.datetime(2021, 6, 1)))
        for _ in range(rnd.randint(0, 3)):
            ships.append(dict(order_id=oid, delivery_duration=rnd.randint(0, 9), carrier="c", warehouse_id=1))
    products = [dict(product_sku=s) for s in range(1, 11)]
    retailers = [dict(retailer_id=r, region=f"r{r % 3}") for r in range(1, 6)]
    return orders, rets, ships, products, retailers


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_literal_fanout_forms_equal_pair_joins(spark, seed):
    orders, rets, ships, products, retailers = _data(seed)
    t = make_tables(spark, fact_orders=orders, fact_returns=rets, fact_shippings=ships, dim_products=products,
                    dim_retailers=retailers)

    # q03: returns x order rows on order_id, by order month
    num, den = defaultdict(int), defaultdict(int)
    for r in rets:
        for o in orders:
            if o["order_id"] == r["order_id"]:
                k = (o["order_date"].year, o["order_date"].month)
                num[k] += r["return_quantity"]
                den[k] += o["order_quantity"]
    want = sorted((k[0], k[1], num[k] / den[k]) for k in num)
    got = sorted(tuple(x) for x in returns.monthly_return_rate(t).collect())
    assert [g[:2] for g in got] == [w[:2] for w in want]
    assert all(abs(g[2] - w[2]) < 1e-12 for g, w in zip(got, want))

    # q14: order rows left join returns on order_id, by SKU
    ordered, returned = defaultdict(int), defaultdict(int)
    for o in orders:
        matches = [r for r in rets if r["order_id"] == o["order_id"]] or [None]
        for r in matches:
            ordered[o["product_sku"]] += o["order_quantity"]
            returned[o["product_sku"]] += r["return_quantity"] if r else 0
    want = sorted((s, ordered[s], returned[s]) for s in ordered)
    assert sorted(tuple(x) for x in returns.orders_vs_returns(t).collect()) == want

    # q33: returns summed per order, order rows left join that, by customer
    per_order = defaultdict(int)
    for r in rets:
        per_order[r["order_id"]] += r["return_quantity"]
    oq, rq = defaultdict(int), defaultdict(int)
    for o in orders:
        oq[o["customer_id"]] += o["order_quantity"]
        rq[o["customer_id"]] += per_order.get(o["order_id"], 0)
    want = sorted((c, oq[c], rq[c]) for c in oq)
    got = sorted((r["customer_id"], r["total_order_qty"], r["total_return_qty"]) for r in returns.customer_return_rate(t).collect())
    assert got == want

    # q36 literal: products left join order rows on SKU left join returns on SKU
    want = []
    for p in products:
        s = p["product_sku"]
        os_ = [o for o in orders if o["product_sku"] == s] or [None]
        rs_ = [r for r in rets if r["product_sku"] == s] or [None]
        o_sum = sum(o["order_quantity"] for o in os_ for _ in rs_ if o) if os_ != [None] else None
        r_sum = sum(r["return_quantity"] for _ in os_ for r in rs_ if r) if rs_ != [None] else None
        if o_sum is not None and r_sum is not None and r_sum > o_sum:
            want.append((s, o_sum, r_sum))
    got = sorted(tuple(x) for x in returns.skus_more_returned_than_sold(t, fixed=False).collect())
    assert got == sorted(want)

    # q23: retailers x order rows x shipment rows, mean duration by region
    region = {r["retailer_id"]: r["region"] for r in retailers}
    tot, cnt = defaultdict(int), defaultdict(int)
    for o in orders:
        for s in ships:
            if s["order_id"] == o["order_id"]:
                tot[region[o["retailer_id"]]] += s["delivery_duration"]
                cnt[region[o["retailer_id"]]] += 1
    want = sorted((g, round(tot[g] / cnt[g], 2)) for g in tot)
    got = sorted(tuple(x) for x in logistics.avg_delivery_by_region(t).collect())
    assert got == want
