"""Hand-made cases the synthetic test tables cannot show."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest

from tests.conftest import D, make_tables, money, order
from tillpoint.plans import customers, logistics, prep, products, promotions, quality, returns, sales
from tillpoint.tables import Tables


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def promo(pid, sku, start, end, campaign="c"):
    return dict(promotion_id=pid, product_sku=sku, start_date=start, end_date=end,
                discount_percentage=Decimal("10.0"), campaign_name=campaign)


def ship(order_id, duration, carrier="ups", status="on-time", cost=1, day=D(2021, 1, 5), wh=1, method="standard"):
    return dict(order_id=order_id, order_date=D(2021, 1, 1), ship_date=day, delivery_duration=duration,
                delivery_date=day + dt.timedelta(days=duration), shipping_method=method, carrier=carrier,
                shipping_cost=money(cost), delivery_status=status, warehouse_id=wh)


def ret(order_id, sku, qty, when=dt.datetime(2021, 2, 1)):
    return dict(order_id=order_id, product_sku=sku, return_quantity=qty, return_year=when.year,
                return_month=when.month, return_day=when.day, returndate=when)


def test_two_returns_for_one_order_literal_and_fixed(spark):
    t = make_tables(spark, fact_orders=[order(1, 7, qty=2), order(2, 8, qty=5)],
                    fact_returns=[ret(1, 7, 1), ret(1, 7, 2)],
                    dim_products=[dict(product_sku=7), dict(product_sku=8)])
    # q03 literal: the order row repeats for each return -> 3 / (2*2)
    assert rows(returns.monthly_return_rate(t), "year", "month", "return_rate") == [(2021, 1, 0.75)]
    # fixed: all orders, returns once -> 3 / 7
    assert rows(returns.monthly_return_rate(t, fixed=True), "return_rate") == [(3 / 7,)]
    # q14 literal: ordered 2 counted twice
    assert rows(returns.orders_vs_returns(t), "product_sku", "ordered", "returned") == [(7, 4, 3), (8, 5, 0)]
    assert rows(returns.orders_vs_returns(t, fixed=True), "product_sku", "ordered", "returned") == [(7, 2, 3), (8, 5, 0)]
    # q33: returns pre-aggregated per order, so the order quantity is not repeated
    assert rows(returns.customer_return_rate(t), "total_order_qty", "total_return_qty") == [(7, 3)]
    # q36 fixed: 3 > 2 ; literal: returned 3*1 vs ordered 2*2
    assert rows(returns.skus_more_returned_than_sold(t), "product_sku", "ordered", "returned") == [(7, 2, 3)]
    assert rows(returns.skus_more_returned_than_sold(t, fixed=False), "product_sku") == []


def test_two_promotions_and_inclusive_bounds(spark):
    day = D(2021, 3, 10)
    t = make_tables(
        spark,
        fact_orders=[order(1, 5, day=day, price=10, cost=4, qty=1), order(2, 5, day=D(2021, 3, 1)),
                     order(3, 5, day=D(2021, 3, 20)), order(4, 5, day=D(2021, 3, 21)), order(5, 6, day=day)],
        dim_promotions=[promo(1, 5, D(2021, 3, 1), D(2021, 3, 15), "a"), promo(2, 5, D(2021, 3, 5), D(2021, 3, 20), "b")],
    )
    v = promotions.orders_with_promo(t)
    assert v.count() == 5  # never multiplied by overlapping promotions
    assert rows(v, "order_id", "is_promotion_active") == [(1, True), (2, True), (3, True), (4, False), (5, False)]
    assert rows(promotions.promo_ratio(t), "promo_ratio") == [(60.0,)]
    # q44: order 1 (profit 6) counts for both campaigns; order 2 for a, order 3 for b (profit 5 each)
    top = promotions.top_campaigns_by_profit(t, k=2)
    assert rows(top, "campaign_name", "profit") == [("a", Decimal("11.00")), ("b", Decimal("11.00"))]


def test_unmatched_dimension_rows(spark):
    t = make_tables(
        spark,
        fact_orders=[order(1, 1, customer=1, retailer=1, qty=3, price=10, cost=4, discount=2)],
        dim_products=[dict(product_sku=1, product_name="p1", product_category="x"),
                      dict(product_sku=2, product_name="p2", product_category="x")],
        dim_customers=[dict(customer_id=1), dict(customer_id=2)],
        dim_retailers=[dict(retailer_id=1, retailer_name="r1", region="north"),
                       dict(retailer_id=2, retailer_name="r2", region="south")],
    )
    assert rows(products.products_without_sales(t), "product_sku") == [(2,)]
    # q13: product 2 counts as one row with discount 0 -> (2 + 0) / 2
    assert rows(promotions.avg_discount_by_category(t), "avg_discount") == [(1.0,)]
    assert rows(sales.top_retailers(t), "retailer_id", "revenue") == [(1, Decimal("30.00")), (2, Decimal("0.00"))]
    assert rows(sales.quantity_by_region(t), "region", "total_quantity") == [("north", 3), ("south", 0)]
    assert rows(customers.top_customers_by_profit(t), "customer_id", "lifetime_profit") == [
        (1, Decimal("18.00")), (2, Decimal("0.00"))]
    churn = customers.churn_risk(t, as_of="2021-02-01")
    assert rows(churn, "customer_id") == [(2,)]


def test_churn_boundary_is_strict(spark):
    as_of = D(2021, 6, 1)
    t = make_tables(spark, fact_orders=[order(1, 1, customer=1, day=as_of - dt.timedelta(days=90)),
                                        order(2, 1, customer=2, day=as_of - dt.timedelta(days=91))],
                    dim_customers=[dict(customer_id=1), dict(customer_id=2)])
    assert rows(customers.churn_risk(t, as_of=as_of, days=90), "customer_id") == [(2,)]


def test_single_month_sku_has_null_variance_and_loses(spark):
    t = make_tables(spark, fact_orders=[order(1, 1, qty=100, day=D(2021, 1, 3)),
                                        order(2, 2, qty=1, day=D(2021, 1, 3)), order(3, 2, qty=4, day=D(2021, 2, 3))])
    assert rows(products.most_seasonal_product(t), "product_sku", "variance") == [(2, 4.5)]


def test_rank_ties_are_kept(spark):
    t = make_tables(
        spark,
        fact_orders=[order(1, 1, price=10, cost=5), order(2, 2, price=10, cost=5), order(3, 3, price=7, cost=5)],
        dim_products=[dict(product_sku=s, product_category="c") for s in (1, 2, 3)],
    )
    assert rows(sales.best_product_per_category(t), "product_sku") == [(1,), (2,)]
    assert rows(sales.worst_product_per_month(t), "product_sku") == [(3,)]


def test_discount_bucket_edges(spark):
    vals = [0, 0.01, 10, 20, 30, 50, 50.01, None, -1]
    t = make_tables(spark, fact_orders=[dict(order(i, 1), product_discount=None if v is None else money(v))
                                        for i, v in enumerate(vals)])
    got = dict(rows(promotions.avg_discount_by_bucket(t), "discount_bucket", "avg_discount"))
    assert got == {"0%": 0.0, "1-10%": 5.01, "11-20%": 20.0, "21-30%": 30.0, "31-50%": 50.0, "50%+": 24.51}


def test_uplift_integer_division(spark):
    # SKU 1: promo 7 units over 2 days (7 div 2 = 3), non-promo 3 units over 1 day -> kept only with div
    p = [promo(1, 1, D(2021, 1, 1), D(2021, 1, 2))]
    fo = [order(1, 1, qty=4, day=D(2021, 1, 1)), order(2, 1, qty=3, day=D(2021, 1, 2)), order(3, 1, qty=3, day=D(2021, 1, 9))]
    t = make_tables(spark, fact_orders=fo, dim_promotions=p)
    assert rows(promotions.promotions_without_uplift(t), "product_sku", "promo_daily_qty") == [(1, 3)]
    assert rows(promotions.promotions_without_uplift(t, integer_division=False), "product_sku") == []


def test_bought_together_counts_distinct_orders(spark):
    fo = [order(1, 1), order(1, 2), order(1, 2), order(1, 3), order(2, 1), order(2, 2)]
    t = make_tables(spark, fact_orders=fo)
    got = rows(products.bought_together(t, min_freq=1), "item1", "item2", "freq")
    assert got == [(1, 2, 2), (1, 3, 1), (2, 3, 1)]


def test_gap_months_rows_versus_calendar(spark):
    fo = [order(1, 1, qty=1, price=1, day=D(2021, 1, 5)), order(2, 1, qty=2, price=1, day=D(2021, 2, 5)),
          order(3, 1, qty=4, price=1, day=D(2021, 4, 5))]
    t = make_tables(spark, fact_orders=fo)
    assert [r["mom_growth"] for r in sales.month_over_month_growth(t).orderBy("month").collect()] == [
        None, Decimal("1.00"), Decimal("2.00")]
    assert [r["sma_3_month"] for r in sales.demand_sma(t).orderBy("month").collect()] == [1.0, 1.5, 7 / 3]
    roll = sales.rolling_revenue_monthly(t, months=1).orderBy("order_month").collect()
    assert [r["rolling_12m_revenue"] for r in roll] == [Decimal("1.00"), Decimal("3.00"), Decimal("4.00")]


def test_rolling_365_frame_end(spark):
    last = D(2022, 1, 1)
    fo = [order(1, 1, price=1, day=last - dt.timedelta(days=366)), order(2, 1, price=2, day=last - dt.timedelta(days=365)),
          order(3, 1, price=4, day=last)]
    t = make_tables(spark, fact_orders=fo)
    got = {r["order_day"]: r["rolling_12m_revenue"] for r in sales.rolling_revenue_daily(t).collect()}
    assert got[last] == Decimal("6.00")


def test_weighted_cost_zero_durations(spark):
    t = make_tables(spark, fact_shippings=[ship(1, 0, carrier="a"), ship(2, 0, carrier="a"), ship(3, 2, carrier="b", cost=3)])
    assert rows(logistics.weighted_shipping_cost(t), "carrier", "weighted_cost") == [("a", None), ("b", 3.0)]


def test_sla_parameter(spark):
    t = make_tables(spark, fact_shippings=[ship(1, 1, status="on-time"), ship(2, 1, status="delayed")])
    assert rows(logistics.sla_violation_rate(t), "violation_rate") == [(0.5,)]
    assert rows(logistics.sla_violation_rate(t, ok="On Time"), "violation_rate") == [(1.0,)]
    assert rows(logistics.on_time_rate(t), "on_time_rate") == [(0.5,)]


def test_promo_date_repair(spark):
    t = make_tables(spark, dim_promotions=[promo(1, 1, D(2021, 5, 1), D(2021, 4, 1)), promo(2, 1, D(2021, 5, 1), D(2021, 6, 1))])
    got = rows(prep.repair_promo_dates(t["dim_promotions"], 10), "promotion_id", "end_date")
    assert got == [(1, D(2021, 5, 11)), (2, D(2021, 6, 1))]


def test_quality_checks(spark):
    t = make_tables(
        spark,
        dim_products=[dict(product_sku=1, product_name="x" * 51), dict(product_sku=1, product_name="ok"),
                      dict(product_sku=None)],
        fact_orders=[order(1, 9)],
        dim_customers=[dict(customer_id=1, loyalty_score=Decimal("9999.9"))],
    )
    wide = spark.createDataFrame(
        [(1, Decimal("99999999.99"), "online"), (2, Decimal("100000000.00"), "web")],
        "retailer_id int, distance_from_warehouse decimal(12,2), retailer_channel string",
    )
    pk = {tuple(r) for r in quality.pk_violations(t["dim_products"], ["product_sku"]).collect()}
    assert pk == {(1, 2, "duplicate key"), (None, 1, "null key")}
    orphans = quality.fk_orphans(t["fact_orders"], t["dim_products"], "product_sku")
    assert rows(orphans, "order_id") == [(1,)]
    dom = {(r["column_name"], r["rule"]): r["violations"] for r in quality.domain_violations(t["dim_products"], "dim_products").collect()}
    assert dom[("product_name", "length>50")] == 1
    # the declared NUMERIC(5,1) holds at most 9999.9 -> fits; 10000.0 would not
    cust = {(r["column_name"], r["rule"]): r["violations"] for r in quality.domain_violations(t["dim_customers"], "dim_customers").collect()}
    assert cust[("loyalty_score", "not decimal(5,1)")] == 0
    ret = {(r["column_name"], r["rule"]): r["violations"] for r in quality.domain_violations(wide, "dim_retailers").collect()}
    assert ret[("distance_from_warehouse", "not decimal(10,2)")] == 1
    assert ret[("retailer_channel", "outside domain")] == 1


def test_calendar(spark):
    cal = prep.build_calendar(spark, "2024-02-27", "2024-03-02",
                              holidays=spark.createDataFrame([(D(2024, 2, 29),)], "date date"))
    got = rows(cal, "date", "quarter", "weekday", "is_holiday")
    assert got[2] == (D(2024, 2, 29), 1, "Thursday", True)
    assert len(got) == 5 and sum(r[3] for r in got) == 1


def test_return_id_and_timestamp(spark):
    t = make_tables(spark, fact_returns=[ret(5, 1, 1, dt.datetime(2021, 3, 1)), ret(4, 1, 1, dt.datetime(2021, 2, 1)),
                                         ret(3, 1, 2, dt.datetime(2021, 3, 1))])
    got = rows(prep.with_return_id(t["fact_returns"]), "return_id", "order_id")
    assert got == [(1, 4), (2, 3), (3, 5)]
    parts = spark.createDataFrame([(2021, 5, 6, 7, 8, 9)], "return_year int, return_month int, return_day int, hour int, minute int, second int")
    assert prep.return_timestamp(parts).first()["returndate"] == dt.datetime(2021, 5, 6, 7, 8, 9)


def test_enrich_returns_fetches_the_sku_and_keeps_quantities(spark):
    t = make_tables(spark, fact_orders=[order(1, 1, qty=2), order(2, 2, qty=5)], fact_returns=[ret(1, 9, 3), ret(2, 9, 1), ret(3, 9, 1)])
    bare = t["fact_returns"].drop("product_sku")
    got = [tuple(r) for r in prep.enrich_returns(bare, t["fact_orders"]).select("order_id", "product_sku", "return_quantity").orderBy("order_id").collect()]
    assert got == [(1, 1, 3), (2, 2, 1), (3, None, 1)]
    assert {r.product_sku for r in prep.enrich_returns(t["fact_returns"], t["fact_orders"]).collect()} == {9}


@pytest.mark.parametrize("mode,expected", [("started", 1), ("active", 3)])
def test_promotions_per_month(spark, mode, expected):
    t = make_tables(spark, dim_promotions=[promo(1, 1, D(2021, 1, 20), D(2021, 3, 2))])
    assert promotions.promotions_per_month(t, mode=mode).count() == expected


def test_identical_promotions_collapse_but_count(spark):
    day = D(2021, 3, 10)
    p = [promo(i, 5, D(2021, 3, 1), D(2021, 3, 15), "a") for i in range(1, 4)]
    p += [promo(9, 5, D(2021, 3, 1), D(2021, 3, 5), "b"), promo(10, 5, D(2021, 3, 1), D(2021, 3, 9), "b")]
    t = make_tables(spark, fact_orders=[order(1, 5, day=day, price=10, cost=4, qty=1)], dim_promotions=p)
    # three identical promotions of campaign a each count the order; campaign b's end before the order
    assert rows(promotions.top_campaigns_by_profit(t, k=5), "campaign_name", "profit") == [("a", Decimal("18.00"))]
    assert rows(promotions.orders_with_promo(t), "order_id", "is_promotion_active") == [(1, True)]


def test_discount_buckets_with_amount_edges(spark):
    vals = [0, 999.99, 1000, 1000.01, 3000, 3000.01]
    t = make_tables(spark, fact_orders=[dict(order(i, 1), product_discount=money(v)) for i, v in enumerate(vals)])
    got = dict(rows(promotions.avg_discount_by_bucket(t, (0, 1000, 3000), suffix=""), "discount_bucket", "avg_discount"))
    assert got == {"0": 0.0, "1-1000": 1000.0, "1001-3000": 2000.01, "3000+": 3000.01}  # 2000.005 rounds up


def test_foreign_and_primary_key_reports(spark):
    """Planted orphans, a NULL reference, repeated keys, and a table without its key column."""
    t = make_tables(
        spark,
        dim_products=[dict(product_sku=1), dict(product_sku=1), dict(product_sku=2)],
        dim_customers=[dict(customer_id=1)],
        dim_retailers=[dict(retailer_id=1)],
        fact_orders=[order(1, 1), order(2, 9), order(3, 9, customer=None), order(4, 2, customer=7)],
        fact_returns=[dict(return_id=1, order_id=1, product_sku=1), dict(return_id=2, order_id=99, product_sku=1)],
    )
    got = {(r["table_name"], r["column_name"]): r["orphan_rows"] for r in quality.fk_report(t).collect()}
    expected = {("fact_orders", "product_sku"): 2, ("fact_orders", "customer_id"): 1, ("fact_returns", "order_id"): 1}
    assert {k: n for k, n in got.items() if n} == expected
    keyless = Tables(
        dim_products=t["dim_products"], fact_returns=t["fact_returns"].drop("return_id"), dim_customers=t["dim_customers"]
    )
    assert {tuple(r) for r in quality.pk_report(keyless).collect()} == {
        ("dim_products", "1", 2, "duplicate key"),
        ("fact_returns", None, 2, "no key column"),
    }


def test_campaign_profit_over_months(spark):
    """A promotion over several months counts an order once; one that ends before it starts counts for none."""
    t = make_tables(
        spark,
        fact_orders=[order(1, 1, day=D(2021, 1, 31)), order(2, 1, day=D(2021, 2, 1)), order(3, 1, day=D(2021, 4, 1))],
        dim_promotions=[
            dict(promotion_id=1, product_sku=1, start_date=D(2021, 1, 15), end_date=D(2021, 3, 15), campaign_name="a"),
            dict(promotion_id=2, product_sku=1, start_date=D(2021, 1, 15), end_date=D(2021, 3, 15), campaign_name="a"),
            dict(promotion_id=3, product_sku=1, start_date=D(2021, 4, 15), end_date=D(2021, 3, 1), campaign_name="b"),
        ],
    )
    assert [tuple(r) for r in promotions.top_campaigns_by_profit(t, k=5).collect()] == [("a", money(20))]
