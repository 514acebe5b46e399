"""Facts stored by order: same answers, no shuffle by order, never a stale or a broken copy."""

from __future__ import annotations

import datetime as dt
import os

import pytest

from tests.conftest import make_tables, order
from tillpoint.plans.registry import BY_ORDER, build_registry
from tillpoint.sources.by_order import FACTS, arrange, read_by_order
from tillpoint.sources.files import load_table, read_tables

D = dt.date


def retail(spark):
    """300 orders of one to four rows, with shipments and returns, some orders without; a null order id."""
    orders, ships, returns = [], [], []
    for i in range(300):
        for k in range(1 + i % 4):
            orders.append(order(i, 1 + (i + k) % 7, qty=1 + i % 5, day=D(2021, 1 + i % 12, 1 + i % 28), customer=i % 11, retailer=i % 3))
        if i % 3:
            ships.append(dict(order_id=i, order_date=D(2021, 1, 1), ship_date=D(2021, 1, 2), delivery_duration=i % 9, warehouse_id=1))
        if i % 5 == 0:
            returns += [dict(return_id=2 * i + k, order_id=i, product_sku=1 + i % 7, return_quantity=1, return_year=2021) for k in range(1 + i % 2)]
    orders.append(order(None, 1))
    returns.append(dict(return_id=9999, order_id=None, product_sku=1, return_quantity=1, return_year=2021))
    retailers = [dict(retailer_id=i, region=f"r{i % 2}") for i in range(3)]
    return make_tables(spark, fact_orders=orders, fact_shippings=ships, fact_returns=returns, dim_retailers=retailers)


@pytest.fixture
def root(spark, tmp_path):
    t = retail(spark)
    for name in t:
        load_table(t[name], name, str(tmp_path))
    return str(tmp_path)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def answers(df):
    return sorted(map(str, df.collect()))


def test_joins_by_order_need_no_shuffle_and_answer_alike(spark, root):
    plain = read_tables(spark, root)
    arrange(plain, root, 6)
    copies, registry = read_by_order(spark, root), build_registry("2022-01-01")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # no small side hides a shuffle
    try:
        for key in sorted(BY_ORDER):
            before, after = registry[key](plain), registry[key](copies)
            assert "hashpartitioning(order_id" in plan(before), key
            assert "hashpartitioning(order_id" not in plan(after) and "SortMergeJoin [order_id" in plan(after), key
            assert answers(before) == answers(after) and answers(after), key
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_copy_has_one_file_a_bucket_and_every_row(spark, root):
    plain = read_tables(spark, root)
    copies = arrange(plain, root, 6)
    for name in FACTS:
        assert answers(copies[name].select(*plain[name].columns)) == answers(plain[name])
        assert len(copies[name].inputFiles()) <= 6
    again = arrange(plain, root, 6)
    assert [sorted(again[n].inputFiles()) for n in FACTS] == [sorted(copies[n].inputFiles()) for n in FACTS]
    other = arrange(plain, root, 3)
    assert len(other["fact_orders"].inputFiles()) <= 3 and answers(other["fact_orders"]) == answers(copies["fact_orders"])


def test_copy_is_left_aside_once_rows_are_added(spark, root):
    arrange(read_tables(spark, root), root, 4)
    more = make_tables(spark, fact_orders=[order(5000, 1)])["fact_orders"]
    load_table(more, "fact_orders", root)
    now = read_by_order(spark, root)
    assert now["fact_orders"].where("order_id = 5000").count() == 1
    assert "__by_order" not in now["fact_orders"].inputFiles()[0]
    assert "__by_order" in now["fact_returns"].inputFiles()[0]
    arrange(read_tables(spark, root), root, 4)
    assert "__by_order" in read_by_order(spark, root)["fact_orders"].inputFiles()[0]


def test_broken_copy_is_not_read(spark, root):
    copies = arrange(read_tables(spark, root), root, 4)
    folder = os.path.dirname(copies["fact_orders"].inputFiles()[0].removeprefix("file://"))
    os.rename(os.path.join(folder, "_SUCCESS"), os.path.join(folder, "_unfinished"))
    assert "__by_order" not in read_by_order(spark, root)["fact_orders"].inputFiles()[0]


def test_copy_of_another_session_is_found_by_its_folder(spark, root):
    copies = arrange(read_tables(spark, root), root, 4)
    for table in spark.catalog.listTables():
        if "by_order" in table.name:
            spark.sql(f"drop table {table.name}")  # the catalog of a session ends with it, the files stay
    found = read_by_order(spark, root)
    assert answers(found["fact_orders"]) == answers(read_tables(spark, root)["fact_orders"])
    assert "hashpartitioning(order_id" not in plan(found["fact_returns"].groupBy("order_id").count())
    assert set(copies) == set(found)


def test_empty_facts(spark, tmp_path):
    t = make_tables(spark)
    copies = arrange(t, str(tmp_path), 3)
    assert [copies[n].count() for n in FACTS] == [0, 0, 0]
    assert build_registry("2022-01-01")["q33_customer_return_rate"](copies).count() == 0


def test_command_line_copies_and_uses_them(spark, root, tmp_path):
    from tillpoint.__main__ import main

    assert main(["arrange", root, "--buckets", "4"]) == 0
    out = str(tmp_path / "out")
    assert main(["run", "q33_customer_return_rate", "--tables", root, "--out", out]) == 0
    want = build_registry("2022-01-01")["q33_customer_return_rate"](read_tables(spark, root))
    assert answers(spark.read.parquet(os.path.join(out, "q33_customer_return_rate"))) == answers(want)
