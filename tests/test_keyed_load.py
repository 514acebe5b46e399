"""The checked load: second loads, bad values, orphans, duplicates, crashes, conflicting loads."""

from __future__ import annotations

import csv
import os
import tempfile

import pytest

from tillpoint.plans import sales
from tillpoint.schemas import SPECS
from tillpoint.sources import keyed_load, ledger
from tillpoint.sources.files import read_tables
from tillpoint.sources.keyed_load import load_batch, load_report, raw_violations, rejected_rows


def put(folder, name, rows, without=()):
    os.makedirs(folder, exist_ok=True)
    header = [c for c in SPECS[name].names if c not in without]
    with open(os.path.join(folder, f"{name}.csv"), "w", newline="") as fh:
        w = csv.writer(fh)
        w.writerow(header)
        w.writerows(r if isinstance(r, list) else [r.get(c, "NA") for c in header] for r in rows)


def product(sku, **more):
    return dict(product_sku=sku, product_name=f"p{sku}") | more


def sale(order_id, sku=1, **more):
    base = dict(order_id=order_id, order_date="2021-05-01", retailer_id=1, product_sku=sku, product_price="10.00")
    return base | dict(product_cost="5.00", order_quantity=3, customer_id=1, product_discount="0.00") | more


def parents(folder, skus=(1, 2)):
    put(folder, "dim_products", [product(s) for s in skus])
    put(folder, "dim_retailers", [dict(retailer_id=1, retailer_name="r")])
    put(folder, "dim_customers", [dict(customer_id=1, customer_name="c")])


def report(spark, root):
    return {(r["load_number"], r["table_name"], r["outcome"]): r["rows"] for r in load_report(spark, root).collect()}


@pytest.fixture
def folders():
    base = tempfile.mkdtemp(prefix="tp-load-")
    return os.path.join(base, "csv"), os.path.join(base, "tables")


def test_second_load_changes_nothing(spark, folders):
    src, root = folders
    parents(src)
    put(src, "fact_orders", [sale(1), sale(2, 2)])
    put(src, "fact_returns", [dict(order_id=1, product_sku=1, return_quantity=1, returndate="2021-06-01 00:00:00", return_year=2021)], ("return_id",))
    load_batch(spark, src, root)
    first = {n: sorted(map(str, read_tables(spark, root)[n].collect())) for n in ("fact_orders", "fact_returns")}
    assert sales.top_products(read_tables(spark, root)).count() == 2
    load_batch(spark, src, root)
    tables = read_tables(spark, root)
    assert {n: sorted(map(str, tables[n].collect())) for n in first} == first
    assert [r["return_id"] for r in tables["fact_returns"].collect()] == [1]
    got = report(spark, root)
    assert got[2, "fact_orders", "stored key"] == 2 and got[2, "fact_returns", "stored key"] == 1
    assert not any(load == 2 and outcome == "accepted" for load, _, outcome in got)
    put(src, "fact_orders", [sale(2, 2), sale(3)])
    put(src, "fact_returns", [dict(order_id=3, product_sku=1, return_quantity=1, returndate="2021-06-01 00:00:00", return_year=2021)], ("return_id",))
    load_batch(spark, src, root)
    tables = read_tables(spark, root)
    assert sorted(r["order_id"] for r in tables["fact_orders"].collect()) == [1, 2, 3]
    assert sorted(r["return_id"] for r in tables["fact_returns"].collect()) == [1, 2]


def test_refused_rows_are_kept_with_their_reason(spark, folders):
    src, root = folders
    parents(src)
    rows = [sale(1), sale(1), sale(1, product_price="9.00"), sale(2, product_price="ten"), sale("NA"), sale(4, retailer_id=77)]
    rows += [sale(5, sku="x"), sale(6, customer_id="NA"), sale(7, order_date="2021-02-30"), sale(3_000_000_000), ["8", "2021-05-01"]]
    put(src, "fact_orders", rows)
    put(src, "dim_products", [product(1), product(2), product(2, product_size="x" * 11), product(9, product_name="")])
    put(src, "fact_shippings", [dict(order_id=1, shipping_method="standard"), dict(order_id=2), dict(order_id=1, warehouse_id=5)])
    load_batch(spark, src, root)
    got = {(t, o): n for (_, t, o), n in report(spark, root).items()}
    assert {o: n for (t, o), n in got.items() if t == "fact_orders"} == {
        "accepted": 2, "duplicate key": 2, "product_price: not decimal(10,2)": 1, "null key": 1, "product_sku: not int": 1,
        "retailer_id: no dim_retailers": 1, "order_date: not date": 1, "order_id: not int": 1, "malformed row": 1,
    }
    assert got["dim_products", "accepted"] == 3 and got["dim_products", "product_size: length>10"] == 1
    assert got["fact_shippings", "order_id: no fact_orders"] == 1 and got["fact_shippings", "warehouse_id: no dim_warehouses"] == 1
    kept = read_tables(spark, root)["fact_orders"].collect()
    assert {(r["order_id"], str(r["product_price"])) for r in kept} == {(1, "10.00"), (6, "10.00")}
    refused = {r["outcome"]: r["text"] for r in rejected_rows(spark, root, "fact_orders").collect()}
    assert "ten" in refused["product_price: not decimal(10,2)"] and refused["malformed row"].startswith("8,2021-05-01")
    assert sum(r["times"] for r in rejected_rows(spark, root, "fact_orders").collect()) == 9


def test_row_repeated_many_times_is_stored_once(spark, folders):
    src, root = folders
    put(src, "dim_products", [product(1)] * 3000 + [product(2)])
    load_batch(spark, src, root)
    assert report(spark, root) == {(1, "dim_products", "accepted"): 2, (1, "dim_products", "duplicate key"): 2999}


def test_crash_between_tables_leaves_no_half_load(spark, folders, monkeypatch):
    src, root = folders
    parents(src)
    put(src, "fact_orders", [sale(1)])
    stage = keyed_load._Load.stage

    def breaks(self, judged, spec, *rest):
        if spec.name == "fact_orders":
            raise RuntimeError("lost")
        stage(self, judged, spec, *rest)

    monkeypatch.setattr(keyed_load._Load, "stage", breaks)
    with pytest.raises(RuntimeError):
        load_batch(spark, src, root)
    monkeypatch.undo()
    assert ledger.finished_loads(spark, root) == [] and load_report(spark, root).collect() == []
    with pytest.raises(FileNotFoundError):
        read_tables(spark, root, ["dim_products"])["dim_products"]
    load_batch(spark, src, root)
    tables = read_tables(spark, root)
    assert tables["dim_products"].count() == 2 and tables["fact_orders"].count() == 1


def test_of_two_loads_from_one_state_one_is_refused(spark, folders):
    src, root = folders
    put(src, "dim_products", [product(1)])
    slow = keyed_load._Load(spark, root)
    load_batch(spark, src, root)
    with pytest.raises(ledger.LoadConflict):
        ledger.finish_load(spark, root, slow.number, slow.batch, ["dim_products"])
    assert read_tables(spark, root)["dim_products"].count() == 1


def test_raw_violations_before_any_load(spark, folders):
    src, _ = folders
    put(src, "fact_shippings", [dict(order_id="a", carrier="ups"), dict(order_id=1, carrier="pigeon", shipping_cost="1e99"), ["1"]])
    got = {(r["column_name"], r["rule"]): r["violations"] for r in raw_violations(spark, "fact_shippings", src).collect()}
    assert got["order_id", "not int"] == 1 and got["carrier", "outside domain"] == 1 and got["", "malformed row"] == 1
    assert got["shipping_cost", "not decimal(10,2)"] == 1 and got["ship_date", "not date"] == 0


def test_empty_files(spark, folders):
    src, root = folders
    put(src, "dim_products", [])
    assert load_batch(spark, os.path.join(src, "none"), root) is None
    load_batch(spark, src, root)
    assert load_report(spark, root).collect() == []


def test_rows_move_as_the_text_of_their_file(spark, folders):
    src, root = folders
    put(src, "fact_orders", [sale(1), sale(1), sale(2, product_price="ten")])
    spec = SPECS["fact_orders"]
    raw = keyed_load.read_raw(spark, spec, src)
    judged = keyed_load._Load(spark, root).judged(raw, spec, {f.name: f.dataType for f in spec.struct.fields})
    assert judged.columns == [*raw.columns, "outcome", "times"]  # neither typed values nor a line beside the fields
    got = sorted((r["order_id"], r["outcome"], r["times"]) for r in judged.collect())
    assert got == [("1", "retailer_id: no dim_retailers", 2), ("2", "product_price: not decimal(10,2)", 1)]
