"""CSV / Parquet sources, the append load and its streaming form."""

from __future__ import annotations

import csv
import os
import tempfile
from decimal import Decimal

from tests.conftest import D, make_tables, order
from tillpoint.plans import prep
from tillpoint.sources.files import read_table, read_tables
from tillpoint.streaming import ingest_stream


def _write(path, header, rows):
    with open(path, "w", newline="") as fh:
        w = csv.writer(fh)
        w.writerow(header)
        w.writerows(rows)


def test_read_table_without_surrogate_column(spark):
    d = tempfile.mkdtemp(prefix="tp-csv-")
    os.makedirs(os.path.join(d, "fact_returns.csv"))
    _write(os.path.join(d, "fact_returns.csv", "part-0.csv"),
           ["order_id", "product_sku", "return_quantity", "return_year", "return_month", "return_day", "returndate"],
           [[1001, 7, 2, 2022, 3, 4, "2022-03-04 05:06:07"]])
    df = read_table(spark, "fact_returns", d)
    r = df.first()
    assert df.columns[0] == "return_id" and r["return_id"] is None
    assert r["returndate"].hour == 5 and r["return_quantity"] == 2


def test_export_ingest_round_trip(spark):
    t = make_tables(spark, fact_orders=[order(1, 2, qty=3, day=D(2021, 5, 1)), order(2, 2, qty=1, day=D(2022, 5, 1))],
                    dim_products=[dict(product_sku=2, product_name="p")])
    root = tempfile.mkdtemp(prefix="tp-ingest-")
    prep.export_csv(t, os.path.join(root, "csv"), ["dim_products", "fact_orders"])
    stored = prep.ingest(spark, os.path.join(root, "csv"), os.path.join(root, "tables"),
                         names=["dim_products", "fact_orders"])
    back = stored["fact_orders"].select(*t["fact_orders"].columns)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, t["fact_orders"].collect()))
    # facts are partitioned by year on disk
    parts = sorted(p for p in os.listdir(os.path.join(root, "tables", "fact_orders")) if p.startswith("order_year="))
    assert parts == ["order_year=2021", "order_year=2022"]
    again = read_tables(spark, os.path.join(root, "tables"))
    assert again["dim_products"].count() == 1


def test_stream_ingest_appends_new_files_once(spark):
    root = tempfile.mkdtemp(prefix="tp-stream-")
    landing, out, ckpt = (os.path.join(root, x) for x in ("landing", "tables", "ckpt"))
    os.makedirs(landing)
    header = ["product_sku", "product_full_description", "product_gender", "product_category", "product_name",
              "product_size", "product_color"]
    _write(os.path.join(landing, "a.csv"), header, [[1, "d", "m", "c", "n1", "s", "red"]])
    q = ingest_stream(spark, "dim_products", landing, out, checkpoint_location=ckpt)
    q.awaitTermination(120)
    assert read_tables(spark, out)["dim_products"].count() == 1
    _write(os.path.join(landing, "b.csv"), header, [[2, "d", "f", "c", "n2", "m", "blue"], [3, "d", "f", "c", "n3", "l", "red"]])
    q = ingest_stream(spark, "dim_products", landing, out, checkpoint_location=ckpt)
    q.awaitTermination(120)
    got = read_tables(spark, out)["dim_products"]
    assert sorted(r["product_sku"] for r in got.collect()) == [1, 2, 3]


def test_load_decimal_types(spark):
    t = make_tables(spark, fact_orders=[order(1, 2, price=Decimal("12.34"))])
    assert str(t["fact_orders"].schema["product_price"].dataType) == "DecimalType(10,2)"


def test_register_views_runs_sql(spark):
    from tillpoint.sources.views import register_views

    t = make_tables(spark, fact_orders=[order(1, 2, day=D(2021, 5, 1))],
                    dim_promotions=[dict(promotion_id=1, product_sku=2, start_date=D(2021, 5, 1), end_date=D(2021, 5, 2))])
    names = register_views(spark, t, as_of="2021-06-01")
    assert "customer_rfm" in names
    got = spark.sql("SELECT COUNT(*) AS n FROM fact_orders_with_promo WHERE is_promotion_active").first()["n"]
    assert got == 1
    assert spark.sql("SELECT recency FROM customer_rfm").first()["recency"] == 31


def test_cli_ingest_and_run(spark):
    from tillpoint.__main__ import main

    t = make_tables(spark, fact_orders=[order(1, 2, qty=3, day=D(2021, 5, 1)), order(2, 2, qty=1, day=D(2021, 6, 1))],
                    dim_products=[dict(product_sku=2, product_name="p", product_category="c")],
                    dim_customers=[dict(customer_id=1), dict(customer_id=2)])
    root = tempfile.mkdtemp(prefix="tp-cli-")
    prep.export_csv(t, os.path.join(root, "csv"), ["dim_products", "dim_customers", "fact_orders"])
    assert main(["ingest", os.path.join(root, "csv"), os.path.join(root, "tables")]) == 0
    assert main(["run", "q01_top_products", "q16_monthly_profit", "q19_churn_risk", "--tables",
                 os.path.join(root, "tables"), "--out", os.path.join(root, "out"), "--as-of", "2021-08-01"]) == 0
    top = spark.read.parquet(os.path.join(root, "out", "q01_top_products")).collect()
    assert [(r["product_name"], str(r["revenue"])) for r in top] == [("p", "40.00")]
    churn = spark.read.parquet(os.path.join(root, "out", "q19_churn_risk")).collect()
    assert sorted(r["customer_id"] for r in churn) == [2]  # customer 1 ordered 2021-06-01, within 90 days


def test_ingest_numbers_returns_like_serial(spark):
    root = tempfile.mkdtemp(prefix="tp-serial-")
    header = ["order_id", "product_sku", "return_quantity", "return_year", "return_month", "return_day", "returndate"]
    for batch, rows in enumerate([[[1, 7, 2, 2022, 3, 4, "2022-03-04 05:06:07"], [2, 7, 1, 2022, 1, 4, "2022-01-04 00:00:00"]],
                                  [[3, 8, 1, 2023, 1, 1, "2023-01-01 00:00:00"]]]):
        d = os.path.join(root, f"csv{batch}", "fact_returns.csv")
        os.makedirs(d)
        _write(os.path.join(d, "part-0.csv"), header, rows)
        prep.ingest(spark, os.path.join(root, f"csv{batch}"), os.path.join(root, "tables"), names=["fact_returns"])
    got = sorted((r["return_id"], r["order_id"]) for r in read_tables(spark, os.path.join(root, "tables"))["fact_returns"].collect())
    assert got == [(1, 2), (2, 1), (3, 3)]


def test_quoted_header_csv_ingest(spark):
    d = tempfile.mkdtemp(prefix="tp-quoted-")
    with open(os.path.join(d, "dim_promotions.csv"), "w") as fh:
        fh.write('"promotion_id","product_sku","start_date","end_date","discount_percentage","campaign_name"\n')
        fh.write('7,3,2022-01-05,2022-02-01,12.5,"spring sale"\n')
    with open(os.path.join(d, "dim_customers.csv"), "w") as fh:
        fh.write('"customer_id","customer_name","age_group","gender","region","channel","loyalty_score"\n')
        fh.write('5,"customer 5","26-35","female","asia","online",49\n')
    stored = prep.ingest(spark, d, os.path.join(d, "tables"), names=["dim_promotions", "dim_customers"])
    p = stored["dim_promotions"].first()
    assert (p["promotion_id"], p["start_date"], str(p["discount_percentage"]), p["campaign_name"]) == (
        7, D(2022, 1, 5), "12.5", "spring sale")
    assert str(stored["dim_customers"].first()["loyalty_score"]) == "49.0"


def test_date_range_prunes_year_folders(spark):
    from tillpoint.plans import products

    t = make_tables(spark, fact_orders=[order(1, 2, day=D(2021, 5, 1)), order(2, 3, day=D(2022, 5, 1))],
                    dim_products=[dict(product_sku=s, product_name=f"p{s}") for s in (2, 3, 4)])
    root = tempfile.mkdtemp(prefix="tp-prune-")
    prep.export_csv(t, os.path.join(root, "csv"), ["dim_products", "fact_orders"])
    stored = prep.ingest(spark, os.path.join(root, "csv"), os.path.join(root, "tables"), names=["dim_products", "fact_orders"])
    out = products.products_without_sales(stored, "2022-01-01", "2022-12-31")
    assert sorted(r["product_sku"] for r in out.collect()) == [2, 4]
    plan = out._jdf.queryExecution().executedPlan().toString()
    import re

    assert any("order_year" in f for f in re.findall(r"PartitionFilters: \[([^\]]*)\]", plan))


def test_ingest_by_uri_in_the_writing_of_r(spark):
    """Doubled quotes, NA, and a path that only Spark understands; ids go on between loads."""
    d = tempfile.mkdtemp(prefix="tp-uri-")
    with open(os.path.join(d, "dim_customers.csv"), "w") as fh:
        fh.write('"customer_id","customer_name","age_group","gender","region","channel","loyalty_score"\n')
        fh.write('5,"5"" pipe, long","26-35",NA,"asia","online",49\n')
    header = ["order_id", "product_sku", "return_quantity", "return_year", "return_month", "return_day", "returndate"]
    _write(os.path.join(d, "fact_returns.csv"), header, [[1, 7, 2, 2022, 3, 4, "2022-03-04 05:06:07"]])
    for _ in range(2):
        prep.ingest(spark, f"file://{d}", f"file://{d}/tables")
    stored = read_tables(spark, f"file://{d}/tables")
    customer = stored["dim_customers"].first()
    assert (customer["customer_name"], customer["gender"]) == ('5" pipe, long', None)
    assert sorted(r["return_id"] for r in stored["fact_returns"].collect()) == [1, 2]


def test_ingest_of_an_absent_named_table_fails(spark):
    d = tempfile.mkdtemp(prefix="tp-absent-")
    try:
        prep.ingest(spark, d, os.path.join(d, "tables"), names=["dim_customers"])
    except Exception as e:  # noqa: BLE001
        assert "dim_customers" in str(e)
    else:
        raise AssertionError("an absent table was skipped")


def test_stream_after_batch_keeps_all_rows(spark):
    root = tempfile.mkdtemp(prefix="tp-both-")
    t = make_tables(spark, fact_orders=[order(i, 2) for i in range(1, 6)])
    prep.export_csv(t, os.path.join(root, "csv"), ["fact_orders"])
    prep.ingest(spark, os.path.join(root, "csv"), os.path.join(root, "tables"), names=["fact_orders"])
    late = make_tables(spark, fact_orders=[order(9, 2)])
    prep.export_csv(late, os.path.join(root, "late"), ["fact_orders"])
    for _ in range(2):  # the second start finds nothing new
        ingest_stream(
            spark, "fact_orders", os.path.join(root, "late", "fact_orders.csv"), os.path.join(root, "tables")
        ).awaitTermination()
    stored = read_tables(spark, os.path.join(root, "tables"))["fact_orders"]
    assert sorted(r["order_id"] for r in stored.collect()) == [1, 2, 3, 4, 5, 9]
