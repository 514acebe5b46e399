"""Preparation jobs: calendar, derived columns, surrogate keys, enrichment, ingest."""

from __future__ import annotations

import datetime as dt
import os
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillpoint.operators.ranking import with_row_number
from tillpoint.schemas import LOAD_ORDER, SPECS
from tillpoint.sources.files import load_table, path_exists, read_table, scan_table, write_csv
from tillpoint.tables import Tables

DateLike = str | dt.date


def calendar_between(bounds: DataFrame, holidays: DataFrame | None = None) -> DataFrame:
    """One row per day from ``bounds.start`` to ``bounds.end`` (a one-row frame):
    date, year, month, quarter, weekday name, is_holiday (from ``holidays.date``)."""
    days = bounds.select(F.explode(F.sequence("start", "end", F.expr("interval 1 day"))).alias("date"))
    cal = days.select(
        "date",
        F.year("date").alias("year"),
        F.month("date").alias("month"),
        F.quarter("date").alias("quarter"),
        F.date_format("date", "EEEE").alias("weekday"),
    )
    if holidays is None:
        return cal.withColumn("is_holiday", F.lit(False))
    # Holiday lists are small in practice; the join strategy is left to AQE's size check.
    h = holidays.select(F.col("date").cast("date").alias("date")).distinct().withColumn("_h", F.lit(True))
    return cal.join(h, "date", "left").withColumn("is_holiday", F.coalesce(F.col("_h"), F.lit(False))).drop("_h")


def build_calendar(
    spark: SparkSession, start: DateLike, end: DateLike, holidays: DataFrame | None = None
) -> DataFrame:
    """p01 with fixed bounds."""
    bounds = spark.range(1).select(F.lit(start).cast("date").alias("start"), F.lit(end).cast("date").alias("end"))
    return calendar_between(bounds, holidays)


def order_calendar(t: Tables, holidays: DataFrame | None = None) -> DataFrame:
    """p01: the calendar spanning the first to the last order date of the facts."""
    bounds = t["fact_orders"].agg(F.min("order_date").alias("start"), F.max("order_date").alias("end"))
    return calendar_between(bounds, holidays)


def with_discount(df: DataFrame, rate: float | Column = 0.1, name: str = "product_discount") -> DataFrame:
    """p02: discount amount = round(price * quantity * rate, 2), in exact decimal."""
    r = rate if isinstance(rate, Column) else F.lit(Decimal(str(rate)))
    return df.withColumn(name, F.round(F.col("product_price") * F.col("order_quantity") * r, 2))


def repair_promo_dates(df: DataFrame, days: int | Column = 30) -> DataFrame:
    """p03: a promotion ending before it starts ends ``days`` after its start instead."""
    d = days if isinstance(days, Column) else F.lit(days)
    fixed = F.when(F.col("end_date") < F.col("start_date"), F.date_add("start_date", d)).otherwise(F.col("end_date"))
    return df.withColumn("end_date", fixed)


def derive_delivery_dates(df: DataFrame, lag: str = "ship_lag_days", duration: str = "delivery_duration") -> DataFrame:
    """p04: ship_date = order_date + lag days; delivery_date = ship_date + duration days."""
    ship = F.date_add("order_date", F.col(lag))
    return df.withColumn("ship_date", ship).withColumn("delivery_date", F.date_add("ship_date", F.col(duration)))


def return_timestamp(df: DataFrame) -> DataFrame:
    """p05: returndate from year, month, day, hour, minute, second (UTC wall time)."""
    return df.withColumn(
        "returndate",
        F.make_timestamp_ntz(
            F.col("return_year"), F.col("return_month"), F.col("return_day"),
            F.col("hour"), F.col("minute"), F.col("second").cast("decimal(8,6)"),
        ),
    )


def with_return_id(df: DataFrame) -> DataFrame:
    """p06: surrogate key 1..n in (returndate, order_id, product_sku, return_quantity) order,
    numbered across partitions (operators.ranking)."""
    order = [
        F.col("returndate").asc_nulls_last(), F.col("order_id").asc_nulls_last(),
        F.col("product_sku").asc_nulls_last(), F.col("return_quantity").asc_nulls_last(),
    ]
    out = with_row_number(df, order, "return_id")
    return out.select("return_id", *[c for c in df.columns if c != "return_id"])


def enrich_returns(returns: DataFrame, orders: DataFrame) -> DataFrame:
    """p07: fetch the SKU of returns that know only their order, and keep the seven stored
    columns; quantities stay as they are. An order of several rows gives its least SKU, so the
    join is many-to-one and cannot multiply returns; a SKU that is there already is kept."""
    o = orders.groupBy("order_id").agg(F.min("product_sku").alias("_sku"))
    own = F.col("product_sku") if "product_sku" in returns.columns else F.lit(None)
    j = returns.join(o, "order_id", "left")
    return j.select(
        "order_id",
        F.coalesce(own, F.col("_sku")).alias("product_sku"),
        F.col("return_quantity").cast("int").alias("return_quantity"),
        "return_year",
        "return_month",
        "return_day",
        "returndate",
    )


def ingest(
    spark: SparkSession,
    csv_dir: str,
    out_dir: str,
    *,
    names: list[str] | None = None,
    schemas: dict[str, T.StructType] | None = None,
) -> Tables:
    """p08: read each table's CSV with its schema and append it to a typed Parquet
    table, parents before children. A table named in ``names`` must be there; without names, the tables
    whose CSV is there are loaded. ``schemas`` overrides the declared types
    (the test binding uses long ids and wider decimals)."""
    wanted = names or [s.name for s in LOAD_ORDER]
    for spec in LOAD_ORDER:
        path = os.path.join(csv_dir, f"{spec.name}.csv")
        if spec.name not in wanted or (names is None and not path_exists(spark, path)):
            continue
        df = read_table(spark, spec, csv_dir, schema=(schemas or {}).get(spec.name))
        if spec.name == "fact_returns" and "return_id" not in spark.read.option("header", True).csv(path).columns:
            df = _serial_return_ids(spark, df, os.path.join(out_dir, spec.name))
        load_table(df, spec, out_dir, mode="append", typed=schemas is None or spec.name not in schemas)
    return Tables({n: (lambda n=n: scan_table(spark, n, out_dir)) for n in wanted if n in SPECS})


def _serial_return_ids(spark: SparkSession, df: DataFrame, existing: str) -> DataFrame:
    """Assign return_id like a SERIAL column: 1, 2, ... after the largest id already stored."""
    start = 0
    if path_exists(spark, existing):
        start = spark.read.parquet(existing).agg(F.max("return_id")).first()[0] or 0
    numbered = with_return_id(df.drop("return_id"))
    return numbered.withColumn("return_id", F.col("return_id") + F.lit(int(start)))


def export_csv(t: Tables, csv_dir: str, names: list[str], compression: str = "none") -> dict[str, T.StructType]:
    """S2: write tables as CSV folders ``<csv_dir>/<name>.csv``; returns their schemas."""
    schemas = {}
    for n in names:
        write_csv(t[n], os.path.join(csv_dir, f"{n}.csv"), compression=compression)
        schemas[n] = t[n].schema
    return schemas
