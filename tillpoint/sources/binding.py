"""Bind the driver's TPC-H-like test tables to the retail star schema.

The analyses only ever see retail tables. On the test data those are views over
``lineitem``, ``orders``, ``part``, ``supplier``, ``customer``, ``nation`` and
``region``; the same definitions are the CTE prefix of every oracle query
(``oracle/_binding.sql``), so both engines start from identical rows.

Facts are at line grain: one ``lineitem`` row is one order row, one shipment row
and, when ``l_returnflag = 'R'``, one return row. An ``order_id`` therefore has
several rows, which the analyses take into account where the source assumed one.

Scale notes:
* ``nation`` and ``region`` have a size fixed by the TPC-H specification (25 and 5
  rows), so they are broadcast explicitly.
* ``part`` and ``supplier`` grow with the data. They are joined through an aggregate
  on their primary key with a left join, which lets Catalyst drop the join entirely
  when no column of theirs is used (EliminateOuterJoin on a distinct key); when the
  column is used, the join strategy is left to AQE's size check.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillpoint.sources.files import stored_bytes
from tillpoint.tables import Tables

# How test attributes map onto retail attributes.
STATUS_BY_ORDERSTATUS = {"F": "on-time", "P": "delayed", "O": "returned"}
CHANNEL_BY_SUPPKEY_MOD3 = {0: "online", 1: "in-store", 2: "distributor"}
PROMO_EPOCH = dt.date(1995, 1, 1)
PROMO_START_SPREAD = 2000  # start = epoch + (partkey * 37) % spread + k * 20 days
PROMO_BASE_DAYS = 180  # end = start + 180 + partkey % 60 days
PROMO_SECOND_MIN_SIZE = 25  # parts with p_size above this get a second, overlapping promotion
COST_MULTIPLIER = 20


def _money(c) -> F.Column:
    return F.col(c).cast("decimal(12,2)") if isinstance(c, str) else c.cast("decimal(12,2)")


def _rate(c: str) -> F.Column:
    return F.col(c).cast("decimal(4,2)")


def _by_key(df: DataFrame, key: str, cols: list[str]) -> DataFrame:
    """One row per primary key: lets the optimizer prune an unused left join."""
    return df.groupBy(key).agg(*[F.max(c).alias(c) for c in cols])


# Column types of the driver's test tables (declared, so no file footer
# is read to infer them when a query is planned).
RAW_SCHEMAS = {
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "region": "r_regionkey int, r_name string",
}


#: Bytes of lineitem's files from which its rows are dealt by order into tasks of so many bytes each. AQE
#: joins partitions by their compressed bytes, and order keys compress to a small part of their rows.
DEALT_FROM, DEALT_BYTES = 128 << 20, 4 << 20


def dealt_by_order(lines: DataFrame, stored: int) -> DataFrame:
    """The order lines, from ``stored`` bytes of files, in as many tasks as these need; few bytes stay as they are."""
    return lines.repartition(-(-stored // DEALT_BYTES), "l_orderkey") if stored >= DEALT_FROM else lines


def bind(spark: SparkSession, sf_dir: str) -> Tables:
    sf_dir = sf_dir.rstrip("/")

    def lines() -> DataFrame:
        return dealt_by_order(raw("lineitem"), stored_bytes(spark, f"{sf_dir}/lineitem.parquet"))

    def raw(name: str) -> DataFrame:
        return spark.read.schema(RAW_SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")

    def geo() -> DataFrame:
        # nation ⋈ region: 25 rows by specification.
        return F.broadcast(
            raw("nation").join(F.broadcast(raw("region")), F.col("n_regionkey") == F.col("r_regionkey"))
            .select("n_nationkey", "n_name", "r_name")
        )

    def order_header() -> DataFrame:
        return raw("orders").select(
            "o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority",
            F.to_date("o_orderdate").alias("order_date"),
        )

    def fact_orders() -> DataFrame:
        li = lines()
        cost = _by_key(raw("part"), "p_partkey", ["p_retailprice"])
        return (
            li.join(order_header(), li["l_orderkey"] == F.col("o_orderkey"))
            .join(cost, li["l_partkey"] == cost["p_partkey"], "left")
            .select(
                F.col("l_orderkey").alias("order_id"),
                F.col("order_date"),
                F.col("l_suppkey").alias("retailer_id"),
                F.col("l_partkey").alias("product_sku"),
                _money("l_extendedprice").alias("product_price"),
                (_money("p_retailprice") * F.lit(COST_MULTIPLIER)).alias("product_cost"),
                F.col("l_quantity").cast("int").alias("order_quantity"),
                F.col("o_custkey").alias("customer_id"),
                (_money("l_extendedprice") * _rate("l_discount")).alias("product_discount"),
            )
        )

    def fact_shippings() -> DataFrame:
        li = lines()
        wh = _by_key(raw("supplier"), "s_suppkey", ["s_nationkey"])
        ship_date = F.to_date("l_shipdate")
        duration = F.abs(F.datediff(ship_date, F.col("order_date"))).cast("int")
        status = F.when(F.col("o_orderstatus") == "F", STATUS_BY_ORDERSTATUS["F"]).when(
            F.col("o_orderstatus") == "P", STATUS_BY_ORDERSTATUS["P"]
        ).when(F.col("o_orderstatus") == "O", STATUS_BY_ORDERSTATUS["O"])
        return (
            li.join(order_header(), li["l_orderkey"] == F.col("o_orderkey"))
            .join(wh, li["l_suppkey"] == wh["s_suppkey"], "left")
            .select(
                F.col("l_orderkey").alias("order_id"),
                F.col("order_date"),
                ship_date.alias("ship_date"),
                duration.alias("delivery_duration"),
                F.date_add(ship_date, duration).alias("delivery_date"),
                F.col("l_returnflag").alias("shipping_method"),
                F.col("o_orderpriority").alias("carrier"),
                (_money("l_extendedprice") * _rate("l_tax")).alias("shipping_cost"),
                status.alias("delivery_status"),
                F.col("s_nationkey").alias("warehouse_id"),
            )
        )

    def fact_returns() -> DataFrame:
        ts = F.col("l_shipdate")
        return raw("lineitem").where(F.col("l_returnflag") == "R").select(
            F.col("l_orderkey").alias("order_id"),
            F.col("l_partkey").alias("product_sku"),
            F.col("l_quantity").cast("int").alias("return_quantity"),
            F.year(ts).alias("return_year"),
            F.month(ts).alias("return_month"),
            F.dayofmonth(ts).alias("return_day"),
            ts.alias("returndate"),
        )

    def dim_products() -> DataFrame:
        return raw("part").select(
            F.col("p_partkey").alias("product_sku"),
            F.col("p_name").alias("product_full_description"),
            F.lit(None).cast("string").alias("product_gender"),
            F.col("p_type").alias("product_category"),
            F.col("p_name").alias("product_name"),
            F.col("p_size").cast("string").alias("product_size"),
            F.lit(None).cast("string").alias("product_color"),
        )

    def dim_customers() -> DataFrame:
        c = raw("customer")
        return c.join(geo(), c["c_nationkey"] == F.col("n_nationkey")).select(
            F.col("c_custkey").alias("customer_id"),
            F.col("c_name").alias("customer_name"),
            F.col("c_mktsegment").alias("age_group"),
            F.lit(None).cast("string").alias("gender"),
            F.col("r_name").alias("region"),
            F.lit(None).cast("string").alias("channel"),
            F.col("c_acctbal").cast("decimal(12,2)").alias("loyalty_score"),
        )

    def dim_retailers() -> DataFrame:
        s = raw("supplier")
        m = F.col("s_suppkey") % 3
        channel = F.when(m == 0, CHANNEL_BY_SUPPKEY_MOD3[0]).when(m == 1, CHANNEL_BY_SUPPKEY_MOD3[1]).otherwise(
            CHANNEL_BY_SUPPKEY_MOD3[2]
        )
        return s.join(geo(), s["s_nationkey"] == F.col("n_nationkey")).select(
            F.col("s_suppkey").alias("retailer_id"),
            channel.alias("retailer_channel"),
            F.col("s_name").alias("retailer_name"),
            F.col("n_name").alias("city"),
            F.col("r_name").alias("region"),
            F.lit(None).cast("string").alias("area"),
            F.col("n_name").alias("country"),
            F.col("s_acctbal").cast("decimal(12,2)").alias("distance_from_warehouse"),
        )

    def dim_warehouses() -> DataFrame:
        return geo().select(
            F.col("n_nationkey").alias("warehouse_id"),
            F.col("n_name").alias("warehouse_location"),
            F.col("r_name").alias("region"),
            F.lit(None).cast("int").alias("capacity"),
        )

    def dim_promotions() -> DataFrame:
        p = raw("part").select("p_partkey", "p_brand", "p_size")
        k = F.explode(
            F.when(F.col("p_size") > PROMO_SECOND_MIN_SIZE, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
        ).alias("k")
        start = F.date_add(
            F.lit(PROMO_EPOCH), ((F.col("p_partkey") * 37) % PROMO_START_SPREAD + F.col("k") * 20).cast("int")
        )
        return p.select("*", k).select(
            (F.col("p_partkey") * 10 + F.col("k")).alias("promotion_id"),
            F.col("p_partkey").alias("product_sku"),
            start.alias("start_date"),
            F.date_add(start, (F.lit(PROMO_BASE_DAYS) + F.col("p_partkey") % 60).cast("int")).alias("end_date"),
            (F.lit(5) + F.col("p_partkey") % 46).cast("decimal(10,1)").alias("discount_percentage"),
            F.col("p_brand").alias("campaign_name"),
        )

    def dim_date() -> DataFrame:
        from tillpoint.plans.prep import calendar_between

        # Bounds from the order headers alone: one column of the smaller table, no fact join.
        h = order_header()
        bounds = h.agg(F.min("order_date").alias("start"), F.max("order_date").alias("end"))
        return calendar_between(bounds)

    return Tables(
        {
            "fact_orders": fact_orders,
            "fact_shippings": fact_shippings,
            "fact_returns": fact_returns,
            "dim_products": dim_products,
            "dim_customers": dim_customers,
            "dim_retailers": dim_retailers,
            "dim_warehouses": dim_warehouses,
            "dim_promotions": dim_promotions,
            "dim_date": dim_date,
        }
    )
