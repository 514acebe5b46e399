"""Customer analyses: lifetime value, RFM scoring, churn, repeat rate, cohorts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillpoint.functions.measures import as_double, dated, month_start, net_sales, profit, revenue
from tillpoint.operators.selection import with_rank_of_few, with_tiles
from tillpoint.tables import Tables

DateLike = str | dt.date


def _date(d: DateLike | None) -> F.Column:
    return F.current_date() if d is None else F.lit(d).cast("date")


def customer_ltv(t: Tables) -> DataFrame:
    """q02: revenue per customer that has orders (and exists in dim_customers)."""
    per = t["fact_orders"].groupBy("customer_id").agg(F.sum(revenue()).alias("revenue"))
    return per.join(t["dim_customers"].select("customer_id"), "customer_id", "left_semi")


def customer_rfm(t: Tables, as_of: DateLike | None = None, n: int = 5) -> DataFrame:
    """v02: recency, frequency, monetary per customer, their NTILE(n) scores and
    ``100*r + 10*f + m`` (a low score is a good customer).

    Ties inside each NTILE are broken by customer_id. The three NTILEs are exact
    global tiles, found by selecting their ends (see operators.selection).
    """
    raw = t["fact_orders"].groupBy("customer_id").agg(
        F.max("order_date").alias("last_order_date"),
        F.count("order_id").alias("frequency"),
        F.sum(net_sales()).alias("monetary"),
    )
    scored = raw.select(
        "customer_id",
        F.datediff(_date(as_of), F.col("last_order_date")).alias("recency"),
        "frequency",
        "monetary",
    )
    order = {"r_score": F.col("recency"), "f_score": -F.col("frequency"), "m_score": -F.col("monetary")}
    scored = with_tiles(scored, "customer_id", order, n)
    return scored.select(
        "customer_id", "recency", "frequency", "monetary", "r_score", "f_score", "m_score",
        (F.col("r_score") * 100 + F.col("f_score") * 10 + F.col("m_score")).alias("rfm_score"),
    )


def rfm_rank(t: Tables, as_of: DateLike | None = None, k: int | None = 20, n: int = 5) -> DataFrame:
    """q06: the ``k`` best RFM scores with ``RANK() OVER (ORDER BY rfm_score)``.

    The first k rows in (rfm_score, customer_id) order contain every row ranked
    before them, so the rank computed inside that top-k equals the global rank;
    the top-k itself is a distributed TakeOrderedAndProject. ``k=None`` ranks every
    customer from the counts of the scores, of which there are at most n * n * n.
    """
    rfm = customer_rfm(t, as_of, n).select("customer_id", "rfm_score")
    if k is None:
        return with_rank_of_few(rfm, "rfm_score", "rfm_rank")
    top = rfm.orderBy(F.col("rfm_score").asc_nulls_last(), F.col("customer_id").asc_nulls_last()).limit(k)
    return top.withColumn("rfm_rank", F.rank().over(Window.orderBy(F.col("rfm_score").asc_nulls_last())))


def repeat_purchase_rate(t: Tables, start: DateLike | None = None, end: DateLike | None = None) -> DataFrame:
    """q10: customers with more than one order row / customers with orders
    (within ``[start, end]`` when given)."""
    per = dated(t["fact_orders"], start, end).groupBy("customer_id").agg(F.count(F.lit(1)).alias("order_count"))
    return per.agg(
        (
            as_double(F.sum(F.when(F.col("customer_id").isNotNull() & (F.col("order_count") > 1), 1).otherwise(0)))
            / F.nullif(F.count("customer_id"), F.lit(0))
        ).alias("repeat_rate")
    )


def churn_risk(t: Tables, as_of: DateLike | None = None, days: int = 90) -> DataFrame:
    """q19: customers whose last order is more than ``days`` before ``as_of``, or who never ordered."""
    last = t["fact_orders"].groupBy("customer_id").agg(F.max("order_date").alias("last_order_date"))
    c = t["dim_customers"].select("customer_id")
    out = c.join(last, "customer_id", "left")
    cutoff = F.date_sub(_date(as_of), days)
    return out.where((F.col("last_order_date") < cutoff) | F.col("last_order_date").isNull())


def top_customers_by_profit(t: Tables, k: int = 3) -> DataFrame:
    """q22: lifetime profit per customer (0 without orders), top ``k``."""
    per = t["fact_orders"].groupBy("customer_id").agg(F.sum(profit()).alias("lifetime_profit"))
    out = t["dim_customers"].select("customer_id").join(per, "customer_id", "left").select(
        "customer_id", F.coalesce(F.col("lifetime_profit"), F.lit(0)).alias("lifetime_profit")
    )
    return out.orderBy(F.col("lifetime_profit").desc_nulls_last(), F.col("customer_id").asc_nulls_last()).limit(k)


def customers_by_age_group(t: Tables) -> DataFrame:
    """q26: customers per age group."""
    return t["dim_customers"].groupBy("age_group").agg(F.count(F.lit(1)).alias("customers"))


def order_frequency(t: Tables) -> DataFrame:
    """q38: order rows per customer."""
    return t["fact_orders"].groupBy("customer_id").agg(F.count(F.lit(1)).alias("order_count"))


def single_order_customers(t: Tables, start: DateLike | None = None) -> DataFrame:
    """q40: customers with exactly one order row (since ``start`` when given)."""
    fo = dated(t["fact_orders"], start)
    return fo.groupBy("customer_id").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") == 1).select("customer_id")


def customer_cohort(t: Tables) -> DataFrame:
    """q42: first order month per customer."""
    out = t["fact_orders"].groupBy("customer_id").agg(F.min(month_start("order_date")).alias("cohort_month"))
    return out.orderBy(F.col("cohort_month").asc_nulls_last())


def cohort_retention(t: Tables) -> DataFrame:
    """q43: distinct customers by first-order month x order month.

    Distinct (customer, month) pairs by hash aggregation, and each customer's first
    month among them; a customer has no more rows than the calendar has months.
    """
    fo = t["fact_orders"].where(F.col("customer_id").isNotNull())
    months = fo.select("customer_id", month_start("order_date").alias("order_month")).distinct()
    months = months.where(F.col("order_month").isNotNull())
    cohort = F.min("order_month").over(Window.partitionBy("customer_id")).alias("cohort_month")
    out = months.select("order_month", cohort).groupBy("cohort_month", "order_month").agg(F.count(F.lit(1)).alias("customers"))
    return out.orderBy("cohort_month", "order_month")
