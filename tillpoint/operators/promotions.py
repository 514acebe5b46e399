"""Promotion coverage: is a (SKU, day) inside some promotion of that SKU?

The source tests each order row with ``EXISTS (promotion of the same SKU whose
[start_date, end_date] contains the order date)``. Run directly on the fact
table, that join is keyed on SKU only, so one best-selling SKU would land in a
single task. The analyses therefore first reduce the facts to one row per
(SKU, day) with map-side partial aggregation, test coverage on those keys (a SKU
has at most one key per calendar day, whatever the fact volume), and join the
flag back on (SKU, day) only where row-level output is wanted. The promotions are
reduced the same way (see ``coverage``), so neither side of the range join can hold
an unbounded number of rows for one SKU.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def coverage(promotions: DataFrame) -> DataFrame:
    """The promotions reduced to what coverage depends on: per (SKU, start day) the
    latest end. Partial aggregation bounds a SKU's rows by the number of calendar
    days, however many promotions it has."""
    return promotions.groupBy("product_sku", "start_date").agg(F.max("end_date").alias("end_date"))


def covered_intervals(promotions: DataFrame) -> DataFrame:
    """The days covered by each SKU's promotions as disjoint [start_date, end_date]
    intervals (overlapping promotions merged; adjacent ones may stay apart).

    Gaps and islands over ``coverage``: a window per SKU, ordered by start, marks a
    new island where a start lies after every earlier end. A SKU has at most one row
    per calendar day here, so each window partition is bounded by the calendar.
    Promotions with a missing bound or ending before they start cover no day (as
    BETWEEN gives) and are left out."""
    c = coverage(promotions).where(
        F.col("start_date").isNotNull() & F.col("end_date").isNotNull() & (F.col("end_date") >= F.col("start_date"))
    )
    by_sku = Window.partitionBy("product_sku").orderBy("start_date")
    earlier_end = F.max("end_date").over(by_sku.rowsBetween(Window.unboundedPreceding, -1))
    starts = c.withColumn("_new", F.when(earlier_end.isNull() | (F.col("start_date") > earlier_end), 1).otherwise(0))
    islands = starts.withColumn("_island", F.sum("_new").over(by_sku.rowsBetween(Window.unboundedPreceding, 0)))
    return islands.groupBy("product_sku", "_island").agg(
        F.min("start_date").alias("start_date"), F.max("end_date").alias("end_date")
    ).drop("_island")


def flag_rows(
    rows: DataFrame,
    promotions: DataFrame,
    *,
    sku: str = "product_sku",
    day: str = "order_date",
    flag: str = "is_promotion_active",
) -> DataFrame:
    """Add ``flag`` to every row in one pass over ``rows``.

    The disjoint covered intervals are cut into month pieces, and rows join them on
    (SKU, month of the day) with the date range as residual. A day lies in at most
    one interval, and an interval has one piece per month, so each row matches at
    most once and is never repeated. Keying on the month as well spreads a hot SKU's
    rows over every month it sells in, instead of one task per SKU; both sides reach
    the join through their own shuffle, so AQE can split what skew remains. The merge
    hint keeps it so: Spark's estimate of the pieces leaves out how often months repeat
    an interval, and broadcasting them would pass all of them through the driver."""
    iv = covered_intervals(promotions)
    pieces = iv.select(
        F.col("product_sku").alias("_iv_sku"),
        F.col("start_date").alias("_iv_start"),
        F.col("end_date").alias("_iv_end"),
        F.explode(
            F.sequence(F.trunc("start_date", "MM"), F.trunc("end_date", "MM"), F.expr("interval 1 month"))
        ).alias("_iv_month"),
    )
    pieces = pieces.hint("merge")
    keyed = rows.withColumn("_row_month", F.trunc(F.col(day), "MM"))
    cond = (
        (keyed[sku] == pieces["_iv_sku"])
        & (keyed["_row_month"] == pieces["_iv_month"])
        & keyed[day].between(pieces["_iv_start"], pieces["_iv_end"])
    )
    return keyed.join(pieces, cond, "left").select(*rows.columns, F.col("_iv_start").isNotNull().alias(flag))


def promotion_active(promotions: DataFrame, keys_alias: str, sku: str = "product_sku", day: str = "order_date"):
    """Correlated EXISTS column for rows of a frame aliased ``keys_alias``."""
    p = coverage(promotions).alias("_promo")
    return p.where(
        (F.col("_promo.product_sku") == F.col(f"{keys_alias}.{sku}").outer())
        & F.col(f"{keys_alias}.{day}").outer().between(F.col("_promo.start_date"), F.col("_promo.end_date"))
    ).exists()


def flag_days(
    keys: DataFrame,
    promotions: DataFrame,
    *,
    sku: str = "product_sku",
    day: str = "order_date",
    flag: str = "is_promotion_active",
) -> DataFrame:
    """Add ``flag`` to a frame with one row per (sku, day)."""
    return keys.alias("_keys").withColumn(flag, promotion_active(promotions, "_keys", sku, day))


def matching_promotions(
    keys: DataFrame, promotions: DataFrame, *, sku: str = "product_sku", day: str = "order_date",
    by: list[str] | None = None,
) -> DataFrame:
    """(key row, promotion group) pairs whose range covers the day, with ``promotions``
    = how many promotions of the group do. Promotions identical in SKU, range and the
    ``by`` columns are one row with their count; each is cut into its months and joined
    on (SKU, month) with the range as residual, so a pair is found in one month only and
    a SKU with many promotions spreads over its months. The merge hint keeps the months'
    rows, whose number Spark's estimate leaves out, from being broadcast by way of the driver."""
    by = by or []
    p = promotions.where("start_date <= end_date").groupBy("product_sku", "start_date", "end_date", *by).agg(
        F.count(F.lit(1)).alias("promotions")
    )
    p = p.withColumn(
        "_promo_month",
        F.explode(F.sequence(F.trunc("start_date", "MM"), F.trunc("end_date", "MM"), F.expr("interval 1 month"))),
    ).withColumnRenamed("product_sku", "_promo_sku").hint("merge")
    cond = (
        (keys[sku] == p["_promo_sku"])
        & (F.trunc(keys[day], "MM") == p["_promo_month"])
        & keys[day].between(p["start_date"], p["end_date"])
    )
    return keys.join(p, cond, "inner").drop("_promo_sku", "_promo_month")
