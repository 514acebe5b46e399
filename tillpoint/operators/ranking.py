"""Exact global ordering functions without a single-partition window.

``ntile`` / ``row_number`` / ``rank`` over a whole table (``OVER (ORDER BY ...)``
with no PARTITION BY) make Spark move every row into one task. Here the rows are
range-partitioned on the sort key instead, each partition is sorted locally, and
the partition sizes (one small row per partition) give each partition its offset.
A row's global position is then ``offset + position within its partition``.

The range-partitioned, numbered rows are written with ``checkpoint()`` to the
cluster's reliable checkpoint folder before the sizes are counted, so the sizes
and the numbered rows come from the same materialised data even when a task is
retried or an executor is lost.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillpoint.session import ensure_checkpoint_dir

_PART, _MID, _FIRST, _OFF, _TOTAL, _N = "_tp_part", "_tp_mid", "_tp_first", "_tp_off", "_tp_total", "_tp_n"


def _partitions(df: DataFrame, num_partitions: int | None) -> int:
    if num_partitions:
        return num_partitions
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def with_row_number(
    df: DataFrame,
    order: list[Column],
    name: str = "row_number",
    *,
    total: str | None = None,
    num_partitions: int | None = None,
) -> DataFrame:
    """Add a 1-based row number over ``order`` (make ``order`` total for a stable result).

    ``total`` optionally names a column holding the table's row count.
    """
    ensure_checkpoint_dir(df.sparkSession)
    staged = (
        df.repartitionByRange(_partitions(df, num_partitions), *order)
        .sortWithinPartitions(*order)
        .withColumn(_PART, F.spark_partition_id())
        .withColumn(_MID, F.monotonically_increasing_id())
        .checkpoint(eager=True)
    )
    # One row per partition: bounded by the partition count, safe to broadcast.
    before = Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    offsets = (
        staged.groupBy(_PART)
        .agg(F.count(F.lit(1)).alias(_N), F.min(_MID).alias(_FIRST))
        .select(
            _PART,
            _FIRST,
            F.coalesce(F.sum(_N).over(before), F.lit(0)).alias(_OFF),
            F.sum(_N).over(everything).alias(_TOTAL),
        )
    )
    out = staged.join(F.broadcast(offsets), _PART).withColumn(
        name, (F.col(_OFF) + F.col(_MID) - F.col(_FIRST) + 1).cast("long")
    )
    if total:
        out = out.withColumnRenamed(_TOTAL, total)
    return out.drop(_PART, _MID, _FIRST, _OFF, _TOTAL)


def ntile_from_row_number(rn: Column, total: Column, tiles: int) -> Column:
    """NTILE(tiles) from a 1-based row number and the row count.

    The first ``total % tiles`` buckets hold one row more than the rest, as in SQL.
    """
    q = F.floor(total / F.lit(tiles)).cast("long")
    r = (total % F.lit(tiles)).cast("long")
    big = r * (q + 1)
    first = F.floor((rn - 1) / (q + 1)).cast("long") + 1
    rest = r + F.floor((rn - 1 - big) / F.when(q > 0, q)).cast("long") + 1
    return F.when(rn <= big, first).otherwise(rest).cast("int")


def with_ntile(
    df: DataFrame, order: list[Column], tiles: int, name: str, *, num_partitions: int | None = None
) -> DataFrame:
    """``NTILE(tiles) OVER (ORDER BY order)`` computed across partitions."""
    numbered = with_row_number(df, order, "_tp_rn", total="_tp_cnt", num_partitions=num_partitions)
    return numbered.withColumn(name, ntile_from_row_number(F.col("_tp_rn"), F.col("_tp_cnt"), tiles)).drop(
        "_tp_rn", "_tp_cnt"
    )


def with_rank(
    df: DataFrame, value: str, tie_break: list[Column], name: str = "rank", *, ascending: bool = True,
    num_partitions: int | None = None,
) -> DataFrame:
    """``RANK() OVER (ORDER BY value)``: 1 + the number of rows ordered strictly before.

    The first row number of each value is found by a grouped min (partial
    aggregation, so a value held by many rows costs one row per map task) and
    joined back on the value.
    """
    key = F.col(value).asc() if ascending else F.col(value).desc()
    numbered = with_row_number(df, [key, *tie_break], "_tp_rn", num_partitions=num_partitions)
    firsts = numbered.groupBy(F.col(value).alias("_tp_value")).agg(F.min("_tp_rn").alias(name))
    return numbered.join(firsts, F.col(value).eqNullSafe(F.col("_tp_value"))).drop("_tp_rn", "_tp_value")
