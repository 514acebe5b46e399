"""Tiles by selection and ranks of few values equal their window definitions."""

from __future__ import annotations

import random
from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tillpoint.operators.selection import with_rank_of_few, with_tiles


def table(spark, n, seed):
    """Measures without ties, with a few values, and with one value held by most rows; nulls in all."""
    rng = random.Random(seed)
    ids = rng.sample(range(10 * n + 1), n)
    rows = [
        (
            i,
            None if rng.random() < 0.02 else Decimal(rng.randrange(10**9)) / 100,
            None if rng.random() < 0.02 else rng.randrange(4),
            1 if rng.random() < 0.7 else rng.randrange(50),
        )
        for i in ids
    ]
    if n > 5:
        rows[0] = (None, *rows[0][1:])
    return spark.createDataFrame(rows, "id long, money decimal(12,2), few int, hot int").repartition(3)


@pytest.mark.parametrize("n,tiles", [(1, 5), (3, 5), (7, 5), (14, 4), (100, 7), (997, 5), (6000, 13), (20000, 5)])
def test_tiles_equal_ntile(spark, n, tiles):
    df = table(spark, n, n)
    got = with_tiles(df, "id", {"a": -F.col("money"), "b": F.col("few"), "c": -F.col("hot")}, tiles)
    by_id = F.col("id").asc_nulls_last()
    orders = {"a": F.col("money").desc_nulls_last(), "b": F.col("few").asc_nulls_last(), "c": F.col("hot").desc_nulls_last()}
    want = df
    for name, order in orders.items():
        want = want.withColumn(name, F.ntile(tiles).over(Window.orderBy(order, by_id)))
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_tiles_of_an_empty_table(spark):
    assert with_tiles(table(spark, 7, 1).limit(0), "id", {"a": F.col("few")}).collect() == []


def test_tiles_start_no_job_and_sort_no_rows(spark):
    df = table(spark, 500, 2)
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("tiles-plan", "planning")
    got = with_tiles(df, "id", {"a": -F.col("money"), "b": F.col("few")})
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert not tracker.getJobIdsForGroup("tiles-plan")
    spark.sparkContext.setJobGroup("rest", "")
    assert "rangepartitioning" not in plan


def test_rank_of_few_values(spark):
    df = table(spark, 800, 3)
    got = with_rank_of_few(df, "few")
    want = df.withColumn("rank", F.rank().over(Window.orderBy(F.col("few").asc_nulls_last())))
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert "Join" not in got._jdf.queryExecution().executedPlan().toString()
