"""Distributed operators equal their single-partition / brute-force definitions."""

from __future__ import annotations

import itertools
import random
from collections import Counter

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tillpoint.operators.baskets import holdings, item_counts, pair_bound, pair_counts, top_pairs, useful_items
from tillpoint.operators.ranking import with_ntile, with_rank, with_row_number


def _frame(spark, n, seed=7, distinct=5):
    rnd = random.Random(seed)
    data = [(i, rnd.randint(0, distinct)) for i in range(n)]
    return spark.createDataFrame(data, "id long, v long").repartition(3)


@pytest.mark.parametrize("n,tiles", [(3, 5), (7, 5), (100, 7), (1500, 13)])
def test_ntile_matches_window(spark, n, tiles):
    df = _frame(spark, n)
    order = [F.col("v").desc(), F.col("id").asc()]
    ours = with_ntile(df, order, tiles, "t", num_partitions=4)
    ref = df.withColumn("t", F.ntile(tiles).over(Window.orderBy(*order)))
    assert sorted(ours.select("id", "t").collect()) == sorted(ref.select("id", "t").collect())


def test_row_number_and_rank(spark):
    df = _frame(spark, 500, distinct=20)
    order = [F.col("v").asc(), F.col("id").asc()]
    rn = with_row_number(df, order, "rn", num_partitions=5)
    ref = df.withColumn("rn", F.row_number().over(Window.orderBy(*order)))
    assert sorted(rn.select("id", "rn").collect()) == sorted(ref.select("id", "rn").collect())
    rk = with_rank(df, "v", [F.col("id").asc()], "rk", num_partitions=5)
    ref_rk = df.withColumn("rk", F.rank().over(Window.orderBy("v")))
    assert sorted(rk.select("id", "rk").collect()) == sorted(ref_rk.select("id", "rk").collect())


def _brute_pairs(lines, min_freq):
    baskets = {}
    for b, i in lines:
        baskets.setdefault(b, set()).add(i)
    c = Counter()
    for items in baskets.values():
        for a, b in itertools.combinations(sorted(items), 2):
            c[(a, b)] += 1
    return sorted((a, b, n) for (a, b), n in c.items() if n >= min_freq)


@pytest.mark.parametrize("min_freq,block", [(1, 1000), (3, 1000), (4, 6), (2, 2), (6, 1)])
def test_pair_counts_match_brute_force(spark, min_freq, block):
    rnd = random.Random(3)
    lines = [(b, rnd.randint(1, 12)) for b in range(60) for _ in range(rnd.randint(1, 5))]
    # two oversized baskets
    lines += [(1000, i) for i in range(1, 13)] + [(1001, i) for i in range(1, 13, 2)]
    df = spark.createDataFrame(lines, "order_id long, product_sku long")
    got = sorted(tuple(r) for r in pair_counts(df, min_freq=min_freq, block=block).collect())
    assert got == _brute_pairs(lines, min_freq)


@pytest.mark.parametrize("k,min_freq,block,heads", [(20, 1, 1000, 256), (20, 3, 4, 8), (5, 2, 1, 3), (50, 4, 1000, 2), (3, 1, 2, 1)])
def test_top_pairs_match_brute_force(spark, k, min_freq, block, heads):
    rnd = random.Random(k)
    lines = [(b, min(int(rnd.expovariate(0.15)), 60)) for b in range(250) for _ in range(rnd.randint(1, 6))]
    lines += [(1000, i) for i in range(50)] + [(1000, 3), (None, 1), (5, None)]
    df = spark.createDataFrame(lines, "order_id long, product_sku long")
    got = [tuple(r) for r in top_pairs(df, k=k, min_freq=min_freq, block=block, heads=heads).collect()]
    whole = [(b, i) for b, i in lines if b is not None and i is not None]
    assert got == sorted(_brute_pairs(whole, min_freq), key=lambda p: (-p[2], p[0], p[1]))[:k]


def test_rising_bound_forms_fewer_pairs(spark):
    rnd = random.Random(11)
    lines = [(b, i) for b in range(400) for i in rnd.sample(range(6), 4)]  # few items in most baskets
    lines += [(b, 100 + rnd.randrange(300)) for b in range(400) for _ in range(8)]  # many items of some baskets each
    df = spark.createDataFrame(lines, "order_id long, product_sku long")
    held = holdings(df, "order_id", "product_sku")
    bound = pair_bound(held, k=10, min_freq=2, heads=32).first()["bound"]
    exact = sorted((n for *_, n in _brute_pairs(lines, 2)), reverse=True)[9]
    assert 100 < bound <= exact
    useful = {r["_i"] for r in useful_items(held, 10, 2, heads=32).collect()}
    by_least = {r["_i"] for r in item_counts(held).where("_n >= 2").collect()}
    formed = lambda items: sum(n for *_, n in _brute_pairs([x for x in lines if x[1] in items], 1))
    assert useful == set(range(6)) and formed(useful) * 10 < formed(by_least)


def test_top_pairs_of_nothing(spark):
    df = spark.createDataFrame([], "order_id long, product_sku string")
    assert top_pairs(df, k=3).count() == 0


def test_covered_intervals_flag_equals_exists(spark):
    import datetime as dt

    from tillpoint.operators.promotions import flag_rows

    rnd = random.Random(5)
    base = dt.date(2021, 1, 1)
    promos = []
    for pid in range(60):
        s = base + dt.timedelta(days=rnd.randint(0, 60))
        e = s + dt.timedelta(days=rnd.randint(-3, 12))  # some end before they start
        promos.append((pid, rnd.randint(1, 4), s, e))
    promos += [(100, 1, None, base), (101, 2, base, None)]
    days = [(i, rnd.randint(1, 5), base + dt.timedelta(days=rnd.randint(0, 80))) for i in range(300)]
    p = spark.createDataFrame(promos, "promotion_id int, product_sku int, start_date date, end_date date")
    rows = spark.createDataFrame(days, "row_id int, product_sku int, order_date date")
    got = sorted((r["row_id"], r["is_promotion_active"]) for r in flag_rows(rows, p).collect())
    want = sorted(
        (i, any(ps == sku and s is not None and e is not None and s <= d <= e for _, ps, s, e in promos))
        for i, sku, d in days
    )
    assert got == want


def test_ntile_arithmetic_exhaustive(spark):
    """NTILE from (row number, count) for every count 1..60 and tile count 1..12."""
    from tillpoint.operators.ranking import ntile_from_row_number

    def reference(n, tiles):
        q, r = divmod(n, tiles)
        out = []
        for tile in range(1, tiles + 1):
            out += [tile] * (q + (1 if tile <= r else 0))
        return out

    cases = [(n, k, rn) for n in range(1, 61) for k in range(1, 13) for rn in range(1, n + 1)]
    df = spark.createDataFrame(cases, "n long, k int, rn long")
    got = {}
    for k in range(1, 13):
        part = df.where(F.col("k") == k).select("n", "rn", ntile_from_row_number(F.col("rn"), F.col("n"), k).alias("t"))
        for r in part.collect():
            got[(r["n"], k, r["rn"])] = r["t"]
    for n in range(1, 61):
        for k in range(1, 13):
            assert [got[(n, k, rn)] for rn in range(1, n + 1)] == reference(n, k)


def test_rank_keeps_null_values(spark):
    from pyspark.sql import functions as F

    from tillpoint.operators.ranking import with_rank

    df = spark.createDataFrame([(1, None), (2, 5), (3, 5), (4, 9)], "id int, v int")
    got = {r["id"]: r["rank"] for r in with_rank(df, "v", [F.col("id").asc()]).collect()}
    assert got == {1: 1, 2: 2, 3: 2, 4: 4}


def test_pair_counting_starts_no_job_while_planned(spark):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("plan-pairs", "planning only")
    df = spark.createDataFrame([(1, 1), (1, 2)], "order_id int, product_sku int")
    pair_counts(df, min_freq=1, block=1)
    assert len(tracker.getJobIdsForGroup("plan-pairs")) == 0
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_large_quantities_do_not_overflow(spark):
    from tests.conftest import make_tables, order
    from tillpoint.plans import products

    t = make_tables(spark, fact_orders=[order(i, 1, qty=1) for i in range(1, 30)] + [order(99, 1, qty=2_000_000_000)])
    assert [r["order_id"] for r in products.quantity_outliers(t).collect()] == [99]
