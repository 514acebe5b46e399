"""Item pairs bought in the same basket, counted per pair.

A self-join on the basket id puts all pairs of a basket into one task. Each basket's items are
therefore dealt into blocks of about ``block`` items, and its rows go to every pair of blocks they
belong to: a cell of at most two blocks. An ordinary basket is one block and is not repeated; an
oversized one spreads over as many tasks as it has cells. The plan is the same for any data, and no
job runs while it is built.

Before that, items held by fewer than ``min_freq`` baskets are dropped (exact: a pair is never more
frequent than its rarer item). For the ``k`` most frequent pairs the bound rises: the pairs among the
``heads`` most frequent items are counted first, and no item held by fewer baskets than the k-th of
these pairs can be in the answer.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Most frequent items whose pairs are counted first, for a bound on the k-th pair.
HEADS = 256


def holdings(lines: DataFrame, basket: str, item: str) -> DataFrame:
    """Different (_b, _i): which basket holds which item."""
    held = lines.select(F.col(basket).alias("_b"), F.col(item).alias("_i"))
    return held.where("_b is not null and _i is not null").distinct()


def item_counts(held: DataFrame) -> DataFrame:
    """(_i, _n): baskets that hold the item."""
    return held.groupBy("_i").agg(F.count(F.lit(1)).alias("_n"))


def _all_pairs(held: DataFrame, block: int) -> DataFrame:
    """(item1, item2, freq) of all pairs of the holdings."""
    sizes = held.groupBy("_b").agg(F.ceil(F.count(F.lit(1)) / F.lit(block)).cast("int").alias("_blocks"))
    dealt = (
        held.join(sizes, "_b")
        .withColumn("_own", F.pmod(F.xxhash64("_i"), F.col("_blocks")).cast("int"))
        .withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
        .select("_b", "_i", "_own", F.least("_own", "_other").alias("_p"), F.greatest("_own", "_other").alias("_q"))
    )
    left = dealt.select("_b", "_p", "_q", F.col("_i").alias("item1"), F.col("_own").alias("_own1"))
    right = dealt.select("_b", "_p", "_q", F.col("_i").alias("item2"), F.col("_own").alias("_own2"))
    once = (F.col("_p") == F.col("_q")) | (F.col("_own1") != F.col("_own2"))
    pairs = left.join(right, ["_b", "_p", "_q"]).where((F.col("item1") < F.col("item2")) & once)
    return pairs.groupBy("item1", "item2").agg(F.count(F.lit(1)).alias("freq"))


def pair_counts(
    lines: DataFrame,
    basket: str = "order_id",
    item: str = "product_sku",
    *,
    min_freq: int = 1,
    block: int = 1000,
) -> DataFrame:
    """(item1, item2, freq): number of distinct baskets holding both, item1 < item2,
    for pairs with freq >= min_freq."""
    held = holdings(lines, basket, item)
    if min_freq > 1:
        held = held.join(item_counts(held).where(F.col("_n") >= min_freq), "_i", "left_semi")
    return _all_pairs(held, block).where(F.col("freq") >= min_freq)


def pair_bound(held: DataFrame, k: int, min_freq: int = 1, heads: int = HEADS) -> DataFrame:
    """One row, ``bound``: a frequency that the k-th most frequent pair reaches at least.

    It is the k-th best among pairs of the ``heads`` most frequent items (``min_freq`` where these form
    fewer than k). A basket's array holds at most ``heads`` items here, whatever its size.
    """
    top = item_counts(held).where(F.col("_n") >= min_freq).orderBy(F.col("_n").desc(), "_i").limit(heads)
    among = held.join(F.broadcast(top.select("_i")), "_i", "left_semi")
    groups = among.groupBy("_b").agg(F.sort_array(F.collect_list("_i")).alias("_items")).where(F.size("_items") > 1)
    first = groups.select("_items", F.posexplode("_items").alias("_at", "item1"))
    pairs = first.select("item1", F.explode(F.expr("slice(_items, _at + 2, size(_items))")).alias("item2"))
    counted = pairs.groupBy("item1", "item2").agg(F.count(F.lit(1)).alias("freq"))
    best = counted.orderBy(F.col("freq").desc()).limit(k)
    reached = F.when(F.count(F.lit(1)) >= k, F.min("freq"))
    return best.agg(F.greatest(F.coalesce(reached, F.lit(0)), F.lit(min_freq)).cast("long").alias("bound"))


def useful_items(held: DataFrame, k: int, min_freq: int = 1, heads: int = HEADS) -> DataFrame:
    """(_i, _n) of the items that can be in one of the ``k`` most frequent pairs."""
    return item_counts(held).where(F.col("_n") >= pair_bound(held, k, min_freq, heads).scalar())


def top_pairs(
    lines: DataFrame,
    basket: str = "order_id",
    item: str = "product_sku",
    *,
    k: int = 20,
    min_freq: int = 1,
    block: int = 1000,
    heads: int = HEADS,
) -> DataFrame:
    """The ``k`` pairs of :func:`pair_counts` of highest ``freq``, ties by the items."""
    held = holdings(lines, basket, item)
    kept = held.join(useful_items(held, k, min_freq, heads), "_i", "left_semi")
    pairs = _all_pairs(kept, block).where(F.col("freq") >= min_freq)
    return pairs.orderBy(F.col("freq").desc(), F.col("item1").asc(), F.col("item2").asc()).limit(k)
