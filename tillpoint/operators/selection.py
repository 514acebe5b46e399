"""NTILE of several measures by selecting the rows at which tiles end, without sorting the table.

A tile's end is the row at a known place of the order (measure, id). It is found by counting: pivots
from a mergeable quantile sketch bracket the place, an exact count says how many rows lie below the
bracket, and the distinct values inside it, with their counts, give the value at the place and how
many of its ties belong before it. Ties are settled in the same way on their ids. The few ends are
then compared with every row. All of it is one lazy plan of partial aggregations: no row moves for
its place in the order, equal values are one row after the map side, and nothing runs while the query
is planned.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Steps of the grid of pivots. A bracket is SLACK steps wide to either side of the place, far more
#: than the sketch's error of one part in ACCURACY; the rows inside it are about 4 / GRID of all.
GRID, SLACK, ACCURACY = 1000, 2, 10_000
_VALUE, _ID = "decimal(38,10)", "decimal(38,0)"
_LAST_VALUE, _LAST_ID = Decimal("9" * 28), Decimal("9" * 38)


def _grid(of: Column) -> Column:
    steps = F.expr("array(" + ", ".join(f"{i / GRID}D" for i in range(GRID + 1)) + ")")
    return F.percentile_approx(of.cast("double"), steps, ACCURACY)


def _bracket(grid: str, place: Column, of: Column, margin: int) -> list[Column]:
    """Pivots below and above a place (1-based) among ``of`` rows; null where the grid ends."""
    low = F.floor((place - margin) * GRID / of).cast("int") - SLACK
    high = F.ceil((place + margin) * GRID / of).cast("int") + SLACK
    at = lambda i: F.when((i > 0) & (i < GRID), F.get(F.col(grid), i))
    return [at(low).alias("low"), at(high).alias("high")]


def _settled(rows: DataFrame, keys: list[str], of: str, ends: DataFrame, place: str) -> DataFrame:
    """For every row of ``ends`` (``keys``, ``low``, ``high``, ``place``): the value ``of`` at the place, the
    place among its ties and their number, from ``rows`` that hold ``keys`` and ``of``."""
    # ends: a handful of rows for each measure, fixed by the number of tiles
    near = rows.join(F.broadcast(ends), keys)
    double = F.col(of).cast("double")
    near = near.where(F.col("high").isNull() | (double <= F.col("high")))
    below = F.col("low").isNotNull() & (double < F.col("low"))
    group = ["m", "cut"]
    counted = near.groupBy(*group, place, F.when(~below, F.col(of)).alias("found")).agg(F.count("*").alias("ties"))
    upto = F.sum("ties").over(Window.partitionBy(*group).orderBy(F.col("found").asc_nulls_first()))
    counted = counted.withColumn("upto", upto)
    hit = (F.col("upto") >= F.col(place)) & (F.col("upto") - F.col("ties") < F.col(place)) & F.col("found").isNotNull()
    return counted.where(hit).select(*group, "found", (F.col(place) - F.col("upto") + F.col("ties")).alias("rest"), "ties")


def _ends_before(measure: int, value: Column, rank_id: Column):
    """Whether a tile of the measure ends before a row of this value and id."""
    return lambda e: (e["m"] == measure) & ((value > e["value"]) | ((value == e["value"]) & (rank_id > e["id"])))


def with_tiles(df: DataFrame, id_col: str, measures: dict[str, Column], tiles: int = 5) -> DataFrame:
    """``df`` with ``NTILE(tiles) OVER (ORDER BY measure, id)`` for each name in ``measures``.

    Measures are numeric, ascending (negate one to descend), ids numeric; nulls of both come last. As in
    SQL, the first ``rows % tiles`` tiles hold one row more. ``df`` should be cheap to read again: its
    aggregates are the plan's shuffles, and Spark reuses a shuffle that several of them share.
    """
    value = {n: F.coalesce(c.cast(_VALUE), F.lit(_LAST_VALUE).cast(_VALUE)) for n, c in measures.items()}
    rank_id = F.coalesce(F.col(id_col).cast(_ID), F.lit(_LAST_ID).cast(_ID))
    entries = [F.struct(F.lit(i).alias("m"), v.alias("value")) for i, v in enumerate(value.values())]
    long = df.select(rank_id.alias("id"), F.explode(F.array(*entries)).alias("e")).select("id", "e.*")
    n = F.col("n")
    cut = F.explode(F.sequence(F.lit(1), F.lit(tiles - 1))).alias("cut")
    sized = long.groupBy("m").agg(F.count("*").alias("n"), _grid(F.col("value")).alias("grid")).select("*", cut)
    place = F.col("cut") * F.floor(n / tiles) + F.least(F.col("cut").cast("long"), n % tiles)
    sized = sized.withColumn("place", place)
    ends = sized.select("m", "cut", "place", *_bracket("grid", F.col("place"), n, tiles))
    values = _settled(long, ["m"], "value", ends, "place").withColumnRenamed("found", "value")
    tied = long.join(F.broadcast(values), ["m", "value"])
    spread = tied.groupBy("m", "cut", "value", "rest", "ties").agg(_grid(F.col("id")).alias("grid"))
    ends = spread.select("m", "cut", "value", "rest", *_bracket("grid", F.col("rest"), F.col("ties"), 1))
    ids = _settled(long, ["m", "value"], "id", ends, "rest")
    known = values.select("m", "cut", "value").join(F.broadcast(ids.select("m", "cut", F.col("found").alias("id"))), ["m", "cut"])
    last = known.agg(F.collect_list(F.struct("m", "value", "id"))).scalar()
    out = df.withColumn("_ends", last)
    for i, (name, v) in enumerate(value.items()):
        out = out.withColumn(name, (F.size(F.filter("_ends", _ends_before(i, v, rank_id))) + 1).cast("int"))
    return out.drop("_ends")


def with_rank_of_few(df: DataFrame, value: str, name: str = "rank") -> DataFrame:
    """``RANK() OVER (ORDER BY value NULLS LAST)`` where ``value`` has few distinct values (a bounded
    score): their counts, running over the distinct values, are looked up in one map."""
    counts = df.groupBy(value).agg(F.count("*").alias("rows"))
    before = F.sum("rows").over(Window.orderBy(F.col(value).asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1))
    ranks = counts.select(value, (F.coalesce(before, F.lit(0)) + 1).alias("rank"))
    known = ranks.where(F.col(value).isNotNull()).agg(F.map_from_entries(F.collect_list(F.struct(value, "rank")))).scalar()
    # nulls stand behind all rows that have a value
    valued = df.agg(F.count(value) + 1).scalar()
    looked_up = F.coalesce(F.try_element_at(F.col("_ranks"), F.col(value)), F.col("_valued"))
    return df.withColumn("_ranks", known).withColumn("_valued", valued).withColumn(name, looked_up).drop("_ranks", "_valued")
