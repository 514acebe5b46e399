"""Mixtures of sources by temperature: flattened token shares, realised as permuted blocks."""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillpoint.llm.tables import settled

#: Sources up to which the plan goes to every task and its sums are taken on the driver; beyond it the
#: sums are aggregates and the plan meets the rows in a shuffled join.
MOST_SOURCES = 20_000
#: Parts of a permuted source whose token totals are compared with the budget.
PARTS = 4_096
#: Equal rows that one task repeats where the budget ends among them.
COPIES = 10_000
SEED = 17
#: Exponents tried at once by the bisection, and its rounds: 16 ** 13 steps in [0, 1].
POINTS, ROUNDS = 15, 13


def entropy(weights: list[float]) -> float:
    return -sum(w * math.log(w) for w in weights if w > 0)


def bisect_exponent(good: Callable[[list[float]], list[bool]]) -> float:
    """The least exponent in [0, 1] that is good, if goodness only grows with it (1 if none is)."""
    low, high = 0.0, 1.0
    if good([0.0])[0]:
        return 0.0
    for _ in range(ROUNDS):
        tried = [low + (high - low) * k / (POINTS + 1) for k in range(1, POINTS + 1)]
        bad = sum(not g for g in good(tried))
        low, high = [low, *tried][bad], [*tried, high][bad]
    return high


@dataclass
class Totals:
    """What a plan must know of the sources that have tokens: how many, the least and the most tokens,
    and for exponents the sums of r and r * log(r), where r is (tokens / most) to the exponent."""

    sources: int
    least: int
    most: int
    sums: Callable[[list[float]], list[tuple[float, float]]]


@dataclass
class SourcePlan:
    source: str | None
    tokens: int
    weight: float
    repeats: float


@dataclass
class Mixture:
    """Weights and repeats as functions of a source's tokens."""

    exponent: float
    most: int
    norm: float
    budget: float

    def weight(self, tokens: int) -> float:
        return math.exp(self.exponent * math.log(tokens / self.most)) / self.norm if tokens > 0 else 0.0

    def of(self, source: str | None, tokens: int) -> SourcePlan:
        weight = self.weight(tokens)
        return SourcePlan(source, tokens, weight, self.budget * weight / tokens if tokens > 0 else 1.0)

    def planned(self, totals: DataFrame) -> DataFrame:
        """The plan of every source: its weight, its repeats, whole permutations (a remainder within
        rounding of one counts as whole) and the tokens of the last, cut one."""
        some = F.col("_total") > 0
        ratio = F.col("_total") / F.lit(float(max(self.most, 1)))
        weight = F.when(some, F.exp(F.lit(self.exponent) * F.log(ratio)) / F.lit(self.norm)).otherwise(0.0)
        repeats = F.when(some, F.lit(self.budget) * F.col("weight") / F.col("_total")).otherwise(1.0)
        over = F.col("_repeats") - F.col("_whole")
        return (
            totals.withColumn("weight", weight)
            .withColumn("_repeats", repeats)
            .withColumn("_whole", F.floor(F.col("_repeats") + 1e-9))
            .withColumn("_rest", F.when(over > 1e-9, F.round(over * F.col("_total"))).otherwise(0).cast("long"))
        )


def find_mixture(
    totals: Totals,
    target_entropy: float | None = None,
    max_repeats: float | None = None,
    budget: int | None = None,
) -> Mixture:
    """The exponent is the greatest at which the mixture's entropy reaches ``target_entropy`` (a share
    of the entropy of equal weights; natural shares if they reach it), or the least at which no
    source is shown more than ``max_repeats`` times, whichever is nearer to natural shares. With
    neither, shares stay natural. Without a ``budget`` it is the least that shows every text once.

    For exponents up to 1 the largest source needs the most tokens to be shown once and the smallest
    is repeated most, so sums over the sources and these two decide.
    """
    if totals.sources == 0:
        return Mixture(1.0, 0, 1.0, float(budget or 0))

    def tokens_shown(norm: float) -> float:
        return float(budget) if budget else totals.most * norm

    def even(exponents: list[float]) -> list[bool]:
        goal = target_entropy * math.log(totals.sources)
        return [math.log(z) - e / z >= goal for z, e in totals.sums([1.0 - x for x in exponents])]

    def rare(exponents: list[float]) -> list[bool]:
        small = [math.exp(a * math.log(totals.least / totals.most)) / totals.least for a in exponents]
        return [tokens_shown(z) * s / z <= max_repeats for s, (z, _) in zip(small, totals.sums(exponents), strict=True)]

    exponent = 1.0
    if target_entropy is not None:
        exponent = 1.0 - bisect_exponent(even)
    if max_repeats is not None:
        limit = bisect_exponent(rare)
        exponent = max(exponent, limit) if target_entropy is not None else limit
    norm = totals.sums([exponent])[0][0]
    return Mixture(exponent, totals.most, norm, tokens_shown(norm))


def listed_totals(tokens: list[int]) -> Totals:
    """Totals of sources that the driver holds."""
    some = sorted(n for n in tokens if n > 0)
    most = max(some, default=0)
    logs = [math.log(n / most) for n in some]

    def sums(exponents: list[float]) -> list[tuple[float, float]]:
        found = []
        for a in exponents:
            raised = [math.exp(a * x) for x in logs]
            found.append((math.fsum(raised), math.fsum(r * a * x for r, x in zip(raised, logs, strict=True))))
        return found

    return Totals(len(some), min(some, default=0), most, sums)


def gathered_totals(totals: DataFrame) -> Totals:
    """Totals of any number of sources (column ``_total``); only sums reach the driver."""
    some = totals.where("_total > 0")
    row = some.agg(F.count(F.lit(1)).alias("n"), F.min("_total").alias("a"), F.max("_total").alias("b")).first()

    def sums(exponents: list[float]) -> list[tuple[float, float]]:
        x = F.log(F.col("_total") / F.lit(float(row["b"])))
        pairs = [(F.sum(F.exp(F.lit(a) * x)), F.sum(F.exp(F.lit(a) * x) * F.lit(a) * x)) for a in exponents]
        found = some.agg(*[c.alias(f"s{i}") for i, c in enumerate(c for pair in pairs for c in pair)]).first()
        return [(found[2 * i], found[2 * i + 1]) for i in range(len(exponents))]

    return Totals(row["n"], row["a"] or 0, row["b"] or 0, sums)


def plan_mixture(
    totals: list[tuple[str | None, int]],
    target_entropy: float | None = None,
    max_repeats: float | None = None,
    budget: int | None = None,
) -> list[SourcePlan]:
    """Weights and repeats of the sources in ``totals``, by :func:`find_mixture`."""
    mixture = find_mixture(listed_totals([n for _, n in totals]), target_entropy, max_repeats, budget)
    return [mixture.of(s, n) for s, n in totals]


def words(text_col: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text_col), F.lit(r"\S+")), F.lit(0)).cast("long")


def _hashable(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return all(_hashable(f.dataType) for f in kind.fields)
    if isinstance(kind, T.ArrayType):
        return _hashable(kind.elementType)
    return not isinstance(kind, (T.MapType, T.VariantType))


def mix_sources(
    df: DataFrame,
    source_col: str = "source",
    id_col: str = "doc_id",
    text_col: str = "text",
    tokens: Column | None = None,
    target_entropy: float | None = None,
    max_repeats: float | None = None,
    budget: int | None = None,
    seed: int = SEED,
    broadcast_sources: int = MOST_SOURCES,
) -> DataFrame:
    """The rows of ``df``, repeated to the planned mixture, with ``epoch``, ``n_tokens``, ``weight``
    and ``mix_pos``.

    Each source is a row of blocks, one permutation of its texts for each epoch, the last cut where
    the source's token budget ends. ``mix_pos`` in [0, 1) is the place of a row in its source's
    blocks; sorted by it, all sources advance together at their weights. Without a ``budget`` the
    largest source is shown once and no text is left out.

    Tokens are counted into a written table of one narrow row each; only totals of sources, of
    ``PARTS`` hash ranges of each, and of the places in the range where the budget ends are shuffled.
    A text joins the plan where it lies, unless there are more than ``broadcast_sources`` sources.
    The cut is exact: it lies before the first text that does not fit. Equal rows share one place in a
    permutation, given by id and text alone, so further columns of the input move no text; rows that share
    both and differ in another column (maps aside) follow one another. Where the budget ends among equal
    rows, as many of them are shown as fit. Null sources are one source; texts without tokens
    are shown as often as their source is wholly repeated, once at least; null ids are ordinary; an empty
    table gives no rows; input columns with the names of the new ones are replaced.
    """
    kept = [f for f in df.schema.fields if f.name not in ("epoch", "n_tokens", "weight", "mix_pos")]
    further = [F.col(f"`{f.name}`") for f in kept if f.name not in (id_col, text_col) and _hashable(f.dataType)]
    base = df.select(
        F.struct(*[F.col(f"`{f.name}`") for f in kept]).alias("_row"),
        F.col(f"`{source_col}`").cast("string").alias("_source"),
        F.xxhash64(F.col(f"`{id_col}`"), F.col(f"`{text_col}`")).alias("_key"),
        F.xxhash64(*further).alias("_tie"),
        (tokens if tokens is not None else words(text_col)).alias("n_tokens"),
    )
    narrow = settled(base.drop("_row"), "mixing-sizes")
    totals = settled(narrow.groupBy(F.col("_source").alias("_s")).agg(F.sum("n_tokens").alias("_total")), "mixing-totals")
    found = totals.select("_total").limit(broadcast_sources + 1).collect()
    few = len(found) <= broadcast_sources
    known = listed_totals([r["_total"] for r in found]) if few else gathered_totals(totals)
    plan = find_mixture(known, target_entropy, max_repeats, budget).planned(totals)

    def place(epoch: Column) -> Column:
        return F.xxhash64(F.lit(seed), epoch, F.col("_key"))

    def joined(rows: DataFrame, by_source: DataFrame) -> DataFrame:
        return rows.join(F.broadcast(by_source) if few else by_source, F.col("_source").eqNullSafe(F.col("_s")))

    partial = joined(narrow, plan.where("_rest > 0")).withColumn("_place", place(F.col("_whole")))
    part = F.shiftrightunsigned("_place", 64 - PARTS.bit_length() + 1)
    partial = partial.withColumn("_part", F.when(part >= PARTS // 2, part - PARTS).otherwise(part))
    in_order = Window.partitionBy("_s").orderBy("_part").rowsBetween(Window.unboundedPreceding, 0)
    ends = (
        partial.groupBy("_s", "_rest", "_part")
        .agg(F.sum("n_tokens").alias("n"))
        .withColumn("_upto", F.sum("n").over(in_order))
        .where("_upto > _rest")
        .groupBy(F.col("_s").alias("_es"))
        .agg(F.min(F.struct("_part", (F.col("_upto") - F.col("n")).alias("before"))).alias("_end"))
    )
    at_end = F.col("_s").eqNullSafe(F.col("_es")) & (F.col("_part") == F.col("_end._part"))
    by_place = Window.partitionBy("_s").orderBy("_place", "_tie").rowsBetween(Window.unboundedPreceding, 0)
    cuts = (
        partial.join(F.broadcast(ends) if few else ends, at_end)
        .groupBy("_s", "_rest", "_place", "_tie")
        .agg(F.sum("n_tokens").alias("n"), F.count(F.lit(1)).alias("rows"), F.first("_end.before").alias("_before"))
        .withColumn("_upto", F.col("_before") + F.sum("n").over(by_place))
        .where("_upto > _rest")
        .withColumn("_fit", F.expr("(_rest - _upto + n) * rows div n"))
        .groupBy(F.col("_s").alias("_cs"))
        .agg(F.min(F.struct("_place", "_tie", "_fit")).alias("_cut"))
    )
    ends_at = settled(cuts.select("_cs", F.struct("_cut._place", "_cut._tie").alias("_cut"), F.col("_cut._fit").alias("_fit")), "mixing-cuts")
    whole = plan.join(F.broadcast(ends_at) if few else ends_at, F.col("_s").eqNullSafe(F.col("_cs")), "left")

    shown = joined(base, whole)
    last = F.struct(place(F.col("_whole")).alias("_place"), F.col("_tie"))
    takes = ((F.col("_rest") > 0) & (F.col("_cut").isNull() | (last < F.col("_cut")))).cast("long")
    times = F.when(F.col("_total") == 0, F.lit(1)).otherwise(F.col("_whole") + takes)
    epochs = F.when(times > 0, F.sequence(F.lit(0).cast("long"), times - 1))
    needed = ["_row", "_key", "n_tokens", "weight", "_repeats"]
    spread = shown.select(*needed, F.explode(epochs).alias("epoch"))
    if ends_at.where("_fit > 0").limit(1).count():  # the budget ends among equal rows: one of them stands for those that fit
        equal = joined(base, whole.where("_fit > 0")).where(last == F.col("_cut"))
        one = equal.groupBy("_s").agg(*[F.first(c).alias(c) for c in [*needed, "_fit", "_whole"]])
        pieces = one.withColumn("_piece", F.explode(F.sequence(F.lit(0).cast("long"), F.expr("(_fit - 1) div " + str(COPIES)))))
        size = F.least(F.col("_fit") - F.col("_piece") * COPIES, F.lit(COPIES))
        copies = pieces.repartition("_s", "_piece").withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), size)))
        spread = spread.unionByName(copies.select(*needed, F.col("_whole").alias("epoch")))
    at = place(F.col("epoch")).cast("double") / F.lit(2.0**64) + 0.5
    mix_pos = F.least((F.col("epoch") + at) / F.greatest(F.col("_repeats"), F.lit(1e-12)), F.lit(1.0 - 2.0**-53))
    return spread.select(
        "_row.*", F.col("epoch").cast("int").alias("epoch"), "n_tokens", "weight", mix_pos.alias("mix_pos")
    )


def mixture_report(documents: DataFrame, target_entropy: float = 0.9, max_repeats: float = 2.0) -> DataFrame:
    """The mixture of all documents in which small sources are shown up to twice."""
    mixed = mix_sources(documents, target_entropy=target_entropy, max_repeats=max_repeats)
    return mixed.select("doc_id", "source", "epoch", "n_tokens", "weight", "mix_pos")
