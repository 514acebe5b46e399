"""Merkle manifest of a table: a hash tree for each group of rows and one over the groups.

Digests are SHA-256. Inside the tables they are 32 bytes; what is hashed and returned is their
lowercase hex text. Every level of a tree is one equijoin of its nodes with the places of their
siblings, after which the nodes of slot zero emit the parents.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillpoint.llm.tables import settled
from tillpoint.session import ensure_checkpoint_dir

ARITY = 2
_NONE = bytearray()


def encode(value: Column) -> Column:
    """``-`` for null, else the count of UTF-8 bytes, ``:`` and the value as text."""
    text = value.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def _text(digests: Column) -> Column:
    """Hex text of one or more digests side by side."""
    return F.lower(F.hex(digests))


def _digest(content: Column) -> Column:
    return F.unhex(F.sha2(content.cast("binary"), 256))


def leaf_digest(values: Sequence[Column]) -> Column:
    """Digest of a row's values in the order given; their lengths keep them apart."""
    return _digest(F.concat(*[encode(v) for v in values]))


def _number(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """``rows`` (with a group ``g``, never null) with ``idx`` (from 0 within the group, in the order
    of the columns ``order``) and ``n`` (rows of the group).

    Rows go to range partitions, so that a group of any size is spread; equal rows are told apart by
    where they stood, so that those are spread too. The sorted partitions are written, which
    fixes them; a count for each partition and group gives the offsets.
    """
    ensure_checkpoint_dir(rows.sparkSession)
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = ["g", *order, "_stood"]
    placed = settled(
        rows.withColumn("_stood", F.monotonically_increasing_id())
        .repartitionByRange(parts, *keys)
        .sortWithinPartitions(*keys)
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_at", F.monotonically_increasing_id()),
        "merkle-rows",
    )
    held = placed.groupBy("g", "_part").agg(F.min("_at").alias("_first"), F.count("*").alias("_rows"))
    group = Window.partitionBy("g")
    before = group.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    held = held.select(
        "g", "_part", "_first", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"), F.sum("_rows").over(group).alias("n")
    )
    out = placed.join(held, ["g", "_part"]).withColumn("idx", F.col("_before") + F.col("_at") - F.col("_first"))
    return out.drop("_stood", "_part", "_at", "_first", "_before")


def _siblings(nodes: DataFrame, arity: int) -> DataFrame:
    """``nodes`` with the digests of their siblings to the left (``before``) and right (``after``).

    One equijoin on the computed place for each offset: in a binary tree the place with its last
    bit flipped, otherwise the slots that follow in turn within the run.
    """
    slot = F.pmod("idx", F.lit(arity))
    out = nodes
    for o in range(1, arity):
        if arity == 2:
            place = F.col("idx").bitwiseXOR(F.lit(1).cast("long"))
        else:  # the node whose sibling at this offset stands here
            place = F.col("idx") - slot + F.pmod(slot - o, F.lit(arity))
        shifted = nodes.select("g", place.alias("idx"), F.col("h").alias(f"_s{o}"))
        out = out.join(shifted, ["g", "idx"], "left")
    right = [F.when(slot + o < arity, F.coalesce(f"_s{o}", F.lit(_NONE))).otherwise(F.lit(_NONE)) for o in range(1, arity)]
    left = [F.when(slot + o >= arity, F.coalesce(f"_s{o}", F.lit(_NONE))).otherwise(F.lit(_NONE)) for o in range(1, arity)]
    out = out.withColumn("before", F.concat(*left)).withColumn("after", F.concat(*right))
    return out.drop(*[f"_s{o}" for o in range(1, arity)])


@dataclass
class Forest:
    """Trees over the nodes of each group.

    ``levels[k]``: nodes of level k (``g, idx, n, h, before, after``; level 0 with the columns of the
    rows). A group that is one node by then passes it on as it is. ``tops``: ``g, h`` for each group,
    the digest that remains.
    """

    levels: list[DataFrame]
    tops: DataFrame
    arity: int

    def proofs(self, seeds: DataFrame) -> DataFrame:
        """The rows of level 0 with ``proof`` (an array of the siblings' digests ``before`` and
        ``after`` for each level upwards) and all columns of ``seeds`` but ``g``.

        ``seeds`` has, for each group, its ``g`` and a ``proof`` of what lies above it. Every level
        takes its parents' proofs by one equijoin, from the top down, so a proof is never gathered
        from rows and no key holds more than a run of nodes.
        """
        given = [c for c in seeds.columns if c != "g"]
        above = seeds.withColumn("up", F.lit(0).cast("long"))
        own = F.concat(F.array(F.struct("before", "after")), F.col("proof"))
        for k in reversed(range(len(self.levels))):
            mine = self.levels[k].columns if k == 0 else ["g", F.col("idx").alias("up")]
            joined = self.levels[k].withColumn("up", F.floor(F.col("idx") / self.arity).cast("long")).join(above, ["g", "up"])
            more = [F.when(F.col("n") > 1, own).otherwise(F.col("proof")).alias(c) if c == "proof" else c for c in given]
            above = joined.select(*mine, *more) if k == 0 else joined.drop("up").select(*mine, *more)
            if k % 3 == 1:  # keeps the plan short; level 0, where most of the rows are, is not written
                above = settled(above, "merkle-proofs")
        return above


def grow(rows: DataFrame, order: Sequence[str], arity: int = ARITY) -> Forest:
    """Trees over the rows (``g``, ``h`` and others) of each group, in the order of ``order``.

    Every level is written to the shared scratch folder, where the next one reads it. The number of
    levels follows from the largest group.
    """
    nodes = _number(rows, order)
    most = nodes.agg(F.max("n")).first()[0] or 0
    parent = F.when(F.col("n") > 1, _digest(_text(F.concat("h", "after")))).otherwise(F.col("h"))
    levels = []
    while most > 1 or not levels:
        levels.append(settled(_siblings(nodes, arity), "merkle-level"))
        nodes = levels[-1].where(F.pmod("idx", F.lit(arity)) == 0).select(
            "g",
            F.floor(F.col("idx") / arity).cast("long").alias("idx"),
            F.ceil(F.col("n") / arity).cast("long").alias("n"),
            parent.alias("h"),
        )
        most = -(-most // arity)
    return Forest(levels, nodes.select("g", "h"), arity)


@dataclass
class Manifest:
    """``rows``: the given columns with ``leaf``, ``subroot`` (bytes) and ``proof`` (from the leaf to
    the root); ``root``: hex text of the whole table's digest, None for an empty one; ``subroots``:
    ``group_order`` and ``subroot`` of each group."""

    rows: DataFrame
    root: str | None
    subroots: DataFrame


def build_manifest(rows: DataFrame, group_col: str, order_col: str, leaf_col: str, arity: int = ARITY) -> Manifest:
    """Hash trees over ``leaf_col`` (32 bytes) of ``rows``: one for each value of ``group_col``, its
    leaves in ascending ``order_col``, and one over the groups' digests in ascending group.

    While a tree has several nodes, every ``arity`` consecutive ones become the digest of their hex
    texts side by side; the last run of a level may hold fewer, even one. Nulls of group and order
    come first and make a group or a place like any value. Rows of equal order are placed by their
    leaf; equal rows are leaves of their own with one digest. An empty table has no rows and no root.
    Columns of ``rows`` named like this module's own (``g idx n h before after up proof subroot``)
    must be renamed by the caller; the report below selects what it needs.
    """
    own = rows.withColumn("g", encode(F.col(group_col))).withColumnRenamed(leaf_col, "h")
    forest = grow(own, [order_col, "h"], arity)
    # One row for each group; its value is read back from the encoded group, whose order is not its own.
    label = F.when(F.col("g") != "-", F.expr("substring(g, length(substring_index(g, ':', 1)) + 2)"))
    ordered = rows.schema[group_col].dataType.simpleString() if group_col in rows.columns else "string"
    groups = forest.tops.select(
        F.lit("").alias("g"),
        label.cast(ordered).alias("group_order"),
        F.col("g").alias("member"),
        "h",
    )
    table = grow(groups, ["group_order", "member"], arity)
    top = table.tops.first()
    root = None if top is None else bytes(top["h"]).hex()
    nothing = F.array().cast("array<struct<before:binary,after:binary>>")
    above = table.proofs(table.tops.select("g", nothing.alias("proof")))
    seeds = above.select(F.col("member").alias("g"), "proof", F.col("h").alias("subroot"))
    out = forest.proofs(seeds).withColumnRenamed("h", leaf_col)
    return Manifest(
        out.select(*rows.columns, "subroot", "proof"), root, above.select("group_order", F.col("h").alias("subroot"))
    )


def proof_text(proof: Column) -> Column:
    """Hex text of all siblings of a proof, level by level, left to right."""
    return F.aggregate(proof, F.lit(""), lambda text, s: F.concat(text, _text(F.concat(s["before"], s["after"]))))


def fold(leaf: Column, proof: Column) -> Column:
    """Hex text of the root that a leaf (bytes) and its proof lead to."""
    return F.aggregate(
        proof,
        _text(leaf),
        lambda node, s: F.sha2(F.concat(_text(s["before"]), node, _text(s["after"])).cast("binary"), 256),
    )


def manifest_report(documents: DataFrame, arity: int = ARITY) -> DataFrame:
    """Leaf, subroot, root and proof of every document, and whether a tampered row is found out.

    A leaf is the digest of doc_id, source, lang, n_chars and text. Where 7 divides the crc32 of the
    decimal doc_id, one is added to n_chars after the manifest was made; ``folded_root`` is the root
    that the row as it is then and its proof lead to, ``verified`` whether it is the manifest's.

    Null values have an encoding of their own; a null n_chars stays null and a null doc_id is not
    tampered with. Equal documents are leaves of their own. Columns besides the five are not read,
    so their names cannot clash. An empty table gives no rows.
    """
    five = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")]
    more = F.col("n_chars").cast("decimal(38,0)") + F.lit(1).cast("decimal(38,0)")
    tampered = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0, F.lit(False))
    changed = [F.when(tampered, more).otherwise(c.cast("decimal(38,0)")) if i == 3 else c for i, c in enumerate(five)]
    rows = documents.select(
        "doc_id", "lang", leaf_digest(five).alias("leaf"), leaf_digest(changed).alias("leaf_now")
    )
    made = build_manifest(rows, "lang", "doc_id", "leaf", arity)
    folded = fold(F.col("leaf_now"), F.col("proof"))
    root = F.lit(made.root).cast("string")
    return made.rows.select(
        "doc_id",
        _text(F.col("leaf")).alias("leaf"),
        _text(F.col("subroot")).alias("subroot"),
        root.alias("root"),
        F.sha2(proof_text(F.col("proof")).cast("binary"), 256).alias("proof_sha256"),
        folded.alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))
