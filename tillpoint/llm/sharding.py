"""Contiguous shards of nearly equal bytes, from prefix sums over per-partition totals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Bytes counted for each row besides its text.
ROW_BYTES = 16


def byte_shards(
    df: DataFrame,
    n_shards: int,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: list[Column | str] | None = None,
    row_bytes: int = ROW_BYTES,
) -> DataFrame:
    """Cut the rows, in the order of their id, into ``n_shards`` runs of nearly equal bytes.

    Returns ``keep`` (by default the id) with ``size`` (UTF-8 bytes of the text and ``row_bytes``),
    ``text_crc32``, ``shard`` and ``slot`` (gapless from 0 within a shard). A row belongs to the
    shard in which the middle of its bytes falls, so a shard misses its target by at most half of
    the rows at its two ends; a row larger than the target may leave shards beside it empty.

    Rows go to range partitions by id and a hash of the text, so that one id with very many rows is
    split as well; the narrow rows are then written once to the checkpoint folder, which fixes the
    partitions for good. Per-partition totals (one row each) give every partition its first byte
    and row number. Null ids come first, null texts count no bytes of text and have the crc32 of an
    empty text, equal rows are told apart only by their slots, an empty table gives no rows.
    """
    spark = df.sparkSession
    keep = keep or [id_col]
    kept = df.select(*keep).columns
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = df.select(
        *keep,
        F.col(id_col).alias("_id"),
        (F.octet_length(text) + F.lit(row_bytes)).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64(text).alias("_tie"),
    )
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = rows.repartitionByRange(parts, "_id", "_tie").withColumn("_part", F.spark_partition_id()).checkpoint()
    every = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    totals = placed.groupBy("_part").agg(F.sum("size").alias("_bytes"), F.count("*").alias("_rows"))
    totals = totals.select(
        "_part",
        F.coalesce(F.sum("_bytes").over(every), F.lit(0)).alias("_first_byte"),
        F.coalesce(F.sum("_rows").over(every), F.lit(0)).alias("_first_row"),
        F.sum("_bytes").over(Window.partitionBy()).alias("_total"),
    )
    within = Window.partitionBy("_part").orderBy("_id", "_tie", "size")
    counted = placed.select(
        "*",
        (F.sum("size").over(within.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")).alias("_before"),
        (F.row_number().over(within) - 1).alias("_row"),
    )
    middle = (F.col("_first_byte") + F.col("_before")) * 2 + F.col("size")
    cut = counted.join(F.broadcast(totals), "_part").select(
        *kept,
        "size",
        "text_crc32",
        F.least(F.lit(n_shards - 1), F.floor(middle.cast("decimal(28,0)") * n_shards / (F.col("_total") * 2)))
        .cast("int")
        .alias("shard"),
        (F.col("_first_row") + F.col("_row")).alias("_row"),
    )
    first = cut.groupBy("shard").agg(F.min("_row").alias("_first"))
    out = cut.join(F.broadcast(first), "shard")
    return out.select(*kept, "size", "text_crc32", "shard", (F.col("_row") - F.col("_first")).cast("long").alias("slot"))


def shard_report(documents: DataFrame, n_shards: int = 40) -> DataFrame:
    """Shard and slot of every document under the law that the shards' bytes are nearly equal."""
    return byte_shards(documents, n_shards).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
