"""Facts stored together by order: bucketed copies that joins and groupings on order_id read without a shuffle.

The stored facts lie by date, so every analysis that meets order rows with shipments or returns moves
both to their order first. A copy in hash buckets of ``order_id`` (Spark's own bucketed tables, the same
number of buckets for every fact) is moved once, when it is written; afterwards bucket i of one fact
meets bucket i of the other in one task.

A copy is named by the files it was made from, so it is used only while exactly these are stored: after
a load, an append or a stream the copy no longer fits and the plain table is read until the next
``arrange``. A broken ``arrange`` leaves a folder without its ``_SUCCESS`` file, which nobody reads.

One task reads a bucket, so ``buckets`` should give each core some and hold a bucket to a few hundred
MB. Rows of one order share a bucket; it is streamed, never collected, but unlike a shuffled join it
is not split, so facts with one order of very many rows are better left by date.
"""

from __future__ import annotations

import hashlib
import os
import re
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from tillpoint.sources.files import path_exists, read_tables
from tillpoint.tables import Tables

FACTS = ("fact_orders", "fact_shippings", "fact_returns")
KEY = "order_id"


def _fingerprint(df: DataFrame) -> str:
    """Which files a table consists of, whatever their order."""
    return hashlib.sha256("\n".join(sorted(df.inputFiles())).encode()).hexdigest()[:16]


def _base(root: str, name: str) -> str:
    return os.path.join(root, f"{name}__by_order")


def _folders(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, on any file system that Spark reads."""
    if not path_exists(spark, path):
        return []
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return sorted(f.getPath().getName() for f in at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(at))


def _catalogued(spark: SparkSession, path: str, buckets: int) -> DataFrame:
    """A bucketed folder as a table of the session's catalog, where Spark learns of its buckets."""
    table = re.sub(r"\W", "_", f"{os.path.basename(os.path.dirname(path))}_{os.path.basename(path)}")
    if not spark.catalog.tableExists(table):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(path).schema.fields)
        quoted = path.replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(
            f"create table if not exists {table} ({columns}) using parquet "
            f"clustered by ({KEY}) sorted by ({KEY}) into {buckets} buckets location '{quoted}'"
        )
    return spark.table(table)


def _finished(spark: SparkSession, root: str, name: str, mark: str) -> tuple[str, int] | None:
    """A whole copy of the files named by ``mark``: its folder and number of buckets."""
    base = _base(root, name)
    for folder in _folders(spark, base):
        made_of, buckets, _ = folder.split("-")
        if made_of == mark and path_exists(spark, os.path.join(base, folder, "_SUCCESS")):
            return os.path.join(base, folder), int(buckets)
    return None


def arrange(t: Tables, root: str, buckets: int | None = None, names: Iterable[str] = FACTS) -> Tables:
    """Write the facts ``names`` of ``t`` by order below ``root`` and return ``t`` with them in place.

    ``buckets`` defaults to the session's shuffle partitions. A fact whose copy is there already, made
    from the same files with as many buckets, is not written again. Null order ids share a bucket and
    join with nothing, as in any join; empty facts give empty copies.
    """
    out = t
    for name in names:
        df = t[name]
        spark = df.sparkSession
        n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        mark = _fingerprint(df)
        there = _finished(spark, root, name, mark)
        if there is None or there[1] != n:
            path = os.path.join(_base(root, name), f"{mark}-{n}-{uuid.uuid4().hex[:8]}")
            table = re.sub(r"\W", "_", f"{os.path.basename(_base(root, name))}_{os.path.basename(path)}")
            dealt = df.repartition(n, KEY).sortWithinPartitions(KEY)  # the hash of the buckets: one file for each
            dealt.write.format("parquet").bucketBy(n, KEY).sortBy(KEY).option("path", path).saveAsTable(table)
            there = path, n
        out = out.with_table(name, _catalogued(spark, *there))
    return out


def read_by_order(spark: SparkSession, root: str) -> Tables:
    """The tables stored under ``root``, each fact from its copy by order where one fits what is stored."""
    t = read_tables(spark, root)
    for name in FACTS:
        if name in set(t) and (there := _finished(spark, root, name, _fingerprint(t[name]))):
            t = t.with_table(name, _catalogued(spark, *there))
    return t
