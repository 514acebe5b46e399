"""Which loads of a table folder count: a ledger of numbered files, one for each finished load.

A load writes its rows into folders of its own (``<table>__loads/batch=<id>``). Nothing reads them
until the load's file is created in ``load_ledger``, which names all its tables at once; a load that
was broken off leaves folders that no reader looks at. Files are created exclusively, so of two
loads that started from the same state one is refused.
"""

from __future__ import annotations

import json
import os

from pyspark.sql import SparkSession

from tillpoint.sources.files import path_exists

LEDGER = "load_ledger"


class LoadConflict(RuntimeError):
    """Another load was finished since this one looked at the stored keys."""


def finished_loads(spark: SparkSession, root: str) -> list[dict]:
    """The entries of all finished loads in order: ``number``, ``batch``, ``tables`` (names with rows)."""
    folder = os.path.join(root, LEDGER)
    if not path_exists(spark, folder):
        return []
    texts = [r[0] for r in spark.read.text(folder, wholetext=True).collect()]  # one short row for each load
    entries = []
    for text in texts:
        try:
            entries.append(json.loads(text))
        except ValueError:  # created but not written to its end: not finished
            continue
    return sorted(entries, key=lambda e: e["number"])


def finish_load(spark: SparkSession, root: str, number: int, batch: str, tables: list[str]) -> None:
    """Make the load count, with all its tables in one step; refuse it if its number is taken."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(os.path.join(root, LEDGER, f"{number:08d}.json"))
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    try:
        out = fs.create(at, False)
    except Exception as taken:
        if fs.exists(at):
            raise LoadConflict(f"load {number} of {root} was finished by another job; load again") from taken
        raise
    out.write(bytearray(json.dumps({"number": number, "batch": batch, "tables": tables}).encode()))
    out.close()
