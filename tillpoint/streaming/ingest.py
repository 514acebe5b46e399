"""Incremental form of the append load (p08): new CSV files landing in a folder are
parsed with the table's schema and appended to its Parquet table exactly once.

The source loads whole CSV files into the database by appending (the tables are
only ever appended to). As a Structured Streaming job the same load becomes
restartable: the file source remembers which files it has read in the query's
checkpoint, so a rerun after a failure or with new files appends only the rows
not yet written. ``availableNow`` processes what is there and stops, which suits
a scheduled batch; any other trigger keeps the query running.
"""

from __future__ import annotations

import os

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tillpoint.schemas import SPECS
from tillpoint.sources.files import CSV_DIALECT, PARTITION_COLUMNS, PARTITION_SOURCE, streamed_name


def _default_checkpoint(spark: SparkSession, name: str, out_root: str) -> str:
    """Beside the table itself, so that a restart from anywhere goes on where the last one stopped."""
    return os.path.join(out_root, "_stream_checkpoints", name)


def ingest_stream(
    spark: SparkSession,
    name: str,
    landing_dir: str,
    out_root: str,
    *,
    file_columns: list[str] | None = None,
    schema: T.StructType | None = None,
    checkpoint_location: str | None = None,
    available_now: bool = True,
    processing_time: str | None = None,
) -> StreamingQuery:
    """Start the load of ``landing_dir`` (CSV files with a header) into ``out_root/<name>``.

    ``file_columns`` lists the files' columns in order (default: the declared
    columns; source files of fact_returns may omit ``return_id``). ``schema``
    overrides the declared types. Returns the started query.
    """
    spec = SPECS[name]
    if name == "fact_returns" and "return_id" not in (file_columns or [c.name for c in spec.columns]):
        raise ValueError("streamed returns need their return_id: only a batch load can number them")
    types = {f.name: f.dataType for f in (schema.fields if schema is not None else spec.struct.fields)}
    cols = file_columns or list(types)
    raw = (
        spark.readStream.schema(T.StructType([T.StructField(c, T.StringType()) for c in cols]))
        .options(**CSV_DIALECT)
        .option("header", True)
        .option("mode", "FAILFAST")
        .csv(landing_dir)
    )
    typed = []
    for c, dtype in types.items():
        if c in cols:
            src = F.to_timestamp_ntz(F.col(c)) if isinstance(dtype, T.TimestampNTZType) else F.col(c)
            typed.append(src.cast(dtype).alias(c))
        else:
            typed.append(F.lit(None).cast(dtype).alias(c))
    out = raw.select(*typed)
    parts = PARTITION_COLUMNS.get(name, ())
    for p in parts:
        if p not in out.columns:
            out = out.withColumn(p, F.year(F.col(PARTITION_SOURCE[p])))
    writer = (
        out.writeStream.format("parquet")
        .outputMode("append")
        .option("path", os.path.join(out_root, streamed_name(name)))
        .option("checkpointLocation", checkpoint_location or _default_checkpoint(spark, name, out_root))
    )
    if parts:
        writer = writer.partitionBy(*parts)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()
