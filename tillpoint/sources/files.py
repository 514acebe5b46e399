"""CSV and Parquet sources and sinks for the retail tables."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillpoint.schemas import SPECS, TableSpec
from tillpoint.tables import Tables

# Facts are stored partitioned by order year so that date-bounded analyses prune files.
PARTITION_COLUMNS = {
    "fact_orders": ("order_year",),
    "fact_shippings": ("order_year",),
    "fact_returns": ("return_year",),
}
PARTITION_SOURCE = {"order_year": "order_date"}
# Column each fact is range-partitioned and sorted on before it is written: every task
# then holds one contiguous date range, so a year folder gets a few large files (not
# one per task) and the Parquet min/max statistics of each file cover a narrow range.
LAYOUT_ORDER = {
    "fact_orders": ("order_date", "product_sku"),
    "fact_shippings": ("order_date", "order_id"),
    "fact_returns": ("returndate", "order_id"),
}


# A quote inside a quoted field is doubled, and NA stands for a missing value.
CSV_DIALECT = {"quote": '"', "escape": '"', "nullValue": "NA"}


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there, on any file system that Spark reads."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at)


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of a file or of all files of a folder, on any file system that Spark reads."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getContentSummary(at).getLength()


def _spec(name: str | TableSpec) -> TableSpec:
    return name if isinstance(name, TableSpec) else SPECS[name]


def read_table(
    spark: SparkSession,
    name: str | TableSpec,
    directory: str,
    *,
    header: bool = True,
    schema=None,
) -> DataFrame:
    """Read ``<directory>/<name>.csv`` with the declared schema (never inferred).

    Columns are matched by header name, so a file without a column (the
    surrogate ``return_id``) yields NULL there. Values are parsed with ANSI casts
    on the executors, so a malformed value fails the job as FAILFAST would.
    ``schema`` overrides the declared column types.
    """
    from pyspark.sql import types as T

    spec = _spec(name)
    path = os.path.join(directory, f"{spec.name}.csv")
    types = {f.name: f.dataType for f in (schema.fields if schema is not None else spec.struct.fields)}
    file_cols = spark.read.options(**CSV_DIALECT).option("header", header).csv(path).columns if header else list(types)
    raw = (
        spark.read.schema(T.StructType([T.StructField(c, T.StringType()) for c in file_cols]))
        .options(**CSV_DIALECT)
        .option("header", header)
        .option("mode", "FAILFAST")
        .csv(path)
    )
    cols = []
    for c, dtype in types.items():
        if c in file_cols:
            src = F.col(c)
            if isinstance(dtype, T.TimestampNTZType):
                src = F.to_timestamp_ntz(src)
            cols.append(src.cast(dtype).alias(c))
        else:
            cols.append(F.lit(None).cast(dtype).alias(c))
    return raw.select(*cols)


def write_csv(df: DataFrame, path: str, *, mode: str = "overwrite", compression: str = "none") -> None:
    """CSV with a header and no row names; one folder of part files per table."""
    df.write.mode(mode).options(**CSV_DIALECT).option("header", True).option("compression", compression).csv(path)


def conform(df: DataFrame, name: str | TableSpec) -> DataFrame:
    """Cast to the declared column types and order; unknown columns are dropped."""
    spec = _spec(name)
    cols = []
    for c in spec.columns:
        if c.name in df.columns:
            cols.append(F.col(c.name).cast(c.dtype).alias(c.name))
        else:
            cols.append(F.lit(None).cast(c.dtype).alias(c.name))
    return df.select(*cols)


def load_table(
    df: DataFrame,
    name: str | TableSpec,
    root: str,
    *,
    mode: str = "append",
    typed: bool = True,
    num_partitions: int | None = None,
) -> str:
    """Append rows to a typed Parquet table under ``root/<name>``.

    Facts are partitioned by year so scans of a date range prune whole folders, and
    range-partitioned on their date first (``LAYOUT_ORDER``) into ``num_partitions``
    tasks (default: the session's shuffle partitions, fewer where AQE finds little data). ``typed=False`` keeps the
    frame's own (wider) types, as the binding's ids are long.
    """
    spec = _spec(name)
    out = conform(df, spec) if typed else df
    path = os.path.join(root, spec.name)
    writer = out
    parts = PARTITION_COLUMNS.get(spec.name, ())
    for p in parts:
        if p not in out.columns:
            writer = writer.withColumn(p, F.year(F.col(PARTITION_SOURCE[p])))
    order = [c for c in LAYOUT_ORDER.get(spec.name, ()) if c in writer.columns]
    if order:
        ranged = writer.repartitionByRange(num_partitions, *order) if num_partitions else writer.repartitionByRange(*order)
        writer = ranged.sortWithinPartitions(*parts, *order)
    w = writer.write.mode(mode)
    if parts:
        w = w.partitionBy(*parts)
    w.parquet(path)
    return path


def streamed_name(name: str) -> str:
    """Folder of a table's streamed rows: the file sink's log governs a whole folder, so it has its own."""
    return f"{name}__stream"


def loads_name(name: str) -> str:
    """Folder of the rows that checked loads have stored (``sources.keyed_load``), one below for each load."""
    return f"{name}__loads"


def _loaded(spark: SparkSession, name: str, root: str) -> DataFrame | None:
    """Accepted rows of all finished loads of a table."""
    from tillpoint.sources.ledger import finished_loads

    base = os.path.join(root, loads_name(name))
    kept = [
        path
        for e in finished_loads(spark, root)
        if name in e["tables"] and path_exists(spark, path := os.path.join(base, f"batch={e['batch']}", "accepted=true"))
    ]
    if not kept:
        return None
    return spark.read.option("basePath", base).parquet(*kept).drop("batch", "accepted", "outcome", "times", "text")


def scan_table(spark: SparkSession, name: str, root: str, *, keep_partition_columns: bool = True) -> DataFrame:
    """A stored table. Its year partition column is kept by default so that date
    filters can add the matching year predicate (``functions.measures.dated``) and
    prune whole folders; analyses select their own columns, so it does not leak."""
    path = os.path.join(root, name)
    streamed = os.path.join(root, streamed_name(name))
    found = [spark.read.parquet(p) for p in (path, streamed) if path_exists(spark, p)]
    if (loaded := _loaded(spark, name, root)) is not None:
        found.append(loaded)
    if not found:
        raise FileNotFoundError(f"no rows of {name} under {root}")
    df = found[0]
    for more in found[1:]:  # appends, streams and checked loads keep folders of their own
        df = df.unionByName(more)
    if keep_partition_columns:
        return df
    drop = [p for p in PARTITION_COLUMNS.get(name, ()) if p not in SPECS[name].names]
    return df.drop(*drop) if drop else df


def read_tables(spark: SparkSession, root: str, names: list[str] | None = None) -> Tables:
    """Retail tables stored by :func:`load_table`, as a lazy :class:`Tables`."""
    names = names or [
        n for n in SPECS if any(path_exists(spark, os.path.join(root, p)) for p in (n, streamed_name(n), loads_name(n)))
    ]
    return Tables({n: (lambda n=n: scan_table(spark, n, root)) for n in names})
