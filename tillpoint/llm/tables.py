"""Reading the corpus tables."""

from __future__ import annotations

import gc

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillpoint.session import ensure_checkpoint_dir, scratch_path

#: Bytes of a batch that goes to a Python worker. Texts differ in length by orders of magnitude, so a
#: limit by rows alone (Spark's 10,000) bounds no memory.
BATCH_BYTES = 2 << 20
_BATCH_KEY, _BATCH_DEFAULT = "spark.sql.execution.arrow.maxBytesPerBatch", "67108864b"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Table ``name`` of a data folder, by a path that only Spark needs to understand."""
    ensure_checkpoint_dir(spark)
    if spark.conf.get(_BATCH_KEY, None) == _BATCH_DEFAULT:  # a setting of the user's own is left alone
        spark.conf.set(_BATCH_KEY, str(BATCH_BYTES))
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


_ALTERED = (T.IntegralType, T.FloatType, T.DoubleType)


def exact(df: DataFrame, columns: list[str]) -> DataFrame:
    """``columns`` of ``df`` as pandas may see them: numbers as text. A pandas column of integers with a
    null in it holds doubles, so large ids would change; a NaN would come back as null."""
    kept = []
    for c in columns:
        altered = isinstance(df.schema[c].dataType, _ALTERED)
        kept.append(F.col(f"`{c}`").cast("string").alias(c) if altered else F.col(f"`{c}`"))
    return df.select(*kept)


def restored(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` with the columns of ``schema`` in their own types again, and its further ones as they are."""
    types = {f.name: f.dataType for f in schema.fields}
    return df.select(*[F.col(f"`{c}`").cast(types[c]).alias(c) if c in types else F.col(f"`{c}`") for c in df.columns])


def ddl(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)


def settled(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared scratch folder and read again: its lineage ends there, and unlike a
    checkpoint nothing of its plan (statistics, constraints) goes on into the plans built on it."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release_shuffles(spark: SparkSession) -> None:
    """Let Spark delete shuffle files that nothing refers to any more, after a checkpoint.

    Spark does so when the driver collects its garbage, which it may not do for the whole length of
    a job; until then the files of every earlier step fill the executors' disks.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()
