"""Load of CSV files that enforces values, keys and references, and keeps what it refuses.

Every column is read as text and cast row by row, so a bad value costs its row, not the job. A row is
refused for the first of these that holds; the rest are stored:

* ``malformed row``: more or fewer fields than the header;
* ``<column>: not <type>`` or ``<column>: length><n>``, in the order of the columns;
* ``null key``: a null in the primary key;
* ``<column>: no <parent>``: a reference without a row among the stored and the rows now accepted;
* ``stored key``: the key is stored already, so a load that runs again changes nothing;
* ``duplicate key``: another valid row of the load has the key (of several the least, compared as
  text, is stored).

All tables of a load count from one moment, when the ledger names them (``sources.ledger``). Refused
rows lie beside the accepted ones, with the reason, their text and how often they came.
"""

from __future__ import annotations

import os
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillpoint.operators.ranking import with_row_number
from tillpoint.schemas import DOMAINS, LOAD_ORDER, SPECS, TableSpec
from tillpoint.session import ensure_checkpoint_dir, scratch_path, shuffles_dropped
from tillpoint.sources.files import (
    CSV_DIALECT,
    LAYOUT_ORDER,
    PARTITION_COLUMNS,
    PARTITION_SOURCE,
    loads_name,
    path_exists,
    scan_table,
)
from tillpoint.sources.ledger import finish_load, finished_loads

#: Key of a table whose file leaves its surrogate key out: without it a second load would not be known.
NATURAL_KEYS = {"fact_returns": ("order_id", "product_sku", "return_quantity", "returndate")}
BROKEN = "_malformed"
ACCEPTED = "accepted"


def read_raw(spark: SparkSession, name: str | TableSpec, directory: str) -> DataFrame:
    """``<directory>/<name>.csv`` as text: the columns of its header and ``_malformed``, the whole line
    where it does not fit the header."""
    spec = SPECS[name] if isinstance(name, str) else name
    path = os.path.join(directory, f"{spec.name}.csv")
    header = spark.read.options(**CSV_DIALECT).option("header", True).csv(path).columns
    fields = [T.StructField(c, T.StringType()) for c in [*header, BROKEN]]
    return (
        spark.read.schema(T.StructType(fields))
        .options(**CSV_DIALECT)
        .option("header", True)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", BROKEN)
        .csv(path)
    )


def value_checks(spec: TableSpec, columns: list[str], types: dict[str, T.DataType] | None = None) -> list[tuple[str, str, Column]]:
    """(column, rule, condition of a violation) on text columns, for declared or given types."""
    out = []
    for c in spec.columns:
        if c.name not in columns:
            continue
        text, dtype = F.col(c.name), (types or {}).get(c.name, c.dtype)
        if not isinstance(dtype, T.StringType):
            out.append((c.name, f"not {dtype.simpleString()}", text.isNotNull() & text.try_cast(dtype).isNull()))
        if c.max_length is not None:
            out.append((c.name, f"length>{c.max_length}", F.length(text) > c.max_length))
    return out


def raw_violations(spark: SparkSession, name: str, directory: str) -> DataFrame:
    """dq3 on a file before any load: ``table_name``, ``column_name``, ``rule``, ``violations`` for the
    declared type, length and domain of every column, and for malformed rows. One pass over the file."""
    spec, raw = SPECS[name], read_raw(spark, name, directory)
    checks = [("", "malformed row", F.col(BROKEN).isNotNull()), *value_checks(spec, raw.columns)]
    for (table, column), domain in DOMAINS.items():
        if table == name and column in raw.columns:
            checks.append((column, "outside domain", F.col(column).isNotNull() & ~F.col(column).isin(list(domain))))
    counts = raw.agg(*[F.count_if(cond).alias(f"_c{i}") for i, (*_, cond) in enumerate(checks)])
    rows = [
        F.struct(F.lit(name).alias("table_name"), F.lit(c).alias("column_name"), F.lit(rule).alias("rule"), F.col(f"_c{i}").alias("violations"))
        for i, (c, rule, _) in enumerate(checks)
    ]
    return counts.select(F.explode(F.array(*rows)).alias("_r")).select("_r.*")


def _key(values: list[Column]) -> Column:
    """One text for a key; the lengths of its parts keep them apart, nulls are told from texts."""
    parts = []
    for value in values:
        text = value.cast("string")
        parts.append(F.when(text.isNull(), "-").otherwise(F.concat(F.length(text).cast("string"), F.lit(":"), text)))
    return F.concat(*parts)


def _typed(raw: DataFrame, types: dict[str, T.DataType]) -> dict[str, Column]:
    """Typed values of the columns, from their text."""
    return {c: (F.col(c) if c in raw.columns else F.lit(None)).try_cast(t) for c, t in types.items()}


def _line(raw: DataFrame) -> Column:
    """The text kept of a refused row: its line if it is malformed, else its fields."""
    return F.coalesce(F.col(BROKEN), F.to_json(F.struct(*[c for c in raw.columns if c != BROKEN])))


class _Load:
    """One load into a table folder: what was stored when it began, and what it has accepted so far."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        ensure_checkpoint_dir(spark)
        self.spark, self.root = spark, root
        done = finished_loads(spark, root)
        self.number = done[-1]["number"] + 1 if done else 1
        self.batch = f"{self.number:08d}-{uuid.uuid4().hex[:12]}"
        self.staged: dict[str, DataFrame] = {}
        self._stored: dict[str, DataFrame | None] = {}

    def stored(self, name: str) -> DataFrame | None:
        """Rows that counted when the load began, or None where the table has none."""
        if name not in self._stored:
            try:
                self._stored[name] = scan_table(self.spark, name, self.root, keep_partition_columns=False)
            except FileNotFoundError:
                self._stored[name] = None
        return self._stored[name]

    def rows(self, name: str) -> DataFrame | None:
        """Stored rows and those of this load."""
        known = [df for df in (self.stored(name), self.staged.get(name)) if df is not None]
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), known) if known else None

    def judged(self, raw: DataFrame, spec: TableSpec, types: dict[str, T.DataType]) -> DataFrame:
        """The different rows, as text, with ``outcome`` and ``times``.

        Equal rows are counted before anything else, so a row repeated a billion times is one row from
        there on. Rows move as the text of their file; types and the text that is kept of a refused row
        are formed where they are needed. References and stored keys are equijoins against unique keys;
        the stored keys are first reduced to those that the load has, which needs no shuffle of the
        stored table while the load's keys are few.
        """
        given = [c for c in raw.columns if c != BROKEN]
        value = _typed(raw, types)
        refused = F.when(F.col(BROKEN).isNotNull(), "malformed row")
        for column, rule, broken in value_checks(spec, given, types):
            refused = refused.when(broken, f"{column}: {rule}")
        surrogate = any(c not in given for c in spec.primary_key)
        key = NATURAL_KEYS.get(spec.name, spec.primary_key) if surrogate else spec.primary_key
        if not surrogate:
            null = reduce(lambda a, b: a | b, [value[k].isNull() for k in key])
            refused = F.coalesce(refused, F.when(null, "null key"))
        own_key = _key([value[k] for k in key])
        out = raw.groupBy(*raw.columns).agg(F.count("*").alias("times")).withColumn("_outcome", refused)
        # Rows of one key meet in one place, those without a valid key are spread by all they hold.
        spread = F.concat(F.lit("#"), F.xxhash64(*raw.columns).cast("string"))
        out = out.withColumn("_spot", F.when(F.col("_outcome").isNull(), own_key).otherwise(spread))
        missing, by_key = [], []
        for i, (column, parent, parent_column) in enumerate(spec.foreign_keys):
            held, lacks = self.rows(parent), value[column].isNotNull()
            if held is not None:
                of = held.select(F.col(parent_column).cast(types[column]).alias("_of"))
                if key == (column,):  # the reference is the key: met where the rows of a key meet
                    by_key.append(of.select(_key([F.col("_of")]).alias("_spot")).distinct().withColumn(f"_p{i}", F.lit(True)))
                else:
                    found = of.distinct().withColumn(f"_p{i}", F.lit(True))
                    out = out.join(found, value[column] == found["_of"], "left").drop("_of")
                lacks = lacks & F.col(f"_p{i}").isNull()
            missing.append(F.when(lacks, f"{column}: no {parent}"))
        out = out.repartition("_spot")
        for found in by_key:
            out = out.join(found, "_spot", "left")
        before = self.stored(spec.name)
        if before is not None:
            mine = raw.where(refused.isNull()).select(own_key.alias("_spot")).distinct()
            same = before.select(_key([F.col(c).cast(types[c]) for c in key]).alias("_spot"))
            again = same.join(mine, "_spot", "left_semi").distinct().withColumn("_again", F.lit(True))
            out = out.join(again, "_spot", "left")
            missing.append(F.when(F.col("_again"), "stored key"))
        out = out.select("*", F.coalesce("_outcome", *missing, F.lit(None).cast("string")).alias("outcome"), _line(raw).alias("_text"))
        rival = Window.partitionBy("_spot").orderBy("outcome", "_text")
        first = F.col("outcome").isNull() & (F.row_number().over(rival) == 1)
        share = lambda outcome, times: F.struct(outcome.alias("outcome"), times.alias("times"))
        double = F.lit("duplicate key")
        parts = F.when(first, F.array(share(F.lit(ACCEPTED), F.lit(1).cast("long")), share(double, F.col("times") - 1))).otherwise(
            F.array(share(F.coalesce(F.col("outcome"), double), F.col("times")))
        )
        out = out.select(*raw.columns, parts.alias("_parts"))
        out = out.select(*raw.columns, F.explode(F.filter("_parts", lambda p: p["times"] > 0)).alias("_part"))
        return out.select(*raw.columns, "_part.outcome", "_part.times")

    def stage(self, judged: DataFrame, spec: TableSpec, types: dict[str, T.DataType], serial: bool) -> None:
        """Write accepted and refused rows in folders of their own, facts by year and in date order."""
        line = _line(judged.drop("outcome", "times"))
        if serial:
            column = spec.primary_key[0]
            path = scratch_path(self.spark, "judged")
            judged.write.option("compression", "zstd").parquet(path)
            judged = self.spark.read.schema(judged.schema).parquet(path)
            known = self.stored(spec.name)
            last = (known.agg(F.max(column)).first()[0] if known is not None else 0) or 0
            value = _typed(judged, types)
            order = [value[c].asc_nulls_first() for c in NATURAL_KEYS[spec.name]]  # accepted once each
            fresh = with_row_number(judged.where(F.col("outcome") == ACCEPTED), order, column)
            fresh = fresh.withColumn(column, F.col(column) + int(last))
            refused = judged.where(F.col("outcome") != ACCEPTED).withColumn(column, F.lit(None).cast("long"))
            judged = fresh.unionByName(refused)
        parts = PARTITION_COLUMNS.get(spec.name, ())
        value = _typed(judged, types)
        for p in parts:
            if p not in value:
                value[p] = F.year(value[PARTITION_SOURCE[p]])
        out = judged.withColumn("accepted", F.col("outcome") == ACCEPTED)
        ready = {}  # columns that rows are ordered by have their values before they move, the others after
        if order := [c for c in LAYOUT_ORDER.get(spec.name, ()) if c in value]:
            ready = {c: f"_typed_{c}" for c in (*parts, *order)}
            out = out.withColumns({name: value[c] for c, name in ready.items()})
            by = [ready[c] for c in order]
            out = out.repartitionByRange("accepted", *by).sortWithinPartitions("accepted", *[ready[p] for p in parts], *by)
        final = {c: (F.col(ready[c]) if c in ready else v).alias(c) for c, v in value.items()}
        text = F.when(~F.col("accepted"), line).alias("text")
        added = [final[p] for p in parts if p not in types]
        out = out.select(*[final[c] for c in types], text, "outcome", "times", "accepted", *added)
        path = os.path.join(self.root, loads_name(spec.name), f"batch={self.batch}")
        out.write.option("compression", "zstd").partitionBy("accepted", *parts).parquet(path)
        written = self.spark.read.schema(out.schema).parquet(path)
        self.staged[spec.name] = written.where("accepted").select(*types)


def load_batch(
    spark: SparkSession,
    csv_dir: str,
    root: str,
    *,
    names: list[str] | None = None,
    schemas: dict[str, T.StructType] | None = None,
) -> str | None:
    """Load ``<csv_dir>/<table>.csv`` (all that are there, or ``names``) into the tables under ``root``,
    parents before children. Returns the batch's id; None if there was nothing to load.

    Nothing is visible before the last step. A load that fails can simply be run again; one that runs
    again after it was finished stores nothing. ``schemas`` overrides declared types by table.
    """
    load = _Load(spark, root)
    for spec in LOAD_ORDER:
        path = os.path.join(csv_dir, f"{spec.name}.csv")
        if spec.name not in (names or SPECS) or (names is None and not path_exists(spark, path)):
            continue
        raw = read_raw(spark, spec, csv_dir)
        given = (schemas or {}).get(spec.name)
        types = {f.name: f.dataType for f in (given or spec.struct).fields}
        serial = spec.name in NATURAL_KEYS and spec.primary_key[0] not in raw.columns
        for c in spec.columns if serial else ():
            types.setdefault(c.name, c.dtype)
        with shuffles_dropped(spark):
            load.stage(load.judged(raw, spec, types), spec, types, serial)
    if not load.staged:
        return None
    finish_load(spark, root, load.number, load.batch, sorted(load.staged))
    return load.batch


def load_report(spark: SparkSession, root: str) -> DataFrame:
    """Rows by load, table and outcome: ``load_number``, ``table_name``, ``outcome``, ``rows``."""
    parts = []
    for entry in finished_loads(spark, root):
        for name in entry["tables"]:
            rows = _of_load(spark, root, name, entry["batch"])
            parts.append(
                rows.groupBy("outcome")
                .agg(F.sum("times").alias("rows"))
                .select(F.lit(entry["number"]).alias("load_number"), F.lit(name).alias("table_name"), "outcome", "rows")
            )
    if not parts:
        return spark.createDataFrame([], "load_number int, table_name string, outcome string, rows long")
    return reduce(DataFrame.unionByName, parts)


def rejected_rows(spark: SparkSession, root: str, name: str) -> DataFrame:
    """Every refused row of a table: ``load_number``, ``outcome``, ``times``, ``text``."""
    parts = [
        _of_load(spark, root, name, e["batch"]).where(F.col("outcome") != ACCEPTED).select(F.lit(e["number"]).alias("load_number"), "outcome", "times", "text")
        for e in finished_loads(spark, root)
        if name in e["tables"]
    ]
    if not parts:
        return spark.createDataFrame([], "load_number int, outcome string, times long, text string")
    return reduce(DataFrame.unionByName, parts)


def _of_load(spark: SparkSession, root: str, name: str, batch: str) -> DataFrame:
    path = os.path.join(root, loads_name(name), f"batch={batch}")
    return spark.read.schema("outcome string, times long, text string").parquet(path)
