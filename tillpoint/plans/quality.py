"""Data-quality jobs re-aimed from the schema's constraints.

The source relies on the database to enforce primary keys, foreign keys, VARCHAR
lengths and NUMERIC precisions at insert time. Here they are checks that report
violations; every check is one aggregation pass with map-side partial aggregation.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillpoint.schemas import DOMAINS, SPECS, TableSpec
from tillpoint.tables import Tables


def pk_violations(df: DataFrame, keys: list[str]) -> DataFrame:
    """dq1: key values that are NULL or held by more than one row, with their row count."""
    any_null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    g = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"))
    return g.where(any_null | (F.col("rows") > 1)).withColumn(
        "reason", F.when(any_null, F.lit("null key")).otherwise(F.lit("duplicate key"))
    )


def _joined(parts: list) -> Column:
    """Key columns with bars between; NULL if any of them is."""
    out = parts[0]
    for p in parts[1:]:
        out = F.concat(out, F.lit("|"), p)
    return out


def pk_report(t: Tables, names: list[str] | None = None) -> DataFrame:
    """dq1 over every table: (table_name, key_value, rows, reason). A table with rows but without
    its key columns is one violation, with all its rows."""
    parts = []
    for name in names or list(SPECS):
        if name not in t:
            continue
        spec, df = SPECS[name], t[name]
        if not all(k in df.columns for k in spec.primary_key):
            rows = df.agg(F.count(F.lit(1)).alias("rows")).where("rows > 0")
            key_value, reason = F.lit(None).cast("string").alias("key_value"), F.lit("no key column").alias("reason")
            parts.append(rows.select(F.lit(name).alias("table_name"), key_value, "rows", reason))
            continue
        v = pk_violations(df, list(spec.primary_key))
        parts.append(
            v.select(
                F.lit(name).alias("table_name"),
                _joined([F.col(k).cast("string") for k in spec.primary_key]).alias("key_value"),
                "rows",
                "reason",
            )
        )
    return reduce(DataFrame.unionByName, parts)


def fk_orphans(child: DataFrame, parent: DataFrame, key: str, parent_key: str | None = None) -> DataFrame:
    """dq2: child rows whose non-NULL ``key`` has no parent row."""
    pk = parent_key or key
    p = parent.select(F.col(pk).alias(key)).distinct()
    return child.where(F.col(key).isNotNull()).join(p, key, "left_anti")


def fk_report(t: Tables) -> DataFrame:
    """dq2 for every declared foreign key: (table_name, column_name, parent_table, orphan_rows).

    Each table is read once: its rows are stacked into one row per foreign key (parent, key,
    number of the foreign key) and one for the key that others refer to (number -1), counted per
    distinct key before the shuffle. One group per (parent, key) then tells whether the parent
    exists and how many rows refer to it, so there is no join and a key held by most rows costs
    one row per task.
    """
    links = [
        (spec.name, c, p, pc)
        for spec in SPECS.values()
        if spec.name in t
        for c, p, pc in spec.foreign_keys
        if p in t and c in t[spec.name].columns
    ]
    referred = dict.fromkeys((p, pc) for _, _, p, pc in links)
    used = dict.fromkeys(n for n in SPECS if any(n in (child, p) for child, _, p, _ in links))
    stacked = []
    for name in used:
        refs = [(p, c, i) for i, (child, c, p, _) in enumerate(links) if child == name]
        refs += [(p, pc, -1) for p, pc in referred if p == name]
        rows = [
            F.struct(F.lit(p).alias("_parent"), F.col(c).cast("string").alias("_key"), F.lit(i).alias("_link"))
            for p, c, i in refs
        ]
        stacked.append(t[name].select(F.explode(F.array(*rows)).alias("_r")).select("_r.*"))
    keys = (
        reduce(DataFrame.unionByName, stacked)
        .where("_key is not null")
        .groupBy("_parent", "_key")
        .agg(
            F.max(F.col("_link") == -1).alias("_found"),
            *[F.count_if(F.col("_link") == i).alias(f"_n{i}") for i in range(len(links))],
        )
    )
    totals = keys.where(~F.col("_found")).agg(
        *[F.coalesce(F.sum(f"_n{i}"), F.lit(0)).alias(f"_o{i}") for i in range(len(links))]
    )
    report = [
        F.struct(
            F.lit(child).alias("table_name"),
            F.lit(c).alias("column_name"),
            F.lit(p).alias("parent_table"),
            F.col(f"_o{i}").alias("orphan_rows"),
        )
        for i, (child, c, p, _) in enumerate(links)
    ]
    return totals.select(F.explode(F.array(*report)).alias("_r")).select("_r.*")


def _checks(df: DataFrame, spec: TableSpec) -> list[tuple[str, str, F.Column]]:
    out = []
    for c in spec.columns:
        if c.name not in df.columns:
            continue
        col = F.col(c.name)
        if c.max_length is not None:
            out.append((c.name, f"length>{c.max_length}", F.length(col) > c.max_length))
        if isinstance(c.dtype, T.DecimalType):
            p, s = c.dtype.precision, c.dtype.scale
            out.append(
                (c.name, f"not decimal({p},{s})", col.isNotNull() & col.try_cast(f"decimal({p},{s})").isNull())
            )
        dom = DOMAINS.get((spec.name, c.name))
        if dom:
            out.append((c.name, "outside domain", col.isNotNull() & ~col.isin(list(dom))))
    return out


def domain_violations(df: DataFrame, spec: TableSpec | str) -> DataFrame:
    """dq3: per column and rule, the number of rows breaking a VARCHAR length,
    a NUMERIC precision or a stated value domain (one pass over the table)."""
    spec = SPECS[spec] if isinstance(spec, str) else spec
    checks = _checks(df, spec)
    if not checks:
        return df.limit(0).select(
            F.lit(spec.name).alias("table_name"),
            F.lit(None).cast("string").alias("column_name"),
            F.lit(None).cast("string").alias("rule"),
            F.lit(None).cast("long").alias("violations"),
        )
    counts = df.agg(*[F.sum(F.when(cond, 1).otherwise(0)).cast("long").alias(f"_c{i}") for i, (_, _, cond) in enumerate(checks)])
    rows = F.explode(
        F.array(
            *[
                F.struct(F.lit(col).alias("column_name"), F.lit(rule).alias("rule"), F.col(f"_c{i}").alias("violations"))
                for i, (col, rule, _) in enumerate(checks)
            ]
        )
    ).alias("_r")
    return counts.select(rows).select(
        F.lit(spec.name).alias("table_name"), "_r.column_name", "_r.rule", "_r.violations"
    )


def domain_report(t: Tables) -> DataFrame:
    """dq3 over every table present."""
    parts = [domain_violations(t[n], SPECS[n]) for n in SPECS if n in t and _checks(t[n], SPECS[n])]
    return reduce(DataFrame.unionByName, parts)
