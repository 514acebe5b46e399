"""DuckDB oracle SQL for every registered key.

``oracle_sql()`` returns ``{key: sql}`` where each text starts with the binding
CTEs of ``binding.sql`` and then runs the key's own query as a subquery.
"""

from __future__ import annotations

import os
import re

_HERE = os.path.dirname(os.path.abspath(__file__))


def _read(name: str) -> str:
    with open(os.path.join(_HERE, name), encoding="utf-8") as fh:
        return fh.read()


def _strip_comments(sql: str) -> str:
    return "\n".join(line for line in sql.splitlines() if not line.lstrip().startswith("--")).strip()


def _blocks() -> dict[str, str]:
    text = _read("queries.sql")
    parts = re.split(r"^-- key: *(\S+) *$", text, flags=re.MULTILINE)
    out = {}
    for key, body in zip(parts[1::2], parts[2::2]):
        out[key] = _strip_comments(body).rstrip(";")
    return out


def _domain_sql() -> str:
    """dq3 as SQL, one SELECT per (table, column, rule) of the declared schema."""
    from tillpoint.schemas import DOMAINS, SPECS
    from pyspark.sql import types as T

    # The binding has no surrogate return_id column.
    absent = {("fact_returns", "return_id")}
    selects = []
    for spec in SPECS.values():
        for c in spec.columns:
            if (spec.name, c.name) in absent:
                continue
            checks = []
            if c.max_length is not None:
                checks.append((f"length>{c.max_length}", f"length({c.name}) > {c.max_length}"))
            if isinstance(c.dtype, T.DecimalType):
                p, s = c.dtype.precision, c.dtype.scale
                checks.append(
                    (f"not decimal({p},{s})", f"{c.name} IS NOT NULL AND TRY_CAST({c.name} AS DECIMAL({p},{s})) IS NULL")
                )
            dom = DOMAINS.get((spec.name, c.name))
            if dom:
                values = ", ".join("'" + v + "'" for v in dom)
                checks.append(("outside domain", f"{c.name} IS NOT NULL AND {c.name} NOT IN ({values})"))
            for rule, cond in checks:
                selects.append(
                    f"SELECT '{spec.name}' AS table_name, '{c.name}' AS column_name, '{rule}' AS rule, "
                    f"CAST(SUM(CASE WHEN {cond} THEN 1 ELSE 0 END) AS BIGINT) AS violations FROM {spec.name}"
                )
    return "\nUNION ALL\n".join(selects)


# The faults of the files, as in the registry's rules.
FAULTS = {
    ("dim_customers", "customer_name"): "CASE WHEN customer_id % 50 = 0 THEN repeat(customer_name, 5) ELSE customer_name END",
    ("fact_orders", "product_price"): "CASE WHEN order_id % 97 = 0 THEN 'n/a' ELSE CAST(product_price AS VARCHAR) END",
    ("fact_orders", "retailer_id"): "CASE WHEN order_id % 89 = 0 THEN retailer_id + 900000000 ELSE retailer_id END",
}
SQL_TYPES = {"int": "INTEGER", "bigint": "BIGINT", "date": "DATE", "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP"}
ABSENT = {("fact_returns", "return_id")}  # the bound returns have no surrogate key


def _raw_text(table: str, column: str) -> str:
    return f"CAST({FAULTS.get((table, column), column)} AS VARCHAR)"


def _raw_domain_sql() -> str:
    """dq3 on the files' text: one SELECT for each (table, column, rule)."""
    from pyspark.sql import types as T

    from tillpoint.schemas import DOMAINS, SPECS

    selects = []
    for spec in SPECS.values():
        checks = [("", "malformed row", "false")]
        for c in spec.columns:
            if (spec.name, c.name) in ABSENT:
                continue
            text = _raw_text(spec.name, c.name)
            if not isinstance(c.dtype, T.StringType):
                name = c.dtype.simpleString()
                checks.append((c.name, f"not {name}", f"{text} IS NOT NULL AND TRY_CAST({text} AS {SQL_TYPES.get(name, name)}) IS NULL"))
            if c.max_length is not None:
                checks.append((c.name, f"length>{c.max_length}", f"length({text}) > {c.max_length}"))
            if domain := DOMAINS.get((spec.name, c.name)):
                values = ", ".join(f"'{v}'" for v in domain)
                checks.append((c.name, "outside domain", f"{text} NOT IN ({values})"))
        selects += [
            f"SELECT '{spec.name}' AS table_name, '{c}' AS column_name, '{rule}' AS rule, "
            f"count(*) FILTER (WHERE {cond}) AS violations FROM {spec.name}"
            for c, rule, cond in checks
        ]
    return "\nUNION ALL\n".join(selects)


def _checked_load_sql() -> str:
    """Outcomes of two loads of the files. A key is stored once in the first; in the second all valid
    rows meet a stored key. Parents come before children, as their kept keys are looked up."""
    from tillpoint.schemas import LOAD_ORDER

    ctes, selects = [], []
    for spec in LOAD_ORDER:
        name = spec.name
        key = ("order_id", "product_sku", "return_quantity", "returndate") if name == "fact_returns" else spec.primary_key
        whens = []
        for c in spec.columns:
            if c.max_length is not None:
                whens.append(f"WHEN length({_raw_text(name, c.name)}) > {c.max_length} THEN '{c.name}: length>{c.max_length}'")
            if (name, c.name) == ("fact_orders", "product_price"):
                whens.append(f"WHEN {_raw_text(name, c.name)} = 'n/a' THEN 'product_price: not decimal(12,2)'")
        for column, parent, parent_column in spec.foreign_keys:
            value = FAULTS.get((name, column), column)
            whens.append(
                f"WHEN {column} IS NOT NULL AND {value} NOT IN (SELECT {parent_column} FROM kept_{parent}) THEN '{column}: no {parent}'"
            )
        why = f"CASE {' '.join(whens)} END" if whens else "CAST(NULL AS VARCHAR)"
        ctes.append(f"judged_{name} AS (SELECT *, {why} AS why FROM {name})")
        ctes.append(f"kept_{name} AS (SELECT DISTINCT {', '.join(key)} FROM judged_{name} WHERE why IS NULL)")
        valid = f"(SELECT count(*) FROM judged_{name} WHERE why IS NULL)"
        kept = f"(SELECT count(*) FROM kept_{name})"
        for load, outcome, rows in (
            (1, "accepted", kept), (1, "duplicate key", f"{valid} - {kept}"), (2, "stored key", valid),
        ):
            selects.append(f"SELECT {load} AS load_number, '{name}' AS table_name, '{outcome}' AS outcome, {rows} AS rows")
        selects.append(
            f"SELECT load_number, '{name}', why, count(*) FROM judged_{name}, (VALUES (1), (2)) AS loads(load_number) "
            "WHERE why IS NOT NULL GROUP BY load_number, why"
        )
    return "WITH " + ",\n".join(ctes) + "\nSELECT * FROM (" + "\nUNION ALL\n".join(selects) + ") AS outcomes WHERE rows > 0"


def oracle_sql() -> dict[str, str]:
    from tillpoint.plans.registry import BY_ORDER

    binding = _strip_comments(_read("binding.sql"))
    queries = _blocks()
    queries |= {k + "_by_order": queries[k] for k in BY_ORDER}  # the storage of the facts changes no answer
    queries["dq3_domain"] = _domain_sql()
    queries["dq3_domain_raw"] = _raw_domain_sql()
    queries["p08_ingest_checked"] = _checked_load_sql()
    return {k: f"WITH {binding}\nSELECT * FROM (\n{q}\n) AS oracle_result" for k, q in queries.items()}
