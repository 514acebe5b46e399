"""Every registered key against its DuckDB oracle on the smallest test tables."""

from __future__ import annotations

import datetime as dt
import decimal
import os

import pytest

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem".split()


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        return f"{v:.9g}"
    if isinstance(v, decimal.Decimal):
        return f"{float(v):.9g}"
    if isinstance(v, (dt.date, dt.datetime)):
        return v.isoformat()
    return str(v)


def _canon(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted("|".join(_norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def _keys():
    import __spark_entry__ as E

    return list(E.REGISTRY)


@pytest.mark.skipif(not os.path.exists(SF), reason="test tables absent")
@pytest.mark.parametrize("key", _keys())
def test_key_matches_oracle(spark, duck, key):
    import __spark_entry__ as E

    df = E.queries()[key](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    sql = E.oracle_sql()
    assert key in sql, f"{key} has no oracle SQL"
    rel = duck.execute(sql[key])
    ocols = [d[0] for d in rel.description]
    orows = rel.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert _canon(rows, df.columns) == _canon(orows, ocols)


def test_entry_smoke(spark):
    import __spark_entry__ as E

    df = E.entry(spark)
    assert df.columns == ["product_category", "product_sku", "profit"]
    assert df.count() >= 0
