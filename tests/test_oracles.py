"""Every registered query against its DuckDB oracle on the smallest test tables."""

from __future__ import annotations

import math
import re

import duckdb
import pytest

import __spark_entry__ as entry
from caseload.sources.testdata import RAW_TABLES

from .conftest import SF_SMALL


def _norm(v):
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else round(v, 6)
    if hasattr(v, "as_tuple"):
        return round(float(v), 6)
    return v


def _sorted(records, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in records]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in RAW_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


#: The training-text queries (op1_... and so on) have tests of their own.
OWN = sorted(q for q in entry.queries() if not re.match(r"op\d+_|pipeline$", q))


@pytest.mark.parametrize("name", OWN)
def test_query_matches_oracle(spark, duck, name):
    df = entry.queries()[name](spark, SF_SMALL)
    got = _sorted([tuple(r) for r in df.collect()], df.columns)
    res = duck.execute(entry.oracle_sql()[name])
    cols = [d[0] for d in res.description]
    want = _sorted(res.fetchall(), cols)
    assert sorted(df.columns) == sorted(cols)
    assert got == want
    duck_types = {c[0]: c[1] for c in duck.execute(f"DESCRIBE {entry.oracle_sql()[name]}").fetchall()}
    spark_to_duck = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE"}
    assert {c: spark_to_duck.get(t, t) for c, t in df.dtypes} == duck_types


def test_every_query_has_an_oracle():
    assert set(OWN) <= set(entry.oracle_sql())
