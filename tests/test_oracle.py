"""Every registered report query against its DuckDB oracle."""

import datetime as dt
import decimal
import math

import pytest

import __spark_entry__ as E
from ledgerlens import catalog

QUERIES = {k: v for k, v in E.queries().items() if k in catalog.queries()}
ORACLES = {k: v for k, v in E.oracle_sql().items() if k in QUERIES}


def _norm(v):
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6) + 0.0
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat(" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    return v


def _key(row):
    return tuple((x is None, str(type(x)), x if x is not None else 0) for x in row)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    cols = df.columns
    assert len(set(cols)) == len(cols), "duplicate output column names"
    got = sorted((tuple(_norm(x) for x in r) for r in df.collect()), key=_key)
    res = duck.execute(ORACLES[name])
    ocols = [d[0] for d in res.description]
    assert sorted(ocols) == sorted(cols)
    idx = [ocols.index(c) for c in cols]
    want = sorted((tuple(_norm(r[i]) for i in idx) for r in res.fetchall()), key=_key)
    assert len(got) == len(want)
    if got != want:
        # tolerate last-bit float noise (ties at the rounding digit), nothing more
        for a, b in zip(got, want):
            for x, y in zip(a, b):
                if isinstance(x, float) and isinstance(y, float):
                    assert abs(x - y) <= 2e-6 + 1e-9 * max(abs(x), abs(y)), (a, b)
                else:
                    assert x == y, (a, b)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "activity_date" in df.columns
