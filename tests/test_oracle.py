"""Every registered query against its DuckDB oracle at sf0.001 (rows, columns, values)."""

from __future__ import annotations

import math

import duckdb
import pytest

from oracle.queries import oracle_sql
from pitchside.plans.registry import queries

from .conftest import SF_SMALL

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")
QUERIES = queries()
ORACLE = oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def _canon(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])

    def norm(v):
        if isinstance(v, float):
            return round(v, 9) if not math.isnan(v) else "nan"
        return v.isoformat() if hasattr(v, "isoformat") else v

    out = [tuple(norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


def test_every_query_has_an_oracle():
    assert set(ORACLE) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    srows, scols = [tuple(r) for r in df.collect()], df.columns
    res = con.execute(ORACLE[name])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(scols) == sorted(dcols)
    assert len(srows) == len(drows)
    assert _canon(srows, scols) == _canon(drows, dcols)
