"""Every registered query against its DuckDB oracle at sf0.001 (the driver does sf0.01)."""

import hashlib
import math

import duckdb
import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL
from wxspark.plans import catalog
from wxspark.sources.tables import TABLES

# Those of the training-data operators are tested in their own folder.
QUERIES = {k: v for k, v in E.queries().items() if k in catalog.QUERIES}
ORACLE = {k: v for k, v in E.oracle_sql().items() if k in catalog.QUERIES}


def norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.9g}")
    if hasattr(v, "isoformat"):
        return str(v)
    return v


def digest(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return hashlib.md5("\n".join(sorted(repr(tuple(norm(r[i]) for i in order)) for r in rows)).encode()).hexdigest()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle_or_is_documented():
    assert set(ORACLE) <= set(QUERIES)
    assert set(QUERIES) - set(ORACLE) == set()


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0 and df.columns[0] == "city"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF_SMALL)
    srows = [tuple(r) for r in df.collect()]
    cur = duck.execute(ORACLE[name])
    drows = cur.fetchall()
    dcols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(dcols)
    assert len(srows) == len(drows)
    assert digest(srows, df.columns) == digest(drows, dcols)
