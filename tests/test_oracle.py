"""Every registered query equals its DuckDB oracle on the smallest fixture."""

import hashlib
import math

import duckdb
import pytest

import __spark_entry__ as E
from areatab.plans.registry import QUERIES as REGISTERED

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
QUERIES = {k: f for k, f in E.queries().items() if k in REGISTERED}
SQL = E.oracle_sql()


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 9))
    return repr(v)


DUCK_TO_SPARK = {"INTEGER": "int", "BIGINT": "bigint", "DOUBLE": "double", "VARCHAR": "string", "BOOLEAN": "boolean"}


def _digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return hashlib.sha256("\n".join(sorted("|".join(_norm(r[i]) for i in order) for r in rows)).encode()).hexdigest()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_every_query_has_oracle():
    assert set(QUERIES) == set(REGISTERED) <= set(SQL)


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_matches_oracle(spark, con, key):
    df = QUERIES[key](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    rel = con.sql(SQL[key])
    otypes = {c: DUCK_TO_SPARK.get(str(t).upper(), str(t).lower()) for c, t in zip(rel.columns, rel.types)}
    cur = con.execute(SQL[key])
    ocols = [d[0] for d in cur.description]
    orows = cur.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert dict(df.dtypes) == otypes
    assert len(rows) == len(orows)
    assert _digest(df.columns, rows) == _digest(ocols, orows)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns[0] == "id_geo" and df.columns[-1] == "conteo"
