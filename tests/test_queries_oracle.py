"""Every registered query with oracle SQL must equal DuckDB on sf0.001;
rows-only queries must run and return rows."""

import math

import duckdb
import pytest

from tests.conftest import SMALL

import __spark_entry__ as E
from spindle.sources.tables import TABLES

SQL = E.oracle_sql()
ALL = E.queries()


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6) + 0.0
    return v


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return [cols[i] for i in order], sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    return c


DUCK_TO_SPARK = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string",
                 "TIMESTAMP": "timestamp_ntz", "FLOAT": "float", "BOOLEAN": "boolean"}


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, con, name):
    df = ALL[name](spark, SMALL)
    got = _canon(df.columns, [tuple(r) for r in df.collect()])
    rel = con.sql(SQL[name])
    duck_types = {c: DUCK_TO_SPARK.get(str(t), str(t)) for c, t in zip(rel.columns, rel.types)}
    want = _canon(rel.columns, rel.fetchall())
    assert got[0] == want[0]
    assert dict(df.dtypes) == duck_types
    assert got[1] == want[1]


@pytest.mark.parametrize("name", sorted(set(ALL) - set(SQL)))
def test_rows_only_query_runs(spark, name):
    assert ALL[name](spark, SMALL).count() > 0


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["l_returnflag", "cluster", "quantity", "discount_pct", "tax_pct"]
    assert df.count() > 0
