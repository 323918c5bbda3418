"""Every registered query against independent SQL on the same tables."""

from __future__ import annotations

import math

import duckdb
import pytest

import __spark_entry__ as contract
from checks.oracle import oracle_sql
from checks.queries import queries

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def comparable(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(round(value, 6) + 0.0)
    return repr(value)


QUERIES, ORACLES = queries(), oracle_sql()
TYPES = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE",
         "boolean": "BOOLEAN"}


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
    assert set(QUERIES) - set(ORACLES) == {"score_purchase", "score_churn"}


def test_contract_has_them_all():
    assert set(QUERIES) <= set(contract.queries())
    assert set(ORACLES) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(name, spark, duck, sf_dir):
    df = QUERIES[name](spark, sf_dir)
    columns = sorted(df.columns)
    got = sorted(tuple(map(comparable, r)) for r in df.select(*columns).collect())
    cursor = duck.execute(ORACLES[name])
    names = [d[0] for d in cursor.description]
    types = {d[0]: str(d[1]) for d in cursor.description}
    assert sorted(names) == columns
    assert {c: TYPES[t] for c, t in df.dtypes} == types
    order = [names.index(c) for c in columns]
    want = sorted(tuple(comparable(r[i]) for i in order) for r in cursor.fetchall())
    assert got == want
    assert got


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_trained_probabilities(name, spark, sf_dir):
    rows = QUERIES[name](spark, sf_dir)
    assert rows.where("probability BETWEEN 0 AND 1").count() == rows.count() >= 15


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns[:3] == ["event_date", "period_label", "funnel_step"]
    assert df.count() > 0
