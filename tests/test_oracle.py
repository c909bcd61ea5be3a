"""Every driver query against its DuckDB oracle at sf0.001, compared as the driver does."""

import math

import duckdb
import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
SPARK_TO_DUCK = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
                 "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN"}
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return ([cols[i] for i in order],
            sorted((tuple(norm(r[i]) for i in order) for r in rows), key=lambda t: tuple(map(str, t))))


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_every_query_has_oracle():
    from strata.plans.queries import registry
    assert set(registry()) <= set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    s = canon(df.columns, [tuple(r) for r in df.collect()])
    res = con.execute(E.oracle_sql()[name])
    duck_types = {x[0]: str(x[1]) for x in res.description}
    spark_types = {f.name: SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString())
                   for f in df.schema.fields}
    assert spark_types == duck_types
    d = canon([x[0] for x in res.description], res.fetchall())
    assert s[0] == d[0]
    assert len(s[1]) == len(d[1])
    assert s[1] == d[1]


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "rank_overall" in df.columns
