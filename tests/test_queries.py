"""Every query against its DuckDB SQL on the smallest tables."""

import duckdb
import pytest

from sheafwork.plans.queries import ORACLE_SQL, QUERIES

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


@pytest.fixture(scope="module")
def duck(sf_dir):
    c = duckdb.connect()
    for t in TABLES.split():
        c.sql(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_same_rows_as_sql(spark, sf_dir, duck, name):
    frame = QUERIES[name](spark, sf_dir)
    got = sorted((tuple(r[c] for c in sorted(frame.columns)) for r in frame.collect()), key=repr)
    result = duck.sql(ORACLE_SQL[name])
    assert sorted(result.columns) == sorted(frame.columns)
    want = sorted((tuple(x for _, x in sorted(zip(result.columns, row, strict=True))) for row in result.fetchall()), key=repr)
    assert got == want


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE_SQL)))
def test_rows_only(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).count() > 0
