import math

import pytest

from tallyframe.catalog import QUERIES, SQL

duckdb = pytest.importorskip("duckdb")
TABLES = "region nation customer supplier part orders lineitem events".split()


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def canonical(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def cell(v):
        return "~" if v is None or (isinstance(v, float) and math.isnan(v)) else repr(v + 0.0) if isinstance(v, float) else str(v)

    return sorted("|".join(cell(r[i]) for i in order) for r in data)


def test_twins_belong_to_queries():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_its_twin(spark, sf_dir, duck, name):
    df = QUERIES[name](spark, sf_dir)
    got = canonical(df.columns, [tuple(r) for r in df.collect()])
    cursor = duck.execute(SQL[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(columns) == sorted(df.columns)
    assert got == canonical(columns, cursor.fetchall())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_rows_only(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).count() > 0
