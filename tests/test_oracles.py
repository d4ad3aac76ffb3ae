"""Every registered query against its oracle, on the smallest tables."""

import math
import os

import pytest

from mentionlake.plans import QUERIES

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables not present")


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    con.sql("SET timezone = 'UTC'")
    for file in os.listdir(FOLDER):
        con.sql(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM '{FOLDER}/{file}'")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(round(value, 9))
    return value.isoformat() if hasattr(value, "isoformat") else repr(value)


def table(rows):
    return sorted(tuple(plain(v) for v in row) for row in rows)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    query = QUERIES[name]
    df = query.run(spark, FOLDER)
    columns = sorted(df.columns)
    rows = df.select(*columns).collect()
    if query.oracle is None:
        return
    want = duck.sql(query.oracle)
    assert sorted(want.columns) == columns
    quoted = ", ".join(f'"{c}"' for c in columns)
    assert table(rows) == table(want.select(quoted).fetchall())
