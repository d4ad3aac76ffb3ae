"""Queries that SQL can express, against their SQL."""

import os

import pytest

from mentionlake.llm.plans import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"


def table(rows):
    plain = lambda v: repr(round(v, 9)) if isinstance(v, float) else repr(v)
    return sorted(tuple(map(plain, row)) for row in rows)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for file in os.listdir(FOLDER):
        con.sql(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM '{FOLDER}/{file}'")
    df = QUERIES[name](spark, FOLDER)
    columns = sorted(df.columns)
    want = con.sql(ORACLES[name])
    assert sorted(want.columns) == columns
    quoted = ", ".join(f'"{c}"' for c in columns)
    got = table(df.select(*columns).collect())
    assert got and got == table(want.select(quoted).fetchall())
