"""Every registered query next to its SQL, on the smallest data."""

import duckdb
import pytest

import __spark_entry__ as contract

FOLDER = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{FOLDER}/{t}.parquet'")
    return con


def test_entry_has_rows(spark):
    assert contract.entry(spark).count() == 11


@pytest.mark.parametrize("name", sorted(contract.queries()))
def test_query(spark, db, name):
    df = contract.queries()[name](spark, FOLDER)
    columns = sorted(df.columns)
    rows = sorted(repr(tuple(r)) for r in df.select(*[f"`{c}`" for c in columns]).collect())
    if name not in contract.oracle_sql():
        assert rows
        return
    result = db.execute(contract.oracle_sql()[name])
    names = [d[0] for d in result.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    assert columns == sorted(names)
    assert rows == sorted(repr(tuple(r[i] for i in order)) for r in result.fetchall())
