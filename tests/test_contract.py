"""Every registered query against its SQL, at the smallest scale."""

import duckdb
import pytest

import __spark_entry__ as contract

ROOT = "/root/testdata/sf0.001"
TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{ROOT}/{t}.parquet'")
    return con


def ordered(rows):
    def cell(x):
        if x is None:
            return (0, "")
        if isinstance(x, bool) or not isinstance(x, (int, float)):
            return (1, str(x))
        return (2, f"{float(x):.5f}")

    return sorted(rows, key=lambda r: [cell(x) for x in r])


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_query(spark, con, name):
    df = contract.queries()[name](spark, ROOT)
    cols = sorted(df.columns)
    got = ordered([tuple(r[c] for c in cols) for r in df.collect()])
    res = con.execute(contract.oracle_sql()[name])
    names = [d[0] for d in res.description]
    assert sorted(names) == cols
    order = [names.index(c) for c in cols]
    want = ordered([tuple(r[i] for i in order) for r in res.fetchall()])
    assert got == want


@pytest.mark.parametrize("name", sorted(set(contract.queries()) - set(contract.oracle_sql())))
def test_rows_only(spark, name):
    assert contract.queries()[name](spark, ROOT).count() > 0


def test_entry(spark):
    assert contract.entry(spark).count() > 0


def test_every_oracle_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())
