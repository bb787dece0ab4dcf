"""Every registered query against its SQL, on the smallest tables."""

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
NAMES = [n for n in entry.queries() if not n.startswith("op") and n != "pipeline"]


def cells(df: pd.DataFrame) -> list[str]:
    def cell(v):
        if hasattr(v, "tolist"):
            v = v.tolist()
        if v is None or v is pd.NaT or v is pd.NA or (isinstance(v, float) and v != v):
            return "null"
        return repr(round(float(v), 6)) if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v)

    columns = sorted(df.columns)
    return sorted("|".join(cell(v) for v in row) for row in df[columns].itertuples(index=False))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, duck, name):
    got = entry.queries()[name](spark, SF).toPandas()
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert len(got)
        return
    want = duck.execute(sql).fetchdf()
    assert sorted(got.columns) == sorted(want.columns)
    assert cells(got) == cells(want)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
