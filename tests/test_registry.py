"""Every registered query against its DuckDB oracle on the smallest tables."""

import math

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()
ORACLE = E.oracle_sql()


def _norm(v):
    if v is None or v is pd.NA or v is pd.NaT or (isinstance(v, float) and math.isnan(v)):
        return None
    if hasattr(v, "item") and not hasattr(v, "__len__"):
        v = v.item()
    if isinstance(v, float) and v.is_integer():
        return int(v)
    if isinstance(v, float):
        return round(v, 9 - int(math.floor(math.log10(abs(v)))))
    if isinstance(v, pd.Timestamp):
        return v.to_pydatetime()
    return v


def _rows(df):
    cols = sorted(df.columns)
    rows = [tuple(_norm(x) for x in r) for r in df[cols].itertuples(index=False, name=None)]
    return sorted(rows, key=lambda t: tuple((x is None, str(x)) for x in t))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0 and df.columns[:2] == ["METADATA_TM_FILE", "METADATA_TM_INSERT"]


@pytest.mark.parametrize("name", sorted(E.queries()))
def test_query_matches_oracle(spark, duck, name):
    got = E.queries()[name](spark, SF).toPandas()
    if name not in ORACLE:
        assert len(got) > 0
        return
    want = duck.sql(ORACLE[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert len(got) == len(want)
    assert _rows(got) == _rows(want)



def test_tables_are_opened_once_per_session(spark):
    from loadwright.registry import table

    assert table(spark, SF, "orders") is table(spark, SF + "/", "orders")
    assert table(spark, SF, "orders") is not table(spark, SF, "lineitem")
