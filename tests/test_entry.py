"""The driver contract: every query is registered with its SQL, and the two agree where DuckDB can run it."""

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry
from tideline.plans import queries as series

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def test_entry_has_rows(spark):
    assert entry.entry(spark).limit(1).count() == 1


def test_names():
    assert set(series.ORACLES) <= set(series.QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


def rows(df):
    def plain(v):
        if v is None or (not isinstance(v, (list, dict)) and pd.isna(v)):
            return "~"
        if isinstance(v, bool) or type(v).__name__ == "bool_":
            return str(bool(v))
        if isinstance(v, (int, float)) or hasattr(v, "dtype"):
            return repr(round(float(v), 6) + 0.0)
        return str(v)

    return sorted(tuple(plain(v) for v in r) for r in df[sorted(df.columns)].itertuples(index=False))


@pytest.mark.parametrize("name", sorted(series.ORACLES))
def test_oracle(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    got, want = series.QUERIES[name](spark, SF).toPandas(), con.sql(series.ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns) and rows(got) == rows(want)
