"""Every registered query with reference SQL, against DuckDB on the same files."""

import math

import pandas as pd
import pytest

from gridlens.plans import catalog

duckdb = pytest.importorskip("duckdb")

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _cell(x):
    if x is None or x is pd.NA or x is pd.NaT or (isinstance(x, float) and math.isnan(x)):
        return None
    if isinstance(x, bool) or type(x).__name__ == "bool":
        return bool(x)
    if hasattr(x, "isoformat"):
        return pd.Timestamp(x).isoformat()
    return float(x) if isinstance(x, (int, float)) or hasattr(x, "dtype") else x


def canonical(frame):
    frame = frame[sorted(frame.columns)]
    return sorted((tuple(_cell(x) for x in row) for row in frame.itertuples(index=False)), key=repr)


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_same_rows_as_reference_sql(spark, sf_dir, duck, name):
    ours = catalog.queries()[name](spark, sf_dir).toPandas()
    theirs = duck.execute(catalog.oracle_sql()[name]).df()
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert canonical(ours) == canonical(theirs)


#: Their longest lag outruns the series of the smallest scale; `test_forecast` runs them on longer ones.
LONG = {"f3_fit_price_windows", "f4_predict_windows", "f8_window_registry"}


@pytest.mark.parametrize("name", sorted(set(catalog.queries()) - set(catalog.oracle_sql()) - LONG))
def test_runs_without_reference_sql(spark, sf_dir, name):
    assert catalog.queries()[name](spark, sf_dir).count() > 0


def test_every_reference_sql_has_a_query():
    assert set(catalog.oracle_sql()) <= set(catalog.queries())


def test_entry_point(spark):
    import __spark_entry__ as entry
    assert entry.entry(spark).count() > 0
    assert set(entry.queries()) >= set(catalog.queries())
