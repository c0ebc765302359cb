"""Every query against its SQL, evaluated by another engine on the same files."""

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry_module
from barwright.catalogue import QUERIES
from barwright.oracle import ORACLE
from conftest import SF


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM '{SF}/events.parquet'")
    return con


def normal(frame: pd.DataFrame) -> list:
    frame = frame[sorted(frame.columns)]
    rows = [
        tuple("" if pd.isna(v) else f"{v:.9g}" if isinstance(v, float) else str(v) for v in row)
        for row in frame.itertuples(index=False)
    ]
    return sorted(rows)


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0


def test_registered():
    assert set(QUERIES) <= set(entry_module.queries()) and set(ORACLE) <= set(entry_module.oracle_sql())
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())


def test_only_fitted_models_lack_sql():
    assert set(QUERIES) - set(ORACLE) == {"model_grid", "next_step", "forecast_vs_actual"}
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, sql, name):
    got, wanted = QUERIES[name](spark, SF).toPandas(), sql.sql(ORACLE[name]).df()
    assert sorted(got.columns) == sorted(wanted.columns)
    assert normal(got) == normal(wanted)


@pytest.mark.parametrize("name, rows", [("model_grid", 9), ("next_step", 5)])
def test_fitted_queries(spark, name, rows):
    assert QUERIES[name](spark, SF).count() == rows
