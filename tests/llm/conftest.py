from __future__ import annotations

import os

import duckdb
import pytest
from pyspark.sql import types as T

from barwright.llm.ship import ship

SF = "/root/testdata/sf0.001"
DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())])


@pytest.fixture(autouse=True)
def shipped(spark):
    ship(spark)


@pytest.fixture
def make_docs(spark):
    """A table of (doc_id, text, ...) with extra columns whose names operators use inside."""

    def make(rows, **extra):
        kind = {int: T.LongType(), str: T.StringType(), float: T.DoubleType()}
        more = [T.StructField(n, kind[t]) for n, t in extra.items()]
        return spark.createDataFrame(rows, T.StructType([*DOCS, *more]))

    return make


@pytest.fixture
def duck():
    """The tables of a folder as views."""

    def connect(folder):
        con = duckdb.connect()
        for name in os.listdir(folder):
            con.execute(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM '{folder}/{name}'")
        return con

    return connect


def plain(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: [(x is None, str(type(x)), x if x is not None else 0) for x in r])
