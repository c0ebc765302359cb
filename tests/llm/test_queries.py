from __future__ import annotations

import re

import pytest

from barwright.llm import queries

from .conftest import SF


def value(x):
    return f"{x:.9g}" if isinstance(x, float) else str(x)


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_equals_its_sql(spark, duck, name):
    found = queries.QUERIES[name](spark, SF)
    expected = duck(SF).execute(queries.ORACLE[name])
    columns = [c[0] for c in expected.description]
    assert sorted(columns) == sorted(found.columns)
    mine = sorted([value(x) for x in r] for r in found.select(columns).collect())
    assert mine == sorted([value(x) for x in r] for r in expected.fetchall())


@pytest.mark.parametrize("name", ["op3_mixture", "op6_decontamination", "op7_url_filter", "op12_shards"])
def test_native_queries_run_no_python(spark, name):
    plan = queries.QUERIES[name](spark, SF)._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def test_every_operator_has_one_query():
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in queries.QUERIES) == list(range(1, 14))
