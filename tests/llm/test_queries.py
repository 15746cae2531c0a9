"""Every query on training records that SQL can express against DuckDB over the smallest tables."""

from __future__ import annotations

import pytest

from tests.test_queries import duck, rows_of  # noqa: F401
from tidewright.llm import queries


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query(spark, small_dir, duck, name):  # noqa: F811
    made = queries.queries()[name](spark, small_dir)
    found = duck.execute(queries.oracle_sql()[name])
    columns = [d[0] for d in found.description]
    assert sorted(made.columns) == sorted(columns)
    assert rows_of(made.columns, [tuple(r) for r in made.collect()]) == rows_of(columns, found.fetchall())
