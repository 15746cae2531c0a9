"""Every query with SQL against DuckDB over the smallest tables."""

from __future__ import annotations

import glob
import os
from collections import Counter

import duckdb
import pytest

from tidewright.plans import catalog


def normal(value):
    if value is None or (isinstance(value, float) and value != value):
        return None
    return f"{value:.9g}" if isinstance(value, float) else str(value)


def rows_of(columns, rows):
    order = [columns.index(c) for c in sorted(columns)]
    return Counter(tuple(normal(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def duck(small_dir):
    connection = duckdb.connect()
    connection.execute("SET timezone='UTC'")
    for path in glob.glob(f"{small_dir}/*.parquet"):
        connection.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM read_parquet('{path}')")
    return connection


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_query(spark, small_dir, duck, name):
    made = catalog.queries()[name](spark, small_dir)
    found = duck.execute(catalog.oracle_sql()[name])
    columns = [d[0] for d in found.description]
    assert sorted(made.columns) == sorted(columns)
    assert rows_of(made.columns, [tuple(r) for r in made.collect()]) == rows_of(columns, found.fetchall())


def test_tokenizer_counts(spark, small_dir):
    """SQL cannot count these tokens; the library can."""
    from tokenizers import Tokenizer

    from tidewright.plans.catalog_records import TOKENIZERS

    path = f"{TOKENIZERS}/byte_bpe_50k.json"
    if not os.path.exists(path):
        pytest.skip("no tokenizer file")
    loaded = Tokenizer.from_file(path)
    got = {r["doc_id"]: r["token_count"] for r in catalog.queries()["tokenizer_counts"](spark, small_dir).collect()}
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{small_dir}/documents.parquet").collect()}
    assert got == {k: len(loaded.encode(t or "", add_special_tokens=False).ids) for k, t in texts.items()}
    assert set(catalog.queries()) - set(catalog.oracle_sql()) == {"tokenizer_counts"}
