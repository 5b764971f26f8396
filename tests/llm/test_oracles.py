"""Every operator query with SQL against DuckDB, and the list of those without."""

import os

import duckdb
import pytest

from tests.compare import compare
from tests.llm.helpers import SF
from tickroll.llm.catalog import ORACLES, QUERIES

TYPES = {"bigint": "BIGINT", "string": "VARCHAR", "boolean": "BOOLEAN"}


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ("documents", "benchmark", "pages", "labels", "conversations", "embeddings"):
        if os.path.exists(f"{SF}/{t}.parquet"):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, con, name):
    df = QUERIES[name](spark, SF)
    assert {f.name: TYPES[f.dataType.simpleString()] for f in df.schema.fields} == {
        r[0]: r[1] for r in con.execute(f"DESCRIBE {ORACLES[name]}").fetchall()}
    compare(df.toPandas(), con.execute(ORACLES[name]).df())


def test_queries_without_sql_are_the_ones_tested_by_other_means():
    assert set(QUERIES) - set(ORACLES) == {"op4_toxicity", "op5_token_files", "op6_bpe", "op8_spans", "op10_url_filter", "op12_whitening"}
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
