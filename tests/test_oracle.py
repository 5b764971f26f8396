"""Every registered query against its DuckDB oracle at sf0.01."""

import pytest

from tests.compare import compare

import __spark_entry__ as entry_mod

from tickroll.plans.catalog import QUERIES as OWN

# the training-data queries have tests of their own
QUERIES = {k: q for k, q in entry_mod.queries().items() if k in OWN}
ORACLES = {k: q for k, q in entry_mod.oracle_sql().items() if k in OWN}


SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
                 "boolean": "BOOLEAN", "date": "DATE"}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, duck, name):
    from tests.conftest import SF
    df = QUERIES[name](spark, SF)
    spark_types = {f.name: SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString())
                   for f in df.schema.fields}
    duck_types = {r[0]: r[1] for r in duck.execute(f"DESCRIBE {ORACLES[name]}").fetchall()}
    assert spark_types == duck_types
    got = df.toPandas()
    want = duck.execute(ORACLES[name]).df()
    compare(got, want)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES) and len(QUERIES) >= 70


def test_entry_smoke(spark):
    df = entry_mod.entry(spark)
    assert df.count() > 0
