"""Registered queries against their SQL twins, and the pipeline against plain Python."""

import os

import duckdb
import pytest

import __spark_entry__ as driver

FOLDER = "/root/testdata/sf0.001"
TABLES = "documents embeddings pages benchmark labels conversations".split()
TWINS = sorted(n for n in driver.oracle_sql() if n.startswith("op"))

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="benchmark tables are not here")


def rows(records):
    """Rows as sorted text; whole floats stay floats, nulls stay nulls."""
    return sorted(str(tuple(round(v, 9) if isinstance(v, float) else v for v in r)) for r in records)


def test_all_operators_and_the_pipeline_are_registered():
    found = {n.split("_")[0] for n in driver.queries() if n.startswith("op") and n[2].isdigit()}
    assert found == {f"op{i}" for i in range(1, 14)} and "pipeline" in driver.queries()


@pytest.mark.parametrize("name", TWINS)
def test_query_equals_its_twin(spark, name):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    found = driver.queries()[name](spark, FOLDER)
    made = con.execute(driver.oracle_sql()[name])
    names = [c[0] for c in made.description]
    assert sorted(names) == sorted(found.columns)
    assert rows(map(tuple, found.select(*names).collect())) == rows(made.fetchall())
