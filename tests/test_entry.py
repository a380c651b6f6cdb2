import os
import shutil
import subprocess
import sys

import duckdb
import pytest

import __spark_entry__ as driver

FOLDER = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
SAMPLE = [
    "domain_items", "legacy_records", "festival_dates", "visitor_calendar", "confidence_merge", "incoming_fold", "image_fold", "kv_upsert",
    "chunk_build", "vector_topk", "image_targets", "page_parse", "harvest_details", "stream_monthly", "festivals_of_october",
    "visitor_stream_late", "dataset_merge", "final_cities_years", "vector_build", "ingest_retry", "metadata_budget", "japanese_cities",
]

@pytest.fixture(scope="module", autouse=True)
def generated_code(spark):
    """Queries run as in production, with code generation."""
    before = spark.conf.get("spark.sql.codegen.wholeStage")
    spark.conf.set("spark.sql.codegen.wholeStage", "true")
    yield
    spark.conf.set("spark.sql.codegen.wholeStage", before)


pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="benchmark tables are not here")


def rows(frame):
    frame = frame[sorted(frame.columns)]
    return sorted(tuple("" if v is None or v != v else str(v) for v in r) for r in frame.itertuples(index=False))


def test_registry():
    assert set(driver.oracle_sql()) <= set(driver.queries()) and len(driver.queries()) > 100


def test_entry(spark):
    assert driver.entry(spark).columns == ["PK", "gsi_sk", "title"]


@pytest.mark.parametrize("left", [(), ("corpus_pipeline.py",)])
def test_entry_imports_without_the_optional_subpackage(tmp_path, left):
    """A copy without the optional folders registers all other queries, whether or not the pipeline's file is there."""
    root = os.path.dirname(os.path.abspath(driver.__file__))
    shutil.copytree(os.path.join(root, "tripweave"), tmp_path / "tripweave", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    for name in ("__spark_entry__.py", *(n for n in left if os.path.exists(os.path.join(root, n)))):
        shutil.copy(os.path.join(root, name), tmp_path)
    code = "import __spark_entry__ as d; print(len(d.queries()), 'pipeline' in d.queries())"
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, check=True)
    others = [n for n in driver.queries() if not (n.startswith("op") and n[2:3].isdigit()) and n != "pipeline"]
    assert done.stdout.split() == [str(len(others)), "False"]


@pytest.mark.parametrize("name", SAMPLE)
def test_query_equals_its_twin(spark, name):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    got = driver.queries()[name](spark, FOLDER).toPandas()
    want = con.execute(driver.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns) and rows(got) == rows(want)
