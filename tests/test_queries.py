"""Registered queries that store, search or infer, against their SQL twins, value by value."""

import os
from datetime import date, datetime
from decimal import Decimal

import duckdb
import pytest

import __spark_entry__ as driver

FOLDER = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
NAMES = [
    "geohash_places", "places_within_radius", "graph_expansion", "quota_search", "evidence", "city_scores", "theme_profiles", "similar_cities",
    "recurrence_rules", "next_festivals", "crowding_scores", "crowding_sketch", "contact_overrides", "store_batches", "store_conditional",
    "store_history", "legacy_job", "load_items_job", "load_legacy_job", "load_and_index_job", "regional_vectors", "clean_table_job",
    "stream_files", "csv_export", "report_files", "tokyo_names", "staged_run", "region_targets", "required_files",
]

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="benchmark tables are not here")


def plain(value):
    if isinstance(value, (Decimal, float)):
        return round(float(value), 9)
    return str(value) if isinstance(value, (date, datetime)) else value


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_its_twin(spark, name):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    found = driver.queries()[name](spark, FOLDER)
    columns = sorted(found.columns)
    want = con.execute(f"SELECT {', '.join(f'"{c}"' for c in columns)} FROM ({driver.oracle_sql()[name]}) q").fetchall()
    got = found.select(*columns).collect()
    assert sorted((tuple(map(plain, r)) for r in got), key=str) == sorted((tuple(map(plain, r)) for r in want), key=str) and got


def test_batches_of_the_file_stream_read_saved_classes(spark, monkeypatch):
    from tripweave.workloads import run_queries

    seen = []

    def stop(session, path, store, checkpoint, classes, files):
        seen.append(classes.inputFiles())
        raise KeyError("enough")

    monkeypatch.setattr(run_queries.ingest, "ingest_raw_files", stop)
    with pytest.raises(KeyError, match="enough"):
        driver.queries()["stream_files"](spark, FOLDER)
    assert seen[0] and not any(f.endswith("/part.parquet") for f in seen[0])
