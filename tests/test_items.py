import json
import os

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripweave.operators import keyvalue
from tripweave.sources import raw, sinks


def rows(spark, *data):
    return spark.createDataFrame(list(data), "PK string, SK string, title string, seq int")


def test_upsert_last_write_wins(spark):
    old = rows(spark, ("a", "1", "old", 0), ("b", "1", "keep", 0)).drop("seq").withColumn("extra", F.lit("x"))
    new = rows(spark, ("a", "1", "n2", 2), ("a", "1", "n1", 1), ("c", "1", "new", 3), ("", "1", "bad", 4), (None, "2", "bad", 5))
    out = {(r["PK"], r["SK"]): (r["title"], r["extra"]) for r in keyvalue.upsert(old, new, ["seq"]).collect()}
    assert out == {("a", "1"): ("n2", None), ("b", "1"): ("keep", "x"), ("c", "1"): ("new", None)}
    assert keyvalue.load_summary(new).first().asDict() == {"loaded": 3, "load_failed": 2, "status_code": 207}
    assert keyvalue.load_failures(new, 1).count() == 1


def test_upsert_of_a_hot_key_combines_before_the_shuffle(spark):
    hot = spark.range(60_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("PK"),
        F.lit("s").alias("SK"), F.col("id").alias("seq"), F.col("id").cast("string").alias("title"),
    )
    existing = hot.limit(0).drop("seq")
    out = keyvalue.upsert(existing, hot, ["seq"])
    assert out.count() == 40_001
    assert out.where("PK = 'hot'").first()["title"] == "59997"
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("partial_max_by") >= 1 and "Window" not in plan


def test_store_batches_are_idempotent(spark, tmp_path):
    store = str(tmp_path / "store")
    sinks.append_batch(rows(spark, ("a", "1", "v1", 1), ("a", "2", "v1", 2)), store, 1, ["seq"])
    sinks.append_batch(rows(spark, ("a", "1", "v2", 1), ("a", "1", "v3", 2)), store, 2, ["seq"])
    sinks.append_batch(rows(spark, ("a", "1", "v2", 1), ("a", "1", "v3", 2)), store, 2, ["seq"])
    stored = sinks.current_items(spark, store)
    assert {(r["SK"], r["title"]) for r in stored.collect()} == {("1", "v3"), ("2", "v1")}
    plan = stored.where("PK = 'a'")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(PK), EqualTo(PK,a)]" in plan


def test_published_versions(spark, tmp_path):
    path = str(tmp_path / "table")
    assert sinks.read_published(spark, path) is None
    items = rows(spark, ("a", "1", "x", 0)).withColumn("entity_type", F.lit("festival"))
    sinks.publish_items(items, path, 1)
    sinks.publish_items(items.withColumn("title", F.lit("y")), path, 2)
    os.remove(tmp_path / "table" / "version=2" / "_SUCCESS")
    assert sinks.latest_version(spark, path) == 1
    assert sinks.read_published(spark, path).first()["title"] == "x"


def test_queries(spark):
    data = [("CITY#A", f"STAT#2025{m:02d}", None, None) for m in range(1, 13)]
    data += [("CITY#A", "FESTIVAL#1", "FESTIVAL#10#1", "succeeded"), ("CITY#A", "FESTIVAL#2", "FESTIVAL#10#2", "failed"), ("CITY#A", "FESTIVAL#3", "FESTIVAL#01#3", "succeeded")]
    items = spark.createDataFrame(data, "PK string, SK string, gsi_sk string, s string").select(
        "PK", "SK", "gsi_sk", F.when(F.col("gsi_sk").isNotNull(), "festival").otherwise("visitor_statistics").alias("entity_type"),
        F.struct(F.col("s").alias("status")).alias("festival_theme_classification"),
    )
    assert [r["SK"] for r in keyvalue.city_items_between(items, "CITY#A", "STAT#202503", "STAT#202505").collect()] == ["STAT#202503", "STAT#202504", "STAT#202505"]
    assert [r["SK"] for r in keyvalue.festivals_in_month(items, 10).collect()] == ["FESTIVAL#1"]
    assert keyvalue.festivals_in_month(items, 10, None).count() == 2 and keyvalue.festivals_in_month(items, 1).count() == 1
    assert keyvalue.city_items(items, "CITY#A", "FEST").count() == 3 and keyvalue.get_item(items, "CITY#A", "STAT#202501").count() == 1


def test_backfill_and_cleanup(spark):
    items = spark.createDataFrame(
        [("CITY#A", "festival", "7", None, "P1", None, "2025-07-01", None), ("CITY#A", "attraction", "8", "k", "P1", "PROVINCE#P2", "", "kept"), (None, "x", "", None, "", None, "", None)],
        "PK string, entity_type string, content_id string, entity_id string, province string, province_key string, eventstartdate string, domain_sort_key string",
    ).withColumn("month", F.lit(None).cast("string")).withColumn("city_key", F.lit("old")).withColumn("gsi_sk", F.lit("old"))
    out = keyvalue.backfill_index_keys(items).collect()
    assert (out[0]["gsi_sk"], out[0]["province_key"], out[0]["domain_sort_key"]) == ("FESTIVAL#07#7", "P1", "festival#7")
    assert (out[1]["gsi_sk"], out[1]["domain_sort_key"], out[1]["city_key"]) == ("old", "kept", "old")
    assert (out[2]["city_key"], out[2]["province_key"], out[2]["domain_sort_key"]) == ("UNKNOWN", "UNKNOWN", "x#UNKNOWN")
    kept, removed = keyvalue.split_by_province(items, ["PROVINCE#P1"])
    assert kept.count() == 2 and [tuple(r) for r in keyvalue.removal_report(removed).collect()] == [("PROVINCE#P2", 1)]


def test_decimal_view(spark):
    df = spark.createDataFrame([(1, 0.1, [1.5], {"a": 2.25}, "x")], "i int, d double, l array<double>, m map<string,double>, s string")
    out = sinks.decimal_view(df, T.DecimalType(10, 2))
    assert dict(out.dtypes) == {"i": "int", "d": "decimal(10,2)", "l": "array<decimal(10,2)>", "m": "map<string,decimal(10,2)>", "s": "string"}
    assert str(out.first()["d"]) == "0.10"


def write(folder, name, content):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(content if isinstance(content, str) else json.dumps(content, ensure_ascii=False), encoding="utf-8")


def test_raw_files_and_manifest(spark, tmp_path):
    body = {"meta": {"city_name_en": "CHUNCHEON"}, "attractions": [{}], "festivals": [{}], "visitor_statistics": [{}]}
    write(tmp_path, "chuncheon.json", body)
    write(tmp_path, "b.json", {"visitor_statistics": {"a": 1, "b": 2}})
    write(tmp_path, "notes.txt", "x")
    assert raw.read_raw_files(spark, str(tmp_path)).count() == 2
    manifest = sinks.raw_manifest(sinks.read_file_bytes(spark, str(tmp_path)), F.lit("20260609"))
    row = {r["file_name"]: r for r in manifest.collect()}
    c = row["chuncheon.json"]
    assert (c["attraction_count"], c["festival_count"], c["visitor_statistics_count"]) == (1, 1, 1)
    assert c["s3_key"] == "raw/KR/details/20260609/CHUNCHEON.json" and c["byte_size"] == len(json.dumps(body))
    assert row["b.json"]["visitor_statistics_count"] == 2 and row["b.json"]["city_name_en"] == "b"
    previous = manifest.where("file_name = 'b.json'").select("s3_key", "checksum_sha256")
    status = {r["file_name"]: r["status"] for r in sinks.ingest_status(manifest, previous).collect()}
    assert status == {"chuncheon.json": "uploaded", "b.json": "skipped"}
    assert {r["status"] for r in sinks.ingest_status(manifest, previous, overwrite=True).collect()} == {"uploaded"}
    bad_date = sinks.raw_manifest(sinks.read_file_bytes(spark, str(tmp_path)), F.lit("2026"))
    assert {r["status"] for r in sinks.ingest_status(bad_date, previous).collect()} == {"failed"}
    required = sinks.required_files(spark, ["b.json", "c.json"], manifest)
    assert {(r["file_name"], r["status"], r["error"]) for r in required.collect()} == {("b.json", "found", None), ("c.json", "failed", "File not found: c.json")}


def test_json_lines(spark, tmp_path):
    write(tmp_path, "lines.json", '{"a": 1}\n{"a": 2}\n')
    assert raw.parse_payloads(raw.read_raw_files(spark, str(tmp_path), whole_files=False)).where("is_valid").count() == 2


def test_processed_files(spark, tmp_path):
    for date, content in (("20250101", {"n": 1}), ("20250301", [{"n": 2}, 5, {"n": 3}]), ("latest", {"n": 9})):
        write(tmp_path / f"ingest_date={date}", "x.json", content)
    write(tmp_path / "ingest_date=20250301", "y.json", {"records": [{"n": 4}]})
    write(tmp_path / "ingest_date=20250301", "bad.json", "{")

    def numbers(frame):
        return sorted(r[0] for r in frame.select(F.try_variant_get("item", "$.n", "int")).collect())

    assert numbers(raw.read_processed_files(spark, str(tmp_path))) == [2, 3, 4]
    assert numbers(raw.read_processed_files(spark, str(tmp_path), "20250101")) == [1]


def test_targets_and_dataset(spark):
    files = spark.createDataFrame([("t", '["A", {"title": "B", "lang": "ja"}, 5]'), ("u", "{")], "source_key string, value string")
    out = raw.page_targets(files, default_prefecture_id="KR-1").collect()
    assert [(r["title"], r["lang"], r["prefecture_id"], r["is_valid"]) for r in out if r["source_key"] == "t"] == [
        ("A", "ko", "KR-1", True), ("B", "ja", "KR-1", True), (None, "ko", "KR-1", False),
    ]
    assert [r["is_valid"] for r in out if r["source_key"] == "u"] == [False]
    docs = spark.createDataFrame(
        [("f", 0, '{"city_id": "1", "city_name_en": "old"}'), ("f", 1, '{"city_id": "1", "city_name_en": "new", "image_urls": [{"url": "u", "source": "s"}, {"url": "x"}, 3], "latitude": 37}'), ("f", 2, '{"city_name_en": "none"}')],
        "source_key string, pos int, j string",
    ).select("source_key", "pos", F.parse_json("j").alias("item"))
    row = raw.city_dataset(docs).collect()
    assert len(row) == 1 and row[0]["city_name_en"] == "new" and row[0]["latitude"] == 37.0
    assert [tuple(e) for e in row[0]["image_urls"]] == [("u", "s")] and row[0]["data_confidence"] == "medium" and row[0]["site_urls"] == []
