import datetime
import json
import os

from pyspark.sql import functions as F

from tests_data import GARAM, cities
from tripweave.operators import domain
from tripweave.plans import jobs
from tripweave.sources import dimensions, raw, sinks


def write_raw(folder, **bodies):
    folder.mkdir(parents=True, exist_ok=True)
    for name, body in bodies.items():
        (folder / f"{name}.json").write_text(body if isinstance(body, str) else json.dumps(body, ensure_ascii=False), encoding="utf-8")
    return str(folder)


def embedder():
    # A closure, as Python workers cannot import the test module.
    def embed(texts):
        return [ValueError("no") if "물빛" in text else [float(len(text)), 1.0] for text in texts]

    return embed


def test_preprocess_load_and_index(spark, tmp_path):
    source = write_raw(tmp_path / "raw", garam=GARAM, bad="[]")
    out = str(tmp_path / "out")
    done = jobs.preprocess_domain(spark, source, out)
    assert done["failed_files"].count() == 1 and done["summary"].first()["load_items"] == 4
    processed = spark.read.parquet(f"{out}/items").where("bucket = 'load_items'").drop("bucket")
    # The stored layout keeps every output apart.
    assert spark.read.parquet(f"{out}/items").where("bucket = 'review'").count() == 2
    result = jobs.load_and_index(spark, processed, str(tmp_path / "store"), 1, ["source_key", "SK"], embedder(), "index", dimension=2)
    assert result["load"].first()["loaded"] == 4
    assert result["summary"].first().asDict() == {"items_processed": 3, "items_upserted": 2, "items_skipped": 1, "status_code": 207}
    assert result["verdict"].first()["verdict"] == "FAIL" and result["errors"].count() == 1
    assert {r["key"] for r in result["records"].collect()} == {"city#CITY-KR-44-925#0", "festival#8850#0"}
    regional = jobs.build_vectors(sinks.current_items(spark, str(tmp_path / "store")), embedder(), "i", dimension=2, provinces=["강원"])
    assert regional["summary"].first()["items_processed"] == 0
    profile = jobs.profile_table(sinks.current_items(spark, str(tmp_path / "store")))
    assert profile["provinces"].first()["item_count"] == 4
    removed = jobs.clean_table(spark, str(tmp_path / "store"), str(tmp_path / "published"), 1, ["PROVINCE#충청남도"])
    assert removed.count() == 0
    published = sinks.read_published(spark, str(tmp_path / "published"))
    assert published.count() == 4 and {p.name for p in (tmp_path / "published" / "version=1").glob("entity_type=*")} == {f"entity_type={t}" for t in ("attraction", "festival", "city_metadata", "visitor_statistics")}


def test_legacy_jobs(spark, tmp_path):
    source = write_raw(tmp_path / "raw", garam=GARAM, bad="[]")
    done = jobs.transform_legacy(spark, source, str(tmp_path / "out"), "20260101")
    assert done["summary"].first().asDict() == {"city_processed": 2, "review_count": 0, "failed_count": 2, "status": "partial", "status_code": 207}
    assert {p.name for p in (tmp_path / "out" / "ingest_date=20260101").iterdir()} == {"quality_status=passed", "quality_status=review", "quality_status=failed"}
    doc = {"status": "passed", "city_record": {"city_id": "1", "city_name_en": "A"}, "records": [{"entity_type": "attraction", "content_id": "1"}, {"x": 1}]}
    processed = write_raw(tmp_path / "processed", a=doc)
    summary = jobs.load_legacy(spark, processed, str(tmp_path / "store"), 1)["summary"].first()
    assert (summary["loaded"], summary["load_failed"], summary["status_code"]) == (2, 1, 207)
    assert sinks.current_items(spark, str(tmp_path / "store")).count() == 2


def test_visitor_jobs(spark, tmp_path):
    day = datetime.date
    daily = spark.createDataFrame([("1", day(2025, 1, 1), 1, 2.0), ("2", day(2025, 1, 1), 1, 2.0), ("1", day(2024, 1, 1), 1, 9.0)], "signgu_code string, date date, tou_div_cd int, tou_num double")
    districts = spark.createDataFrame([("1", "A", "P"), ("2", "B", "P")], "code string, city_name_en string, province_id string")
    monthly = jobs.collect_visitors(daily, districts, 2025)
    assert monthly.count() == 24
    again = jobs.collect_visitors(daily, districts, 2025, monthly.where("city_name_en = 'A'"))
    assert again.count() == 24
    meta = spark.createDataFrame([("A", "x", 1), ("C", "y", 2)], "city_name_en string, t string, pos int")
    counts = jobs.finalise_cities(meta, "pos", monthly.union(monthly.withColumn("year", F.lit(2024))), str(tmp_path / "final"), 2025).first()
    assert counts.asDict() == {"merged_count": 1, "wikipedia_only_count": 1, "visitor_only_count": 1, "total": 3}
    assert {p.name for p in (tmp_path / "final").iterdir() if p.is_dir()} == {"city_name_en=A", "city_name_en=B", "city_name_en=C"}


def numbered(records):
    return records.withColumn("seq", F.monotonically_increasing_id())


def test_city_jobs(spark, tmp_path):
    path = str(tmp_path / "cities")
    assert jobs.merge_city_dataset(spark, path, numbered(cities(spark, {}, {"city_id": "B", "prefecture_id": ""}))) == 1
    assert jobs.merge_city_dataset(spark, path, numbered(cities(spark, {"description": "첫"}, {"description": "새"}))) == 2
    current = sinks.read_published(spark, path)
    assert current.count() == 2 and current.where("city_id = 'KR-11-SEOUL'").first()["description"] == "새"
    reviewed = jobs.review_cities(current)
    assert reviewed["review"].count() == 1 and reviewed["reasons"].first()["entry_count"] == 1 and reviewed["counters"].first()["records_processed"] == 2
    pages = spark.createDataFrame([('<h1 id="firstHeading">모래시</h1><div class="mw-parser-output"><p>전라남도의 포구.</p></div>', "")], "html string, prefecture_id string")
    names = spark.createDataFrame([("모래시", "MORAE")], "city_name_ko string, city_name_en string")
    acquired = jobs.acquire_korean_cities(pages, names, F.lit("t"))
    assert [r["city_id"] for r in acquired["cities"].collect()] == ["KR-46-MORAE"] and acquired["provinces"].count() == 1
    both = jobs.acquire_korean_cities(pages, names, F.lit("u"), acquired["cities"])
    assert [r["collected_at"] for r in both["cities"].collect()] == ["u"]


def test_region_and_harvest_jobs(spark):
    records = spark.createDataFrame([("가", "attraction", None, "A1", None), ("가", "festival", None, "F1", None), ("가", "festival", None, "Z", None)], "city_name_ko string, kind string, lclsSystm1 string, lclsSystm3 string, cat3 string")
    themes = spark.createDataFrame([("A1", "t"), ("F1", "t")], "code string, theme string")
    lookup = spark.createDataFrame([("가", "GA")], "city_name_ko string, city_name_en string")
    out = jobs.filter_region(records, themes, themes, lookup)
    assert out["records"].count() == 2 and out["cities"].first()["city_name_en"] == "GA" and out["cities"].first()["festivals_count_raw"] == 2
    inventory = spark.createDataFrame([("data/GA.json", '{"attractions": [{"contentid": "1"}]}')], "path string, j string").select("path", F.parse_json("j").alias("payload"))
    targets = dimensions.city_targets(spark.createDataFrame([("1", "가", "GA", "P")], "city_id string, city_name_ko string, city_name_en string, prefecture_id string"))
    cache = spark.createDataFrame([("1", '{"a": 1}')], "content_id string, j string").select("content_id", F.parse_json("j").alias("detail"))
    harvested = jobs.harvest_city_details(targets, inventory, cache)
    assert harvested["cities"].first()["attractions_count_filtered"] == 1
    assert harvested["records"].first()["field_status"]["detail"] == "collected"


def test_image_and_ingest_jobs(spark, tmp_path):
    records = spark.createDataFrame([("C", 0, 0, "1", "푸른정자", "http://x/a.jpg", "")], "city string, grp int, pos int, contentid string, title string, firstimage string, firstimage2 string")
    nothing = spark.createDataFrame([], "city string, file_name string")
    audit = jobs.audit_images(records, nothing, spark.createDataFrame([("C", "Pureunjeongja_1.jpg", "404")], "city string, file_name string, error string"))
    assert audit["missing"].first()["recovery"] == "failed" and audit["summary"].where("city = 'C'").first()["failed"] == 1
    rows = spark.createDataFrame([("C", 0, "1", "x", "attraction", None, None)], "city_name_en string, pos int, content_id string, title string, entity_type string, image_url string, firstimage string")
    review = jobs.review_images(rows, spark.createDataFrame([], "city_name_en string, pos int, error string"), "b")
    assert review["report"].first()["status"] == "partial" and review["reasons"].first()["entry_count"] == 1
    source = write_raw(tmp_path / "raw", a={"meta": {"city_name_en": "A"}}, b={"meta": {"city_name_en": "B"}})
    none = spark.createDataFrame([], "s3_key string, checksum_sha256 string")
    first = jobs.ingest_raw(spark, source, str(tmp_path / "zone"), "20260101", none, 1)
    assert [r["status"] for r in first.collect()] == ["uploaded", "uploaded"]
    second = jobs.ingest_raw(spark, source, str(tmp_path / "zone"), "20260101", first.select("s3_key", "checksum_sha256"), 2)
    assert [r["status"] for r in second.collect()] == ["skipped", "skipped"] and jobs.ingested_bodies(spark, str(tmp_path / "zone")).count() == 2


def test_model_jobs_and_stages(spark):
    items = domain.domain_items(raw.parse_payloads(spark.createDataFrame([("f", json.dumps(GARAM))], "source_key string, body string")))
    enriched = jobs.run_enrichment(items.where("entity_type = 'attraction'"), lambda prompts: ['{"vibe_tags": ["calm"]}'] * len(prompts))
    assert [tuple(r) for r in enriched["counts"].collect()] == [("succeeded", 1)]
    themed = jobs.run_classification(items.where("entity_type = 'festival'"), lambda prompts: ["{}"] * len(prompts))
    assert [tuple(r) for r in themed["counts"].collect()] == [("review_required", 1)] and themed["failed"].count() == 0
    frames = jobs.run_stages({"n": spark.range(3)}, [lambda f: {"m": f["n"].where("id > 0")}, lambda f: {"k": f["m"].limit(1)}])
    assert frames["m"].count() == 2 and frames["k"].count() == 1 and frames["n"].count() == 3


def test_steps_of_a_scope_are_deleted(spark):
    from tripweave import session

    outside = session.saved(spark.range(3), "kept")
    with session.work_scope(spark, "scope"):
        inside = session.saved(spark.range(5), "step")
        with session.work_scope(spark, "inner"):
            deeper = session.saved(inside, "step").inputFiles()[0]
        kept = session.saved(inside, "result")
        path = inside.inputFiles()[0]
        assert inside.count() == kept.count() == 5 and "/scope-" in path and "/inner-" in deeper
    assert not os.path.exists(path.removeprefix("file://")) and not os.path.exists(deeper.removeprefix("file://"))
    assert outside.count() == 3 and os.path.exists(outside.inputFiles()[0].removeprefix("file://"))
