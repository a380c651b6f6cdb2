import json

import pytest
from pyspark.sql import functions as F

from tripweave import schemas
from tripweave.operators import domain, legacy
from tripweave.sources import raw



def tour_record(number, kind, title, east, north, **more):
    return {"contentid": str(number), "contenttypeid": kind, "title": title, "mapx": str(east), "mapy": str(north), **more}


# An invented coastal town: one usable sight, a restaurant and a route (both excluded), one festival, one month.
GARAM = {
    "meta": {"city_name_en": "Garam", "city_name_ko": "가람시", "province": "충청남도", "lDongRegnCd": "44", "lDongSignguCd": "925", "sigungus_included": ["북면", "남면"]},
    "attractions": [
        7,
        tour_record(7301, "12", "물빛등대", 126.31, 36.87, _assigned_theme="seaside", lclsSystm3="NA020900",
                    detail={"common": {"overview": "\t밤에 빛난다 "}, "intro": {"infocenterculture": "041-555-0137"}}),
        tour_record(7302, "25", "둘레 코스", 126.33, 36.88),
        tour_record(7303, "39", "조개 부엌", 126.35, 36.9, detail={"intro": {"opentimefood": "11-20"}}),
    ],
    "festivals": [
        {"contentid": "8850", "title": "갯벌 잔치", "mapx": "126.4", "mapy": "36.8",
         "detail": {"common": {"lclsSystm3": "EV010100"}, "intro": {"eventstartdate": "20260718", "eventenddate": "20260720", "eventplace": "모래 광장", "program": "  "}}},
    ],
    "visitor_statistics": {"year": "2024", "annual_totals": {"locals": 40.25}, "monthly_statistics": ["x", {"month": "2024-06", "days": 30, "locals_total": 12.75}, {"month": "June"}]},
}


def payloads(spark, *bodies):
    rows = [(f"f{i}.json", b if isinstance(b, str) else json.dumps(b, ensure_ascii=False)) for i, b in enumerate(bodies)]
    return raw.parse_payloads(spark.createDataFrame(rows, "source_key string, body string"))


@pytest.fixture(scope="module")
def items(spark):
    return domain.domain_items(payloads(spark, GARAM)).cache()


def test_summary(items):
    row = domain.quality_summary(items).first()
    counts = {b: row[b] for b in schemas.BUCKETS}
    assert counts == {"city_metadata": 1, "visitor_statistics": 1, "attractions": 1, "festivals": 1, "review": 2, "failed": 0, "load_items": 4}
    assert (row["city_id"], row["city_name_en"]) == ("KR-44-925", "Garam")


def test_attraction(items):
    view = domain.entity_view(items, "attraction")
    assert set(view.columns) == set(schemas.ATTRACTION_COLUMNS)
    row = view.first()
    assert row["SK"] == "ATTRACTION#7301" and row["entity_id"] == "ATT-7301" and row["PK"] == "CITY#Garam"
    assert (row["attraction_subtype_code"], row["attraction_subtype_name"], row["classification_mapping_version"]) == ("NA020900", "등대, 포구, 항구", "2026-06-23")
    assert row["phone"] == "041-555-0137" and row["description"] == "밤에 빛난다" and row["theme_tags"] == ["seaside"]
    assert row["quality_status"] == "passed" and row["review_queues"] == [] and row["province_key"] == "PROVINCE#충청남도"


def test_festival(items):
    row = domain.entity_view(items, "festival").first()
    assert (row["SK"], row["gsi_sk"], row["event_start_date"], row["season"]) == ("FESTIVAL#8850", "FESTIVAL#07#8850", "2026-07-18", "summer")
    assert (row["source_subtype_name"], row["source_theme"], row["theme"], row["venue"]) == ("문화관광축제", "예술·감성", "예술·감성", "모래 광장")
    assert row["contenttypeid"] == "15" and row["visit_months"] == [7] and row["program"] is None


def test_city_and_statistics(items):
    city = domain.entity_view(items, "city_metadata").first()
    assert (city["SK"], city["entity_id"], city["sigungus_included"]) == ("METADATA#city", "CITY-KR-44-925", ["북면", "남면"])
    stat = domain.entity_view(items, "visitor_statistics").first()
    assert (stat["SK"], stat["month"], stat["year"], stat["days"], stat["locals_total"]) == ("STAT#202406", "202406", 2024, 30, 12.75)
    assert stat["annual_totals"] == {"locals": 40.25}


def test_excluded_goes_to_review_only(items):
    rows = items.where("entity_type = 'excluded'").select("SK", "buckets", "review_queues").collect()
    assert {r["SK"] for r in rows} == {"EXCLUDED#7302", "EXCLUDED#7303"}
    assert all(r["buckets"] == ["review"] and r["review_queues"] == ["source_review"] for r in rows)


def test_failures_and_reviews(spark):
    payload = {"meta": {"city_id": "9"}, "attractions": [
        {"contentid": "", "contenttypeid": "12", "title": "a"},
        {"contentid": "1", "contenttypeid": "14", "title": "b", "mapx": "0", "mapy": "0", "cat3": "x", "lclsSystm3": "EV010100"},
        {"contenttypeid": "39", "title": "c", "mapx": "127", "mapy": "36"},
    ], "festivals": [{"contentid": "2", "title": "d", "contenttypeid": None, "mapx": "127", "mapy": "36", "lclsSystm3": "ZZ"}]}
    out = {r["title"]: r for r in domain.domain_items(payloads(spark, payload)).collect() if r["title"]}
    assert out["a"]["quality_status"] == "failed" and out["a"]["buckets"] == ["failed"]
    assert out["a"]["review_queues"] == ["missing_contentid", "location_review", "theme_review", "classification_review"]
    assert out["b"]["review_queues"] == ["location_review", "classification_review"] and out["b"]["attraction_subtype_code"] is None
    assert out["b"]["buckets"] == ["attractions", "load_items", "review"] and out["b"]["longitude"] == 0.0
    assert out["c"]["SK"] == "EXCLUDED#UNKNOWN" and out["c"]["quality_status"] == "review"
    assert out["d"]["entity_type"] == "festival" and out["d"]["contenttypeid"] is None and out["d"]["review_queues"] == ["classification_review"]
    assert out["d"]["city_id"] == "KR-9" and out["d"]["city_name_en"] == "UNKNOWN" and out["d"]["province_key"] == "PROVINCE#UNKNOWN"


def test_bad_files_and_odd_shapes(spark):
    p = payloads(spark, "[1]", "{bad", {"attractions": {"x": 1}, "meta": [1], "visitor_statistics": [{"month": "202501"}]})
    assert {r["source_key"] for r in raw.failed_files(p).collect()} == {"f0.json", "f1.json"}
    rows = domain.domain_items(p).collect()
    assert [(r["entity_type"], r["city_id"]) for r in rows] == [("city_metadata", "KR-UNKNOWN")]
    record = legacy.city_records(p).first()
    assert (record["attraction_count"], record["visitor_statistics_count"]) == (0, 1)


def test_one_parse_and_no_shuffle(items, spark):
    plan = domain.domain_items(payloads(spark, GARAM))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and plan.count("parseJson(") <= 1


def test_legacy_transform(spark):
    payload = dict(GARAM, visitor_statistics=[{"month": "2026-01"}, {"month": "x"}])
    payload["attractions"] = [
        {"contentid": "1", "contenttypeid": "12", "title": "a", "mapx": "128", "mapy": "36", "cat3": "t", "tel": None},
        {"contentid": "2", "contenttypeid": "39", "title": "b", "mapx": "128", "mapy": "36", "cat3": "t"},
        {"contentid": "3", "contenttypeid": "15", "title": "c", "mapx": "0", "mapy": "0", "cat3": "t", "tel": "1", "eventstartdate": "2026.01.31", "eventenddate": "2026-03-02"},
    ]
    payload["festivals"] = []
    rows = legacy.transform_records(payloads(spark, payload)).collect()
    by_id = {r["content_id"]: r for r in rows if r["content_id"]}
    assert by_id["1"]["quality_status"] == "passed"
    assert by_id["2"]["review_queues"] == ["contact_review"] and by_id["2"]["SK"] == "ATTRACTION#2"
    assert by_id["3"]["visit_months"] == [1, 2, 3] and by_id["3"]["review_queues"] == ["location_review"]
    assert (by_id["3"]["eventstartdate"], by_id["3"]["season"], by_id["3"]["entity_id"]) == ("2026-01-31", "winter", "FEST-3")
    stats = {r["SK"]: r for r in rows if r["entity_type"] == "visitor_statistics"}
    assert stats["STAT#202601"]["statistics"] == {"month": "2026-01"} and stats["STAT#UNKNOWN"]["quality_status"] == "failed"
    status = legacy.file_status(legacy.transform_records(payloads(spark, payload))).first()
    assert (status["passed_count"], status["review_count"], status["failed_count"], status["status"]) == (2, 2, 1, "failed")
    summary = legacy.run_summary(spark.createDataFrame([("a", "passed"), ("b", "review")], "source_key string, status string")).first()
    assert (summary["status"], summary["status_code"], summary["review_count"]) == ("ok", 200, 1)


def test_missing_meta_fails_the_file(spark):
    rows = legacy.transform_records(payloads(spark, {"attractions": []})).collect()
    assert [(r["entity_type"], r["quality_status"], r["message"]) for r in rows] == [("city", "failed", "Missing meta block")]


def test_legacy_load_rows(spark):
    doc = {"status": "passed", "city_record": {"city_id": "KR-1", "city_name_en": "A", "province": "P"}, "records": [
        {"entity_type": "festival", "entity_id": "FEST-7", "content_id": "7", "eventstartdate": "2025-07-01"},
        {"entity_type": "visitor_statistics", "month": "202501", "entity_id": "s"},
        {"content_id": "8"}, 5,
    ]}
    files = spark.createDataFrame([("x", json.dumps(doc))], "source_key string, value string")
    rows = {r["pos"]: r for r in legacy.load_rows(files).collect()}
    assert (rows[0]["SK"], rows[0]["domain_sort_key"], rows[0]["source_status"], rows[0]["province_key"]) == ("METADATA#city", "city#KR-1", "passed", "P")
    assert (rows[1]["SK"], rows[1]["gsi_sk"], rows[1]["domain_sort_key"]) == ("FESTIVAL#7", "FESTIVAL#07#7", "festival#7")
    assert (rows[2]["SK"], rows[2]["domain_sort_key"]) == ("STAT#202501", "visitor_statistics#s")
    assert rows[3]["error"] == "entity_type is required" and rows[4]["error"] == "record is not an object"
    plan = legacy.load_plan(files, "t").first()
    assert (plan["status"], plan["city_id"], plan["record_count"]) == ("passed", "KR-1", 4)


def test_festival_type_from_attractions_list(spark):
    payload = {"meta": {"city_name_en": "A"}, "attractions": [{"contentid": "1", "contenttypeid": "15", "title": "x", "mapx": "127", "mapy": "36", "lclsSystm3": "EV010200"}]}
    row = domain.domain_items(payloads(spark, payload)).where(F.col("content_id") == "1").first()
    assert (row["entity_type"], row["gsi_sk"], row["month"]) == ("festival", "FESTIVAL#00#1", None)
