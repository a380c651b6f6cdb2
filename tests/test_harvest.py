import json

from pyspark.sql import functions as F

from tripweave.operators import harvest
from tripweave.sources import dimensions


def test_theme_filter(spark):
    mapping = spark.createDataFrame(
        [(0, "바다·해안", "A1", "x", "", ""), (1, "역사·전통", "A1", "y", "", ""), (2, "미식·노포", "A2", "클럽", "", ""), (3, "온천·휴양", "A3", "z", "체험관광", ""), (4, "제외", "A4", "z", "", ""), (5, "예술·감성", "A5", "z", "", "공연시설"), (6, "예술·감성", "", "z", "", "")],
        "ordinal int, theme string, code string, name string, large_category string, middle_category string",
    )
    themes = dimensions.theme_map(mapping)
    assert {tuple(r) for r in themes.collect()} == {("A1", "역사·전통")}
    assert dimensions.theme_map(mapping, excluded_themes=["역사·전통"]).first()["theme"] == "바다·해안"
    records = spark.createDataFrame([("1", None, "A1", None), ("2", "C01", "A1", None), ("3", "X", "", "A1"), ("4", "X", "A9", "A1"), ("5", "X", None, None)], "id string, lclsSystm1 string, lclsSystm3 string, cat3 string")
    assert {r["id"] for r in harvest.filter_by_theme(records, themes).collect()} == {"1", "3"}


def test_dimension_files(spark, tmp_path):
    (tmp_path / "c.json").write_text(json.dumps({"version": "v", "mappings": {"A": {"code": "A", "name": "n", "type": "Attraction", "theme": "t"}}}))
    assert tuple(dimensions.read_classification(spark, str(tmp_path / "c.json")).first()) == ("A", "n", "Attraction", "t", "v")
    (tmp_path / "s.json").write_text(json.dumps({"11110": {"city_name_ko": "종로구", "city_name_en": "JONGNO", "province_id": "KR-11"}, "x1": {"city_name_ko": "a", "city_name_en": "b"}, "22": {"city_name_ko": "a", "city_name_en": ""}}))
    assert [r["code"] for r in dimensions.read_sigungu_codes(spark, str(tmp_path / "s.json")).collect()] == ["11110"]
    (tmp_path / "t.json").write_text(json.dumps({"바다·해안": [{"code": "B1"}, 5], "모름": [{"code": "B2"}]}))
    assert [tuple(r) for r in dimensions.read_theme_map(spark, str(tmp_path / "t.json")).collect()] == [("B1", "바다·해안")]
    assert dimensions.provinces(spark).count() == 17 and dimensions.prefectures(spark).count() == 47 and dimensions.classification(spark).count() == 64


def test_targets(spark):
    cities = spark.createDataFrame([("kr-1", "가", "Seoul", ""), ("", "나", "x", "p"), ("KR-2", "다", "busan", "p")], "city_id string, city_name_ko string, city_name_en string, prefecture_id string")
    assert {r["city_id"] for r in dimensions.city_targets(cities).collect()} == {"kr-1", "KR-2"}
    assert dimensions.city_targets(cities, city_ids=["KR-1"]).first()["prefecture_id"] is None
    assert dimensions.city_targets(cities, city_names_en=["BUSAN"]).count() == 1
    districts = spark.createDataFrame([("51", "춘천시"), ("11", "종로구")], "lDongRegnCd string, lDongSignguNm string")
    assert dimensions.region_targets(districts).count() == 1
    import pytest

    with pytest.raises(ValueError):
        dimensions.region_targets(districts, ["종로구"])
    lookup = dimensions.city_name_lookup(cities.withColumn("ordinal", F.lit(1)))
    named = dimensions.with_english_name(spark.createDataFrame([("가",), ("새 도시",)], "city_name_ko string"), lookup)
    assert {r["city_name_en"] for r in named.collect()} == {"Seoul", "새_도시"}


def inventory(spark, **files):
    rows = [(p, json.dumps(b, ensure_ascii=False)) for p, b in files.items()]
    return spark.createDataFrame(rows, "path string, body string").select("path", F.parse_json("body").alias("payload"))


def test_sources_and_details(spark):
    targets = spark.createDataFrame(
        [("KR-1", "가시", "New City", "P"), ("KR-2", "나시", "Two", "P"), ("KR-3", "다시", "Three", "P"), ("KR-4", "라시", "", "P"), ("KR-5", "", "Five", "P")],
        "city_id string, city_name_ko string, city_name_en string, prefecture_id string",
    )
    files = inventory(spark, **{
        "data/raw/final/new_city.json": {"note": "no detail"}, "data/city/New_City_filtered.json": {"attractions": [{"contentid": "1", "title": "t", "mapx": "127", "mapy": "36", "_assigned_theme": "x"}], "attractions_count_filtered": 9},
        "data/New City.json": {"items": []}, "data/Two.json": {"plain": 1}, "else/a.json": {"city_name_en": "two", "records": []},
        "else/b.json": {"meta": {"city_name_ko": "다시"}, "records": [{"contentid": "5", "contenttypeid": "15"}, {"contentId": "6", "detail": {"common": {"tel": "0"}}}, 7]},
        "else/c.json": {"id": "", "meta": {"city_name_en": ""}, "items": [{}]},
    })
    sources = harvest.resolve_sources(targets, files)
    assert {(r["city_id"], r["path"]) for r in sources.collect()} == {("KR-1", "data/city/New_City_filtered.json"), ("KR-3", "else/b.json")}
    details = {r["city_id"]: r for r in harvest.city_details(targets, sources, files).collect()}
    assert len(details) == 5 and details["KR-1"]["attractions_count_filtered"] == 9 and details["KR-1"]["file_name"] == "new_city"
    assert (details["KR-3"]["attractions_count_filtered"], details["KR-3"]["festivals_count_filtered"]) == (1, 1)
    assert details["KR-4"]["source_path"] is None and details["KR-4"]["file_name"] == "kr-4"
    cache = spark.createDataFrame([("5", '{"intro": {"infocenter": "1"}}'), ("6", '{"x": 1}')], "content_id string, j string").select("content_id", F.parse_json("j").alias("detail"))
    rows = {r["id"]: r for r in harvest.harvest_records(targets, sources, files, cache).select("kind", "field_status", F.coalesce(F.try_variant_get("rec", "$.contentid", "string"), F.try_variant_get("rec", "$.contentId", "string")).alias("id")).collect()}
    assert rows["1"]["field_status"] == {"name": "collected", "address": "missing", "coordinates": "collected", "image": "missing", "tel": "missing", "theme": "collected", "detail": "missing"}
    assert rows["5"]["kind"] == "festival" and rows["5"]["field_status"]["tel"] == "collected"
    assert rows["6"]["kind"] == "attraction" and rows["6"]["field_status"]["tel"] == "collected" and rows["6"]["field_status"]["detail"] == "collected"


def test_limit_per_city(spark):
    rows = spark.createDataFrame([("a", g, p) for g in (0, 1) for p in range(4)] + [("b", 1, 0)], "city string, grp int, pos int")
    out = harvest.limit_per_city(rows, 5, "city", ["grp", "pos"])
    assert sorted((r["city"], r["grp"], r["pos"]) for r in out.collect()) == [("a", 0, 0), ("a", 0, 1), ("a", 0, 2), ("a", 0, 3), ("a", 1, 0), ("b", 1, 0)]
    assert "WindowGroupLimit" in out._jdf.queryExecution().executedPlan().toString()
    assert harvest.limit_per_city(rows, 0, "city", ["grp"]).count() == 0


def test_accounting_and_counts(spark):
    targets = spark.createDataFrame([("P1", "a", "1"), ("P1", "b", "2"), ("P1", "c", None), ("P2", "d", "4")], "province_id string, title string, expected_id string")
    existing = spark.createDataFrame([("1",)], "city_id string")
    failures = spark.createDataFrame([("P1", "b")], "province_id string, title string")
    out = {r["province_id"]: (r["skipped"], r["newly_acquired"], r["failed"]) for r in harvest.province_accounting(targets, existing, failures).collect()}
    assert out == {"P1": (1, 1, 1), "P2": (0, 1, 0)}
    assert harvest.skip_existing(targets, existing.withColumnRenamed("city_id", "expected_id"), "expected_id").count() == 3
    gap = dimensions.coverage_gap(targets.select("title"), targets.where("title < 'c'").select("title"))
    assert {r["title"] for r in gap.collect()} == {"c", "d"}
