import random

import pytest
from pyspark.sql import functions as F

from tripweave.operators import merge, quality
from tripweave.sources.raw import UNIFIED_CITY_SCHEMA

NAMES = [p.strip().split(" ")[0] for p in UNIFIED_CITY_SCHEMA.split(", ")]
DEFAULTS = {
    "city_id": "KR-11-SEOUL", "city_name_ko": "서울시", "city_name_ja": "", "city_name_en": "SEOUL", "prefecture_id": "KR-11", "location": "",
    "latitude": 37.5, "longitude": 127.0, "description": "수도", "geography_description": "", "climate_table": None, "site_urls": [],
    "image_url": None, "image_urls": [], "source_name": "wikipedia", "source_url": "", "collected_at": "", "field_status": {},
    "data_confidence": "high", "verified_at": None, "verified_source_url": None, "verification_note": None,
}


def cities(spark, *changes):
    rows = [tuple({**DEFAULTS, **c}[n] for n in NAMES) for c in changes]
    return spark.createDataFrame(rows, UNIFIED_CITY_SCHEMA)


def merged(spark, old, new, **kw):
    return merge.merge_records(cities(spark, old), cities(spark, new), **kw).first()


def test_confidence_rules(spark):
    low = merged(spark, {}, {"description": "새", "data_confidence": "low"})
    assert low["description"] == "수도" and low["data_confidence"] == "high" and low["field_status"] == {}
    same = merged(spark, {}, {"description": "새", "source_name": "tour"})
    assert same["description"] == "새" and same["field_status"]["description"] == "merged: prev_source=wikipedia, new_source=tour"
    up = merged(spark, {"data_confidence": "medium"}, {"latitude": 38.0, "data_confidence": "high"})
    assert (up["latitude"], up["data_confidence"]) == (38.0, "high")


def test_blank_never_overwrites_and_fills(spark):
    row = merged(spark, {"location": " ", "longitude": None}, {"city_name_ko": " ", "latitude": None, "location": "x", "longitude": 1.0, "source_name": ""})
    assert (row["city_name_ko"], row["latitude"], row["location"], row["longitude"]) == ("서울시", 37.5, "x", 1.0)
    assert row["field_status"] == {"location": "updated: source=unknown", "longitude": "updated: source=unknown"}


def test_audit_order_after_source_name(spark):
    row = merged(spark, {"source_url": "a"}, {"description": "새", "source_name": "tour", "source_url": "b"})
    status = row["field_status"]
    assert status["source_name"] == "merged: prev_source=wikipedia, new_source=tour"
    assert status["source_url"] == "merged: prev_source=tour, new_source=tour"


def test_empty_list_overwrites_and_maps_compare(spark):
    row = merged(spark, {"site_urls": ["a"], "climate_table": {"a": "1", "b": "2"}}, {"site_urls": [], "climate_table": {"b": "2", "a": "1"}})
    assert row["site_urls"] == [] and "climate_table" not in row["field_status"] and "site_urls" in row["field_status"]


@pytest.mark.parametrize(
    ("old", "new", "force", "url", "urls", "status"),
    [
        (None, "n", False, "n", [], "updated: source=tour"),
        ("o", "n", False, "o", ["n"], None),
        ("o", "n", True, "n", [], "force_replaced: prev_source=tour, new_source=tour"),
        ("o", "o", False, "o", [], None),
        ("o", None, False, "o", [], None),
    ],
)
def test_images(spark, old, new, force, url, urls, status):
    row = merged(spark, {"image_url": old}, {"image_url": new, "source_name": "tour"}, force_image_update=force)
    assert row["image_url"] == url and [e["url"] for e in row["image_urls"]] == urls
    assert row["field_status"].get("image_url") == status


def test_image_lists_union_and_low_confidence(spark):
    row = merged(
        spark, {"image_url": "o", "image_urls": [("a", "w")]},
        {"image_url": "n", "image_urls": [("a", "x"), ("b", "x"), ("b", "y")], "data_confidence": "low", "source_name": ""},
    )
    assert [tuple(e) for e in row["image_urls"]] == [("a", "w"), ("n", "unknown"), ("b", "x")]


def test_new_and_untouched_cities(spark):
    base = cities(spark, {}, {"city_id": "B"})
    out = merge.merge_records(base, cities(spark, {"city_id": "C"}, {"city_id": ""}))
    assert sorted(r["city_id"] for r in out.collect()) == ["B", "C", "KR-11-SEOUL"]


def apply_in_order(rows):
    """Plain sequential application of merge rules, for comparison only."""
    rank = {"low": 0, "medium": 1, "high": 2}
    state = dict(rows[0], field_status=dict(rows[0]["field_status"]))

    def empty(v):
        return v is None or (isinstance(v, str) and not v.strip())

    for row in rows[1:]:
        have, got = rank.get(state["data_confidence"], 0), rank.get(row["data_confidence"], 0)
        if got >= have:
            for name in merge.MERGED_FIELDS:
                source = row["source_name"] or "unknown"
                if empty(row[name]) or row[name] == state[name]:
                    continue
                text = f"updated: source={source}"
                if not empty(state[name]):
                    text = f"merged: prev_source={state['source_name'] or 'unknown'}, new_source={source}"
                state[name] = row[name]
                state["field_status"][name] = text
        if got > have:
            state["data_confidence"] = row["data_confidence"]
    return state


def test_fold_equals_sequential_application(spark):
    rng = random.Random(5)

    def record(city):
        pick = rng.choice
        return {
            "city_id": city, "city_name_ko": pick(["a", "b", " ", ""]), "location": pick(["", "x", "y"]), "latitude": pick([None, 1.0, 2.0]),
            "climate_table": pick([None, {"a": "1"}, {"a": "2"}, {}]), "site_urls": pick([[], ["u"]]), "source_name": pick(["", " ", "w", "t"]),
            "source_url": pick(["", "p", "q"]), "verified_at": pick([None, "v"]), "data_confidence": pick(["low", "medium", "high", "odd"]),
            "field_status": pick([{}, {"location": "old"}]),
        }

    base = [record(f"c{i}") for i in range(6)]
    # A third of the rows belong to one city; c6-c8 are not in the base.
    incoming = [record("c0" if i % 3 == 0 else f"c{rng.randrange(9)}") for i in range(240)]
    frame = cities(spark, *incoming).withColumn("seq", F.lit(0))
    frame = spark.createDataFrame([(*[{**DEFAULTS, **r}[n] for n in NAMES], i) for i, r in enumerate(incoming)], UNIFIED_CITY_SCHEMA + ", seq long")
    expected = {}
    for row in base + incoming:
        expected.setdefault(row["city_id"], []).append({**DEFAULTS, **row})
    expected = {c: apply_in_order(r) for c, r in expected.items()}
    for chunk_rows in (7, 100_000):
        out = merge.fold_records(cities(spark, *base), frame, chunk_rows=chunk_rows).collect()
        assert len(out) == len(expected)
        for row in out:
            want = expected[row["city_id"]]
            for name in (*merge.MERGED_FIELDS, "data_confidence", "field_status"):
                assert row[name] == want[name], (row["city_id"], name, chunk_rows)


def test_fold_images(spark):
    base = cities(spark, {"image_url": "o", "image_urls": [("a", "w")]}, {"city_id": "B", "image_url": None})
    frame = cities(spark, {"image_url": "n", "image_urls": [("a", "z"), ("c", "z")], "source_name": ""}, {"city_id": "B", "image_url": "p"}, {"image_url": "n"}, {"city_id": "B", "image_url": "q"})
    frame = frame.withColumn("seq", F.monotonically_increasing_id())
    primary, images = merge.fold_images(base, frame)
    assert {r["city_id"]: r["image_url"] for r in primary.collect()} == {"KR-11-SEOUL": "o", "B": "p"}
    listed = {(r["city_id"], r["url"]): r["source"] for r in images.collect()}
    assert listed == {("KR-11-SEOUL", "a"): "w", ("KR-11-SEOUL", "n"): "unknown", ("KR-11-SEOUL", "c"): "z", ("B", "q"): "wikipedia"}


def test_image_precedence(spark):
    offers = [(None, "wikipedia", "https://w"), ("https://o", "wikipedia", "https://w"), ("https://o", "tourapi", "https://t"), (None, "tourapi", "https://t"), (None, "x", "https://x"), (None, "wikipedia", "bad url")]
    base = cities(spark, *[{"city_id": str(i), "image_url": o[0]} for i, o in enumerate(offers)])
    extra = spark.createDataFrame([(str(i), o[1], o[2]) for i, o in enumerate(offers)], "city_id string, src string, u string")
    out = {r["city_id"]: (r["image_url"], [e["url"] for e in r["image_urls"]]) for r in merge.apply_image(base.join(extra, "city_id"), "u", "src").collect()}
    assert out == {"0": ("https://w", ["https://w"]), "1": ("https://w", ["https://w"]), "2": ("https://o", ["https://t"]), "3": ("https://t", ["https://t"]), "4": ("https://x", ["https://x"]), "5": (None, [])}


def test_completeness_and_review(spark):
    records = cities(spark, {}, {"city_id": "m", "latitude": None, "longitude": None}, {"city_id": "l", "prefecture_id": " ", "description": "", "field_status": {"location": "x"}}, {"city_id": "h", "image_url": "https://i"})
    evaluated = quality.evaluate_completeness(records)
    out = {r["city_id"]: r["completeness"] for r in evaluated.collect()}
    assert out["KR-11-SEOUL"]["data_confidence"] == "high" and out["m"]["data_confidence"] == "medium"
    assert out["m"]["review_reasons"] == ["missing_coordinates"] and not out["m"]["needs_review"]
    assert out["l"]["missing_fields"] == ["prefecture_id", "description"] and out["l"]["review_reasons"] == ["empty_description", "low_confidence"]
    reviewed = {r["city_id"]: r for r in quality.apply_review(evaluated).collect()}
    assert reviewed["l"]["field_status"] == {"location": "x", "city_name_ko": "collected", "prefecture_id": "missing", "latitude": "collected", "longitude": "collected", "description": "needs_review", "image_url": "needs_review"}
    assert reviewed["l"]["data_confidence"] == "low" and reviewed["m"]["field_status"] == {} and reviewed["m"]["data_confidence"] == "high"
    assert reviewed["h"]["field_status"]["image_url"] == "collected" and "image_url" not in reviewed["KR-11-SEOUL"]["field_status"]
    entry = quality.review_entries(evaluated).first()
    assert (entry["city_id"], entry["missing_fields"], entry["review_reason"]) == ("l", ["prefecture_id", "description", "image_url"], "empty_description")
    assert quality.stage_counters(evaluated).first().asDict() == {"records_processed": 4, "records_updated": 4}


def test_run_report_and_verdict(spark):
    records = cities(spark, {}, {"city_id": "l", "prefecture_id": ""})
    entries = quality.review_entries(quality.evaluate_completeness(records))
    stages = spark.createDataFrame([("wikipedia", 3), ("tour", 2)], "stage_name string, images_collected int")
    errors = spark.createDataFrame([("API down",), ("socket",), ("?",)], "message string")
    row = quality.run_report(records, stages, entries, errors).first()
    assert (row["total_records_processed"], row["total_images_collected"], row["records_transitioned_to_review"], row["total_errors"]) == (2, 5, 1, 3)
    assert row["error_counts"] == {"api": 1, "network": 1, "other": 1} and row["review_reason_counts"] == {"no_image_url": 1}
    assert [s["stage_name"] for s in row["stages"]] == ["tour", "wikipedia"]
    load = spark.createDataFrame([(2, 0)], "loaded long, load_failed long")
    built = spark.createDataFrame([(2, 1)], "items_upserted long, items_skipped long")
    assert quality.pass_or_fail(records, load, built).first()["verdict"] == "FAIL"
    codes = spark.range(1).select(quality.status_code(F.lit(0)), quality.status_code(F.lit(2)), quality.status_code(F.lit(2), F.lit(True))).first()
    assert tuple(codes) == (200, 207, 400)
