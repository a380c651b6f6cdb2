import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from tripweave.functions.calls import one_by_one
from tripweave.operators import vectors

ITEM = {
    "PK": "CITY#Garam", "SK": "ATTRACTION#7301", "entity_type": "attraction", "content_id": "7301", "entity_id": "ATTR-7301",
    "city_id": "KR-Garam", "city_name_en": "Garam", "title": "물빛등대", "description": "밤에 빛나는 등대", "theme": "night_view",
    "theme_tags": ["bridge"], "class_tags": ["date_course"], "classification": ("scenery", ["photo_spot"]), "category_tags": ["walk"],
}
SCHEMA = (
    "PK string, SK string, entity_type string, content_id string, entity_id string, city_id string, city_name_en string, title string, "
    "description string, theme string, theme_tags array<string>, class_tags array<string>, classification struct<theme:string,tags:array<string>>, category_tags array<string>"
)


def test_chunk(spark):
    row = vectors.build_chunks(spark.createDataFrame([tuple(ITEM.values())], SCHEMA)).first()
    assert row["key"] == "attraction#7301#0" and row["place_id"] == "attraction#7301" and row["error"] is None
    assert row["embedding_text"] == (
        "이름: 물빛등대\n유형: 관광지\n도시:  (Garam)\n지역: \n분류: date_course, walk, scenery, photo_spot\n테마: night_view\n설명: 밤에 빛나는 등대"
    )
    meta = row["metadata"]
    assert meta["class_tags"] == ["date_course", "walk", "scenery", "photo_spot"]
    assert meta["theme_tags"] == ["bridge", "night_view", "date_course", "walk", "scenery", "photo_spot"]
    assert (meta["country"], meta["raw_s3_uri"], meta["ddb_sk"], meta["season_tags"]) == ("KR", "unknown", "ATTRACTION#7301", None)


def test_city_chunk_and_source_id_chain(spark):
    df = spark.createDataFrame([("METADATA#city", "city_metadata", "KR-1", "가람시"), ("x", "", None, None)], "SK string, entity_type string, city_id string, city_name_ko string")
    rows = vectors.build_chunks(df).collect()
    assert [r["key"] for r in rows] == ["city#city#0", "unknown#x#0"]
    assert "도시 ID: KR-1" in rows[0]["embedding_text"] and rows[0]["embedding_text"].startswith("이름: 가람시\n유형: 도시")


def test_enrichment_gate_and_festival_themes(spark):
    df = spark.createDataFrame(
        [("attraction", "1", "succeeded", "indoor", ["calm"], ["a"], None), ("attraction", "2", "failed", "indoor", ["calm"], ["a"], None), ("festival", "3", None, None, None, ["only"], "succeeded"), ("festival", "4", None, None, None, ["t"], "failed")],
        "entity_type string, content_id string, s string, indoor_outdoor string, vibe_tags array<string>, theme_tags array<string>, f string",
    ).withColumns({"metadata_enrichment": F.struct(F.col("s").alias("status")), "festival_theme_classification": F.struct(F.col("f").alias("status")), "theme": F.lit("th")})
    m = {r["place_id"][-1]: r["metadata"] for r in vectors.build_chunks(df).collect()}
    assert (m["1"]["indoor_outdoor"], m["1"]["vibe_tags"]) == ("indoor", ["calm"]) and m["2"]["indoor_outdoor"] is None
    assert m["3"]["theme_tags"] == ["only"] and m["4"]["theme_tags"] == ["t", "th"]


def python_trim(meta, budget=2048):
    """Pops tags one by one until the JSON fits (comparison only)."""
    meta = {k: (list(v) if isinstance(v, list) else v) for k, v in meta.items()}

    def size():
        kept = {k: v for k, v in meta.items() if k in vectors.FILTER_KEYS and v is not None}
        return len(json.dumps(kept, ensure_ascii=False, separators=(",", ":")).encode())

    for name in ("experience_tags", "vibe_tags"):
        while meta.get(name) and size() > budget:
            meta[name].pop()
    return meta if size() <= budget else None


def test_budget_equals_step_by_step_trimming(spark):
    title = {i: "제" * (i % 7) + "x" * (1700 + 23 * i) for i in range(16)}
    rows = [(str(i), title[i], [f"e\"{j}" for j in range(i % 5)] or None, [f"감{j}" for j in range(i % 9)] or None) for i in title]
    df = spark.createDataFrame(rows, "content_id string, title string, experience_tags array<string>, vibe_tags array<string>")
    items = df.withColumns({"entity_type": F.lit("attraction"), "metadata_enrichment": F.struct(F.lit("succeeded").alias("status"))})
    chunks = {r["place_id"].split("#")[1]: r for r in vectors.build_chunks(items).collect()}
    trimmed_rows = over = 0
    for ident, name, experience, vibe in rows:
        full = {"country": "KR", "entity_type": "attraction", "source_type": "attraction", "source_id": ident, "place_id": f"attraction#{ident}", "title": name, "experience_tags": experience, "vibe_tags": vibe}
        want = python_trim(full)
        got = chunks[ident]["metadata"]
        if want is None:
            want = {**full, "experience_tags": None, "vibe_tags": None}
            over += python_trim(want) is None
            assert (chunks[ident]["error"] is not None) == (python_trim(want) is None)
        assert (got["experience_tags"], got["vibe_tags"]) == (want["experience_tags"], want["vibe_tags"])
        trimmed_rows += want["vibe_tags"] != vibe or want["experience_tags"] != experience
    assert trimmed_rows > 3 and over > 0


def test_metadata_contract(value):
    ok = '{"title": "x", "latitude": 36.5, "raw_s3_uri": "%s"}' % ("y" * 3000)
    long = '{"title": "%s"}' % ("x" * 3000)
    assert value(vectors.metadata_error(F.lit(ok)), vectors.metadata_error(F.lit('{"bad": 1, "title": ""}'))) == (None, "metadata keys are not allowlisted: bad")
    assert value(vectors.metadata_error(F.lit(long))) == "filterable metadata is 3012 bytes, exceeds 2048"


def test_string_values(spark):
    df = spark.createDataFrame([(["a", None, ""], {"k": ["x", "y"]}, 5)], "l array<string>, m map<string,array<string>>, n int")
    types = {f.name: f.dataType for f in df.schema.fields}
    row = df.select(*[vectors.string_values(F.col(c), types[c]).alias(c) for c in df.columns]).first()
    assert (row["l"], row["m"], row["n"]) == (["a"], ["x", "y"], ["5"])


def test_export_and_since(spark):
    df = spark.createDataFrame(
        [("a", "attraction", None, "2026-02-01", ""), ("a", "attraction", "review", "2026-02-01", ""), ("b", "festival", "passed", "", "2026-03-01"), ("b", "visitor_statistics", "passed", "", ""), ("b", "city", "", None, None)],
        "PK string, entity_type string, quality_status string, updated_at string, collected_at string",
    )
    exported = vectors.export_items(df)
    assert exported.count() == 3 and vectors.export_items(df, city_pk="b").count() == 2 and vectors.export_items(df, ["festival"]).count() == 1
    assert vectors.modified_since(exported, "2026-02-15").count() == 2 and vectors.modified_since(exported, None).count() == 3


def test_embedding_failures_stay_in_their_row(spark):
    df = spark.createDataFrame([("a", "ok"), ("b", "bad"), ("c", "short"), ("a", "ok")], "key string, embedding_text string")

    def embed(text):
        if text == "bad":
            raise ValueError("nope")
        return [1.0] if text == "short" else [1.0, 2.0]

    out = vectors.embed(df, one_by_one(embed), 2)
    errors = {r["key"]: r["embedding_error"] for r in out.collect()}
    assert errors == {"a": None, "b": "ValueError: nope", "c": "unexpected embedding dimension: 1"}
    assert vectors.rebuild_summary(out).first().asDict() == {"items_processed": 4, "items_upserted": 1, "items_skipped": 2}
    records = vectors.vector_records(out.withColumn("metadata", F.struct(F.lit(1).alias("x"))))
    assert records.count() == 2 and records.first()["data"]["float32"] == [1.0, 2.0]
    manifest = vectors.build_manifest(df.withColumn("entity_type", F.lit("city")), vectors.rebuild_summary(out), "i").first()
    assert manifest["entity_counts"] == {"city": 4} and manifest["failed_count"] == 2


def test_dedupe_modes(spark):
    df = spark.range(1200).select(F.col("id").alias("pos"), (F.col("id") % 3).cast("string").alias("key"))
    assert vectors.first_per_key(df, "pos").count() == 3 and vectors.first_per_key(df, "pos", 500).count() == 9
    assert {r["pos"] for r in vectors.first_per_key(df, "pos").collect()} == {0, 1, 2}


def test_top_k_against_brute_force(spark):
    rng = np.random.default_rng(1)
    data = rng.normal(size=(500, 16)).astype(np.float32)
    data[7] = 0  # no direction
    data[100] = data[3]  # a tie
    rows = [(i, [float(x) for x in v], i % 4) for i, v in enumerate(data)]
    rows += [(900, None, 0), (901, [1.0], 0)]
    df = spark.createDataFrame(rows, "vec int, embedding array<float>, label int").repartition(7)
    query = data[3].astype(float)
    norms = np.linalg.norm(data.astype(float), axis=1)
    with np.errstate(invalid="ignore"):
        distance = np.round(1 - data.astype(float) @ query / norms / np.linalg.norm(query), 12)
    order = sorted((i for i in range(500) if np.isfinite(distance[i])), key=lambda i: (distance[i], i))
    hits = vectors.cosine_top_k(df, list(query), 20, "vec").collect()
    assert [r["vec"] for r in hits] == order[:20] and {3, 100} == {r["vec"] for r in hits[:2]}
    some = vectors.cosine_top_k(df, list(query), 5, "vec", where=F.col("label") == 1).collect()
    assert [r["vec"] for r in some] == [i for i in order if i % 4 == 1][:5]
    with pytest.raises(ValueError):
        vectors.cosine_top_k(df, [0.0] * 16, 1, "vec")


def test_vectors_without_distance_are_reported(spark):
    rows = [("a", [1.0, 2.0]), ("b", [1.0]), ("c", [0.0, 0.0]), ("d", None), ("e", [float("nan"), 1.0])]
    out = vectors.unsearchable(spark.createDataFrame(rows, "key string, embedding array<double>"), 2)
    assert {r["key"]: r["reason"] for r in out.collect()} == {"b": "1 dimensions", "c": "no direction", "d": "no vector", "e": "no direction"}
