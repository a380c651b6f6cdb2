from pyspark.sql import functions as F

from tripweave.operators import images, quality

SCHEMA = "city string, grp int, pos int, contentid string, title string, firstimage string, firstimage2 string"
ROWS = [
    ("Cheorwon", 0, 0, "7410052", "푸른정자", "http://x/a_2.jpg", "http://x/a_3.png"),
    ("Cheorwon", 0, 1, "7410063", "물가절(바위)", "http://x/b_2.jpg", ""),
    ("Cheorwon", 0, 2, "999", "푸른정자", "http://x/c_2.jpg", None),
    ("Cheorwon", 1, 0, "7410074", "바위 맑은내 얼음 잔치", "http://x/f_2.jpg", "http://x/f_3.jpg"),
    ("Other", 0, 0, "5", "푸른정자", " ", "http://x/z.gif"),
    ("Other", 0, 1, "", "()", "http://x/y", ""),
]


def test_targets(spark):
    out = {(r["city"], r["name"], r["suffix"]) for r in images.image_targets(spark.createDataFrame(ROWS, SCHEMA)).collect()}
    assert len([t for t in out if t[0] == "Cheorwon"]) == 6
    assert {("Cheorwon", "Pureunjeongja", "1"), ("Cheorwon", "Pureunjeongja", "2"), ("Cheorwon", "Mulgajeol", "1"), ("Cheorwon", "Pureunjeongja_999", "1")} <= out
    assert ("Other", "Pureunjeongja", "2") in out and ("Other", "item", "1") in out


def test_audit(spark):
    expected = images.expected_files(images.image_targets(spark.createDataFrame(ROWS[:2], SCHEMA)))
    assert {r["file_name"] for r in expected.collect()} == {"Pureunjeongja_1.jpg", "Pureunjeongja_2.png", "Mulgajeol_1.jpg"}
    actual = spark.createDataFrame([("Cheorwon", "Pureunjeongja_1.jpg"), ("Cheorwon", "Pureunjeongja_2.png"), ("X", "Mulgajeol_1.jpg")], "city string, file_name string")
    missing = images.missing_files(expected, actual)
    assert [r["file_name"] for r in missing.collect()] == ["Mulgajeol_1.jpg"]
    outcomes = spark.createDataFrame([("Cheorwon", "Mulgajeol_1.jpg", None)], "city string, file_name string, error string")
    total = images.audit_summary(expected, images.recovery(missing, outcomes)).where("city IS NULL").first()
    assert (total["expected"], total["ok"], total["failed"], total["recovered"]) == (3, 3, 0, 1)
    plain = images.audit_summary(expected, missing).where("city = 'Cheorwon'").first()
    assert (plain["ok"], plain["failed"]) == (2, 1)


def test_audit_of_records_that_share_a_file_name(spark):
    # All but the first lack a content id, so all their files are Pine__1.jpg.
    rows = [("A", 0, i, "1" if i == 1 else "", "Pine", f"http://x/{i}.jpg", "") for i in (1, 2, 3, 4)]
    expected = images.expected_files(images.image_targets(spark.createDataFrame(rows, SCHEMA)))
    assert expected.select("file_name").distinct().count() == 2
    missing = images.missing_files(expected, expected.where("pos < 3").select(*images.IMAGE), images.IMAGE)
    assert {r["pos"] for r in missing.collect()} == {3, 4}
    outcomes = missing.select(*images.IMAGE, F.when(F.col("pos") == 4, "404").alias("error"))
    total = images.audit_summary(expected, images.recovery(missing, outcomes, images.IMAGE)).where("city IS NULL").first()
    assert tuple(total)[1:] == (4, 3, 1, 1)


def test_recovery_of_a_file_tried_twice(spark):
    missing = spark.createDataFrame([("A", "x"), ("A", "y"), ("A", "z")], "city string, file_name string")
    tries = spark.createDataFrame([("A", "x", "404"), ("A", "x", None), ("A", "y", "404"), ("A", "y", "500")], "city string, file_name string, error string")
    found = {(r["file_name"], r["recovery"]) for r in images.recovery(missing, tries).collect()}
    assert found == {("x", "recovered"), ("y", "failed"), ("z", "not_tried")} and images.recovery(missing, tries).count() == 3


def test_hot_name_keeps_every_row(spark):
    rows = spark.range(9_000).select(
        F.lit("C").alias("city"), F.lit(0).alias("grp"), F.col("id").cast("int").alias("pos"), F.col("id").cast("string").alias("contentid"),
        F.when(F.col("id") % 3 == 0, "푸른정자").otherwise(F.concat(F.lit("t"), "id")).alias("title"),
    )
    named = images.unique_names(rows, "city", images.base_name(F.col("title"), F.col("contentid")), F.col("contentid"), ["grp", "pos"])
    assert named.count() == 9_000 and named.select("name").distinct().count() == 9_000
    assert named.where("name = 'Pureunjeongja'").first()["pos"] == 0
    assert "Window" not in named._jdf.queryExecution().executedPlan().toString()


def test_processing_review_and_report(spark):
    records = spark.createDataFrame(
        [("A", 0, "1", "푸른정자", "attraction", "http://x/a.PNG?w=1", None), ("A", 1, "2", "푸른정자", "attraction", " ", "http://x/b.tiff"), ("A", 2, "3", "푸른정자", "attraction", None, ""), ("B", 0, "4", "x", "festival", "http://x/c.jpg", None)],
        "city_name_en string, pos int, content_id string, title string, entity_type string, image_url string, firstimage string",
    )
    outcomes = spark.createDataFrame([("A", 0, None), ("A", 1, None), ("B", 0, "HTTP 404")], "city_name_en string, pos int, error string")
    done = images.process_images(records, outcomes, "bucket")
    out = {r["content_id"]: r for r in done.collect()}
    assert out["1"]["image_url"] == "https://bucket.s3.amazonaws.com/images/KR/A/Pureunjeongja_1.png" and out["1"]["image_status"] == "ok"
    assert out["2"]["image_s3_key"] == "images/KR/A/Pureunjeongja_2_1.jpg"
    assert (out["3"]["failure_reason"], out["4"]["failure_reason"], out["4"]["error_message"], out["4"]["image_url"]) == ("no_source_image", "download_failed", "HTTP 404", "http://x/c.jpg")
    review = images.image_review(done)
    assert {(r["content_id"], r["original_image_url"]) for r in review.collect()} == {("3", ""), ("4", "http://x/c.jpg")}
    assert {tuple(r) for r in quality.reason_counts(review, "failure_reason").collect()} == {("no_source_image", 1), ("download_failed", 1)}
    counts = images.city_image_counts(done)
    assert {tuple(r) for r in images.city_image_rows(counts).collect()} == {("A", 2, 1, 3), ("B", 0, 1, 1)}
    report = images.image_report(counts).first()
    assert (report["status"], report["total_cities"], report["images_downloaded"], report["images_failed"], report["review_count"]) == ("partial", 2, 2, 1, 2)
    assert images.image_report(counts, "boom").first()["status"] == "failed"
    assert images.image_report(counts.where("review_count = 0")).first()["status"] == "success"
