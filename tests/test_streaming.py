import datetime
import json

from pyspark.sql import functions as F

from tripweave.operators import visitors
from tripweave.sources import sinks
from tripweave.streaming import ingest
from tripweave.streaming import visitors as counters


def city_file(folder, name, content_id, title):
    body = {"meta": {"city_name_en": name}, "festivals": [{"contentid": content_id, "title": title, "mapx": "127", "mapy": "36", "lclsSystm3": "EV010100", "eventstartdate": "20251001"}]}
    folder.mkdir(parents=True, exist_ok=True)
    (folder / f"{name}-{content_id}-{title}.json").write_text(json.dumps(body), encoding="utf-8")


def test_new_files_are_loaded_once(spark, tmp_path):
    source, store, checkpoint = tmp_path / "raw", str(tmp_path / "store"), str(tmp_path / "checkpoint")
    city_file(source, "A", "1", "first")
    (source / "bad.json").write_text("{")

    def run():
        ingest.ingest_raw_files(spark, str(source), store, checkpoint).awaitTermination()
        return {(r["PK"], r["SK"]): r["title"] for r in sinks.current_items(spark, store).collect()}

    assert run() == {("CITY#A", "METADATA#city"): None, ("CITY#A", "FESTIVAL#1"): "first"}
    batches = spark.read.parquet(store).count()
    assert run() and spark.read.parquet(store).count() == batches
    city_file(source / "later", "A", "1", "second")
    city_file(source / "later", "B", "2", "other")
    stored = run()
    assert stored[("CITY#A", "FESTIVAL#1")] == "second" and ("CITY#B", "FESTIVAL#2") in stored and len(stored) == 4


def test_batch_summary(spark, tmp_path):
    body = json.dumps({"meta": {"city_name_en": "A"}, "attractions": [{"contentid": "1", "contenttypeid": "12", "title": "x"}]})
    raw = spark.createDataFrame([("f", body)], "source_key string, body string")
    assert ingest.load_batch(raw, 3, str(tmp_path / "s")) == {"loaded": 2, "load_failed": 0, "batch": 3, "status_code": 200}


def test_counters_equal_the_batch_aggregate(spark, tmp_path):
    start = datetime.datetime(2025, 1, 1)
    rows = [("A" if i % 3 else "B", start + datetime.timedelta(hours=7 * i), i % 5, i / 10) for i in range(300)]
    feed = spark.createDataFrame(rows, "city_name_en string, ts timestamp, tou_div_cd int, tou_num double")
    source = str(tmp_path / "feed")
    store, checkpoint = str(tmp_path / "store"), str(tmp_path / "checkpoint")
    for part in (feed.where("hour(ts) < 12"), feed.where("hour(ts) >= 12")):
        part.coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(feed.schema).parquet(source)
        counters.run_counters(stream, store, checkpoint).awaitTermination()
    got = visitors.monthly_statistics(counters.stored_daily(spark, store)).orderBy("city_name_en", "month").collect()
    want = visitors.monthly_statistics(feed.withColumn("date", F.to_date("ts"))).orderBy("city_name_en", "month").collect()
    assert [r.asDict() for r in got] == [r.asDict() for r in want] and len(got) > 4
