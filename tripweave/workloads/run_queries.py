"""Jobs, writers and sources end to end over growing tables: what they store is read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from tripweave.operators import quality
from tripweave.plans import jobs
from tripweave.session import saved, work_folder
from tripweave.sources import dimensions, fixed, sinks
from tripweave.streaming import ingest
from tripweave.workloads.domain_queries import LEGACY
from tripweave.workloads.item_queries import VECTOR_ROWS
from tripweave.workloads.registry import query


def _raw_zone(t, folder: str) -> None:
    """Raw city payloads as lines of text files, and two lines that are no payload."""
    t.payloads.select("body").write.text(f"{folder}/good")
    t.spark.createDataFrame([("[1]",), ("{broken",)], "body string").write.text(f"{folder}/bad")


@query(LEGACY + """
    SELECT quality_status, entity_type, count(*) AS records, '20260101' AS ingest_date, 'partial' AS status, 207 AS status_code FROM legacy_rows GROUP BY 1, 2""")
def legacy_job(t):
    """First data model: raw lines to folders by status; stored records and the run status."""
    folder = work_folder(t.spark, "legacy")
    _raw_zone(t, f"{folder}/raw")
    done = jobs.transform_legacy(t.spark, f"{folder}/raw", f"{folder}/out", "20260101", whole_files=False, pattern="*.txt")
    stored = t.spark.read.parquet(f"{folder}/out").where("entity_type <> 'visitor_statistics'")
    counts = stored.groupBy("quality_status", "entity_type", F.col("ingest_date").cast("string").alias("ingest_date")).agg(F.count("*").alias("records"))
    run = done["summary"].select("status", "status_code")
    return counts.select("*", run.select("status").scalar().alias("status"), run.select("status_code").scalar().alias("status_code"))


@query("""
    SELECT i.PK, i.SK, CASE WHEN province_key = 'PROVINCE#ASIA' THEN concat('new ', title) ELSE title END AS title,
      CASE WHEN pos % 2 = 0 THEN province_key ELSE coalesce(province_key, CASE WHEN province = '' THEN 'UNKNOWN' ELSE province END) END AS province_key, n.loaded, n.load_failed, 207 AS status_code
    FROM {items} i CROSS JOIN (SELECT count(*) AS loaded, (SELECT count(*) FROM {content} WHERE contentid = '') AS load_failed FROM {items}) n""")
def load_items_job(t):
    """Items and rows without key into the store, then one province again; the store and the first run's counts."""
    store = work_folder(t.spark, "load")
    extra = {"entity_id": F.lit(""), "month": F.lit(None).cast("string"), "eventstartdate": F.lit("")}
    items = t["items"].withColumns(extra | {"domain_sort_key": F.when(F.col("pos") % 2 == 0, F.col("domain_sort_key"))})
    broken = t["content"].where("contentid = ''").select(F.lit("").alias("SK"), "pos")
    done = jobs.load_items(t.spark, items.unionByName(broken, allowMissingColumns=True), store, 1, ["pos"])["summary"].first()
    jobs.load_items(t.spark, items.withColumn("title", F.concat(F.lit("new "), "title")), store, 2, ["pos"], "PROVINCE#ASIA")
    counts = [F.lit(done[c]).cast(k).alias(c) for c, k in (("loaded", "long"), ("load_failed", "long"), ("status_code", "int"))]
    return sinks.current_items(t.spark, store).select("PK", "SK", "title", "province_key", *counts)


@query("""
    SELECT concat('CITY#', city_name_en) AS PK, concat(CASE WHEN contenttypeid = '15' THEN 'FESTIVAL#' ELSE 'ATTRACTION#' END, contentid) AS SK, title,
      (SELECT count(*) FROM {content} WHERE contentid <> '') AS loaded,
      cast(0 AS bigint) AS load_failed, 200 AS status_code
    FROM {content} WHERE contentid <> ''""")
def load_legacy_job(t):
    """Processed city files of the first data model into the store, twice; its content rows."""
    folder = work_folder(t.spark, "load-legacy")
    kind = F.when(F.col("contenttypeid") == "15", F.lit("festival")).otherwise(F.lit("attraction"))
    record = F.struct(
        kind.alias("entity_type"), F.concat(F.when(kind == "festival", "FEST-").otherwise("ATT-"), "contentid").alias("entity_id"),
        F.col("contentid").alias("content_id"), "title",
    )
    # a file holds the records of one city out of 2,000 consecutive keys
    files = t["content"].where("contentid <> ''").groupBy("city_name_en", F.floor(F.col("pos") / 2000).alias("file_no")).agg(F.collect_list(record).alias("records"))
    docs = files.select(F.lit("passed").alias("status"), F.struct("city_name_en").alias("city_record"), "records")
    docs.write.option("maxRecordsPerFile", 1).json(f"{folder}/processed")
    jobs.load_legacy(t.spark, f"{folder}/processed", f"{folder}/store", 1)
    done = jobs.load_legacy(t.spark, f"{folder}/processed", f"{folder}/store", 2)["summary"].first()
    counts = [F.lit(done[c]).cast(k).alias(c) for c, k in (("loaded", "long"), ("load_failed", "long"), ("status_code", "int"))]
    stored = sinks.current_items(t.spark, f"{folder}/store").where("SK LIKE 'FESTIVAL#%' OR SK LIKE 'ATTRACTION#%'")
    return stored.select("PK", "SK", "title", *counts)


@query(f"""
    SELECT count(*) AS items_read, count(*) AS items_loaded, cast(0 AS bigint) AS load_failed,
      (SELECT count(DISTINCT concat(entity_type, '#', content_id)) FROM ({VECTOR_ROWS}) v WHERE entity_type <> 'festival') AS vectors_built,
      (SELECT count(*) FROM ({VECTOR_ROWS}) v WHERE entity_type = 'festival') AS vectors_failed,
      (SELECT CASE WHEN count(*) = 0 THEN 'PASS' ELSE 'FAIL' END FROM ({VECTOR_ROWS}) v WHERE entity_type = 'festival') AS verdict
    FROM {{items}}""")
def load_and_index_job(t):
    """Items into the store, the stored ones into an index whose embedding fails for festivals; the verdict."""

    def embed(texts):
        return [None if "축제" in text else [float(len(text)), 1.0] for text in texts]

    items = t["items"].select("*", F.lit("").alias("entity_id"), F.lit(None).cast("string").alias("month"), F.lit("").alias("eventstartdate"))
    done = jobs.load_and_index(t.spark, items, work_folder(t.spark, "e2e"), 1, ["pos"], embed, "index", dimension=2)
    return done["verdict"].select("items_read", "items_loaded", "load_failed", "vectors_built", "vectors_failed", "verdict")


@query(f"SELECT concat(entity_type, '#', content_id, '#0') AS key FROM ({VECTOR_ROWS}) v WHERE province LIKE '%ASIA%' OR province_key LIKE '%ASIA%'")
def regional_vectors(t):
    """Vector build of the items of one province."""
    built = jobs.build_vectors(t["items"], lambda texts: [[1.0, float(len(x))] for x in texts], "index", dimension=2, provinces=["ASIA"])
    return built["records"].select("key")


@query("""
    SELECT province_key, count(*) AS kept, cast((SELECT count(*) FROM {items} WHERE province_key IS NOT NULL AND province_key NOT IN ('PROVINCE#ASIA', 'PROVINCE#EUROPE')) AS bigint) AS removed
    FROM {items} WHERE province_key IS NULL OR province_key IN ('PROVINCE#ASIA', 'PROVINCE#EUROPE') GROUP BY 1""")
def clean_table_job(t):
    """A store published without foreign provinces, read back; with the number of the removed."""
    store, out = work_folder(t.spark, "clean-store"), work_folder(t.spark, "clean-out")
    sinks.append_batch(t["items"], store, 1, ["pos"])
    removed = jobs.clean_table(t.spark, store, out, 1, ["PROVINCE#ASIA", "PROVINCE#EUROPE"])
    number = removed.agg(F.coalesce(F.sum("item_count"), F.lit(0)).cast("long").alias("n")).first()["n"]
    published = sinks.read_published(t.spark, out)
    return published.groupBy("province_key").agg(F.count("*").alias("kept")).withColumn("removed", F.lit(number).cast("long"))


@query("""
    SELECT concat('CITY#', city_name_en) AS PK, concat(CASE WHEN contenttypeid = '15' THEN 'FESTIVAL#' ELSE 'ATTRACTION#' END, contentid) AS SK
    FROM {content} WHERE contenttypeid IN ('12', '14', '15', '28') AND contentid <> '' AND title <> ''""")
def stream_files(t):
    """Raw JSON files, one per city, picked up by the file stream in two runs and stored by key."""
    folder = work_folder(t.spark, "stream-files")
    doc = F.parse_json("body")
    names = ("meta", "attractions", "festivals", "visitor_statistics")
    # Saved, for both runs read the payloads and every batch the classes.
    payloads, classes = saved(t.payloads, "payloads"), saved(t["classes"], "classes")
    files = payloads.select(*(F.try_variant_get(doc, f"$.{n}", "variant").alias(n) for n in names))
    for run, part in enumerate(files.randomSplit([0.5, 0.5], 7)):
        part.write.mode("append").option("maxRecordsPerFile", 1).json(f"{folder}/raw")
        ingest.ingest_raw_files(t.spark, f"{folder}/raw", f"{folder}/store", f"{folder}/checkpoint", classes, 100).awaitTermination()
    stored = sinks.current_items(t.spark, f"{folder}/store")
    return stored.where("SK LIKE 'FESTIVAL#%' OR SK LIKE 'ATTRACTION#%'").select("PK", "SK")


@query("SELECT concat('a, \"', c_name, '\"') AS name, cast(c_acctbal AS string) AS balance, c_mktsegment AS segment FROM {customer}")
def csv_export(t):
    """Rows with commas and quotes written as CSV and read back."""
    path = work_folder(t.spark, "csv")
    rows = t.sql("SELECT concat('a, \"', c_name, '\"') AS name, cast(c_acctbal AS string) AS balance, c_mktsegment AS segment FROM {customer}")
    sinks.write_csv(rows, path)
    return t.spark.read.option("header", True).schema(rows.schema).csv(path)


@query("""
    SELECT f.name, count(*) AS cities, cast(max(s_acctbal) AS double) AS most FROM {supplier} CROSS JOIN (SELECT unnest(['20260102', 'latest']) AS name) f GROUP BY 1""")
def report_files(t):
    """Two reports, each under its stamp and as the latest; what the second left behind."""
    path = work_folder(t.spark, "report")
    report = t["supplier"].agg(F.count("*").alias("cities"), F.max("s_acctbal").alias("most"))
    sinks.write_report(report.withColumn("cities", F.lit(0).cast("long")), path, "20260101")
    sinks.write_report(report, path, "20260102")
    read = lambda name: t.spark.read.schema("cities long, most double").json(f"{path}/{name}").select(F.lit(name).alias("name"), "*")
    return read("20260102").union(read("latest"))


_TOWNS = len(fixed.TOKYO_MUNICIPALITIES)
_TOWN_ROWS = ", ".join(f"({i}, '{ja}', '{ko}')" for i, (ja, ko) in enumerate(fixed.TOKYO_MUNICIPALITIES))


@query(f"""
    WITH towns(i, ja, ko) AS (VALUES {_TOWN_ROWS})
    SELECT c_custkey, coalesce(ko, '') AS name FROM {{customer}} LEFT JOIN towns ON i = c_custkey % {_TOWNS + 3}""")
def tokyo_names(t):
    """Korean names of municipality titles; other titles have none."""
    titles = F.array(*(F.lit(ja) for ja, _ in fixed.TOKYO_MUNICIPALITIES))
    title = F.coalesce(F.get(titles, (F.col("c_custkey") % (_TOWNS + 3)).cast("int")), F.lit("elsewhere"))
    return t["customer"].select("c_custkey", dimensions.tokyo_korean_name(title).alias("name"))


@query("""
    SELECT province_key, count(*) AS items, CASE WHEN min(entity_type) = 'attraction' THEN 200 ELSE 207 END AS status_code
    FROM {items} WHERE quality_status = 'passed' AND province_key IS NOT NULL GROUP BY 1""")
def staged_run(t):
    """User stages one after another: passed items, a count per province, a status from both."""

    def passed(frames):
        return {"passed": frames["items"].where("quality_status = 'passed'")}

    def counted(frames):
        kept = frames["passed"].where("province_key IS NOT NULL")
        return {"counts": kept.groupBy("province_key").agg(F.count("*").alias("items"), F.count_if(F.col("entity_type") == "attraction").alias("good"))}

    def judged(frames):
        bad = F.when(F.col("good") > 0, 0).otherwise(1)
        return {"result": frames["counts"].select("province_key", "items", quality.status_code(bad).alias("status_code"))}

    return jobs.run_stages({"items": t["items"]}, [passed, counted, judged])["result"]
