"""Jobs run end to end over the benchmark tables, their stored output read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from tripweave.operators import domain, pages, visitors
from tripweave.plans import jobs
from tripweave.session import work_folder
from tripweave.sources import dimensions, raw, sinks
from tripweave.streaming import visitors as counters
from tripweave.workloads.domain_queries import ITEMS
from tripweave.workloads.city_queries import FOLD, SHIPMENTS, _mapped, _records
from tripweave.workloads.item_queries import VECTOR_ROWS
from tripweave.workloads.registry import query


@query("""
    SELECT d.city_name_en, cast(year(f.ts) AS int) AS year, concat(cast(year(f.ts) AS string), '-', lpad(cast(month(f.ts) AS string), 2, '0')) AS month,
      cast(printf('%.2f', cast(sum(cast(f.value AS decimal(28, 10))) AS double)) AS double) AS total_visitors
    FROM {events} f JOIN {districts} d ON d.code = concat('D', cast(f.user_id % 25 AS string)) WHERE f.event_type IN ('view', 'click', 'purchase') GROUP BY 1, 2, 3""")
def visitor_stream_late(t):
    """Visitor counters of a feed that arrives in three runs, the latest days first."""
    folder = work_folder(t.spark, "stream-late")
    segment = F.when(F.col("event_type") == "view", 1).when(F.col("event_type") == "click", 2).when(
        F.col("event_type") == "purchase", 3
    )
    feed = t["events"].select(
        F.concat(F.lit("D"), F.col("user_id") % 25).alias("code"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.coalesce(segment, F.lit(9)).alias("tou_div_cd"),
        F.col("value").alias("tou_num"),
    )
    for part in range(3):
        feed.where(2 - F.dayofmonth("ts") % 3 == part).write.mode("append").parquet(f"{folder}/feed")
        arrived = t.spark.readStream.schema(feed.schema).parquet(f"{folder}/feed").join(t["districts"], "code")
        counters.run_counters(arrived, f"{folder}/store", f"{folder}/checkpoint").awaitTermination()
    counters.compact_counters(t.spark, f"{folder}/store", f"{folder}/compact")
    monthly = visitors.monthly_statistics(counters.stored_daily(t.spark, f"{folder}/compact"))
    return monthly.select("city_name_en", "year", "month", "total_visitors")


MERGED = FOLD + """
    , imgs AS (SELECT city_id, arg_min(image_url, seq) FILTER (image_url IS NOT NULL) AS image_url, min(seq) AS start,
        min(seq) FILTER (image_url IS NOT NULL) AS img_seq, arg_min(source_name, seq) FILTER (image_url IS NOT NULL) AS src FROM all_rows GROUP BY 1),
    offers AS (SELECT a.city_id, a.image_url AS url FROM all_rows a JOIN imgs i USING (city_id) WHERE a.image_url <> i.image_url
      UNION ALL SELECT city_id, concat(image_url, '/s') FROM all_rows WHERE image_url IS NOT NULL),
    listed AS (SELECT city_id, count(DISTINCT url) AS n FROM offers GROUP BY 1),
    fields AS (SELECT city_id, coalesce(arg_max(v_name, seq), arg_min(city_name_ko, seq)) AS city_name_ko,
      coalesce(arg_max(v_location, seq), first(location ORDER BY seq)) AS location,
      coalesce(arg_max(v_source, seq), first(source_name ORDER BY seq)) AS source_name,
      first(data_confidence ORDER BY rnk DESC, seq) AS data_confidence, arg_max(a_name, seq) AS city_name_ko_audit FROM audits GROUP BY city_id)
    SELECT f.*, i.image_url, coalesce(n, 0) AS images, CASE WHEN img_seq > start THEN concat('updated: source=', CASE WHEN src = '' THEN 'unknown' ELSE src END) END AS image_audit
    FROM fields f JOIN imgs i USING (city_id) LEFT JOIN listed USING (city_id)"""


@query(MERGED)
def dataset_merge(t):
    """Two versions of the published city dataset, the second from several rows per city."""
    path = work_folder(t.spark, "dataset")
    jobs.merge_city_dataset(t.spark, path, _records(t["base_cities"]).withColumn("seq", F.lit(0).cast("long")))
    jobs.merge_city_dataset(t.spark, path, _records(t["new_cities"]), chunk_rows=500)
    status = F.col("field_status")
    return sinks.read_published(t.spark, path).select(
        "city_id", "city_name_ko", "location", "source_name", "data_confidence",
        F.try_element_at(status, F.lit("city_name_ko")).alias("city_name_ko_audit"),
        "image_url", F.size("image_urls").cast("long").alias("images"),
        F.try_element_at(status, F.lit("image_url")).alias("image_audit"),
    )


YEARS = (1994, 1995)
KNOWN_SEGMENTS = SHIPMENTS.replace("FROM {shipments} f JOIN", "FROM (SELECT * FROM {shipments} WHERE tou_div_cd <= 3) f JOIN")


@query(KNOWN_SEGMENTS + f"""
    , years AS (SELECT unnest([{", ".join(map(str, YEARS))}]) AS year),
    meta AS (SELECT DISTINCT n_name AS city_name_en FROM {{supplier}} JOIN {{nation}} ON n_nationkey = s_nationkey WHERE n_nationkey < 20),
    stats AS (SELECT city_name_en, year, count(*) AS n, sum(cast(total_visitors AS decimal(28, 2))) AS total FROM monthly WHERE has_data GROUP BY 1, 2),
    cities AS (SELECT year, city_name_en FROM years CROSS JOIN meta UNION SELECT year, city_name_en FROM stats WHERE year IN (SELECT year FROM years))
    SELECT c.year, c.city_name_en, coalesce(s.n, 0) AS months, round(cast(s.total AS double), 2) AS total,
      CASE WHEN m.city_name_en IS NULL THEN 'visitor_only' WHEN s.n IS NULL THEN 'wikipedia_only' ELSE 'merged' END AS outcome
    FROM cities c LEFT JOIN meta m USING (city_name_en) LEFT JOIN stats s ON s.city_name_en = c.city_name_en AND s.year = c.year""")
def final_cities_years(t):
    """Merged city files of two years out of statistics of several."""
    folder = work_folder(t.spark, "final-years")
    named = t.sql(
        "SELECT n_name AS city_name_en, s_name AS title, s_suppkey AS pos FROM {supplier} JOIN {nation} "
        "ON n_nationkey = s_nationkey WHERE n_nationkey < 20"
    )
    monthly = jobs.saved(visitors.monthly_statistics(_mapped(t, "shipments")), "monthly")
    schema = """city_name_en string, outcome string,
        visitor_statistics struct<monthly_statistics: array<struct<month: string, total_visitors: double>>>"""
    found = []
    for year in YEARS:
        jobs.finalise_cities(named, "pos", monthly, f"{folder}/{year}", year)
        found.append(t.spark.read.schema(schema).json(f"{folder}/{year}").withColumn("year", F.lit(year)))
    rows = found[0].union(found[1])
    listed = F.col("visitor_statistics.monthly_statistics")
    cents = F.aggregate(listed, F.lit(0).cast("decimal(28,2)"), lambda a, m: (a + m["total_visitors"].cast("decimal(20,2)")).cast("decimal(28,2)"))
    return rows.select(
        "year", "city_name_en", F.coalesce(F.size(listed), F.lit(0)).cast("long").alias("months"),
        F.round(cents.cast("double"), 2).alias("total"), "outcome",
    )


@query(f"""
    SELECT key, ddb_pk, bad, processed FROM (
      SELECT concat(entity_type, '#', content_id, '#0') AS key, CASE WHEN pos % 2 = 0 THEN concat('AREA#', city_name_en) ELSE PK END AS ddb_pk
      FROM ({VECTOR_ROWS}) v WHERE entity_type <> 'festival') k
    CROSS JOIN (SELECT count(CASE WHEN entity_type = 'festival' THEN 1 END) + count(CASE WHEN entity_type = 'festival' AND pos % 2 = 0 THEN 1 END) AS bad,
      count(*) + count(CASE WHEN pos % 2 = 0 THEN 1 END) AS processed FROM ({VECTOR_ROWS}) w) c""")
def vector_build(t):
    """Vector build over items of which every other occurs twice: the first key in store order stays."""

    def embed(texts):
        return [None if "축제" in text else [float(len(text)), 1.0] for text in texts]

    items = t["items"]
    twice = items.where("pos % 2 = 0").withColumn("PK", F.concat(F.lit("AREA#"), "city_name_en"))
    built = jobs.build_vectors(items.union(twice), embed, "index", dimension=2)
    counts = built["summary"].first()
    number = {"bad": counts["items_skipped"], "processed": counts["items_processed"]}
    rows = built["records"].select("key", "metadata.ddb_pk")
    return rows.withColumns({n: F.lit(v).cast("long") for n, v in number.items()})


@query("""
    SELECT concat('raw/KR/details/20260101/', source, '.json') AS s3_key, cast(1 AS bigint) AS bodies,
      CASE WHEN source LIKE '%1' THEN 'skipped' ELSE 'uploaded' END AS again, cast(sum(n_chars) AS bigint) AS chars
    FROM {documents} GROUP BY source""")
def ingest_retry(t):
    """A raw ingest that is tried again, then run anew with a partial manifest; every key has one body."""
    folder = work_folder(t.spark, "ingest-retry")
    meta = F.struct(F.col("source").alias("city_name_en"))
    files = t["documents"].groupBy("source").agg(F.sum("n_chars").alias("chars"))
    files.select(meta.alias("meta"), "chars").write.option("maxRecordsPerFile", 1).json(f"{folder}/raw")
    none = t.spark.createDataFrame([], "s3_key string, checksum_sha256 string")
    zone, date = f"{folder}/zone", "2026-01-01"
    jobs.ingest_raw(t.spark, f"{folder}/raw", zone, date, none, 1)
    first = jobs.ingest_raw(t.spark, f"{folder}/raw", zone, date, none, 1)
    known = first.where(F.col("city_name_en").endswith("1")).select("s3_key", "checksum_sha256")
    again = jobs.ingest_raw(t.spark, f"{folder}/raw", zone, date, jobs.saved(known, "known"), 2)
    bodies = jobs.ingested_bodies(t.spark, zone).groupBy("s3_key").agg(
        F.count("*").alias("bodies"), F.first(F.get_json_object("body", "$.chars").cast("long")).alias("chars")
    )
    return again.select("s3_key", F.col("status").alias("again")).join(bodies, "s3_key")


_PAGE = "struct<title:string,extract:string,coordinates:struct<lat:double,lon:double>,extlinks:array<string>,content:string>"


@query("""
    SELECT page_id, concat(region, '-TOWN-', cast(page_id AS string)) AS city_id,
      CASE WHEN page_id % 5 = 0 THEN 'own' WHEN region = 'JP-13' THEN 'prefecture' ELSE 'none' END AS climate,
      CASE WHEN page_id % 5 = 0 OR region = 'JP-13' THEN 'collected' ELSE 'needs_review' END AS status,
      CASE WHEN region = 'JP-13' THEN 12 ELSE 0 END AS region_cells, CASE WHEN region = 'JP-13' THEN 35.5 END AS region_latitude,
      CASE WHEN region = 'JP-13' THEN '산과 들.' END AS region_geography
    FROM (SELECT page_id, CASE WHEN page_id % 2 = 0 THEN 'JP-13' ELSE 'JP-14' END AS region FROM {pages}) p""")
def japanese_cities(t):
    """Japanese city records with climate tables of their own, of their prefecture, or none."""
    town = F.concat(F.lit("Town "), "page_id")
    content = F.when(F.col("page_id") % 5 == 0, F.concat(F.lit("== 기후 ==\n온화하다 "), "page_id")).otherwise("")
    own = F.struct(town.alias("title"), F.lit("").alias("extract"), F.lit(None).cast("struct<lat:double,lon:double>").alias("coordinates"),
                   F.array().cast("array<string>").alias("extlinks"), content.alias("content")).cast(_PAGE)
    none = F.lit(None).cast(_PAGE)
    structs = t["pages"].select(
        own.alias("source"), own.alias("ko"), none.alias("ja"), own.alias("en"), F.lit("ko").alias("lang"),
        F.when(F.col("page_id") % 2 == 0, "JP-13").otherwise("JP-14").alias("prefecture_id"),
    )
    html = (
        '<h1 id="firstHeading">도쿄도</h1><div id="mw-content-text"><div class="mw-parser-output"><span class="geo-dec">35.5; 139.5</span>'
        '<h2>지리</h2><p>산과 들.</p><h2>기후</h2><table class="wikitable"><caption>도쿄의 기후</caption>'
        "<tr><th>월</th>" + "".join(f"<th>{m}월</th>" for m in range(1, 13)) + "</tr><tr><td>평균 기온 (°C)</td>" + "<td>5.4</td>" * 12 + "</tr>"
        "</table></div></div>"
    )
    regions = t["pages"].agg(F.count("*").alias("n")).select(F.lit(html).alias("html"), F.lit("JP-13").alias("prefecture_id"))
    made = jobs.acquire_japanese_cities(structs, regions, F.lit("2026-01-01"))
    cells = F.coalesce(F.size(pages.climate_data(F.col("climate_table"))), F.lit(0))
    region = made["prefectures"].select(
        "prefecture_id", cells.alias("region_cells"), F.col("latitude").alias("region_latitude"),
        F.nullif("geography_description", F.lit("")).alias("region_geography"),
    )
    table = F.col("climate_table")
    scope = F.coalesce(F.try_element_at(table, F.lit("source_scope")), F.when(F.col("field_status")["climate_table"] == "collected", "own"), F.lit("none"))
    return made["cities"].join(region, "prefecture_id").select(
        F.regexp_extract("city_id", r"(\d+)$", 1).cast("long").alias("page_id"), "city_id", scope.alias("climate"),
        F.col("field_status")["climate_table"].alias("status"), "region_cells", "region_latitude", "region_geography",
    )


@query(ITEMS + """
    , files AS (SELECT count(DISTINCT concat(city_name_en, '/', cast(floor(pos / 2000) AS string))) AS n FROM {content})
    SELECT b.bucket, count(*) AS item_count, cast(2 AS bigint) AS broken FROM (
      SELECT 'review' AS bucket FROM domain_rows WHERE quality_status = 'review'
      UNION ALL SELECT 'failed' FROM domain_rows WHERE quality_status = 'failed'
      UNION ALL SELECT concat(entity_type, 's') FROM domain_rows WHERE entity_type <> 'excluded' AND quality_status <> 'failed'
      UNION ALL SELECT 'load_items' FROM domain_rows WHERE entity_type <> 'excluded' AND quality_status <> 'failed'
      UNION ALL SELECT unnest(['city_metadata', 'visitor_statistics', 'load_items', 'load_items']) FROM (SELECT unnest(range(n)) FROM files) f) b
    GROUP BY 1""")
def preprocess_job(t):
    """Raw lines, two of them broken, to stored buckets; items per bucket and failed lines."""
    folder = work_folder(t.spark, "preprocess")
    t.payloads.select("body").write.text(f"{folder}/raw/good")
    t.spark.createDataFrame([("[1]",), ("{broken",)], "body string").write.text(f"{folder}/raw/bad")
    done = jobs.preprocess_domain(t.spark, f"{folder}/raw", f"{folder}/out", t["classes"], whole_files=False, pattern="*.txt")
    failed = done["failed_files"].count()
    stored = t.spark.read.parquet(f"{folder}/out/items")
    return stored.groupBy("bucket").agg(F.count("*").alias("item_count"), F.lit(failed).cast("long").alias("broken"))


@query("""
    SELECT DISTINCT concat('CITY#', city_name_en) AS PK, 'STAT#202501' AS SK, cast(2025 AS int) AS year, '202501' AS month, cast(31 AS int) AS days,
      cast(floor(pos / 2000) AS double) AS locals_total FROM {content}""")
def statistics_rows(t):
    """Monthly statistics entries of all payloads, as the statistics view shows them."""
    items = domain.domain_items(raw.parse_payloads(t.payloads), t["classes"])
    view = domain.entity_view(items, "visitor_statistics")
    return view.select("PK", "SK", "year", "month", F.col("days").cast("int").alias("days"), "locals_total")


@query("""
    SELECT s_suppkey, s_name AS name FROM {supplier} JOIN {nation} ON n_nationkey = s_nationkey
    WHERE n_regionkey IN (1, 3) AND s_suppkey IN (SELECT l_suppkey FROM {lineitem} WHERE l_quantity >= 50)""")
def region_targets(t):
    """Districts (one per supplier) of the covered regions, limited to the names of those with a large shipment."""
    districts = t["supplier"].join(t["nation"], F.col("n_nationkey") == F.col("s_nationkey")).select(
        "s_suppkey", F.col("s_name").alias("lDongSignguNm"), F.concat(F.lit("r"), "n_regionkey").alias("lDongRegnCd")
    )
    large = t["lineitem"].where("l_quantity >= 50").select(F.col("l_suppkey").alias("s_suppkey"))
    names = t["supplier"].join(large, "s_suppkey", "left_semi").select(F.col("s_name").alias("city_name_ko"))
    found = dimensions.region_targets(districts, names, ("r1", "r3"))
    return found.select("s_suppkey", F.col("lDongSignguNm").alias("name"))


@query("""
    SELECT concat('part-', cast(p_partkey AS string), '.json') AS file_name, CASE WHEN l.k IS NOT NULL THEN 'found' ELSE 'failed' END AS status,
      CASE WHEN l.k IS NULL THEN concat('File not found: part-', cast(p_partkey AS string), '.json') END AS error
    FROM {part} LEFT JOIN (SELECT DISTINCT l_partkey AS k FROM {lineitem} WHERE l_returnflag = 'R') l ON l.k = p_partkey""")
def required_files(t):
    """A file per part, against an inventory of the parts that were returned."""
    name = lambda key: F.concat(F.lit("part-"), key, F.lit(".json")).alias("file_name")
    returned = t["lineitem"].where("l_returnflag = 'R'").select(name("l_partkey"))
    return sinks.required_files(t.spark, t["part"].select(name("p_partkey")), returned)


@query("SELECT entity_type, count(*) AS item_count, cast(2 AS int) AS version FROM {items} WHERE province <> 'ASIA' GROUP BY 1")
def published_items(t):
    """Two published versions of the items; the newest is read back by entity type."""
    path = work_folder(t.spark, "published")
    sinks.publish_items(t["items"], path, 1)
    sinks.publish_items(t["items"].where("province <> 'ASIA'"), path, 2)
    current = sinks.read_published(t.spark, path)
    version = F.lit(sinks.latest_version(t.spark, path)).cast("int").alias("version")
    return current.groupBy("entity_type").agg(F.count("*").alias("item_count")).select("entity_type", "item_count", version)
