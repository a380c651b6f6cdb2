"""Domain normalisation queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tripweave.functions import dates
from tripweave.functions.text import (
    coordinate_status,
    coordinates,
    image_extension,
    image_key,
    media_type,
    raw_detail_key,
    safe_object_name,
    url_extension,
)
from tripweave.operators import domain, harvest, legacy
from tripweave.sources import dimensions, raw
from tripweave.workloads.registry import query


def _items(t):
    return domain.domain_items(raw.parse_payloads(t.payloads), t["classes"], "2026-01-01")


# Content records as domain items, in plain SQL.
ITEMS = """
    WITH typed AS (
      SELECT c.*, CASE WHEN contenttypeid = '15' THEN 'festival' WHEN contenttypeid IN ('12', '14', '28')
          THEN 'attraction' ELSE 'excluded' END AS entity_type,
        CASE WHEN mapx = 'x' THEN NULL ELSE cast(mapx AS double) END AS lon,
        CASE WHEN mapx = 'x' THEN NULL ELSE cast(mapy AS double) END AS lat,
        k.name AS k_name, k.type AS k_type, k.theme AS k_theme,
        CASE WHEN start_ymd = '' THEN '' ELSE concat(substr(start_ymd, 1, 4), '-', substr(start_ymd, 5, 2), '-', substr(start_ymd, 7, 2)) END AS start_iso
      FROM {content} c LEFT JOIN {classes} k ON k.code = c.lcls),
    issued AS (
      SELECT *, concat_ws(',',
          CASE WHEN contentid = '' THEN 'missing_contentid' END,
          CASE WHEN title = '' THEN 'missing_title' END,
          CASE WHEN entity_type = 'excluded' THEN 'source_review' END,
          CASE WHEN NOT coalesce(lon BETWEEN 124 AND 132 AND lat BETWEEN 33 AND 39, false) THEN 'location_review' END,
          CASE WHEN entity_type = 'attraction' AND cat3 = '' THEN 'theme_review' END,
          CASE WHEN (entity_type = 'attraction' AND coalesce(k_type, '') <> 'Attraction')
            OR (entity_type = 'festival' AND k_name IS NULL) THEN 'classification_review' END) AS issues
      FROM typed),
    domain_rows AS (
      SELECT *, CASE WHEN entity_type = 'excluded' THEN 'review'
          WHEN contentid = '' OR title = '' THEN 'failed' WHEN issues <> '' THEN 'review' ELSE 'passed' END AS quality_status
      FROM issued)
"""


@query(ITEMS + """
    SELECT entity_type, quality_status, count(*) AS item_count FROM domain_rows GROUP BY 1, 2""")
def domain_classify_counts(t):
    """Content items by entity type and quality."""
    content = _items(t).where(~F.col("entity_type").isin("city_metadata", "visitor_statistics"))
    return content.groupBy("entity_type", "quality_status").agg(F.count("*").alias("item_count"))


@query(ITEMS + """
    SELECT concat('CITY#', city_name_en) AS PK,
      concat(CASE entity_type WHEN 'excluded' THEN 'EXCLUDED#' WHEN 'festival' THEN 'FESTIVAL#' ELSE 'ATTRACTION#' END,
        CASE WHEN entity_type = 'excluded' AND contentid = '' THEN 'UNKNOWN' ELSE contentid END) AS SK,
      concat('PROVINCE#', CASE WHEN province = '' THEN 'UNKNOWN' ELSE province END) AS province_key,
      contentid AS content_id, entity_type, quality_status, issues AS review_queues, title, lon AS longitude, lat AS latitude,
      overview AS description, trim(addr1) AS address,
      CASE WHEN firstimage <> '' THEN firstimage ELSE trim(firstimage2) END AS image_url,
      CASE WHEN entity_type = 'attraction' THEN trim(tel) END AS phone,
      CASE entity_type WHEN 'festival' THEN coalesce(k_theme, '') WHEN 'attraction' THEN cat3 END AS theme,
      CASE WHEN entity_type = 'attraction' AND k_type = 'Attraction' THEN lcls END AS attraction_subtype_code,
      CASE WHEN entity_type = 'attraction' AND k_type = 'Attraction' THEN k_name END AS attraction_subtype_name,
      CASE WHEN entity_type = 'festival' THEN k_name END AS source_subtype_name,
      CASE WHEN entity_type = 'festival' THEN CASE WHEN trim(addr1) = '' THEN 'hall' ELSE 'hall' END END AS venue,
      CASE WHEN entity_type = 'festival' THEN start_iso END AS event_start_date,
      CASE WHEN entity_type = 'festival' AND start_iso <> '' THEN cast(cast(substr(start_iso, 6, 2) AS int) AS string) END AS month,
      CASE WHEN entity_type = 'festival' THEN concat('FESTIVAL#', CASE WHEN start_iso = '' THEN '00' ELSE substr(start_iso, 6, 2) END, '#', contentid) END AS gsi_sk
    FROM domain_rows""")
def domain_items(t):
    """Wide items of all content records."""
    items = _items(t).where(~F.col("entity_type").isin("city_metadata", "visitor_statistics"))
    return items.select(
        "PK", "SK", "province_key", "content_id", "entity_type", "quality_status",
        F.array_join("review_queues", ",").alias("review_queues"),
        "title", "longitude", "latitude", "description", "address", "image_url", "phone", "theme",
        "attraction_subtype_code", "attraction_subtype_name", "source_subtype_name", "venue",
        "event_start_date", "month", "gsi_sk",
    )


@query(ITEMS + """
    SELECT concat('raw/', city_name_en, '/', cast(cast(floor(pos / 2000) AS int) AS string), '.json') AS source_key,
      cast(1 AS bigint) AS city_metadata, cast(1 AS bigint) AS visitor_statistics,
      count(CASE WHEN entity_type = 'attraction' AND quality_status <> 'failed' THEN 1 END) AS attractions,
      count(CASE WHEN entity_type = 'festival' AND quality_status <> 'failed' THEN 1 END) AS festivals,
      count(CASE WHEN quality_status = 'review' THEN 1 END) AS review,
      count(CASE WHEN quality_status = 'failed' THEN 1 END) AS failed,
      2 + count(CASE WHEN entity_type <> 'excluded' AND quality_status <> 'failed' THEN 1 END) AS load_items
    FROM domain_rows GROUP BY 1""")
def domain_quality_summary(t):
    """Output counts per raw file."""
    return domain.quality_summary(_items(t), "source_key")


@query(ITEMS + """
    SELECT b.bucket, count(*) AS item_count FROM (
      SELECT 'review' AS bucket FROM domain_rows WHERE quality_status = 'review'
      UNION ALL SELECT 'failed' FROM domain_rows WHERE quality_status = 'failed'
      UNION ALL SELECT concat(entity_type, 's') FROM domain_rows WHERE entity_type <> 'excluded' AND quality_status <> 'failed'
      UNION ALL SELECT 'load_items' FROM domain_rows WHERE entity_type <> 'excluded' AND quality_status <> 'failed') b
    GROUP BY 1""")
def domain_buckets(t):
    """Content items per output; a review item is in two outputs."""
    items = _items(t).where(~F.col("entity_type").isin("city_metadata", "visitor_statistics"))
    return items.select(F.explode("buckets").alias("bucket")).groupBy("bucket").agg(
        F.count("*").alias("item_count")
    )


@query("""
    SELECT concat('raw/', city_name_en, '/', cast(cast(floor(pos / 2000) AS int) AS string), '.json') AS source_key,
      city_id, city_name_en, province,
      cast(count(CASE WHEN contenttypeid <> '15' THEN 1 END) AS int) AS attraction_count,
      cast(count(CASE WHEN contenttypeid = '15' THEN 1 END) AS int) AS festival_count,
      0 AS visitor_statistics_count
    FROM {content} GROUP BY 1, 2, 3, 4""")
def city_records(t):
    """City record of every raw file."""
    return legacy.city_records(raw.parse_payloads(t.payloads)).drop(
        "city_name_ko", "lDongRegnCd", "lDongSignguCd"
    )


LEGACY = """
    WITH typed AS (
      SELECT *, CASE WHEN contenttypeid = '15' THEN 'festival' ELSE 'attraction' END AS entity_type,
        CASE WHEN mapx = 'x' THEN NULL ELSE cast(mapx AS double) END AS lon, cast(mapy AS double) AS lat,
        CASE WHEN start_ymd = '' THEN '' ELSE concat(substr(start_ymd, 1, 4), '-', substr(start_ymd, 5, 2), '-', substr(start_ymd, 7, 2)) END AS start_iso
      FROM {content}),
    issued AS (
      SELECT *, concat_ws(',',
          CASE WHEN contentid = '' THEN 'missing_contentid' END,
          CASE WHEN title = '' THEN 'missing_title' END,
          CASE WHEN NOT coalesce(lon BETWEEN 124 AND 132 AND lat BETWEEN 33 AND 39, false) THEN 'location_review' END,
          CASE WHEN cat3 = '' THEN 'theme_review' END,
          CASE WHEN pos % 2 = 1 AND trim(tel) = '' THEN 'contact_review' END) AS issues
      FROM typed),
    legacy_rows AS (
      SELECT *, concat('raw/', city_name_en, '/', cast(cast(floor(pos / 2000) AS int) AS string), '.json') AS source_key,
        CASE WHEN contentid = '' OR title = '' THEN 'failed' WHEN issues <> '' THEN 'review' ELSE 'passed' END AS quality_status
      FROM issued)
"""


@query(LEGACY + """
    SELECT source_key, entity_type, contentid AS content_id, quality_status, issues AS review_queues,
      concat(CASE entity_type WHEN 'festival' THEN 'FESTIVAL#' ELSE 'ATTRACTION#' END, contentid) AS SK,
      start_iso AS eventstartdate, end_iso AS eventenddate,
      CASE WHEN start_iso <> '' AND end_iso <> '' THEN array_to_string(list_sort(list_distinct(list_transform(
        generate_series(0, least(11, datediff('month', cast(start_iso AS date), cast(end_iso AS date)))),
        lambda i: (month(cast(start_iso AS date)) - 1 + i) % 12 + 1))), ',') ELSE '' END AS visit_months
    FROM legacy_rows""")
def legacy_records(t):
    """Flat content records of the first data model."""
    rows = legacy.transform_records(raw.parse_payloads(t.payloads))
    return rows.where(F.col("entity_type") != "visitor_statistics").select(
        "source_key", "entity_type", "content_id", "quality_status",
        F.array_join("review_queues", ",").alias("review_queues"), "SK",
        "eventstartdate", "eventenddate", F.array_join(F.col("visit_months").cast("array<string>"), ",").alias("visit_months"),
    )


@query(LEGACY + """
    SELECT source_key, count(CASE WHEN quality_status = 'passed' THEN 1 END) + 1 AS passed_count,
      count(CASE WHEN quality_status = 'review' THEN 1 END) AS review_count,
      count(CASE WHEN quality_status = 'failed' THEN 1 END) + 1 AS failed_count, 'failed' AS status
    FROM legacy_rows GROUP BY 1""")
def file_status(t):
    """Status of every raw file (each has one bad statistics row)."""
    return legacy.file_status(legacy.transform_records(raw.parse_payloads(t.payloads)))


@query(LEGACY + """
    SELECT count(*) AS city_processed, count(CASE WHEN bad = 0 AND rev > 0 THEN 1 END) AS review_count,
      count(CASE WHEN bad > 0 THEN 1 END) AS failed_count,
      CASE WHEN max(bad) = 0 THEN 'ok' ELSE 'partial' END AS status,
      CASE WHEN max(bad) = 0 THEN 200 ELSE 207 END AS status_code
    FROM (SELECT source_key, count(CASE WHEN quality_status = 'failed' THEN 1 END) AS bad,
      count(CASE WHEN quality_status = 'review' THEN 1 END) AS rev FROM legacy_rows GROUP BY 1) f""")
def run_summary(t):
    """Run status over the content rows of all files."""
    rows = legacy.transform_records(raw.parse_payloads(t.payloads))
    return legacy.run_summary(legacy.file_status(rows.where(F.col("entity_type") != "visitor_statistics")))


@query("""
    SELECT pos, coalesce(lon BETWEEN 124 AND 132 AND lat BETWEEN 33 AND 39, false) AS ok, lon AS longitude, lat AS latitude
    FROM (SELECT pos, CASE WHEN mapx = 'x' THEN NULL ELSE cast(mapx AS double) END AS lon,
      CASE WHEN mapx = 'x' THEN NULL ELSE cast(mapy AS double) END AS lat FROM {content}) c""")
def coordinate_check(t):
    """Bounding-box check of raw coordinates."""
    return t["content"].select("pos", coordinates(F.col("mapx"), F.col("mapy")).alias("c")).select("pos", "c.*")


@query("""
    SELECT pos, CASE WHEN mapx = 'x' THEN 'missing' WHEN mapx = '0' THEN 'needs_review'
      WHEN cast(mapx AS double) BETWEEN 124 AND 132 AND cast(mapy AS double) BETWEEN 33 AND 39 THEN 'collected'
      ELSE 'needs_review' END AS status FROM {content}""")
def coordinate_states(t):
    """Collection status of raw coordinates."""
    return t["content"].select("pos", coordinate_status(F.col("mapx"), F.col("mapy")).alias("status"))


@query(ITEMS + """
    SELECT lcls AS code, k_name AS name, count(*) AS item_count FROM domain_rows
    WHERE entity_type = 'attraction' AND k_type = 'Attraction' GROUP BY 1, 2""")
def subtype_mapping(t):
    """Attractions per mapped subtype."""
    code, name = F.col("attraction_subtype_code").alias("code"), F.col("attraction_subtype_name").alias("name")
    return (
        _items(t).where(F.col("attraction_subtype_code").isNotNull()).groupBy(code, name)
        .agg(F.count("*").alias("item_count"))
    )


@query(ITEMS + """
    SELECT k_name AS source_subtype_name, k_theme AS source_theme, count(*) AS item_count
    FROM domain_rows WHERE entity_type = 'festival' GROUP BY 1, 2""")
def festival_source(t):
    """Festivals per preserved source class."""
    festivals = _items(t).where(F.col("entity_type") == "festival")
    return festivals.groupBy("source_subtype_name", "source_theme").agg(F.count("*").alias("item_count"))


THEMES = """
    WITH kept AS (SELECT * FROM {mapping} WHERE theme <> '기타' AND large_category <> '체험관광' AND middle_category <> '교육시설'),
    themes AS (SELECT code, arg_max(theme, ordinal) AS theme FROM kept GROUP BY code)
"""


@query(THEMES + """
    SELECT c.pos, c.city_name_en, t.theme AS assigned_theme FROM {content} c
    JOIN themes t ON t.code = CASE WHEN c.lcls <> '' THEN c.lcls ELSE c.cat3 END WHERE c.lcls1 <> 'C01'""")
def theme_filter(t):
    """Tour records of the mapped themes."""
    records = t["content"].withColumnsRenamed({"lcls": "lclsSystm3", "lcls1": "lclsSystm1"})
    filtered = harvest.filter_by_theme(records, dimensions.theme_map(t["mapping"]))
    return filtered.select("pos", "city_name_en", "assigned_theme")


@query(THEMES + """
    , filtered AS (SELECT c.*, t.theme FROM {content} c
      JOIN themes t ON t.code = CASE WHEN c.lcls <> '' THEN c.lcls ELSE c.cat3 END WHERE c.lcls1 <> 'C01')
    SELECT c.city_name_en AS city_name_ko,
      count(CASE WHEN c.contenttypeid <> '15' THEN 1 END) AS attractions_count_raw,
      count(CASE WHEN c.contenttypeid = '15' THEN 1 END) AS festivals_count_raw,
      count(CASE WHEN c.contenttypeid <> '15' THEN f.pos END) AS attractions_count_filtered,
      count(CASE WHEN c.contenttypeid = '15' THEN f.pos END) AS festivals_count_filtered
    FROM {content} c LEFT JOIN filtered f ON f.pos = c.pos GROUP BY 1""")
def region_list_counts(t):
    """Raw and theme-filtered record counts per city."""
    kind = F.when(F.col("contenttypeid") == "15", F.lit("festival")).otherwise(F.lit("attraction"))
    records = t["content"].withColumnsRenamed(
        {"lcls": "lclsSystm3", "lcls1": "lclsSystm1", "city_name_en": "city_name_ko"}
    ).withColumn("kind", kind)
    filtered = harvest.filter_by_theme(records, dimensions.theme_map(t["mapping"]))
    return harvest.list_counts(records, filtered)


ORDER_DATES = """
    SELECT o_orderkey, CASE WHEN o_orderkey % 50 = 1 THEN '20251399' WHEN o_orderkey % 50 = 2 THEN '' ELSE
        replace(substr(cast(o_orderdate AS string), 1, 10), '-', CASE o_orderkey % 3 WHEN 0 THEN '' WHEN 1 THEN '-' ELSE '.' END) END AS raw_start,
      CASE WHEN o_orderkey % 40 = 3 THEN '' ELSE substr(cast(cast(o_orderdate AS date) + cast(o_orderkey % 400 AS int) AS string), 1, 10) END AS raw_end
    FROM {orders}
"""
PARSED = f"""
    WITH raw_dates AS ({ORDER_DATES}),
    parsed AS (SELECT *,
      coalesce(strftime(coalesce(try_strptime(raw_start, '%Y%m%d'), try_strptime(raw_start, '%Y-%m-%d'), try_strptime(raw_start, '%Y.%m.%d')), '%Y-%m-%d'), '') AS strict_iso,
      CASE WHEN regexp_matches(raw_start, '^[0-9]{{8}}$') THEN concat(substr(raw_start, 1, 4), '-', substr(raw_start, 5, 2), '-', substr(raw_start, 7, 2))
        WHEN length(raw_start) = 10 AND substr(raw_start, 5, 1) = '-' THEN raw_start ELSE '' END AS shape_iso
      FROM raw_dates)
"""


def _order_dates(t):
    return t.sql(ORDER_DATES).select(
        "*",
        dates.strict_iso_date(F.col("raw_start")).alias("strict_iso"),
        dates.structural_iso_date(F.col("raw_start")).alias("shape_iso"),
    )


@query(PARSED + """
    SELECT o_orderkey, strict_iso, shape_iso,
      concat('FESTIVAL#', CASE WHEN shape_iso = '' THEN '00' ELSE substr(shape_iso, 6, 2) END, '#', cast(o_orderkey AS string)) AS gsi_sk,
      trim(concat(strict_iso, '~', raw_end), '~') AS period
    FROM parsed""")
def festival_dates(t):
    """Both date parsers, the month index key and the period text."""
    return _order_dates(t).select(
        "o_orderkey", "strict_iso", "shape_iso",
        dates.festival_sort_key(F.col("o_orderkey").cast("string"), F.col("shape_iso")).alias("gsi_sk"),
        dates.date_range_text(F.col("strict_iso"), F.col("raw_end")).alias("period"),
    )


@query(PARSED + """
    SELECT o_orderkey, CASE WHEN strict_iso <> '' AND raw_end <> '' THEN array_to_string(list_sort(list_distinct(list_transform(
        generate_series(0, least(11, datediff('month', cast(strict_iso AS date), cast(raw_end AS date)))),
        lambda i: (month(cast(strict_iso AS date)) - 1 + i) % 12 + 1))), ',') ELSE '' END AS months
    FROM parsed""")
def visit_months_span(t):
    """Months touched between start and end, over years."""
    months = dates.visit_months_span(F.nullif("strict_iso", F.lit("")), F.nullif("raw_end", F.lit("")))
    return _order_dates(t).select(
        "o_orderkey", F.coalesce(F.array_join(months.cast("array<string>"), ","), F.lit("")).alias("months")
    )


@query(PARSED + """
    , m AS (SELECT *, CASE WHEN shape_iso <> '' THEN cast(substr(shape_iso, 6, 2) AS int) END AS s,
        CASE WHEN raw_end <> '' THEN cast(substr(raw_end, 6, 2) AS int) END AS e FROM parsed)
    SELECT o_orderkey, array_to_string(CASE WHEN s IS NULL THEN [] WHEN e IS NULL THEN [s] WHEN s <= e THEN generate_series(s, e)
      ELSE list_concat(generate_series(s, 12), generate_series(1, e)) END, ',') AS months FROM m""")
def visit_months_cyclic(t):
    """Months from start to end within one wrapped year."""
    months = dates.visit_months_cyclic(F.col("shape_iso"), F.col("raw_end"))
    return _order_dates(t).select(
        "o_orderkey", F.array_join(months.cast("array<string>"), ",").alias("months")
    )


@query(PARSED + """
    SELECT season, calendar_season, count(*) AS order_count FROM (SELECT
      CASE WHEN shape_iso = '' THEN NULL WHEN substr(shape_iso, 6, 2) IN ('12', '01', '02') THEN 'winter'
        WHEN substr(shape_iso, 6, 2) IN ('03', '04', '05') THEN 'spring'
        WHEN substr(shape_iso, 6, 2) IN ('06', '07', '08') THEN 'summer' ELSE 'autumn' END AS season,
      CASE WHEN shape_iso = '' THEN NULL WHEN substr(shape_iso, 6, 2) IN ('12', '01', '02') THEN 'winter'
        WHEN substr(shape_iso, 6, 2) IN ('03', '04', '05') THEN 'spring'
        WHEN substr(shape_iso, 6, 2) IN ('06', '07', '08') THEN 'summer'
        WHEN substr(shape_iso, 6, 2) IN ('09', '10', '11') THEN 'autumn' ELSE 'unknown' END AS calendar_season FROM parsed) p
    GROUP BY 1, 2""")
def seasons(t):
    """Both season rules over all order dates."""
    month = dates.iso_month(F.col("shape_iso"))
    rows = _order_dates(t).select(
        dates.season(month).alias("season"), dates.calendar_season(month).alias("calendar_season")
    )
    return rows.groupBy("season", "calendar_season").agg(F.count("*").alias("order_count"))


MONTH_TEXT = """
    SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN substr(cast(o_orderdate AS string), 1, 7)
      WHEN 1 THEN replace(substr(cast(o_orderdate AS string), 1, 7), '-', '') WHEN 2 THEN ' 2025-1' ELSE '' END AS raw_month FROM {orders}
"""


@query(f"""
    SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN replace(raw_month, '-', '') WHEN 1 THEN raw_month ELSE '' END AS month
    FROM ({MONTH_TEXT}) m""")
def stat_months(t):
    """Normalised statistics months."""
    return t.sql(MONTH_TEXT).select("o_orderkey", dates.stat_month(F.col("raw_month")).alias("month"))


@query("""
    SELECT y AS year, cast(m AS int) AS month_no, cast(day(last_day(make_date(y, m, 1))) AS int) AS days,
      concat(cast(y AS string), '-', lpad(cast(m AS string), 2, '0')) AS month
    FROM (SELECT DISTINCT cast(year(o_orderdate) AS bigint) AS y FROM {orders}) a, generate_series(1, 12) g(m)""")
def calendar_months(t):
    """Calendar grid of the years that occur in the orders."""
    years = t["orders"].select(F.year("o_orderdate").alias("year")).distinct()
    grid = years.select("year", F.inline(dates.month_grid("year")))
    return grid.select(F.col("year").cast("long").alias("year"), "month_no", "days", "month")


@query("""
    SELECT pos, CASE WHEN firstimage = '' THEN 'jpg' WHEN ext = 0 THEN 'jpg' WHEN ext = 1 THEN 'PNG' WHEN ext = 2 THEN 'gif' ELSE 'jpg' END AS raw_ext,
      CASE WHEN firstimage <> '' AND ext = 1 THEN 'png' WHEN firstimage <> '' AND ext = 2 THEN 'gif' ELSE 'jpg' END AS image_ext,
      CASE WHEN firstimage <> '' AND ext = 1 THEN 'image/png' WHEN firstimage <> '' AND ext = 2 THEN 'image/gif' ELSE 'image/jpeg' END AS media,
      replace(title, ' ', '_') AS object_name,
      concat('images/KR/', city_name_en, '/', CASE WHEN title = '' THEN 'UNKNOWN' ELSE replace(title, ' ', '_') END, '_1.jpg') AS image_key,
      concat('raw/KR/details/20260101/', city_name_en, '.json') AS raw_key
    FROM (SELECT c.*, CASE WHEN firstimage LIKE '%.jpg' THEN 0 WHEN firstimage LIKE '%.PNG%' THEN 1 WHEN firstimage LIKE '%.gif' THEN 2 ELSE 3 END AS ext FROM {content} c) x""")
def image_names(t):
    """Extensions, media types and object keys."""
    url = F.col("firstimage")
    # An address without an extension ends in the host's last label.
    bare = F.when(url.rlike(r"\.(jpg|gif)$|\.PNG"), url).otherwise(F.lit(""))
    return t["content"].select(
        "pos",
        url_extension(bare).alias("raw_ext"),
        image_extension(bare).alias("image_ext"),
        media_type(url_extension(bare)).alias("media"),
        safe_object_name(F.col("title")).alias("object_name"),
        image_key(F.col("city_name_en"), F.col("title"), F.lit("1"), F.lit(".jpg")).alias("image_key"),
        raw_detail_key(F.col("city_name_en"), F.lit("2026-01-01")).alias("raw_key"),
    )
