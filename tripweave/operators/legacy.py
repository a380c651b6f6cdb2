"""Flat record transform and its load normalisation (first data model)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripweave.functions import dates
from tripweave.functions.fields import field, field_or_null, first_field, has_field, stripped_field
from tripweave.functions.text import coordinates, or_default
from tripweave.operators.domain import (
    city_record,
    content_entries,
    content_type_id,
    issue_list,
    quality_status,
    statistics_entries,
)
from tripweave.sources.raw import is_object, text_at


def _entries(payloads: DataFrame) -> DataFrame:
    payload = F.col("payload")
    cities = payloads.select(
        "source_key",
        "payload",
        city_record().alias("city"),
        (F.coalesce(F.size(F.try_variant_get(payload, "$.meta", "map<string,variant>")), F.lit(0)) == 0).alias("no_meta"),
    )
    missing_meta = F.when(
        F.col("no_meta"),
        F.array(F.struct(F.lit("no_meta").alias("kind"), F.lit(0).alias("pos"), F.lit(None).cast("variant").alias("rec"))),
    ).otherwise(F.array().cast("array<struct<kind:string,pos:int,rec:variant>>"))
    entries = F.concat(content_entries(), statistics_entries(accept_list=True), missing_meta)
    return cities.select("source_key", "city", F.inline(F.when(payload.isNotNull(), entries)))


def transform_records(payloads: DataFrame) -> DataFrame:
    """Content and statistics records of (source_key, payload, is_valid).

    Every type but 15 is an attraction here, dates have to be real calendar
    days and a statistics row without a month fails.
    """
    rec, kind, city = F.col("rec"), F.col("kind"), F.col("city")

    def event_date(name: str) -> Column:
        return dates.strict_iso_date(first_field(f"detail.intro.{name}", name))

    no_contact_key = ~(
        has_field("$", "tel") | has_field("$.detail.common", "tel") | has_field("$", "infocenter")
    )
    parsed = _entries(payloads).select(
        "source_key", "city", "kind", "rec",
        stripped_field("contentid").alias("content_id"),
        stripped_field("title").alias("title"),
        content_type_id().alias("type_id"),
        coordinates(field_or_null("mapx"), field_or_null("mapy")).alias("geo"),
        stripped_field("_assigned_theme", "detail.intro.cat3", "cat3").alias("theme"),
        stripped_field("tel", "detail.common.tel", "detail.intro.infocenter").alias("phone"),
        no_contact_key.alias("no_contact_key"),
        event_date("eventstartdate").alias("start"),
        event_date("eventenddate").alias("end"),
        dates.strict_stat_month(field("month")).alias("stat_month"),
    )
    is_stat, no_meta = kind == "statistics", kind == "no_meta"
    is_content = kind.isin("attractions", "festivals")
    is_fest = is_content & (F.col("type_id") == "15")
    content_id, stat_month = F.col("content_id"), F.col("stat_month")
    issues = issue_list(
        (is_content & (content_id == ""), "missing_contentid"),
        (is_content & (F.col("title") == ""), "missing_title"),
        (is_content & ~F.col("geo.ok"), "location_review"),
        (is_content & (F.col("theme") == ""), "theme_review"),
        (is_content & F.col("no_contact_key") & (F.col("phone") == ""), "contact_review"),
        ((is_stat & (stat_month == "")) | no_meta, "source_review"),
    )
    issued = parsed.withColumn("review_queues", issues)
    start_month = dates.iso_month(F.col("start"))
    season = dates.calendar_season(start_month)
    stat_key = or_default(stat_month, "UNKNOWN")
    none = F.array().cast("array<string>")

    def content(col: Column, name: str) -> Column:
        return F.when(is_content, col).alias(name)

    return issued.select(
        F.when(is_stat, F.lit("visitor_statistics"))
        .when(no_meta, F.lit("city"))
        .when(is_fest, F.lit("festival"))
        .otherwise(F.lit("attraction"))
        .alias("entity_type"),
        "source_key",
        city["city_id"].alias("city_id"),
        city["city_name_en"].alias("city_name_en"),
        F.when(~no_meta, F.concat(F.lit("CITY#"), city["city_name_en"])).alias("PK"),
        F.when(is_stat, F.concat(F.lit("STAT#"), stat_key))
        .when(is_fest, F.concat(F.lit("FESTIVAL#"), content_id))
        .when(is_content, F.concat(F.lit("ATTRACTION#"), content_id))
        .alias("SK"),
        F.when(is_stat, F.concat_ws("-", F.lit("KR-STAT"), city["city_id"], stat_key))
        .when(no_meta, city["city_id"])
        .when(is_fest, F.concat(F.lit("FEST-"), content_id))
        .otherwise(F.concat(F.lit("ATT-"), content_id))
        .alias("entity_id"),
        content(content_id, "content_id"),
        content(F.nullif("type_id", F.lit("")), "contenttypeid"),
        content(F.col("title"), "title"),
        content(
            stripped_field("detail.common.overview", "detail.intro.overview", "detail.overview"),
            "description",
        ),
        content(F.col("theme"), "theme"),
        content(F.when(F.col("theme") != "", F.array("theme")).otherwise(none), "theme_tags"),
        content(F.col("phone"), "phone"),
        content(
            stripped_field("firstimage", "detail.common.firstimage", "firstimage2"), "image_url"
        ),
        content(stripped_field("addr1", "detail.intro.addr1"), "address"),
        content(F.col("geo.longitude"), "longitude"),
        content(F.col("geo.latitude"), "latitude"),
        F.lit(None).cast("string").alias("geohash"),
        F.lit(None).cast("string").alias("geohash_prefix"),
        content(F.col("start"), "eventstartdate"),
        content(F.col("end"), "eventenddate"),
        F.when(is_stat, stat_month).when(is_content, start_month.cast("string")).alias("month"),
        content(season, "season"),
        content(F.when(season.isNotNull(), F.array(season)).otherwise(none), "season_tags"),
        content(
            F.coalesce(
                dates.visit_months_span(F.nullif("start", F.lit("")), F.nullif("end", F.lit(""))),
                F.array().cast("array<int>"),
            ),
            "visit_months",
        ),
        F.when(is_stat, F.try_variant_get(rec, "$", "map<string,string>")).alias("statistics"),
        F.when(is_stat, F.when(stat_month == "", F.lit("failed")).otherwise(F.lit("passed")))
        .when(no_meta, F.lit("failed"))
        .otherwise(quality_status(F.col("review_queues")))
        .alias("quality_status"),
        "review_queues",
        F.when(no_meta, F.lit("Missing meta block")).alias("message"),
    )


def city_records(payloads: DataFrame) -> DataFrame:
    """One city record per valid file."""
    return payloads.where("is_valid").select(
        "source_key", F.inline(F.array(city_record()))
    )


def file_status(records: DataFrame) -> DataFrame:
    """Per file: failed if any row failed, else review, else passed."""
    counts = records.groupBy("source_key").agg(
        *[
            F.count_if(F.col("quality_status") == s).alias(f"{s}_count")
            for s in ("passed", "review", "failed")
        ]
    )
    status = (
        F.when(F.col("failed_count") > 0, F.lit("failed"))
        .when(F.col("review_count") > 0, F.lit("review"))
        .otherwise(F.lit("passed"))
    )
    return counts.withColumn("status", status)


def run_summary(files: DataFrame) -> DataFrame:
    """One row: file counts and the run status (200, or 207 on failures).

    ``files`` are ``file_status`` rows plus unreadable files as failed rows.
    """
    counts = files.agg(
        F.count("*").alias("city_processed"),
        F.count_if(F.col("status") == "review").alias("review_count"),
        F.count_if(F.col("status") == "failed").alias("failed_count"),
    )
    clean = F.col("failed_count") == 0
    return counts.select(
        "*",
        F.when(clean, F.lit("ok")).otherwise(F.lit("partial")).alias("status"),
        F.when(clean, F.lit(200)).otherwise(F.lit(207)).alias("status_code"),
    )


def load_plan(files: DataFrame, table_name: str) -> DataFrame:
    """Status, city and record count of processed (source_key, value) files."""
    doc = F.try_parse_json("value")
    return files.select("source_key", doc.alias("doc")).select(
        F.coalesce(text_at(F.col("doc"), "$.status"), F.lit("")).alias("status"),
        F.col("source_key").alias("source_path"),
        text_at(F.col("doc"), "$.city_record.city_id").alias("city_id"),
        F.coalesce(F.size(F.try_variant_get("doc", "$.records", "array<variant>")), F.lit(0)).alias("record_count"),
        F.lit(table_name).alias("table"),
    )


def load_rows(files: DataFrame) -> DataFrame:
    """Normalised key/value rows of processed (source_key, value) files.

    Each file gives a city row and its records.  Records that are no objects
    or lack an entity type come out with ``error`` set and are not loaded.
    """
    doc = F.col("doc")
    records = F.coalesce(
        F.transform(
            F.try_variant_get(doc, "$.records", "array<variant>"),
            lambda r, i: F.struct((i + 1).cast("int").alias("pos"), r.alias("rec")),
        ),
        F.array().cast("array<struct<pos:int,rec:variant>>"),
    )
    city_entry = F.when(
        F.coalesce(text_at(doc, "$.city_record.city_id"), F.lit("")) != "",
        F.array(F.struct(F.lit(0).alias("pos"), F.try_variant_get(doc, "$.city_record", "variant").alias("rec"))),
    ).otherwise(F.array().cast("array<struct<pos:int,rec:variant>>"))
    heads = files.select("source_key", F.try_parse_json("value").alias("doc")).select(
        "source_key",
        "doc",
        F.concat(F.lit("CITY#"), or_default(text_at(doc, "$.city_record.city_name_en"), "UNKNOWN")).alias("PK"),
        F.coalesce(text_at(doc, "$.status"), F.lit("")).alias("file_status"),
    )
    rows = heads.select("source_key", "PK", "file_status", F.inline(F.concat(city_entry, records)))
    rec, is_city = F.col("rec"), F.col("pos") == 0

    raw = field

    def record(col: Column, name: str) -> Column:
        return F.when(~is_city, col).alias(name)

    entity, content_id = F.when(is_city, F.lit("city")).otherwise(raw("entity_type")), raw("content_id")
    derived = (
        F.when(entity == "visitor_statistics", F.concat(F.lit("STAT#"), or_default(raw("month"), "UNKNOWN")))
        .when(raw("entity_id").startswith("FEST-"), F.concat(F.lit("FESTIVAL#"), content_id))
        .otherwise(F.concat(F.lit("ATTRACTION#"), content_id))
    )
    sort_key = F.when(is_city, F.lit("METADATA#city")).otherwise(
        F.coalesce(F.nullif(raw("SK"), F.lit("")), derived)
    )
    city_sort = F.concat(F.lit("city#"), raw("city_id"))
    domain_sort = F.when(is_city, city_sort).otherwise(
        F.concat(entity, F.lit("#"), F.coalesce(F.nullif(content_id, F.lit("")), raw("entity_id")))
    )
    months = F.coalesce(raw("month").try_cast("int"), dates.iso_month(raw("eventstartdate")), F.lit(0))
    index_key = (
        F.when(is_city, city_sort)
        .when(entity == "festival", F.format_string("FESTIVAL#%02d#%s", months, content_id))
        .otherwise(F.concat(entity, F.lit("#"), content_id))
    )
    error = (
        F.when(~is_object(rec), F.lit("record is not an object"))
        .when(entity == "", F.lit("entity_type is required"))
    )

    def text_list(name: str) -> Column:
        return F.coalesce(F.try_variant_get(rec, f"$.{name}", "array<string>"), F.array().cast("array<string>"))

    return rows.select(
        "source_key", "pos", "PK",
        sort_key.alias("SK"),
        entity.alias("entity_type"),
        record(raw("entity_id"), "entity_id"),
        record(content_id, "content_id"),
        F.when(is_city, raw("city_id")).alias("city_id"),
        F.when(is_city, raw("city_name_en")).alias("city_name_en"),
        F.when(is_city, raw("city_name_ko")).alias("city_name_ko"),
        F.when(is_city, raw("lDongRegnCd")).alias("lDongRegnCd"),
        F.when(is_city, raw("lDongSignguCd")).alias("lDongSignguCd"),
        F.when(is_city, F.col("file_status")).alias("source_status"),
        record(raw("quality_status"), "quality_status"),
        record(raw("source_key"), "source"),
        *[record(raw(n), n) for n in ("title", "theme", "description", "address", "phone", "image_url")],
        record(text_list("theme_tags"), "theme_tags"),
        record(text_list("season_tags"), "season_tags"),
        record(
            F.coalesce(F.try_variant_get(rec, "$.visit_months", "array<int>"), F.array().cast("array<int>")),
            "visit_months",
        ),
        record(F.try_variant_get(rec, "$.longitude", "double"), "longitude"),
        record(F.try_variant_get(rec, "$.latitude", "double"), "latitude"),
        record(or_default(text_at(rec, "$.geohash_prefix"), "UNKNOWN"), "geohash_prefix"),
        *[record(field_or_null(n), n) for n in ("eventstartdate", "eventenddate", "month", "season")],
        record(F.try_variant_get(rec, "$.statistics", "map<string,string>"), "statistics"),
        record(F.nullif(raw("image_status"), F.lit("")), "image_status"),
        record(F.lit(1), "item_count"),
        F.col("PK").alias("city_key"),
        F.when(is_city, raw("province"))
        .otherwise(F.coalesce(F.nullif(raw("province_key"), F.lit("")), raw("province")))
        .alias("province_key"),
        domain_sort.alias("domain_sort_key"),
        index_key.alias("gsi_sk"),
        F.when(~is_city, error).alias("error"),
    )
