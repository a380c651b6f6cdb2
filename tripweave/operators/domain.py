"""City payloads to typed domain items with quality routing.

A payload is exploded once into city, content and statistics entries and every
entry becomes one wide row, so the raw files are read and parsed a single time
and nothing is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripweave import schemas
from tripweave.functions import dates
from tripweave.functions.fields import (
    field,
    field_or_null,
    first_field,
    has_field,
    number_field,
    stripped_field,
)
from tripweave.functions.text import coordinates, first_non_empty, or_default, strip
from tripweave.sources import fixed
from tripweave.sources.dimensions import classification as built_in_classification

TABLE_NAME = "domain_items"


def city_id(meta_city_id: Column, city_code: Column, region: Column, district: Column, name_en: Column) -> Column:
    """Explicit id, else region and district code, else the English name."""
    code = first_non_empty(meta_city_id, city_code)
    region, district = F.coalesce(region, F.lit("")), F.coalesce(district, F.lit(""))
    return (
        F.when((code != "") & code.startswith("KR-"), code)
        .when(code != "", F.concat(F.lit("KR-"), code))
        .when((region != "") & (district != ""), F.concat_ws("-", F.lit("KR"), region, district))
        .otherwise(F.concat(F.lit("KR-"), first_non_empty(name_en, F.lit("UNKNOWN"))))
    )


def _list_size(name: str) -> Column:
    return F.expr(f"coalesce(size(try_variant_get(payload, '$.{name}', 'array<variant>')), 0)")


def city_record() -> Column:
    """City attributes of the ``payload`` column; counts are list lengths."""
    names = ("city_id", "cityCode", "city_name_ko", "province", "lDongRegnCd", "lDongSignguCd")
    meta = {n: field(f"meta.{n}", "payload") for n in names}
    name_en = or_default(field_or_null("meta.city_name_en", "payload"), "UNKNOWN")
    return F.struct(
        city_id(meta["city_id"], meta["cityCode"], meta["lDongRegnCd"], meta["lDongSignguCd"], name_en).alias("city_id"),
        name_en.alias("city_name_en"),
        meta["city_name_ko"].alias("city_name_ko"),
        meta["province"].alias("province"),
        meta["lDongRegnCd"].alias("lDongRegnCd"),
        meta["lDongSignguCd"].alias("lDongSignguCd"),
        _list_size("attractions").alias("attraction_count"),
        _list_size("festivals").alias("festival_count"),
        _list_size("visitor_statistics").alias("visitor_statistics_count"),
    )


# Object elements of a VARIANT list as (kind, pos, rec).
_TAGGED = """coalesce(filter(
    transform({entries}, (e, i) -> struct('{kind}' AS kind, i AS pos, e AS rec)),
    e -> schema_of_variant(e.rec) LIKE 'OBJECT%'), cast(array() AS array<struct<kind:string,pos:int,rec:variant>>))"""


def _list(path: str) -> str:
    return f"try_variant_get(payload, '$.{path}', 'array<variant>')"


def content_entries() -> Column:
    """Attractions, then festivals, of ``payload`` as (kind, pos, rec)."""
    parts = [_TAGGED.format(kind=k, entries=_list(k)) for k in ("attractions", "festivals")]
    return F.expr(f"concat({', '.join(parts)})")


def statistics_entries(accept_list: bool) -> Column:
    """Monthly statistics; the bare-list form only when ``accept_list``."""
    monthly = _list("visitor_statistics.monthly_statistics")
    if accept_list:
        monthly = f"coalesce({_list('visitor_statistics')}, {monthly})"
    return F.expr(_TAGGED.format(kind="statistics", entries=monthly))


def content_type_id() -> Column:
    """Raw content type of (kind, rec); a festival entry without the key
    counts as 15."""
    missing = (F.col("kind") == "festivals") & ~has_field("$", "contenttypeid")
    return F.when(missing, F.lit("15")).otherwise(field("contenttypeid"))


def classify_domain(content_type: Column, kind: Column) -> Column:
    """festival / attraction / excluded."""
    return (
        F.when((kind == "festivals") | (content_type == "15"), F.lit("festival"))
        .when(content_type.isin("12", "14", "28"), F.lit("attraction"))
        .otherwise(F.lit("excluded"))
    )


def issue_list(*issues: tuple[Column, str]) -> Column:
    """Names of the conditions that hold, in the given order, no duplicates."""
    flagged = [F.when(F.coalesce(cond, F.lit(False)), F.lit(name)) for cond, name in issues]
    return F.array_distinct(F.array_compact(F.array(*flagged)))


def quality_status(issues: Column) -> Column:
    """failed without id or title, review with any issue, else passed."""
    fatal = F.array(F.lit("missing_contentid"), F.lit("missing_title"))
    return (
        F.when(F.arrays_overlap(issues, fatal), F.lit("failed"))
        .when(F.size(issues) > 0, F.lit("review"))
        .otherwise(F.lit("passed"))
    )


def _single(col: Column) -> Column:
    """One-element list, empty for blank."""
    return F.when(F.coalesce(col, F.lit("")) != "", F.array(col)).otherwise(F.array().cast("array<string>"))


def _entries(payloads: DataFrame) -> DataFrame:
    """One row per city, content and statistics entry of the valid payloads."""
    city_entry = F.expr("array(struct('city' AS kind, 0 AS pos, cast(null AS variant) AS rec))")
    head = F.expr("""struct(
        CASE WHEN try_variant_get(payload, '$.visitor_statistics.year', 'string') RLIKE '^[0-9]+$'
          THEN try_variant_get(payload, '$.visitor_statistics.year', 'int') END AS year,
        coalesce(try_variant_get(payload, '$.visitor_statistics.annual_totals', 'map<string,double>'),
          cast(map() AS map<string,double>)) AS totals,
        coalesce(try_variant_get(payload, '$.visitor_statistics.annual_daily_averages', 'map<string,double>'),
          cast(map() AS map<string,double>)) AS averages)""")
    # The city columns are computed below the generator, which then drops the
    # payload, so no output row carries the whole file.  Invalid files have a
    # null payload and a null list gives no rows; a filter would parse twice.
    cities = payloads.select(
        "source_key",
        "payload",
        city_record().alias("city"),
        F.expr(
            "coalesce(try_variant_get(payload, '$.meta.sigungus_included', 'array<string>'), cast(array() AS array<string>))"
        ).alias("sigungus"),
        field("meta.scraped_at", "payload").alias("scraped"),
        head.alias("stat_head"),
    )
    entries = F.concat(city_entry, content_entries(), statistics_entries(accept_list=False))
    return cities.select(
        "source_key", "city", "sigungus", "scraped", "stat_head",
        F.inline(F.when(F.col("payload").isNotNull(), entries)),
    )


def domain_items(
    payloads: DataFrame,
    classification: DataFrame | None = None,
    version: str = fixed.CLASSIFICATION_VERSION,
    table_name: str = TABLE_NAME,
) -> DataFrame:
    """Wide domain items of (source_key, payload, is_valid) rows.

    ``classification`` (code, name, type, theme; one row per code) defaults to
    the built-in table.  ``buckets`` names the outputs a row belongs to; see
    ``bucket_view``.
    """
    if classification is None:
        classification = built_in_classification(payloads.sparkSession)
    rec, kind, city = F.col("rec"), F.col("kind"), F.col("city")
    is_city, is_stat = kind == "city", kind == "statistics"

    # Stage 1: fields that several rules read are taken out of the record once,
    # then parsed.
    taken = _entries(payloads).select(
        "*",
        field_or_null("mapx").alias("mapx"),
        field_or_null("mapy").alias("mapy"),
        first_field("detail.intro.eventstartdate", "eventstartdate").alias("raw_start"),
        first_field("detail.intro.eventenddate", "eventenddate").alias("raw_end"),
        field("month").alias("raw_month"),
        content_type_id().alias("raw_type"),
    )
    coords = coordinates(F.col("mapx"), F.col("mapy"))
    start, end = F.col("raw_start"), F.col("raw_end")
    type_id = strip(F.col("raw_type"))
    parsed = taken.select(
        "source_key", "city", "sigungus", "scraped", "stat_head", "kind", "pos", "rec",
        stripped_field("contentid").alias("content_id"),
        stripped_field("title").alias("title"),
        type_id.alias("contenttypeid"),
        coords.alias("geo"),
        stripped_field("detail.common.lclsSystm3", "lclsSystm3", default="null").alias("lcls_systm3"),
        dates.structural_iso_date(start).alias("start"),
        dates.structural_iso_date(end).alias("end"),
        dates.stat_month(F.col("raw_month")).alias("stat_month"),
        stripped_field("_assigned_theme", "detail.intro.cat3", "cat3").alias("own_theme"),
        stripped_field("addr1", "detail.intro.addr1").alias("address"),
    ).where(~is_stat | (F.col("stat_month") != ""))

    # Stage 2: entity type, classification and issues.
    entity = (
        F.when(is_city, F.lit("city_metadata"))
        .when(is_stat, F.lit("visitor_statistics"))
        .otherwise(classify_domain(F.col("contenttypeid"), kind))
    )
    codes = classification.select(
        F.col("code").alias("lcls_systm3"),
        F.struct("code", "name", "type", "theme").alias("cls"),
    )
    typed = parsed.withColumn("entity_type", entity).join(codes, "lcls_systm3", "left")
    cls, content_id = F.col("cls"), F.col("content_id")
    is_att, is_fest = F.col("entity_type") == "attraction", F.col("entity_type") == "festival"
    is_content = ~is_city & ~is_stat
    subtype = F.when(is_att & (cls["type"] == "Attraction"), cls)
    unmapped = F.when(is_fest, cls["name"].isNull() & cls["theme"].isNull()).when(is_att, subtype.isNull())
    issues = issue_list(
        (is_content & (content_id == ""), "missing_contentid"),
        (is_content & (F.col("title") == ""), "missing_title"),
        (F.col("entity_type") == "excluded", "source_review"),
        (is_content & ~F.col("geo.ok"), "location_review"),
        (is_att & (F.col("own_theme") == ""), "theme_review"),
        (unmapped, "classification_review"),
    )
    typed = typed.select("*", subtype.alias("subtype"), issues.alias("issues"))

    # Stage 3: the item itself.
    id_or_unknown = or_default(content_id, "UNKNOWN")
    sort_key = (
        F.when(is_city, F.lit("METADATA#city"))
        .when(is_stat, F.concat(F.lit("STAT#"), "stat_month"))
        .when(is_fest, F.concat(F.lit("FESTIVAL#"), content_id))
        .when(is_att, F.concat(F.lit("ATTRACTION#"), content_id))
        .otherwise(F.concat(F.lit("EXCLUDED#"), id_or_unknown))
    )
    entity_id = (
        F.when(is_city, F.concat(F.lit("CITY-"), city["city_id"]))
        .when(is_stat, F.concat_ws("-", F.lit("STAT"), city["city_id"], "stat_month"))
        .when(is_fest, F.concat(F.lit("FEST-"), content_id))
        .when(is_att, F.concat(F.lit("ATT-"), content_id))
        .otherwise(F.concat(F.lit("EXCLUDED-"), id_or_unknown))
    )
    status = (
        F.when(is_city | is_stat, F.lit("passed"))
        .when(F.col("entity_type") == "excluded", F.lit("review"))
        .otherwise(quality_status(F.col("issues")))
    )
    pk = F.concat(F.lit("CITY#"), city["city_name_en"])
    start_month = dates.iso_month(F.col("start"))
    season = F.when(F.col("start") != "", dates.season(start_month))
    theme = F.when(is_fest, F.coalesce(cls["theme"], F.lit(""))).when(is_att, F.col("own_theme"))
    texts = {
        "title": F.col("title"),
        "address": F.col("address"),
        "description": stripped_field("detail.common.overview", "detail.intro.overview"),
        "image_url": stripped_field("firstimage", "detail.common.firstimage", "firstimage2"),
        "homepage": stripped_field("detail.common.homepage", "homepage"),
        "zipcode": stripped_field("detail.common.zipcode", "zipcode"),
        "copyright_type": stripped_field("detail.common.cpyrhtDivCd", "cpyrhtDivCd"),
        "created_time": stripped_field("detail.common.createdtime", "createdtime"),
        "modified_time": stripped_field("detail.common.modifiedtime", "modifiedtime"),
    }
    phone = stripped_field("tel", "detail.common.tel", "detail.intro.infocenter", "detail.intro.infocenterculture")
    attraction = {
        "phone": phone,
        "opening_hours": field("detail.intro.usetime"),
        "closed_days": field("detail.intro.restdate"),
        "experience_guide": field("detail.intro.expguide"),
        "parking": field("detail.intro.parking"),
        "attraction_subtype_code": F.col("subtype.code"),
        "attraction_subtype_name": F.col("subtype.name"),
        "classification_source": F.when(F.col("subtype").isNotNull(), F.lit("lcls_systm3")),
        "classification_mapping_version": F.when(F.col("subtype").isNotNull(), F.lit(version)),
    }
    festival = {
        "event_start_date": F.col("start"),
        "event_end_date": F.col("end"),
        "season": season,
        "visit_months": dates.visit_months_cyclic(F.col("start"), F.col("end")),
        "venue": F.coalesce(stripped_field("detail.intro.eventplace", default="null"), "address"),
        "organizer": field("detail.intro.sponsor1"),
        "organizer_phone": field("detail.intro.sponsor1tel"),
        "playtime": field("detail.intro.playtime"),
        "fee_text": field("detail.intro.usetimefestival"),
        "source_subtype_name": cls["name"],
        "source_theme": cls["theme"],
        "program": stripped_field("detail.intro.program", default="null"),
        "subevent": stripped_field("detail.intro.subevent", default="null"),
        "gsi_sk": dates.festival_sort_key(content_id, F.col("start")),
    }
    statistic = {
        "year": F.col("stat_head.year"),
        "days": number_field("days", "int"),
        **{n: number_field(n) for n in schemas.STATISTIC_MEASURES},
        "annual_totals": F.col("stat_head.totals"),
        "annual_daily_averages": F.col("stat_head.averages"),
    }
    month = F.when(is_stat, F.col("stat_month")).when(is_fest, start_month.cast("string"))
    province_key = F.concat(F.lit("PROVINCE#"), or_default(city["province"], "UNKNOWN"))
    items = typed.select(
        pk.alias("PK"),
        sort_key.alias("SK"),
        entity_id.alias("entity_id"),
        "entity_type",
        F.when(is_content, content_id).alias("content_id"),
        F.when(is_content, F.nullif("contenttypeid", F.lit(""))).alias("contenttypeid"),
        *[city[n].alias(n) for n in ("city_id", "city_name_en", "city_name_ko", "province")],
        province_key.alias("province_key"),
        pk.alias("city_key"),
        sort_key.alias("domain_sort_key"),
        *[F.when(is_content, c).alias(n) for n, c in texts.items()],
        F.when(is_content, F.col("geo.longitude")).alias("longitude"),
        F.when(is_content, F.col("geo.latitude")).alias("latitude"),
        F.when(is_content, F.col("lcls_systm3")).alias("lcls_systm3"),
        F.when(is_content, F.lit("tourapi")).alias("source_type"),
        F.when(is_content, or_default(F.col("source_key"), "unknown")).alias("raw_s3_uri"),
        theme.alias("theme"),
        F.when(is_att | is_fest, _single(theme)).alias("theme_tags"),
        F.when(is_fest, _single(season)).when(is_att, _single(F.lit(None).cast("string"))).alias("season_tags"),
        month.alias("month"),
        *[F.when(is_att, c).alias(n) for n, c in attraction.items()],
        *[F.when(is_fest, c).alias(n) for n, c in festival.items()],
        *[F.when(is_stat, c).alias(n) for n, c in statistic.items()],
        F.when(is_city, F.col("sigungus")).alias("sigungus_included"),
        F.when(is_city, F.col("scraped")).alias("scraped_at"),
        status.alias("quality_status"),
        F.col("issues").alias("review_queues"),
        "source_key",
        F.lit(table_name).alias("table"),
        F.struct("kind", "pos").alias("position"),
    )
    return items.withColumn("buckets", _buckets())


def _buckets() -> Column:
    """Outputs of an item: a review item is in its own bucket and in review."""
    kind, status = F.col("entity_type"), F.col("quality_status")
    own = (
        F.when(kind == "attraction", F.lit("attractions"))
        .when(kind == "festival", F.lit("festivals"))
        .otherwise(kind)
    )
    return (
        F.when(status == "failed", F.array(F.lit("failed")))
        .when(kind == "excluded", F.array(F.lit("review")))
        .when(status == "review", F.array(own, F.lit("load_items"), F.lit("review")))
        .otherwise(F.array(own, F.lit("load_items")))
    )


def bucket_view(items: DataFrame, bucket: str) -> DataFrame:
    """Items of one output."""
    return items.where(F.array_contains("buckets", bucket))


def entity_view(items: DataFrame, entity_type: str) -> DataFrame:
    """Items of one type reduced to the attributes that type may carry."""
    return items.where(F.col("entity_type") == entity_type).select(
        *schemas.ENTITY_COLUMNS[entity_type]
    )


def quality_summary(items: DataFrame, *keys: str) -> DataFrame:
    """Row counts per output and file (or other ``keys``)."""
    keys = keys or ("source_key", "city_id", "city_name_en", "table")
    counts = [F.count_if(F.array_contains("buckets", b)).alias(b) for b in schemas.BUCKETS]
    return items.groupBy(*keys).agg(*counts)
