"""Readers of raw and processed JSON files.

Every reader returns plain DataFrames.  Dynamic JSON is kept as VARIANT until
it has been exploded, so one mistyped element never spoils its neighbours.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripweave.functions.text import or_default


def is_object(v: Column) -> Column:
    """True when a VARIANT holds a JSON object."""
    return F.coalesce(F.schema_of_variant(v).startswith("OBJECT"), F.lit(False))


def text_at(v: Column, path: str) -> Column:
    """Text at a path, null when absent."""
    return F.try_variant_get(v, path, "string")


def read_raw_files(
    spark: SparkSession, path: str, whole_files: bool = True, pattern: str = "*.json"
) -> DataFrame:
    """(source_key, body) of the files named by ``pattern`` below ``path``.

    One file is one city payload; ``whole_files=False`` reads JSON lines, one
    payload per line, which Spark can split.
    """
    reader = spark.read.option("pathGlobFilter", pattern).option("recursiveFileLookup", "true")
    rows = reader.text(path, wholetext=whole_files)
    return rows.select(F.col("_metadata.file_path").alias("source_key"), F.col("value").alias("body"))


def parse_payloads(raw: DataFrame) -> DataFrame:
    """Adds ``payload`` (VARIANT) and ``is_valid`` (a JSON object)."""
    # A JSON text that parses and starts with a brace is an object.
    looks_like_object = F.coalesce(F.col("body").rlike(r"\A\s*\{"), F.lit(False))
    return (
        raw.withColumn("payload", F.when(looks_like_object, F.try_parse_json("body")))
        .withColumn("is_valid", F.col("payload").isNotNull())
        .drop("body")
    )


def failed_files(payloads: DataFrame) -> DataFrame:
    """Files that hold no JSON object."""
    return payloads.where(~F.col("is_valid")).select(
        "source_key", F.lit("failed").alias("status"), F.lit("not a JSON object").alias("reason")
    )


def read_processed_files(spark: SparkSession, path: str, ingest_date: str | None = None) -> DataFrame:
    """Items below ``path/ingest_date=YYYYMMDD``; the latest date by default."""
    files = (
        spark.read.option("pathGlobFilter", "*.json")
        .text(path, wholetext=True)
        .select(
            F.col("ingest_date").cast("string").alias("ingest_date"),
            F.col("_metadata.file_path").alias("source_key"),
            "value",
        )
    )
    if ingest_date:
        return processed_items(files.where(F.col("ingest_date") == ingest_date))
    # binaryFile with the content pruned lists files without reading them.
    listing = spark.read.format("binaryFile").option("pathGlobFilter", "*.json").load(path)
    return processed_items(latest_partition(files, listing=listing))


def latest_partition(
    files: DataFrame, column: str = "ingest_date", listing: DataFrame | None = None
) -> DataFrame:
    """Rows of the newest eight-digit date; other partition names are ignored.

    The date is a scalar subquery over ``listing`` (default: ``files``), so the
    scan of ``files`` prunes to one partition.
    """
    dates = (listing if listing is not None else files).select(F.col(column).cast("string").alias("d"))
    newest = dates.where(F.col("d").rlike(r"\A\d{8}\z")).agg(F.max("d"))
    return files.where(F.col(column) == newest.scalar())


def processed_items(files: DataFrame) -> DataFrame:
    """One ``item`` VARIANT per record of (source_key, value) files.

    A file is a list, an object with a ``records`` list or a single object;
    unreadable files and non-object elements give no rows.
    """
    body = F.try_parse_json("value")
    as_list = F.try_variant_get("doc", "$", "array<variant>")
    records = F.try_variant_get("doc", "$.records", "array<variant>")
    items = F.coalesce(as_list, records, F.array("doc"))
    exploded = (
        files.withColumn("doc", body)
        .where(F.col("doc").isNotNull())
        .select(*[c for c in files.columns if c != "value"], F.posexplode(items).alias("pos", "item"))
    )
    return exploded.where(is_object(F.col("item")))


def page_targets(
    files: DataFrame, default_lang: str = "ko", default_prefecture_id: str = ""
) -> DataFrame:
    """(source_key, pos, title, lang, prefecture_id, is_valid) of target lists.

    Elements are titles or objects with a title; anything else is kept as an
    invalid row so the caller can report it.
    """
    entries = files.select(
        "source_key",
        F.posexplode_outer(F.try_variant_get(F.try_parse_json("value"), "$", "array<variant>")).alias("pos", "e"),
    )
    object_title = text_at(F.col("e"), "$.title")
    bare = F.when(F.schema_of_variant("e") == "STRING", text_at(F.col("e"), "$"))
    title = F.coalesce(bare, object_title)
    return entries.select(
        "source_key",
        "pos",
        title.alias("title"),
        or_default(text_at(F.col("e"), "$.lang"), default_lang).alias("lang"),
        or_default(text_at(F.col("e"), "$.prefecture_id"), default_prefecture_id).alias("prefecture_id"),
        title.isNotNull().alias("is_valid"),
    )


UNIFIED_CITY_SCHEMA = (
    "city_id string, city_name_ko string, city_name_ja string, city_name_en string, "
    "prefecture_id string, location string, latitude double, longitude double, "
    "description string, geography_description string, climate_table map<string,string>, "
    "site_urls array<string>, image_url string, image_urls array<struct<url:string,source:string>>, "
    "source_name string, source_url string, collected_at string, field_status map<string,string>, "
    "data_confidence string, verified_at string, verified_source_url string, verification_note string"
)


def unified_city(item: Column) -> list[Column]:
    """Columns of a unified city record from an ``item`` VARIANT.

    Missing texts are '', a missing confidence is medium, image entries without
    url or source are dropped.
    """
    blank = [
        "city_id", "city_name_ko", "city_name_ja", "city_name_en", "prefecture_id", "location",
        "description", "geography_description", "source_name", "source_url", "collected_at",
    ]
    nullable = ["image_url", "verified_at", "verified_source_url", "verification_note"]
    cols = {n: F.coalesce(text_at(item, f"$.{n}"), F.lit("")) for n in blank}
    cols |= {n: text_at(item, f"$.{n}") for n in nullable}
    cols |= {n: F.try_variant_get(item, f"$.{n}", "double") for n in ("latitude", "longitude")}
    cols["climate_table"] = F.try_variant_get(item, "$.climate_table", "map<string,string>")
    cols["site_urls"] = F.coalesce(
        F.try_variant_get(item, "$.site_urls", "array<string>"), F.array().cast("array<string>")
    )
    images = F.transform(
        F.try_variant_get(item, "$.image_urls", "array<variant>"),
        lambda e: F.struct(text_at(e, "$.url").alias("url"), text_at(e, "$.source").alias("source")),
    )
    cols["image_urls"] = F.coalesce(
        F.filter(images, lambda e: e["url"].isNotNull() & e["source"].isNotNull()),
        F.array().cast("array<struct<url:string,source:string>>"),
    )
    cols["field_status"] = F.coalesce(
        F.try_variant_get(item, "$.field_status", "map<string,string>"),
        F.create_map().cast("map<string,string>"),
    )
    cols["data_confidence"] = F.coalesce(text_at(item, "$.data_confidence"), F.lit("medium"))
    order = [part.strip().split(" ")[0] for part in UNIFIED_CITY_SCHEMA.split(", ")]
    return [cols[n].alias(n) for n in order]


def city_dataset(items: DataFrame) -> DataFrame:
    """Existing dataset: rows need a city id and the last duplicate wins.

    ``items`` has source_key, pos and item.  The aggregate combines before the
    shuffle, so a repeated id never gathers in one task.
    """
    rows = items.select(F.struct("source_key", "pos").alias("_order"), *unified_city(F.col("item")))
    names = [c for c in rows.columns if c != "_order"]
    return (
        rows.where(F.col("city_id") != "")
        .groupBy("city_id")
        .agg(F.max_by(F.struct(*names), F.col("_order")).alias("kept"))
        .select(*[F.col(f"kept.{n}").alias(n) for n in names])
    )
