"""Image planning, reconciliation and reports; no image is fetched here."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripweave.functions.names import romanize
from tripweave.functions.text import first_non_empty, image_extension, image_key, is_blank, strip, url_extension


def unique_names(rows: DataFrame, city: str, base: Column, content_id: Column, order: list[str]) -> DataFrame:
    """Adds ``name``: the first row of a base name in a city keeps it, later
    ones append their content id.

    Only names that occur more than once matter.  Their first positions come from
    an aggregate that combines before the shuffle; the later positions are found
    among bare (city, position, name) rows and joined to the whole rows on the
    unique position, so that a name of a third of all rows is no hot key there.
    Where few names repeat, Spark broadcasts both and no whole row moves.
    """
    named = rows.withColumn("_base", base).withColumn("_id", content_id)
    bare = named.select(city, "_base", F.struct(*order).alias("_at"))
    repeated = bare.groupBy(city, "_base").agg(F.min("_at").alias("_first"), F.count("*").alias("_n")).where("_n > 1").drop("_n")
    later = bare.join(repeated, [city, "_base"]).where("_at <> _first").select(city, "_at.*", F.lit(True).alias("_later"))
    joined = named.join(later, [city, *order], "left")
    name = F.when(F.col("_later"), F.concat_ws("_", "_base", "_id")).otherwise(F.col("_base"))
    return joined.withColumn("name", name).drop("_base", "_id", "_later")


def base_name(title: Column, content_id: Column) -> Column:
    """Romanised title, else the content id, else ``item``."""
    return F.coalesce(
        F.nullif(romanize(title), F.lit("")), F.nullif(content_id, F.lit("")), F.lit("item")
    )


def image_targets(records: DataFrame) -> DataFrame:
    """One row per image of (city, grp, pos, contentid, title, firstimage,
    firstimage2); grp 0 is attractions, 1 festivals, pos the array position."""
    content_id = strip(F.coalesce("contentid", F.lit("")))
    named = unique_names(
        records, "city", base_name(F.col("title"), content_id), content_id, ["grp", "pos"]
    )
    fields = F.array(
        *[
            F.struct(F.lit(suffix).alias("suffix"), strip(F.coalesce(column, F.lit(""))).alias("url"))
            for suffix, column in (("1", "firstimage"), ("2", "firstimage2"))
        ]
    )
    rows = named.select(
        "city", "grp", "pos", "name", content_id.alias("content_id"), "title", F.inline(fields)
    )
    return rows.where(F.col("url") != "")


def expected_files(targets: DataFrame) -> DataFrame:
    """Targets with their object key and file name."""
    key = image_key(F.col("city"), F.col("name"), F.col("suffix"), url_extension(F.col("url")))
    return targets.withColumn("image_key", key).withColumn(
        "file_name", F.regexp_extract("image_key", r"([^/]*)\z", 1)
    )


FILE = ("city", "file_name")
# Records of one title without content ids share their file name; their images are told apart by the record.
IMAGE = ("city", "grp", "pos", "suffix")


def missing_files(expected: DataFrame, actual: DataFrame, keys: Sequence[str] = FILE) -> DataFrame:
    """Expected files that are not among the stored ones, by their ``keys``."""
    return expected.join(actual.select(*keys), list(keys), "left_anti")


def recovery(missing: DataFrame, outcomes: DataFrame, keys: Sequence[str] = FILE) -> DataFrame:
    """Missing files with the outcome of other attempts.

    ``outcomes`` is (keys, error); an attempt without error means recovered, no
    outcome means not tried.
    """
    error = F.when(F.count_if(F.col("error").isNull()) == 0, F.min("error")).alias("error")
    tried = outcomes.groupBy(*keys).agg(error).withColumn("_tried", F.lit(True))
    joined = missing.join(tried, list(keys), "left")
    status = (
        F.when(F.col("_tried").isNull(), F.lit("not_tried"))
        .when(F.col("error").isNull(), F.lit("recovered"))
        .otherwise(F.lit("failed"))
    )
    return joined.withColumn("recovery", status).drop("_tried")


def audit_summary(expected: DataFrame, missing: DataFrame) -> DataFrame:
    """Expected, ok, failed and recovered files per city and in total.

    ``missing`` may carry the ``recovery`` column.  The total row has a null
    city.
    """
    recovered = F.col("recovery") == "recovered" if "recovery" in missing.columns else F.lit(False)
    # One aggregate over both inputs instead of a join on the city.
    rows = expected.select("city", F.lit(1).alias("e"), F.lit(0).alias("m"), F.lit(0).alias("r")).unionByName(
        missing.select("city", F.lit(0).alias("e"), F.lit(1).alias("m"), recovered.cast("int").alias("r"))
    )
    totals = rows.rollup("city").agg(
        F.sum("e").alias("expected"), F.sum("m").alias("m"), F.sum("r").alias("recovered")
    )
    return totals.select(
        "city",
        "expected",
        (F.col("expected") - F.col("m") + F.col("recovered")).alias("ok"),
        (F.col("m") - F.col("recovered")).alias("failed"),
        "recovered",
    )


IMAGE_HOST = "s3.amazonaws.com"


def process_images(
    records: DataFrame, outcomes: DataFrame, image_bucket: str, image_host: str = IMAGE_HOST
) -> DataFrame:
    """Image status of every record after fetching; stored images are served from ``image_bucket.image_host``.

    ``records`` are (city_name_en, pos, content_id, title, entity_type,
    image_url, firstimage); ``outcomes`` are (city_name_en, pos, error) of the
    fetch step.  ok rows get the stored URL, the others need review.  Only
    records with an image take part in naming.
    """
    url = F.when(is_blank(F.col("image_url")), F.col("firstimage")).otherwise(F.col("image_url"))
    sourced = records.withColumn("source_url", url)
    has_url = ~is_blank(F.col("source_url"))
    content_id = F.coalesce("content_id", F.lit(""))
    base = F.when(has_url, base_name(F.col("title"), content_id))
    named = unique_names(sourced, "city_name_en", base, content_id, ["pos"])
    keyed = named.withColumn(
        "image_s3_key",
        F.when(
            has_url,
            image_key(F.col("city_name_en"), F.col("name"), F.lit("1"), image_extension(F.col("source_url"))),
        ),
    )
    tried = outcomes.select("city_name_en", "pos", F.lit(True).alias("_tried"), "error")
    joined = keyed.join(tried, ["city_name_en", "pos"], "left")
    failed = has_url & (F.col("error").isNotNull() | F.col("_tried").isNull())
    reason = F.when(~has_url, F.lit("no_source_image")).when(failed, F.lit("download_failed"))
    ok = reason.isNull()
    stored = F.concat(F.lit(f"https://{image_bucket}.{image_host}/"), "image_s3_key")
    return joined.select(
        "city_name_en", "pos", "content_id", "entity_type",
        F.when(ok, F.lit("ok")).otherwise(F.lit("needs_review")).alias("image_status"),
        F.when(ok, stored).otherwise(F.col("image_url")).alias("image_url"),
        F.when(ok, F.col("image_s3_key")).alias("image_s3_key"),
        F.coalesce("source_url", F.lit("")).alias("original_image_url"),
        reason.alias("failure_reason"),
        F.when(failed, F.coalesce("error", F.lit("not fetched"))).alias("error_message"),
    )


def image_review(processed: DataFrame) -> DataFrame:
    """Review manifest rows of the records without a stored image."""
    return processed.where(F.col("failure_reason").isNotNull()).select(
        "city_name_en",
        "content_id",
        "entity_type",
        F.when(F.col("failure_reason") == "no_source_image", F.lit(""))
        .otherwise(F.col("original_image_url"))
        .alias("original_image_url"),
        "failure_reason",
        F.coalesce("error_message", F.lit("")).alias("error_message"),
        F.current_timestamp().alias("timestamp"),
    )


def city_image_counts(processed: DataFrame) -> DataFrame:
    """Per city: downloaded, failed, without source, to review, records."""
    reason = F.col("failure_reason")
    return processed.groupBy("city_name_en").agg(
        F.count("*").alias("total_records"),
        F.count_if(reason.isNull()).alias("images_downloaded"),
        F.count_if(reason == "download_failed").alias("images_failed"),
        F.count_if(reason == "no_source_image").alias("no_source_image"),
        F.count_if(reason.isNotNull()).alias("review_count"),
    )


def city_image_rows(counts: DataFrame) -> DataFrame:
    """Per-city part of the image report."""
    return counts.select(
        "city_name_en",
        F.col("images_downloaded").alias("images_ok"),
        (F.col("images_failed") + F.col("no_source_image")).alias("images_failed"),
        F.col("total_records").alias("records_loaded"),
    )


def image_report(counts: DataFrame, failure_info: str | None = None) -> DataFrame:
    """One-row image report: totals and failed / partial / success."""

    def total(name: str) -> Column:
        return F.coalesce(F.sum(name), F.lit(0))

    sums = counts.agg(
        F.count("*").alias("total_cities"),
        total("images_downloaded").alias("images_downloaded"),
        total("images_failed").alias("images_failed"),
        total("review_count").alias("review_count"),
        total("total_records").alias("records"),
    )
    partial = (F.col("images_failed") > 0) | (F.col("review_count") > 0)
    status = F.when(F.lit(failure_info is not None), F.lit("failed")).when(partial, F.lit("partial"))
    return sums.withColumn("status", status.otherwise(F.lit("success"))).withColumn(
        "failure_info", F.lit(failure_info).cast("string")
    )


def record_image(url: Column, fallback: Column) -> Column:
    """The image a record offers: its own, else the raw first image."""
    return first_non_empty(F.coalesce(url, F.lit("")), F.coalesce(fallback, F.lit("")))
