"""Completeness, review routing and run reports of city records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripweave.functions.text import error_category, is_blank

COLLECTED, NEEDS_REVIEW, MISSING = "collected", "needs_review", "missing"


def _checks() -> dict[str, tuple[Column, str]]:
    """Required field → (absent?, status when absent)."""
    return {
        "city_name_ko": (is_blank(F.col("city_name_ko")), MISSING),
        "prefecture_id": (is_blank(F.col("prefecture_id")), MISSING),
        "latitude": (F.col("latitude").isNull(), NEEDS_REVIEW),
        "longitude": (F.col("longitude").isNull(), NEEDS_REVIEW),
        "description": (is_blank(F.col("description")), NEEDS_REVIEW),
    }


def evaluate_completeness(records: DataFrame) -> DataFrame:
    """Adds a ``completeness`` struct: confidence, missing_fields,
    field_statuses, needs_review and review_reasons."""
    checks = _checks()
    flagged = records.withColumn(
        "_absent", F.struct(*[absent.alias(name) for name, (absent, _) in checks.items()])
    )
    absent = {name: F.col(f"_absent.{name}") for name in checks}
    missing = F.array_compact(F.array(*[F.when(absent[n], F.lit(n)) for n in checks]))
    identified = ~absent["city_name_ko"] & ~absent["prefecture_id"]
    confidence = (
        F.when(identified & ~absent["latitude"] & ~absent["longitude"] & ~absent["description"], F.lit("high"))
        .when(identified, F.lit("medium"))
        .otherwise(F.lit("low"))
    )
    statuses = []
    for name, (_, status) in checks.items():
        statuses += [F.lit(name), F.when(absent[name], F.lit(status)).otherwise(F.lit(COLLECTED))]
    reasons = F.array_compact(
        F.array(
            F.when(absent["latitude"] | absent["longitude"], F.lit("missing_coordinates")),
            F.when(absent["description"], F.lit("empty_description")),
            F.when(confidence == "low", F.lit("low_confidence")),
        )
    )
    return flagged.withColumn(
        "completeness",
        F.struct(
            confidence.alias("data_confidence"),
            missing.alias("missing_fields"),
            F.create_map(*statuses).alias("field_statuses"),
            (confidence == "low").alias("needs_review"),
            reasons.alias("review_reasons"),
        ),
    ).drop("_absent")


def overlay(base: Column, top: Column) -> Column:
    """Map with the entries of ``top`` replacing those of ``base``."""
    kept = F.map_filter(base, lambda k, _: ~F.map_contains_key(top, k))
    return F.map_concat(kept, top)


def apply_review(evaluated: DataFrame) -> DataFrame:
    """Writes the evaluation back to the records.

    Flagged records take the field statuses and the confidence; complete ones
    are upgraded to collected; the others stay as they are.
    """
    result = F.col("completeness")
    no_image = is_blank(F.col("image_url"))
    flagged = result["needs_review"]
    complete = ~flagged & (F.size(result["missing_fields"]) == 0)
    empty = F.create_map().cast("map<string,string>")
    image = F.when(flagged & no_image, F.create_map(F.lit("image_url"), F.lit(NEEDS_REVIEW))).when(
        complete & ~no_image, F.create_map(F.lit("image_url"), F.lit(COLLECTED))
    )
    upgraded = F.transform_values(result["field_statuses"], lambda _, __: F.lit(COLLECTED))
    fields = F.when(flagged, result["field_statuses"]).when(complete, upgraded)
    status = F.coalesce("field_status", empty)
    return evaluated.withColumn(
        "field_status",
        overlay(overlay(status, F.coalesce(fields, empty)), F.coalesce(image, empty)),
    ).withColumn(
        "data_confidence",
        F.when(flagged | complete, result["data_confidence"]).otherwise(F.col("data_confidence")),
    )


def review_reason(result: Column, no_image: Column) -> Column:
    """The one reason shown to a reviewer, most important first."""
    reasons = result["review_reasons"]
    return (
        F.when(F.array_contains(reasons, "missing_coordinates"), F.lit("missing_coordinates"))
        .when(F.array_contains(reasons, "empty_description"), F.lit("empty_description"))
        .when(no_image, F.lit("no_image_url"))
        .otherwise(F.coalesce(F.get(reasons, F.lit(0)), F.lit("unknown")))
    )


def review_entries(evaluated: DataFrame) -> DataFrame:
    """Review manifest rows of the records that need review."""
    result = F.col("completeness")
    no_image = is_blank(F.col("image_url"))
    missing = F.when(
        no_image, F.array_distinct(F.concat(result["missing_fields"], F.array(F.lit("image_url"))))
    ).otherwise(result["missing_fields"])
    return evaluated.where(result["needs_review"]).select(
        "city_id",
        "city_name_ko",
        "prefecture_id",
        missing.alias("missing_fields"),
        review_reason(result, no_image).alias("review_reason"),
        F.current_timestamp().alias("flagged_at"),
    )


def stage_counters(evaluated: DataFrame) -> DataFrame:
    """One row: processed and updated record counts of a stage."""
    result = F.col("completeness")
    updated = (result["data_confidence"] != "medium") | (F.size(result["missing_fields"]) > 0)
    return evaluated.agg(
        F.count("*").alias("records_processed"), F.count_if(updated).alias("records_updated")
    )


def reason_counts(entries: DataFrame, reason: str = "review_reason") -> DataFrame:
    """Entries per reason; empty reasons are not counted."""
    return (
        entries.where(F.coalesce(reason, F.lit("")) != "").groupBy(reason).agg(F.count("*").alias("entry_count"))
    )


def categorised_errors(errors: DataFrame, message: str = "message") -> DataFrame:
    """Error rows with their category."""
    return errors.withColumn("category", error_category(F.col(message)))


def run_report(
    records: DataFrame, stages: DataFrame, entries: DataFrame, errors: DataFrame
) -> DataFrame:
    """One row with the totals of a run and its nested breakdowns.

    Stages, reasons and error categories are few by nature and become nested
    values; the errors themselves stay rows, see ``categorised_errors``.
    """
    reasons = reason_counts(entries).agg(
        F.map_from_entries(F.collect_list(F.struct("review_reason", "entry_count"))).alias("review_reason_counts")
    )
    categories = (
        categorised_errors(errors)
        .groupBy("category")
        .agg(F.count("*").alias("n"))
        .agg(F.map_from_entries(F.collect_list(F.struct("category", "n"))).alias("error_counts"))
    )
    return side_by_side(
        records.agg(F.count("*").alias("total_records_processed")),
        stages.agg(
            F.coalesce(F.sum("images_collected"), F.lit(0)).alias("total_images_collected"),
            F.array_sort(F.collect_list(F.struct(*stages.columns))).alias("stages"),
        ),
        entries.agg(F.count("*").alias("records_transitioned_to_review")),
        errors.agg(F.count("*").alias("total_errors")),
        reasons,
        categories,
    )


def side_by_side(first: DataFrame, *others: DataFrame) -> DataFrame:
    """Columns of several one-row frames in one row, by scalar subqueries."""
    out = first
    for other in others:
        packed = other.select(F.struct(*other.columns).alias("row"))
        out = out.withColumn("_row", packed.scalar()).select(*out.columns, "_row.*")
    return out


def record_details(records: DataFrame) -> DataFrame:
    """Verbose part of a report: one row per record."""
    return records.select(
        "city_id", "city_name_ko", "prefecture_id", "data_confidence", "image_url",
        F.col("image_urls").alias("image_sources"), "field_status",
    )


def field_status(value: Column, review_if_present: bool = False) -> Column:
    """missing for null or '', else collected (or needs_review)."""
    present = NEEDS_REVIEW if review_if_present else COLLECTED
    return F.when(value.isNull() | (value.cast("string") == ""), F.lit(MISSING)).otherwise(F.lit(present))


def pass_or_fail(items_read: DataFrame, load: DataFrame, vectors: DataFrame) -> DataFrame:
    """One-row verdict of a trial run: PASS when nothing failed.

    ``load`` and ``vectors`` are the one-row load and rebuild summaries.
    """
    joined = side_by_side(
        items_read.agg(F.count("*").alias("items_read")),
        load.select(F.col("loaded").alias("items_loaded"), "load_failed"),
        vectors.select(
            F.col("items_upserted").alias("vectors_built"), F.col("items_skipped").alias("vectors_failed")
        ),
    )
    clean = (F.col("load_failed") == 0) & (F.col("vectors_failed") == 0)
    return joined.withColumn("verdict", F.when(clean, F.lit("PASS")).otherwise(F.lit("FAIL")))


def status_code(failed: Column, bad_request: Column | None = None) -> Column:
    """200 when nothing failed, 207 on partial failure, 400 on a bad request."""
    code = F.when(failed > 0, F.lit(207)).otherwise(F.lit(200))
    return code if bad_request is None else F.when(bad_request, F.lit(400)).otherwise(code)
