"""Jobs: readers, operators and writers put together.

A job returns small summary DataFrames; its data goes to the given path.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tripweave.functions.calls import BatchFn
from tripweave.operators import (
    domain,
    enrich,
    harvest,
    images,
    keyvalue,
    legacy,
    merge,
    pages,
    quality,
    vectors,
    visitors,
)
from tripweave.session import saved, work_folder
from tripweave.sources import dimensions, raw, sinks

Frames = dict[str, DataFrame]
Stage = Callable[[Frames], Frames]


def run_stages(frames: Frames, stages: Sequence[Stage]) -> Frames:
    """Applies user stages one after another; each sees the earlier results."""
    for stage in stages:
        frames = {**frames, **stage(frames)}
    return frames


# --- domain items -----------------------------------------------------------


def preprocess_domain(
    spark: SparkSession, raw_path: str, out: str, classification: DataFrame | None = None, **reading
) -> Frames:
    """Raw files to bucketed domain items; summary and failed files returned.

    ``reading`` goes to ``raw.read_raw_files``.
    """
    payloads = raw.parse_payloads(raw.read_raw_files(spark, raw_path, **reading))
    seen, observed = observe_failed(payloads)
    sinks.write_domain_output(domain.domain_items(observed, classification), out)
    return {"summary": spark.read.json(f"{out}/summary"), "failed_files": failed_if_any(payloads, seen)}


def observe_failed(payloads: DataFrame) -> tuple[Observation, DataFrame]:
    """Counts the unreadable files while the payloads are used."""
    seen = Observation("unreadable")
    return seen, payloads.observe(seen, F.count_if(~F.col("is_valid")).alias("failed"))


def failed_if_any(payloads: DataFrame, seen: Observation) -> DataFrame:
    """Unreadable files; the raw zone is read again only if the job has seen some."""
    failed = raw.failed_files(payloads)
    return failed if seen.get["failed"] else failed.sparkSession.createDataFrame([], failed.schema)


def transform_legacy(spark: SparkSession, raw_path: str, out: str, ingest_date: str, **reading) -> Frames:
    """Raw files to flat records by quality status; ``reading`` goes to ``raw.read_raw_files``."""
    payloads = raw.parse_payloads(raw.read_raw_files(spark, raw_path, **reading))
    seen, observed = observe_failed(payloads)
    sinks.write_by_status(legacy.transform_records(observed), out, ingest_date)
    written = spark.read.parquet(out).where(F.col("ingest_date").cast("string") == ingest_date)
    unreadable = failed_if_any(payloads, seen).select("source_key", "status")
    files = legacy.file_status(written).select("source_key", "status").unionByName(unreadable)
    return {"files": files, "summary": legacy.run_summary(files)}


def load_items(
    spark: SparkSession,
    processed: DataFrame,
    store: str,
    batch: int,
    order: Sequence[str],
    province_id: str | None = None,
) -> Frames:
    """Processed items of one run into the keyed store."""
    rows = saved(keyvalue.backfill_index_keys(keyvalue.in_province(processed, province_id)), "load")
    sinks.append_batch(rows, store, batch, order)
    return {"summary": keyvalue.load_summary(rows), "failures": keyvalue.load_failures(rows)}


def load_legacy(spark: SparkSession, processed_path: str, store: str, batch: int) -> Frames:
    """Processed city files into the keyed store, in the first data model."""
    files = spark.read.option("pathGlobFilter", "*.json").option("recursiveFileLookup", "true")
    rows = legacy.load_rows(
        files.text(processed_path, wholetext=True).select(
            F.col("_metadata.file_path").alias("source_key"), "value"
        )
    )
    good = rows.where(F.col("error").isNull()).drop("error")
    sinks.append_batch(good, store, batch, ["source_key", "pos"], transient=["source_key", "pos"])
    summary = rows.agg(
        F.count_if(F.col("error").isNull()).alias("loaded"),
        F.count_if(F.col("error").isNotNull()).alias("load_failed"),
    )
    return {"summary": summary.withColumn("status_code", quality.status_code(F.col("load_failed")))}


def clean_table(spark: SparkSession, store: str, out: str, version: int, keep: Sequence[str]) -> DataFrame:
    """Publishes the store without foreign provinces; report of the removed."""
    kept, removed = keyvalue.split_by_province(sinks.current_items(spark, store), keep)
    sinks.publish_items(kept, out, version)
    return keyvalue.removal_report(removed)


def profile_table(items: DataFrame) -> Frames:
    return {"provinces": keyvalue.province_profile(items), "samples": keyvalue.without_province(items)}


# --- visitors ---------------------------------------------------------------


def collect_visitors(
    daily: DataFrame,
    districts: DataFrame,
    year: int,
    existing: DataFrame | None = None,
    force_refresh: bool = False,
) -> DataFrame:
    """Monthly statistics of a year, merged into the existing ones."""
    # A range on the date column itself reaches the file scan.
    in_year = daily.where((F.col("date") >= f"{year}-01-01") & (F.col("date") < f"{year + 1}-01-01"))
    mapped = visitors.daily_by_city(in_year, districts)
    if existing is not None and not force_refresh:
        mapped = visitors.skip_complete(mapped, existing)
    new = visitors.dense_statistics(mapped)
    return new if existing is None or force_refresh else visitors.replace_statistics(existing, new)


def finalise_cities(cities: DataFrame, order: str, monthly: DataFrame, out: str, year: int) -> DataFrame:
    """Merged city files of a year; counts of both-sided and one-sided cities."""
    statistics = visitors.statistics_envelope(monthly.where(F.col("year") == year)).drop("year")
    final = saved(visitors.final_cities(visitors.last_city_per_name(cities, order), statistics), "final-cities")
    sinks.write_by_city(final, out)
    return visitors.merge_outcomes(final)


# --- city records -----------------------------------------------------------


def merge_city_dataset(
    spark: SparkSession,
    path: str,
    incoming: DataFrame,
    seq: str = "seq",
    force_image_update: bool = False,
    chunk_rows: int = 100_000,
) -> int:
    """Merges incoming city records, any number per city in ``seq`` order, into the published dataset.

    Returns the new version, with one row per city; readers see it only when
    it is complete.
    """
    version = sinks.latest_version(spark, path)
    base = sinks.read_published(spark, path)
    if base is None:
        base = incoming.drop(seq).where(F.lit(False))
    merged = merge.merge_all(base, incoming, seq, force_image_update, chunk_rows)
    sinks.publish_version(merged, path, (version or 0) + 1)
    return (version or 0) + 1


def review_cities(records: DataFrame) -> Frames:
    """Completeness, review transition, manifest and counts."""
    evaluated = quality.evaluate_completeness(records)
    entries = quality.review_entries(evaluated)
    return {
        "records": quality.apply_review(evaluated).drop("completeness"),
        "review": entries,
        "counters": quality.stage_counters(evaluated),
        "reasons": quality.reason_counts(entries),
    }


def acquire_korean_cities(
    page_rows: DataFrame, english_names: DataFrame, collected_at: Column, existing: DataFrame | None = None
) -> Frames:
    """Parsed Korean pages to city and province records, over existing ones."""
    spark = page_rows.sparkSession
    parsed = saved(pages.parse_pages(page_rows), "pages")
    cities = pages.korean_city_records(parsed, english_names, collected_at)
    if existing is not None:
        cities = merge.replace_records(existing, cities.withColumn("_at", F.lit(0)), "_at")
    provinces = dimensions.provinces(spark).withColumnRenamed("province_id", "prefecture_id")
    known = cities.where(F.col("prefecture_id") != "")
    return {
        "cities": cities.orderBy("city_id"),
        "provinces": pages.region_records(known, provinces, "prefecture_id"),
    }


def acquire_japanese_cities(
    page_structs: DataFrame, region_pages: DataFrame, collected_at: Column, only_region: str | None = None
) -> Frames:
    """Japanese city records and the records of their prefectures.

    Cities without an own climate table take that of their prefecture.  With
    ``only_region``, cities of other prefectures are returned as ``rejected``.
    """
    spark = page_structs.sparkSession
    cities = saved(pages.japanese_city_records(page_structs, collected_at), "japanese-cities")
    wanted = F.lit(True) if only_region is None else F.col("prefecture_id") == only_region
    kept = cities.where(wanted)
    regions = dimensions.prefectures(spark)
    id_column = regions.columns[0]
    full = pages.region_page_records(pages.parse_pages(region_pages), regions, id_column, "ko", collected_at)
    full = saved(full.join(kept.select("prefecture_id").distinct(), "prefecture_id", "left_semi"), "prefectures")
    bare = pages.region_records(kept.where(F.col("prefecture_id") != ""), regions, id_column)
    bare = bare.join(full.select("prefecture_id"), "prefecture_id", "left_anti")
    return {
        "cities": pages.inherit_climate(kept, full).orderBy("city_id"),
        "prefectures": full.unionByName(bare, allowMissingColumns=True).orderBy("prefecture_id"),
        "rejected": cities.where(~wanted),
    }


def filter_region(
    records: DataFrame, attraction_themes: DataFrame, festival_themes: DataFrame, lookup: DataFrame
) -> Frames:
    """Theme-filtered tour records of the target cities and their counts.

    ``records`` has city_name_ko, kind (attraction/festival) and the class
    codes.
    """
    filtered = harvest.filter_by_theme(
        records.where(F.col("kind") == "attraction"), attraction_themes
    ).unionByName(harvest.filter_by_theme(records.where(F.col("kind") == "festival"), festival_themes))
    counts = harvest.list_counts(records, filtered)
    return {"records": filtered, "cities": dimensions.with_english_name(counts, lookup)}


def harvest_city_details(targets: DataFrame, inventory: DataFrame, cache: DataFrame) -> Frames:
    """Stored city files of the targets, normalised; cities and records."""
    sources = saved(harvest.resolve_sources(targets, inventory), "sources")
    return {
        "cities": harvest.city_details(targets, sources, inventory),
        "records": harvest.harvest_records(targets, sources, inventory, cache),
    }


# --- images and ingest ------------------------------------------------------


def plan_images(records: DataFrame) -> DataFrame:
    return images.expected_files(images.image_targets(records))


def audit_images(records: DataFrame, actual: DataFrame, outcomes: DataFrame | None = None) -> Frames:
    """Expected against stored files, optionally with recovery outcomes."""
    expected = saved(plan_images(records), "expected")
    missing = images.missing_files(expected, actual)
    if outcomes is not None:
        missing = images.recovery(missing, outcomes)
    return {"missing": missing, "summary": images.audit_summary(expected, missing)}


def review_images(
    records: DataFrame, outcomes: DataFrame, image_bucket: str, image_host: str = images.IMAGE_HOST
) -> Frames:
    """Image status per record, review manifest, counts and run report."""
    processed = saved(images.process_images(records, outcomes, image_bucket, image_host), "images")
    counts = images.city_image_counts(processed)
    review = images.image_review(processed)
    return {
        "records": processed,
        "review": review,
        "reasons": quality.reason_counts(review, "failure_reason"),
        "cities": images.city_image_rows(counts),
        "report": images.image_report(counts),
    }


def ingest_raw(
    spark: SparkSession,
    path: str,
    out: str,
    ingest_date: str,
    previous: DataFrame,
    batch: int,
    overwrite: bool = False,
) -> DataFrame:
    """Manifest of the raw files; new or changed bodies are stored below ``out``.

    The files are read once: manifest and body of a file are one row of
    ``out/batch=N``, the body only where it is uploaded.  A batch that is tried
    again replaces itself; ``ingested_bodies`` reads the newest body per key.
    """
    manifest = sinks.raw_manifest(sinks.read_file_bytes(spark, path), F.lit(ingest_date), keep_body=True)
    status = sinks.ingest_status(manifest, previous, overwrite)
    body = F.when(F.col("status") == "uploaded", F.col("body")).alias("body")
    rows = status.select(*[c for c in status.columns if c != "body"], body)
    rows.write.mode("overwrite").parquet(f"{out}/batch={batch}")
    return spark.read.parquet(f"{out}/batch={batch}").drop("body").orderBy(F.lower("file_name"))


def ingested_bodies(spark: SparkSession, out: str) -> DataFrame:
    """(s3_key, body) last uploaded per key over all batches."""
    stored = spark.read.parquet(out).where(F.col("status") == "uploaded").select("s3_key", "batch", "body")
    return keyvalue.pick_per_key(stored, ["s3_key"], F.col("batch")).drop("batch")


# --- model and vectors ------------------------------------------------------


def run_enrichment(items: DataFrame, model_fn: BatchFn, model_id: str = enrich.MODEL_ID) -> Frames:
    """Model tags for attractions; results are stored before they are counted."""
    results = saved(enrich.enrich_attractions(items, model_fn, model_id), "enrichment")
    return {"results": results, "counts": enrich.batch_counts(results), "failed": enrich.failed_results(results)}


def run_classification(items: DataFrame, model_fn: BatchFn, model_id: str = enrich.MODEL_ID) -> Frames:
    """Model themes for festivals."""
    results = saved(enrich.classify_festivals(items, model_fn, model_id), "classification")
    return {"results": results, "counts": enrich.batch_counts(results), "failed": enrich.failed_results(results)}


def build_vectors(
    items: DataFrame,
    embed_fn: BatchFn,
    index_name: str,
    since: str | None = None,
    dimension: int = vectors.DIMENSION,
    provinces: Sequence[str] = (),
) -> Frames:
    """Vector records of the exportable items.

    ``since`` makes the build incremental, ``provinces`` a regional one.
    Embeddings are stored once; failed ones drop out by key.
    """
    exported = vectors.modified_since(vectors.export_items(items), since)
    if provinces:
        exported = keyvalue.in_provinces(exported, provinces)
    embedded = saved(vectors.embed(vectors.build_chunks(exported), embed_fn, dimension), "embeddings")
    summary = vectors.rebuild_summary(embedded)
    return {
        "records": vectors.first_per_key(
            vectors.vector_records(embedded).withColumn("_order", F.struct("metadata.ddb_pk", "metadata.ddb_sk")), "_order"
        ).drop("_order"),
        "errors": embedded.where(F.col("embedding_error").isNotNull()).select("key", "embedding_error"),
        "summary": summary.withColumn("status_code", quality.status_code(F.col("items_skipped"))),
        "manifest": vectors.build_manifest(exported, summary, index_name),
    }


def load_and_index(
    spark: SparkSession,
    processed: DataFrame,
    store: str,
    batch: int,
    order: Sequence[str],
    embed_fn: BatchFn,
    index_name: str,
    province_id: str | None = None,
    dimension: int = vectors.DIMENSION,
) -> Frames:
    """End to end: load the items, then index what is stored; verdict row."""
    loaded = load_items(spark, processed, store, batch, order, province_id)
    stored = keyvalue.in_province(sinks.current_items(spark, store), province_id)
    built = build_vectors(stored, embed_fn, index_name, dimension=dimension)
    verdict = quality.pass_or_fail(
        keyvalue.in_province(processed, province_id), loaded["summary"], built["summary"]
    )
    return {**built, "load": loaded["summary"], "verdict": verdict}
