"""New raw files to stored items, file by file and exactly once."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tripweave.operators.domain import bucket_view, domain_items
from tripweave.operators.keyvalue import has_key
from tripweave.sources.raw import parse_payloads
from tripweave.sources.sinks import append_batch

ORDER = ["source_key", "position"]


def raw_file_stream(spark: SparkSession, path: str, max_files: int = 1000) -> DataFrame:
    """Stream of (source_key, body), one row per new JSON file."""
    files = (
        spark.readStream.format("text")
        .option("wholetext", True)
        .option("pathGlobFilter", "*.json")
        .option("recursiveFileLookup", "true")
        .option("maxFilesPerTrigger", max_files)
        .load(path)
    )
    return files.select(F.col("_metadata.file_path").alias("source_key"), F.col("value").alias("body"))


def loadable_items(raw: DataFrame, classification: DataFrame | None = None) -> DataFrame:
    """Items to store of raw files (source_key, body), one batch or a stream."""
    items = domain_items(parse_payloads(raw), classification)
    return bucket_view(items, "load_items").drop("buckets", "table")


def store_batch(items: DataFrame, batch: int, store: str) -> dict:
    """One batch of loadable items as one batch of keyed items.

    The counts are observed while the batch is written, so the files are read
    once.  Writing a batch again replaces it, which makes a retry harmless.
    """
    counts = Observation("load")
    observed = items.observe(
        counts,
        F.count_if(has_key()).alias("loaded"),
        F.count_if(~has_key()).alias("load_failed"),
    )
    append_batch(observed, store, batch, ORDER, transient=["position"])
    summary = counts.get
    return {**summary, "batch": batch, "status_code": 207 if summary["load_failed"] else 200}


def load_batch(raw: DataFrame, batch: int, store: str, classification: DataFrame | None = None) -> dict:
    """One batch of raw files as one batch of keyed items; see ``store_batch``."""
    return store_batch(loadable_items(raw, classification), batch, store)


def load_stream(raw: DataFrame, store: str, checkpoint: str, classification: DataFrame | None = None) -> StreamingQuery:
    """Loads what is new in a stream of raw files since the last run, then stops.

    The items are rules on the stream itself, built once, not by every batch.
    """
    return (
        loadable_items(raw, classification)
        .writeStream.foreachBatch(lambda items, batch: store_batch(items, batch, store) and None)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def ingest_raw_files(
    spark: SparkSession,
    path: str,
    store: str,
    checkpoint: str,
    classification: DataFrame | None = None,
    max_files: int = 1000,
) -> StreamingQuery:
    """Loads all files that are new since the last run, then stops."""
    return load_stream(raw_file_stream(spark, path, max_files), store, checkpoint, classification)
