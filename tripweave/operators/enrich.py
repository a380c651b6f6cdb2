"""Batch enrichment around an injected model function.

Items pass guard, skip and sufficiency checks as column expressions; only the
prompts of items that really need an answer travel to Python, one Arrow batch
at a time, and the answers are validated in the JVM again.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripweave.functions.calls import BatchFn, call_batches
from tripweave.functions.hashing import attraction_input_hash, festival_input_hash
from tripweave.functions.prompts import attraction_prompt, festival_prompt
from tripweave.functions.taxonomy import (
    has_sufficient_text,
    nothing_extracted,
    parse_response,
    validate_attraction_tags,
    validate_festival_themes,
)

# Versions stored with every result.
MODEL_ID = "openai.gpt-oss-120b-1:0"
ATTRACTION_PROMPT_VERSION = "attraction-metadata-v2"
FESTIVAL_PROMPT_VERSION = "festival-theme-v1"
SCHEMA_VERSION = "1"
MAX_RETRIES = 2
STEP_BYTES = 4 << 20

_HISTORY = ("status", "input_hash", "prompt_version", "model_id")
_ANSWER = T.StructType([T.StructField("text", T.StringType()), T.StructField("error", T.StringType())])


def is_unchanged(history: Column, input_hash: Column, prompt_version: str, model_id: str) -> Column:
    """An earlier run succeeded on the same input, prompt and model."""
    return F.coalesce(
        (history["status"] == "succeeded")
        & (history["input_hash"] == input_hash)
        & (history["prompt_version"] == prompt_version)
        & (history["model_id"] == model_id),
        F.lit(False),
    )


def with_history(items: DataFrame, history: DataFrame, key: str, column: str) -> DataFrame:
    """Items with their earlier result; ``history`` has one row per key."""
    packed = history.select(key, F.struct(*[F.col(c) for c in _HISTORY]).alias(column))
    return items.join(packed, key, "left")


def _error_code(exc: Exception) -> tuple[str, bool]:
    """(error code, worth another try)."""
    text = f"{type(exc).__name__} {exc}"
    if "Throttling" in text or "TooManyRequests" in text:
        return "throttling", True
    if "timeout" in text.lower():
        return "timeout", True
    if isinstance(exc, ValueError):
        return "validation_error", False
    return "model_error", True


def answers(prompts: pa.Array, call: Callable[[list[str]], list[object]]) -> pa.Array:
    """``struct<text,error>`` of every prompt; only about ``STEP_BYTES`` of prompts are Python strings at a time."""
    sizes = pc.fill_null(pc.binary_length(prompts), 0).to_numpy(zero_copy_only=False)
    steps = np.cumsum(sizes, dtype="int64") // STEP_BYTES
    starts = np.flatnonzero(np.diff(steps, prepend=-1)).tolist()
    told: list[dict | None] = []
    for first, after in zip(starts, [*starts, len(prompts)][1:], strict=True):
        texts = prompts.slice(first, after - first).to_pylist()
        made = iter(call([text for text in texts if text is not None]))
        for text in texts:
            answer = next(made) if text is not None else None
            failed = isinstance(answer, Exception)
            told.append({"text": None if failed else answer, "error": _error_code(answer)[0] if failed else None})
    return pa.array(told, pa.struct([("text", pa.string()), ("error", pa.string())]))


def ask_model(
    prompt: Column,
    model_fn: BatchFn,
    retries: int = MAX_RETRIES,
    pause: float = 1.0,
    batch_size: int = 32,
    concurrency: int = 4,
) -> Column:
    """``struct<text,error>`` per prompt; null prompts are not sent.

    ``model_fn`` takes a list of prompts and returns as many answers, see
    ``functions.calls``.
    """

    def call(texts: list[str]) -> list[object]:
        return call_batches(model_fn, texts, batch_size, concurrency, retries, lambda exc: _error_code(exc)[1], pause)

    @F.arrow_udf(_ANSWER)
    def run(prompts: pa.Array) -> pa.Array:
        return answers(prompts, call)

    # Non-deterministic: Spark must not repeat a model call for one row.
    return run.asNondeterministic()(prompt)


def _struct_or_null(items: DataFrame, name: str) -> Column:
    if name in items.columns:
        return F.col(name)
    fields = ", ".join(f"{c}: string" for c in _HISTORY)
    return F.lit(None).cast(f"struct<{fields}>")


def _stamp() -> Column:
    return F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def _history_entry(status: Column, error: Column, versions: dict[str, Column]) -> Column:
    done = status.isin("succeeded", "skipped", "review_required")
    return F.struct(
        status.alias("status"),
        F.when(status == "failed", error).alias("error_code"),
        *[col.alias(n) for n, col in versions.items()],
        F.when(done, _stamp()).alias("generated_at"),
        F.when(status == "failed", _stamp()).alias("failed_at"),
    )


def enrich_attractions(
    items: DataFrame,
    model_fn: BatchFn,
    model_id: str = MODEL_ID,
    prompt_version: str = ATTRACTION_PROMPT_VERSION,
) -> DataFrame:
    """Items plus ``result`` (status, tags) and the new ``enrichment`` history.

    succeeded: usable tags; skipped: unchanged input or nothing extracted;
    failed: wrong type, model error or invalid answer.
    """
    schema = items.schema
    staged = items.withColumn("_hash", attraction_input_hash(schema)).withColumn(
        "_wrong", F.coalesce(F.col("entity_type") != "attraction", F.lit(True))
    )
    history = _struct_or_null(items, "metadata_enrichment")
    staged = staged.withColumn(
        "_unchanged", ~F.col("_wrong") & is_unchanged(history, F.col("_hash"), prompt_version, model_id)
    )
    asked = ~F.col("_wrong") & ~F.col("_unchanged")
    staged = staged.withColumn("_prompt", F.when(asked, attraction_prompt(schema)))
    staged = staged.withColumn("_answer", ask_model(F.col("_prompt"), model_fn))
    staged = staged.withColumn("_parsed", parse_response(F.col("_answer.text")))
    staged = staged.withColumn("_tags", validate_attraction_tags(F.col("_parsed")))
    tags = F.col("_tags")
    usable = F.col("_parsed").isNotNull() & tags["valid"]
    status = (
        F.when(F.col("_wrong"), F.lit("failed"))
        .when(F.col("_unchanged"), F.lit("skipped"))
        .when(F.col("_answer.error").isNotNull() | ~usable, F.lit("failed"))
        .when(nothing_extracted(tags), F.lit("skipped"))
        .otherwise(F.lit("succeeded"))
    )
    error = F.when(F.col("_wrong"), F.lit("model_error")).otherwise(
        F.coalesce("_answer.error", F.lit("validation_error"))
    )
    staged = staged.withColumn("_status", status).withColumn("_error", error)
    ok = F.col("_status") == "succeeded"
    none = F.array().cast("array<string>")
    result = F.struct(
        F.col("_status").alias("status"),
        F.when(ok, tags["indoor_outdoor"]).alias("indoor_outdoor"),
        *[
            F.when(ok, tags[n]).otherwise(none).alias(n)
            for n in ("vibe_tags", "experience_tags", "companion_fit")
        ],
        F.when(F.col("_status") == "failed", F.col("_error")).alias("error_code"),
    )
    kept = F.when(F.col("_status") != "failed", F.lit(True))
    versions = {
        "model_id": F.when(kept, F.lit(model_id)),
        "prompt_version": F.when(kept, F.lit(prompt_version)),
        "schema_version": F.when(kept, F.lit(SCHEMA_VERSION)),
        "input_hash": F.when(kept, F.col("_hash")),
    }
    return staged.select(
        *items.columns,
        result.alias("result"),
        _history_entry(F.col("_status"), F.col("_error"), versions).alias("enrichment"),
    )


def classify_festivals(
    items: DataFrame,
    model_fn: BatchFn,
    model_id: str = MODEL_ID,
    prompt_version: str = FESTIVAL_PROMPT_VERSION,
) -> DataFrame:
    """Items plus ``result`` (status, themes) and ``classification`` history.

    Unchanged items keep their themes and count as succeeded; items without
    enough text need review; a failure never replaces existing themes.
    """
    schema = items.schema
    staged = items.withColumn("_hash", festival_input_hash(schema)).withColumn(
        "_wrong", F.coalesce(F.col("entity_type") != "festival", F.lit(True))
    )
    history = _struct_or_null(items, "festival_theme_classification")
    texts = [F.col(c) for c in ("description", "program", "subevent") if c in items.columns]
    staged = staged.withColumn(
        "_unchanged", ~F.col("_wrong") & is_unchanged(history, F.col("_hash"), prompt_version, model_id)
    ).withColumn("_enough", has_sufficient_text(*texts))
    asked = ~F.col("_wrong") & ~F.col("_unchanged") & F.col("_enough")
    staged = staged.withColumn("_prompt", F.when(asked, festival_prompt(schema)))
    staged = staged.withColumn("_answer", ask_model(F.col("_prompt"), model_fn))
    staged = staged.withColumn("_themes", validate_festival_themes(parse_response(F.col("_answer.text"))))
    themes = F.col("_themes")
    status = (
        F.when(F.col("_wrong"), F.lit("failed"))
        .when(F.col("_unchanged"), F.lit("succeeded"))
        .when(~F.col("_enough"), F.lit("review_required"))
        .when(F.col("_answer.error").isNotNull() | ~themes["valid"], F.lit("failed"))
        .otherwise(F.lit("succeeded"))
    )
    error = F.when(F.col("_wrong"), F.lit("invalid_entity_type")).otherwise(
        F.coalesce("_answer.error", F.lit("validation_error"))
    )
    staged = staged.withColumn("_status", status).withColumn("_error", error)
    answered = (F.col("_status") == "succeeded") & ~F.col("_unchanged")
    none = F.array().cast("array<string>")
    old_theme = F.col("theme") if "theme" in items.columns else F.lit(None).cast("string")
    old_tags = F.col("theme_tags") if "theme_tags" in items.columns else none
    result = F.struct(
        F.col("_status").alias("status"),
        F.when(answered, themes["primary_theme"]).when(F.col("_unchanged"), old_theme).alias("primary_theme"),
        F.when(answered, themes["theme_tags"]).when(F.col("_unchanged"), old_tags).otherwise(none).alias("theme_tags"),
        F.when(F.col("_status") == "failed", F.col("_error")).alias("error_code"),
    )
    kept = F.when(~F.col("_wrong"), F.lit(True))
    versions = {
        "model_id": F.when(kept, F.lit(model_id)),
        "prompt_version": F.when(kept, F.lit(prompt_version)),
        "schema_version": F.when(kept, F.lit(SCHEMA_VERSION)),
        "input_hash": F.when(kept, F.col("_hash")),
    }
    return staged.select(
        *items.columns,
        result.alias("result"),
        _history_entry(F.col("_status"), F.col("_error"), versions).alias("classification"),
    )


def batch_counts(results: DataFrame) -> DataFrame:
    """Result counts by status."""
    return results.groupBy(F.col("result.status").alias("status")).agg(F.count("*").alias("item_count"))


def failed_results(results: DataFrame) -> DataFrame:
    """Content id and error code of every failed item."""
    return results.where(F.col("result.status") == "failed").select(
        F.coalesce("content_id", F.lit("unknown")).alias("content_id"),
        F.col("result.error_code").alias("error_code"),
    )
