"""Embedding text, filter metadata, vector records and exact top-k search."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripweave.functions.dates import date_range_text
from tripweave.functions.hashing import column_types
from tripweave.functions.calls import BatchFn, call_batches
from tripweave.operators.keyvalue import pick_per_key
from tripweave.operators.quality import side_by_side

# Index contract.
VECTOR_TYPES = ("city", "city_metadata", "attraction", "festival")
EMBEDDING_MODEL = "amazon.titan-embed-text-v2:0"
DIMENSION = 1024
FILTER_KEYS = (
    "country", "province", "city_id", "city_name_en", "city_name_ko", "entity_type",
    "source_type", "source_id", "place_id", "title", "class_tags", "theme_tags", "season_tags",
    "visit_months", "latitude", "longitude", "attraction_subtype_code", "indoor_outdoor",
    "vibe_tags", "experience_tags", "companion_fit", "schema_version",
)
OTHER_KEYS = ("raw_s3_uri", "ddb_pk", "ddb_sk", "embedding_model")
ENRICHMENT_KEYS = ("indoor_outdoor", "vibe_tags", "experience_tags", "companion_fit", "schema_version")
BUDGET_BYTES = 2048
TYPE_LABELS = {"city": "도시", "attraction": "관광지", "festival": "축제"}

_STRINGS = "array<string>"


def is_vectorizable() -> Column:
    """Indexed type and quality passed (missing counts as passed)."""
    quality = F.coalesce(F.nullif("quality_status", F.lit("")), F.lit("passed"))
    return F.col("entity_type").isin(*VECTOR_TYPES) & (quality == "passed")


def export_items(
    items: DataFrame, entity_types: Sequence[str] = VECTOR_TYPES, city_pk: str | None = None
) -> DataFrame:
    """Items to index, optionally of some types or one city."""
    out = items.where(F.col("entity_type").isin(*entity_types) & is_vectorizable())
    return out.where(F.col("PK") == city_pk) if city_pk else out


def modified_since(items: DataFrame, timestamp: str | None) -> DataFrame:
    """Items changed after an ISO time stamp; undated items are included.

    Time stamps compare as text.
    """
    if not timestamp:
        return items
    stamps = [
        F.nullif(F.col(c).cast("string"), F.lit("")) for c in ("updated_at", "collected_at") if c in items.columns
    ]
    if not stamps:
        return items
    modified = F.coalesce(*stamps)
    return items.where(modified.isNull() | (modified > timestamp))


def entity_counts(items: DataFrame) -> DataFrame:
    return items.groupBy(
        F.coalesce(F.nullif("entity_type", F.lit("")), F.lit("unknown")).alias("entity_type")
    ).agg(F.count("*").alias("item_count"))


# --- tags -------------------------------------------------------------------


def string_values(col: Column, data_type: T.DataType) -> Column:
    """All scalar leaves of a typed column as an array of strings."""
    none = F.array().cast(_STRINGS)
    if isinstance(data_type, T.ArrayType):
        nested = F.transform(col, lambda e: string_values(e, data_type.elementType))
        return F.coalesce(F.flatten(nested), none)
    if isinstance(data_type, T.StructType):
        parts = [string_values(col[f.name], f.dataType) for f in data_type.fields]
        return F.when(col.isNotNull(), F.flatten(F.array(*parts))).otherwise(none)
    if isinstance(data_type, T.MapType):
        return string_values(F.map_values(col), T.ArrayType(data_type.valueType))
    text = col.cast("string")
    return F.when(F.coalesce(text, F.lit("")) != "", F.array(text)).otherwise(none)


def class_tags(schema: T.StructType) -> Column:
    """Distinct tags of the four tag columns and of ``classification``."""
    types = column_types(schema)
    parts = [F.array().cast(_STRINGS)]
    for name in ("class_tags", "classification_tags", "category_tags", "cuisine_tags"):
        if name in types:
            parts.append(string_values(F.col(name), types[name]))
    if isinstance(types.get("classification"), T.StructType):
        inner = column_types(types["classification"])
        for name in ("class", "category", "theme", "type", "tags"):
            if name in inner:
                parts.append(string_values(F.col("classification")[name], inner[name]))
    elif "classification" in types:
        parts.append(string_values(F.col("classification"), types["classification"]))
    return F.array_distinct(F.concat(*parts))


def theme_tags(schema: T.StructType, own_classes: Column) -> Column:
    """Theme tags, or season tags without any, then theme and class tags."""
    types = column_types(schema)
    none = F.array().cast(_STRINGS)
    lists = [string_values(F.col(n), types[n]) for n in ("theme_tags", "season_tags") if n in types]
    tags = none
    for col in reversed(lists):
        tags = F.when(F.size(col) > 0, col).otherwise(tags)
    theme = none
    if "theme" in types:
        theme = F.when(F.coalesce("theme", F.lit("")) != "", F.array("theme")).otherwise(none)
    return F.array_distinct(F.concat(tags, theme, own_classes))


# --- chunks -----------------------------------------------------------------


def _field(types: Mapping[str, T.DataType], name: str, as_type: str = "string") -> Column:
    return F.col(name).cast(as_type) if name in types else F.lit(None).cast(as_type)


def _first(types: Mapping[str, T.DataType], *names: str) -> Column:
    """First column with any text (not stripped), else null."""
    return F.coalesce(*[F.nullif(_field(types, n), F.lit("")) for n in names])


def normal_type(entity_type: Column) -> Column:
    kind = F.coalesce(F.nullif(entity_type, F.lit("")), F.lit("unknown"))
    return F.when(kind == "city_metadata", F.lit("city")).otherwise(kind)


def source_id(schema: T.StructType) -> Column:
    """Content id, entity id, the sort key after its first ``#``, or unknown."""
    types = column_types(schema)
    sk = F.coalesce(_field(types, "SK"), F.lit(""))
    tail = F.regexp_replace(sk, r"(?s)\A[^#]*#", "")
    return F.coalesce(_first(types, "content_id", "entity_id"), F.nullif(tail, F.lit("")), F.lit("unknown"))


def embedding_text(schema: T.StructType, kind: Column, tags: Column) -> Column:
    """Labelled lines describing an item, by entity type."""
    types = column_types(schema)
    blank = F.lit("")

    def line(label: str, value: Column) -> Column:
        return F.when(F.coalesce(value, blank) != "", F.concat(F.lit(f"{label}: "), value))

    def text(name: str) -> Column:
        return F.coalesce(_field(types, name), blank)

    is_fest, is_att = kind == "festival", kind == "attraction"
    label = kind
    for name, shown in TYPE_LABELS.items():
        label = F.when(kind == name, F.lit(shown)).otherwise(label)
    period = date_range_text(
        _first(types, "eventstartdate", "event_start_date"), _first(types, "eventenddate", "event_end_date")
    )
    lines = [
        F.concat(F.lit("이름: "), F.coalesce(_first(types, "title", "city_name_ko", "city_name_en"), blank)),
        F.concat(F.lit("유형: "), label),
        F.concat(F.lit("도시: "), text("city_name_ko"), F.lit(" ("), text("city_name_en"), F.lit(")")),
        F.concat(F.lit("지역: "), text("province")),
        line("주소", _first(types, "address", "venue")),
        line("분류", F.array_join(tags, ", ")),
        F.when(is_fest, line("기간", period)),
        F.when(is_fest, line("장소", _field(types, "venue"))),
        F.when(is_fest, line("계절", _field(types, "season"))),
        F.when(is_att, line("테마", _field(types, "theme"))),
        F.when(~is_fest & ~is_att, line("도시 ID", _field(types, "city_id"))),
        line("설명", _field(types, "description")),
    ]
    return F.array_join(F.array_compact(F.array(*lines)), "\n")


def _compact(col: Column, data_type: T.DataType) -> Column:
    """Null for '' and for empty lists."""
    if isinstance(data_type, T.ArrayType):
        return F.when(F.size(col) > 0, col)
    return F.nullif(col, F.lit("")) if isinstance(data_type, T.StringType) else col


def _metadata_fields(schema: T.StructType, kind: Column, tags: Column) -> dict[str, Column]:
    types = column_types(schema)
    place = F.concat(kind, F.lit("#"), source_id(schema))
    is_att = kind == "attraction"
    enriched = F.lit(False)
    if "metadata_enrichment" in types:
        enriched = F.coalesce(F.col("metadata_enrichment.status") == "succeeded", F.lit(False))
    themes = theme_tags(schema, tags)
    if "festival_theme_classification" in types and "theme_tags" in types:
        classified = (
            (kind == "festival")
            & F.coalesce(F.col("festival_theme_classification.status") == "succeeded", F.lit(False))
            & (F.size("theme_tags") > 0)
        )
        themes = F.when(classified, F.col("theme_tags")).otherwise(themes)

    def enrichment(name: str) -> Column:
        as_type = _STRINGS if isinstance(types.get(name), T.ArrayType) else "string"
        if name not in types and name in ("vibe_tags", "experience_tags", "companion_fit"):
            as_type = _STRINGS
        col = _field(types, name, as_type)
        return F.when(is_att & enriched, _compact(col, T.ArrayType(T.StringType()) if as_type == _STRINGS else T.StringType()))

    strings = T.ArrayType(T.StringType())
    return {
        "country": F.lit("KR"),
        **{n: F.nullif(_field(types, n), F.lit("")) for n in ("province", "city_id", "city_name_en", "city_name_ko")},
        "entity_type": kind,
        "source_type": kind,
        "source_id": source_id(schema),
        "place_id": place,
        "title": F.nullif(_field(types, "title"), F.lit("")),
        "class_tags": _compact(tags, strings),
        "theme_tags": _compact(themes, strings),
        "season_tags": _compact(_field(types, "season_tags", _STRINGS), strings),
        "visit_months": _compact(_field(types, "visit_months", "array<int>"), strings),
        "latitude": _field(types, "latitude", "double"),
        "longitude": _field(types, "longitude", "double"),
        "attraction_subtype_code": F.when(
            is_att, F.nullif(_field(types, "attraction_subtype_code"), F.lit(""))
        ),
        **{n: enrichment(n) for n in ENRICHMENT_KEYS},
        "raw_s3_uri": F.coalesce(_first(types, "source", "raw_s3_uri"), F.lit("unknown")),
        "ddb_pk": F.nullif(_field(types, "PK"), F.lit("")),
        "ddb_sk": F.nullif(_field(types, "SK"), F.lit("")),
        "embedding_model": F.lit(EMBEDDING_MODEL),
    }


def filter_bytes(metadata: Column, without: Sequence[str] = ()) -> Column:
    """UTF-8 size of the filterable part of a metadata struct as JSON."""
    kept = [metadata[k].alias(k) for k in FILTER_KEYS if k not in without]
    return F.octet_length(F.to_json(F.struct(*kept)))


def _list_bytes(name: str, tags: Column, kept: Column) -> Column:
    """JSON bytes of the entry ``,"name":[…]`` with the first ``kept`` tags."""
    quoted = F.aggregate(
        F.slice(tags, F.lit(1), kept), F.lit(0), lambda acc, t: acc + F.octet_length(F.to_json(F.array(t))) - 2
    )
    commas = F.greatest(kept - 1, F.lit(0))
    return F.when(tags.isNull(), F.lit(0)).otherwise(quoted + commas + len(f',"{name}":[]'))


def _fitting(tags: Column, room: Column, most: int) -> Column:
    """How many leading tags, ``most`` at most, fit into ``room`` bytes, in one pass."""

    def add(state: Column, tag: Column) -> Column:
        comma = F.when(state["n"] > 0, 1).otherwise(0)
        used = state["used"] + F.octet_length(F.to_json(F.array(tag))) - 2 + comma
        fits = state["open"] & (used <= room)
        return F.struct(
            F.when(fits, used).otherwise(state["used"]).alias("used"),
            F.when(fits, state["n"] + 1).otherwise(state["n"]).alias("n"),
            fits.alias("open"),
        )

    start = F.struct(F.lit(0).alias("used"), F.lit(0).alias("n"), F.lit(True).alias("open"))
    return F.coalesce(F.aggregate(F.slice(tags, F.lit(1), F.lit(most)), start, add, lambda state: state["n"]), F.lit(0))


def trim_to_budget(metadata: Column, budget: int = BUDGET_BYTES) -> Column:
    """Metadata within ``budget`` bytes of filterable JSON, else null.

    Experience tags are dropped from the end first, then vibe tags.  Sizes are
    added up per tag in one pass over each list, as far as tags can fit: a tag
    takes three bytes at least, so longer lists are over budget whatever they hold.
    """
    most = budget // 3 + 2
    trimmed = ("experience_tags", "vibe_tags")
    experience, vibe = (metadata[n] for n in trimmed)
    none = F.lit(0)
    n_vibe = F.least(F.greatest(F.coalesce(F.size(vibe), none), none), F.lit(most))
    bare = filter_bytes(metadata, without=trimmed) + _list_bytes(trimmed[0], experience, none)
    all_vibe = bare + _list_bytes(trimmed[1], vibe, n_vibe)
    no_vibe = bare + _list_bytes(trimmed[1], vibe, none)
    whole = all_vibe <= budget
    cut = metadata.withField(
        "experience_tags",
        F.slice(experience, F.lit(1), F.when(whole, _fitting(experience, F.lit(budget) - all_vibe, most)).otherwise(none)),
    ).withField(
        "vibe_tags",
        F.slice(vibe, F.lit(1), F.when(whole, n_vibe).otherwise(_fitting(vibe, F.lit(budget) - no_vibe, most))),
    )
    return F.when(no_vibe <= budget, cut)


def build_chunks(items: DataFrame, chunk_no: int = 0) -> DataFrame:
    """(key, place_id, embedding_text, metadata, error) of items.

    Metadata over budget loses tags, then all enrichment; what is still too
    large keeps its metadata and gets ``error``.
    """
    schema = items.schema
    kind = normal_type(F.col("entity_type"))
    staged = items.withColumn("_kind", kind).withColumn("_tags", class_tags(schema))
    kind, tags = F.col("_kind"), F.col("_tags")
    fields = _metadata_fields(schema, kind, tags)
    staged = staged.select(
        F.concat(kind, F.lit("#"), source_id(schema)).alias("place_id"),
        embedding_text(schema, kind, tags).alias("embedding_text"),
        F.struct(*[fields[k].alias(k) for k in (*FILTER_KEYS, *OTHER_KEYS)]).alias("full"),
    )
    bare = F.col("full")
    for name in ENRICHMENT_KEYS:
        bare = bare.withField(name, F.lit(None).cast(_metadata_type(name)))
    staged = staged.withColumn("bare", bare)
    sized = staged.withColumn("trimmed", trim_to_budget(F.col("full")))
    over_budget = metadata_error_text(filter_bytes(F.col("bare")))
    return sized.select(
        F.concat_ws("#", "place_id", F.lit(str(chunk_no))).alias("key"),
        "place_id",
        "embedding_text",
        F.coalesce("trimmed", "bare").alias("metadata"),
        F.when(F.col("trimmed").isNull(), over_budget).alias("error"),
    )


def _metadata_type(name: str) -> str:
    return _STRINGS if name in ("vibe_tags", "experience_tags", "companion_fit") else "string"


def metadata_error_text(size: Column, budget: int = BUDGET_BYTES) -> Column:
    return F.when(
        size > budget,
        F.concat(F.lit("filterable metadata is "), size.cast("string"), F.lit(f" bytes, exceeds {budget}")),
    )


def metadata_error(metadata_json: Column) -> Column:
    """Why a metadata JSON object breaks the contract, null when it does not."""
    keys = F.json_object_keys(metadata_json)
    unknown = F.array_sort(F.array_except(keys, F.array(*[F.lit(k) for k in (*FILTER_KEYS, *OTHER_KEYS)])))
    fields = F.try_variant_get(F.try_parse_json(metadata_json), "$", "map<string,variant>")
    kept = F.map_filter(fields, lambda k, _: k.isin(*FILTER_KEYS))
    size = F.octet_length(F.to_json(kept))
    return F.when(
        F.size(unknown) > 0,
        F.concat(F.lit("metadata keys are not allowlisted: "), F.array_join(unknown, ", ")),
    ).otherwise(metadata_error_text(size))


# --- embedding --------------------------------------------------------------


def embed(
    chunks: DataFrame,
    embed_fn: BatchFn,
    dimension: int = DIMENSION,
    batch_size: int = 32,
    concurrency: int = 4,
) -> DataFrame:
    """Adds ``embedding`` and ``embedding_error`` by an injected function.

    ``embed_fn`` takes a list of texts and returns as many vectors, see
    ``functions.calls``; only the text travels to Python.  A text that fails or
    returns the wrong dimension gets an error and does not disturb its
    neighbours.
    """
    schema = T.StructType(
        [T.StructField("embedding", T.ArrayType(T.FloatType())), T.StructField("error", T.StringType())]
    )

    def checked(found: object) -> tuple[list[float] | None, str | None]:
        if isinstance(found, Exception):
            return None, f"{type(found).__name__}: {found}"
        if found is None:
            return None, "no embedding"
        vector = [float(x) for x in found]
        return (vector, None) if len(vector) == dimension else (None, f"unexpected embedding dimension: {len(vector)}")

    @F.pandas_udf(schema)
    def run(texts: pd.Series) -> pd.DataFrame:
        found = call_batches(embed_fn, list(texts), batch_size, concurrency)
        return pd.DataFrame([checked(f) for f in found], columns=["embedding", "error"])

    # Marked non-deterministic so that Spark never evaluates the call twice.
    return chunks.withColumn("_e", run.asNondeterministic()("embedding_text")).select(
        *chunks.columns, F.col("_e.embedding").alias("embedding"), F.col("_e.error").alias("embedding_error")
    )


def vector_records(embedded: DataFrame) -> DataFrame:
    """Storable records: key, float32 vector and metadata."""
    return embedded.where(F.col("embedding").isNotNull()).select(
        "key", F.struct(F.col("embedding").alias("float32")).alias("data"), "metadata"
    )


def attach_embeddings(chunks: DataFrame, embeddings: DataFrame) -> DataFrame:
    """Chunks joined with ready vectors by key."""
    return chunks.join(embeddings.select("key", "embedding"), "key", "left")


def first_per_key(records: DataFrame, order: str, batch_size: int | None = None) -> DataFrame:
    """First record of every key; with ``batch_size`` only within batches of
    consecutive ``order`` numbers, as a batched writer would drop them."""
    keys = ["key"]
    if batch_size:
        records = records.withColumn("_batch", F.floor(F.col(order) / batch_size))
        keys.append("_batch")
    return pick_per_key(records, keys, F.col(order), last=False).drop("_batch")


def rebuild_summary(embedded: DataFrame) -> DataFrame:
    """One row: processed, upserted and skipped counts of an index build."""
    ok = F.col("embedding").isNotNull()
    return embedded.agg(
        F.count("*").alias("items_processed"),
        F.count_distinct(F.when(ok, F.col("key"))).alias("items_upserted"),
        F.count_if(~ok).alias("items_skipped"),
    )


def build_manifest(items: DataFrame, summary: DataFrame, index_name: str) -> DataFrame:
    """One-row build manifest with the counts per entity type."""
    counts = entity_counts(items).agg(
        F.map_from_entries(F.collect_list(F.struct("entity_type", "item_count"))).alias("entity_counts")
    )
    head = summary.select(
        F.lit(index_name).alias("index_name"),
        F.lit("rich").alias("index_text_mode"),
        F.current_timestamp().alias("created_at"),
        F.col("items_processed").alias("chunk_count"),
        F.col("items_upserted").alias("vector_success_count"),
        F.col("items_skipped").alias("failed_count"),
    )
    return side_by_side(head, counts)


# --- search -----------------------------------------------------------------


def metadata_filter(equals: Mapping[str, object], column: str = "metadata") -> Column:
    """All given metadata entries have the given value; lists contain it."""
    out = F.lit(True)
    for key, value in equals.items():
        out = out & (F.col(f"{column}.{key}") == F.lit(value))
    return out


def cosine_top_k(
    vectors: DataFrame,
    query: Sequence[float],
    k: int,
    key: str = "key",
    embedding: str = "embedding",
    where: Column | None = None,
) -> DataFrame:
    """The ``k`` rows nearest to ``query`` by cosine distance, exact.

    Filters first.  Every task scores its Arrow batches with one matrix product
    and forwards only its own best ``k`` (key, distance) pairs, so the final
    ordering sees k rows per task whatever the table size.  Ties go to the
    smaller key; vectors without direction or of another dimension have no
    distance, ``unsearchable`` returns them.
    """
    rows = vectors if where is None else vectors.where(where)
    target = np.asarray(query, dtype=np.float64)
    norm = float(np.linalg.norm(target))
    if norm == 0:
        raise ValueError("the query vector has no direction")
    target = target / norm
    size = len(target)
    out = T.StructType([T.StructField(key, rows.schema[key].dataType), T.StructField("distance", T.DoubleType())])

    def local_best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: pa.Table | None = None
        for batch in batches:
            lists = batch.column(1)
            flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            matrix = flat.reshape(batch.num_rows, size)
            lengths = np.sqrt(np.einsum("ij,ij->i", matrix, matrix))
            with np.errstate(invalid="ignore", divide="ignore"):
                # Rounded so that equal vectors tie whatever their position.
                distance = np.round(1.0 - np.einsum("ij,j->i", matrix, target) / lengths, 12)
            table = pa.table({key: batch.column(0), "distance": distance}).filter(pa.array(np.isfinite(distance)))
            best = table if best is None else pa.concat_tables([best, table])
            best = best.sort_by([("distance", "ascending"), (key, "ascending")]).slice(0, k)
        if best is not None:
            yield from best.combine_chunks().to_batches()

    usable = rows.where(F.size(embedding) == size).select(key, embedding)
    return usable.mapInArrow(local_best, out).orderBy("distance", key).limit(k)


def unsearchable(vectors: DataFrame, size: int, key: str = "key", embedding: str = "embedding") -> DataFrame:
    """(key, reason) of the vectors that a search of ``size`` dimensions leaves out."""
    value = F.col(embedding)
    odd = F.exists(value, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    reason = (
        F.when(value.isNull(), "no vector")
        .when(F.size(value) != size, F.concat(F.size(value).cast("string"), F.lit(" dimensions")))
        .when(odd | ~F.exists(value, lambda x: x != 0), "no direction")
    )
    return vectors.select(key, reason.alias("reason")).where(F.col("reason").isNotNull())


def vectors_by_key(vectors: DataFrame, keys: Sequence[object], key: str = "key") -> DataFrame:
    """Point lookup of some vectors."""
    return vectors.where(F.col(key).isin(*keys))


def look_up_items(hits: DataFrame, items: DataFrame) -> DataFrame:
    """Stored items behind search hits, by the keys in their metadata."""
    keys = hits.select(
        F.col("metadata.ddb_pk").alias("PK"), F.col("metadata.ddb_sk").alias("SK"), "distance"
    )
    return keys.join(items, ["PK", "SK"])
