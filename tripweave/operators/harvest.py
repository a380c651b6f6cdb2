"""Region filter of tour records and harvesting of stored city details."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripweave.functions.hashing import payload_signature
from tripweave.functions.text import coordinate_status, safe_object_name
from tripweave.sources.raw import is_object, text_at

# --- region filter ----------------------------------------------------------


def filter_by_theme(records: DataFrame, themes: DataFrame) -> DataFrame:
    """Records whose class code maps to a theme, with ``assigned_theme``.

    Lodging (``lclsSystm1`` C01) is dropped; the code is lclsSystm3, else cat3.
    ``themes`` has one row per code.
    """
    code = F.coalesce(F.nullif("lclsSystm3", F.lit("")), F.nullif("cat3", F.lit("")))
    kept = records.where(~F.col("lclsSystm1").eqNullSafe(F.lit("C01"))).withColumn("_code", code)
    mapped = themes.select(F.col("code").alias("_code"), F.col("theme").alias("assigned_theme"))
    return kept.join(mapped, "_code").drop("_code")


def list_counts(raw: DataFrame, filtered: DataFrame, city: str = "city_name_ko") -> DataFrame:
    """Raw and filtered record counts per city and kind (attraction/festival)."""
    rows = raw.select(city, "kind", F.lit(0).alias("kept")).unionByName(
        filtered.select(city, "kind", F.lit(1).alias("kept"))
    )

    def count(kind: str, kept: int) -> Column:
        return F.count_if((F.col("kind") == kind) & (F.col("kept") == kept))

    return rows.groupBy(city).agg(
        count("attraction", 0).alias("attractions_count_raw"),
        count("festival", 0).alias("festivals_count_raw"),
        count("attraction", 1).alias("attractions_count_filtered"),
        count("festival", 1).alias("festivals_count_filtered"),
    )


def limit_per_city(records: DataFrame, limit: int, city: str, order: Sequence[str]) -> DataFrame:
    """At most ``limit`` records per city, in ``order`` (attractions first).

    Spark prunes to ``limit`` rows per city before the shuffle, so a huge city
    does not reach one task.
    """
    if limit <= 0:
        return records.where(F.lit(False))
    place = F.row_number().over(Window.partitionBy(city).orderBy(*order))
    return records.withColumn("_place", place).where(F.col("_place") <= limit).drop("_place")


# --- source files -----------------------------------------------------------

# Folders searched for a city file, best first.
LOOKUP_ROOTS = ("data/raw/final", "data/raw/list_by_city", "data/city", "data")
SUFFIXES = ("", "_filtered")
DETAIL_KEYS = ("attractions", "festivals", "visitor_stats", "items", "records")


def candidate_names(name_en: Column, city_id: Column) -> Column:
    """File base names under which a city may be stored, in search order."""
    spellings = F.array(name_en, F.replace(name_en, F.lit(" "), F.lit("_")), city_id)
    variants = F.transform(
        F.filter(F.transform(spellings, lambda n: F.trim(n)), lambda n: n != ""),
        lambda n: F.array(
            n, F.lower(n), F.replace(n, F.lit(" "), F.lit("_")), F.replace(n, F.lit("-"), F.lit("_"))
        ),
    )
    return F.array_distinct(F.flatten(variants))


def is_detail_payload(payload: Column) -> Column:
    """A JSON object with one of the list keys of a city detail file."""
    keys = F.map_keys(F.try_variant_get(payload, "$", "map<string,variant>"))
    return F.coalesce(F.arrays_overlap(keys, F.array(*[F.lit(k) for k in DETAIL_KEYS])), F.lit(False))


def _signature(kind: str, value: Column) -> Column:
    return F.struct(F.lit(kind).alias("kind"), value.alias("value"))


def _signatures(inventory: DataFrame) -> DataFrame:
    """Inventory paths with the city names and ids they mention."""
    p = F.col("payload")

    def value(path: str) -> Column:
        return F.trim(F.coalesce(text_at(p, path), F.lit("")))

    entries = F.array(
        _signature("en", F.upper(value("$.meta.city_name_en"))),
        _signature("ko", value("$.meta.city_name_ko")),
        _signature("id", value("$.meta.city_id")),
        _signature("en", F.upper(value("$.city_name_en"))),
        _signature("id", value("$.city_id")),
        _signature("ko", value("$.name_ko")),
    )
    return inventory.select("path", F.inline(F.array_distinct(entries))).where(F.col("value") != "")


def resolve_sources(targets: DataFrame, inventory: DataFrame) -> DataFrame:
    """(city_id, path) of the file that holds a target's details.

    ``inventory`` is (path, payload); paths are relative to the data root.  A
    file below a lookup folder named after the city wins, by folder, name and
    suffix order; only a city without any such file is searched by the names
    inside the files.  Blank names never match.
    """
    roots = F.array(*[F.lit(r) for r in LOOKUP_ROOTS])
    folder = F.regexp_extract("path", r"\A(.*)/[^/]*\z", 1)
    stem = F.regexp_extract("path", r"([^/]*)\.json\z", 1)
    files = inventory.select(
        "path",
        (F.array_position(roots, folder) - 1).cast("int").alias("root_rank"),
        is_detail_payload(F.col("payload")).alias("is_detail"),
        F.inline(
            F.array(
                F.struct(stem.alias("name"), F.lit(0).alias("suffix_rank")),
                F.struct(
                    F.when(stem.endswith(SUFFIXES[1]), F.regexp_replace(stem, SUFFIXES[1] + r"\z", "")).alias("name"),
                    F.lit(1).alias("suffix_rank"),
                ),
            )
        ),
    ).where((F.col("root_rank") >= 0) & F.col("name").isNotNull())
    wanted = targets.select(
        "city_id",
        F.posexplode(candidate_names(F.col("city_name_en"), F.col("city_id"))).alias("name_rank", "name"),
    )
    matches = wanted.join(files, "name")
    order = F.struct("root_rank", "name_rank", "suffix_rank", "path")
    by_name = matches.groupBy("city_id").agg(
        F.min(F.when(F.col("is_detail"), order)).alias("best")
    )
    named = by_name.where(F.col("best").isNotNull()).select("city_id", "best.path")
    unnamed = targets.join(by_name, "city_id", "left_anti")
    asked = unnamed.select(
        "city_id",
        F.inline(
            F.array(
                _signature("en", F.upper("city_name_en")),
                _signature("ko", F.col("city_name_ko")),
                _signature("id", F.col("city_id")),
            )
        ),
    ).where(F.col("value") != "")
    details = inventory.where(is_detail_payload(F.col("payload")))
    # One path per name before the join: a name in a third of all files is one row.
    named_in = _signatures(details).groupBy("kind", "value").agg(F.min("path").alias("path"))
    by_content = asked.join(named_in, ["kind", "value"]).groupBy("city_id").agg(F.min("path").alias("path"))
    return named.unionByName(by_content)


# --- detail records ---------------------------------------------------------


def split_records(payload: Column) -> Column:
    """array<struct<kind,pos,rec>>: attractions and festivals of a payload.

    Without both lists the first non-empty of items, records and data is split
    by content type 15.
    """
    entry = "array<struct<kind:string,pos:int,rec:variant>>"

    def objects(name: str) -> Column:
        listed = F.try_variant_get(payload, f"$.{name}", "array<variant>")
        return F.coalesce(F.filter(listed, is_object), F.array().cast("array<variant>"))

    def tagged(name: str, kind: str) -> Column:
        return F.transform(
            objects(name),
            lambda r, i: F.struct(F.lit(kind).alias("kind"), i.cast("int").alias("pos"), r.alias("rec")),
        )

    own = F.concat(tagged("attractions", "attraction"), tagged("festivals", "festival"))
    other = F.array().cast("array<variant>")
    for name in ("data", "records", "items"):
        other = F.when(F.size(objects(name)) > 0, objects(name)).otherwise(other)

    def by_type(rec: Column, i: Column) -> Column:
        type_id = F.coalesce(
            F.nullif(text_at(rec, "$.contenttypeid"), F.lit("")), text_at(rec, "$.content_type_id"), F.lit("")
        )
        kind = F.when(type_id == "15", F.lit("festival")).otherwise(F.lit("attraction"))
        return F.struct(kind.alias("kind"), i.cast("int").alias("pos"), rec.alias("rec"))

    return F.when(F.size(own) > 0, own).otherwise(F.transform(other, by_type)).cast(entry)


def attach_details(records: DataFrame, cache: DataFrame) -> DataFrame:
    """Adds ``detail``: the record's own, else the cached one of its id.

    ``records`` has a ``rec`` VARIANT, ``cache`` is (content_id, detail).
    """
    own = F.try_variant_get("rec", "$.detail", "variant")
    own = F.when(is_object(own), own)
    ident = F.coalesce(
        F.nullif(text_at(F.col("rec"), "$.contentid"), F.lit("")), text_at(F.col("rec"), "$.contentId")
    )
    # Records with their own detail, or without an id, must not match; a key of
    # their own keeps them from gathering as nulls in one task.
    plain = [n for n, kind in records.dtypes if kind in ("string", "int", "bigint")]
    alone = F.concat(F.lit("\x00"), F.xxhash64(*plain).cast("string"))
    keyed = records.withColumn("_own", own).withColumn(
        "_id", F.coalesce(F.when(F.col("_own").isNull(), F.nullif(ident, F.lit(""))), alone)
    )
    known = cache.select(F.col("content_id").alias("_id"), F.col("detail").alias("_cached"))
    joined = keyed.join(known, "_id", "left")
    return joined.withColumn("detail", F.coalesce("_own", "_cached")).drop("_own", "_cached", "_id")


def _present(*values: Column) -> Column:
    """collected when the first truthy value has text."""
    first = F.coalesce(*[F.nullif(v, F.lit("")) for v in values])
    return F.when(F.coalesce(F.trim(first), F.lit("")) == "", F.lit("missing")).otherwise(F.lit("collected"))


def item_field_status(rec: Column, detail: Column) -> Column:
    """Collection status of the seven fields a record should have.

    A status map that came with the record is kept.
    """

    def of(name: str) -> Column:
        return text_at(rec, f"$.{name}")

    def common(name: str) -> Column:
        return text_at(detail, f"$.common.{name}")

    lon = F.coalesce(F.nullif(of("mapx"), F.lit("")), of("longitude"))
    lat = F.coalesce(F.nullif(of("mapy"), F.lit("")), of("latitude"))
    detail_size = F.coalesce(F.size(F.try_variant_get(detail, "$", "map<string,variant>")), F.lit(0))
    computed = F.create_map(
        F.lit("name"), _present(of("title"), common("title")),
        F.lit("address"), _present(of("addr1"), common("addr1")),
        F.lit("coordinates"), coordinate_status(lon, lat),
        F.lit("image"), _present(of("firstimage"), common("firstimage")),
        F.lit("tel"), _present(of("tel"), common("tel"), text_at(detail, "$.intro.infocenter")),
        F.lit("theme"), _present(of("_assigned_theme")),
        F.lit("detail"), F.when(detail_size > 0, F.lit("collected")).otherwise(F.lit("missing")),
    )
    return F.coalesce(F.try_variant_get(rec, "$.field_status", "map<string,string>"), computed)


def harvest_records(targets: DataFrame, sources: DataFrame, inventory: DataFrame, cache: DataFrame) -> DataFrame:
    """Status-annotated attraction and festival rows of every target."""
    files = sources.join(inventory, "path").select("city_id", "path", "payload")
    rows = targets.join(files, "city_id").select(
        "city_id", "city_name_en", "prefecture_id", "path", F.inline(split_records(F.col("payload")))
    )
    detailed = attach_details(rows, cache)
    return detailed.withColumn("field_status", item_field_status(F.col("rec"), F.col("detail")))


def city_details(targets: DataFrame, sources: DataFrame, inventory: DataFrame) -> DataFrame:
    """One row per target: meta with defaults, counts and payload signature.

    ``sources`` holds at most one path per city.  Targets without a source keep empty counts.
    """
    files = sources.join(inventory, "path").select("city_id", "path", "payload")
    joined = targets.join(files, "city_id", "left")
    p = F.col("payload")
    entries = F.coalesce(split_records(p), F.array().cast("array<struct<kind:string,pos:int,rec:variant>>"))

    def count(kind: str, declared: str) -> Column:
        found = F.size(F.filter(entries, lambda e: e["kind"] == kind))
        return F.coalesce(F.try_variant_get(p, f"$.{declared}", "int"), found)

    return joined.select(
        "city_id",
        F.coalesce(text_at(p, "$.meta.city_name_ko"), F.col("city_name_ko")).alias("city_name_ko"),
        F.coalesce(text_at(p, "$.meta.city_name_en"), F.col("city_name_en")).alias("city_name_en"),
        "prefecture_id",
        F.col("path").alias("source_path"),
        count("attraction", "attractions_count_filtered").alias("attractions_count_filtered"),
        count("festival", "festivals_count_filtered").alias("festivals_count_filtered"),
        payload_signature(F.coalesce(p, F.parse_json(F.lit("{}")))).alias("signature"),
        safe_object_name(
            F.coalesce(F.nullif("city_name_en", F.lit("")), F.col("city_id")), "city", lower=True
        ).alias("file_name"),
    )


def skip_existing(targets: DataFrame, existing: DataFrame, key: str) -> DataFrame:
    """Targets whose output does not exist yet."""
    return targets.join(existing.select(key).distinct(), key, "left_anti")


def province_accounting(targets: DataFrame, existing: DataFrame, failures: DataFrame) -> DataFrame:
    """Per province: skipped, newly acquired and failed targets.

    ``targets`` is (province_id, title, expected_id); ``existing`` has the
    known city ids, ``failures`` the titles that could not be acquired.
    """
    known = existing.select(F.col("city_id").alias("expected_id"), F.lit(True).alias("_known")).distinct()
    bad = failures.select("province_id", "title", F.lit(True).alias("_bad")).distinct()
    rows = targets.join(known, "expected_id", "left").join(bad, ["province_id", "title"], "left")
    skipped = F.col("_known").isNotNull()
    failed = ~skipped & F.col("_bad").isNotNull()
    return rows.groupBy("province_id").agg(
        F.count_if(skipped).alias("skipped"),
        F.count_if(~skipped & ~failed).alias("newly_acquired"),
        F.count_if(failed).alias("failed"),
    )
