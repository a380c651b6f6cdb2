"""Confidence-ranked merge of city records.

``merge_records`` overlays one incoming row per city.  ``fold_records`` takes
any number of incoming rows per city in sequence; it never gathers a city in
one task, see there.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripweave.functions.text import is_blank, is_valid_url, strip
from tripweave.operators.keyvalue import pick_per_key, upsert
from tripweave.operators.quality import overlay
from tripweave.session import saved

# Confidence order and merged fields.  The field order matters:
# source_name itself is merged, so the audit text of later fields already
# names the new source as the previous one.
CONFIDENCE = ("low", "medium", "high")
MERGED_FIELDS = (
    "city_name_ko", "city_name_ja", "city_name_en", "prefecture_id", "location", "latitude",
    "longitude", "description", "geography_description", "climate_table", "site_urls",
    "source_name", "source_url", "collected_at", "verified_at", "verified_source_url",
    "verification_note",
)
_SOURCE_AT = MERGED_FIELDS.index("source_name")
IMAGE_LIST = "array<struct<url:string,source:string>>"


def confidence_rank(level: Column) -> Column:
    """0 for low and unknown levels, 1 medium, 2 high."""
    return F.when(level == "high", 2).when(level == "medium", 1).otherwise(0)


def _empty(col: Column, data_type: T.DataType) -> Column:
    """Null or blank text; an empty list or map is a value."""
    return is_blank(col) if isinstance(data_type, T.StringType) else col.isNull()


def _differs(a: Column, b: Column, data_type: T.DataType) -> Column:
    if isinstance(data_type, T.MapType):
        a, b = (F.array_sort(F.map_entries(c)) for c in (a, b))
    return ~a.eqNullSafe(b)


def _or_unknown(source: Column) -> Column:
    return F.coalesce(F.nullif(source, F.lit("")), F.lit("unknown"))


def _updated(source: Column) -> Column:
    return F.concat(F.lit("updated: source="), _or_unknown(source))


def _merged(previous: Column, new: Column, verb: str = "merged") -> Column:
    return F.concat(
        F.lit(f"{verb}: prev_source="), _or_unknown(previous), F.lit(", new_source="), _or_unknown(new)
    )


def union_images(old: Column, new: Column) -> Column:
    """``old`` followed by the entries of ``new`` with a url not seen before."""
    none = F.array().cast(IMAGE_LIST)
    old, new = F.coalesce(old, none), F.coalesce(new, none)
    urls = F.transform(new, lambda e: e["url"])
    fresh = F.filter(
        new,
        lambda e, i: ~F.exists(old, lambda o: o["url"] == e["url"])
        & (F.array_position(urls, e["url"]) == i + 1),
    )
    return F.concat(old, fresh)


def _one_image(url: Column, source: Column) -> Column:
    return F.array(F.struct(url.alias("url"), source.alias("source"))).cast(IMAGE_LIST)


def _drop_nulls(entries: list[Column]) -> Column:
    present = F.filter(F.array(*entries), lambda e: e["value"].isNotNull())
    return F.map_from_entries(present)


def merge_records(base: DataFrame, incoming: DataFrame, force_image_update: bool = False) -> DataFrame:
    """Base records overlaid with at most one incoming row per city.

    Fields change only when the incoming confidence is not lower and the new
    value is not empty; every change leaves an audit text in field_status.
    Images merge regardless of confidence.
    """
    types = {f.name: f.dataType for f in base.schema.fields}
    columns = base.columns
    old = base.select("city_id", F.struct(*columns).alias("old"))
    new = incoming.where(F.coalesce("city_id", F.lit("")) != "").select(
        "city_id", F.struct(*columns).alias("new")
    )
    both = old.join(new, "city_id", "full_outer")
    o, n = F.col("old"), F.col("new")
    old_rank, new_rank = confidence_rank(o["data_confidence"]), confidence_rank(n["data_confidence"])
    applies = new_rank >= old_rank
    values, audit = {}, []
    source_now = F.when(
        applies & ~_empty(n["source_name"], T.StringType()), n["source_name"]
    ).otherwise(o["source_name"])
    for at, name in enumerate(MERGED_FIELDS):
        filled = applies & ~_empty(n[name], types[name])
        was_empty = _empty(o[name], types[name])
        changed = filled & (was_empty | _differs(n[name], o[name], types[name]))
        previous = source_now if at > _SOURCE_AT else o["source_name"]
        text = F.when(was_empty, _updated(n["source_name"])).otherwise(_merged(previous, n["source_name"]))
        values[name] = F.when(filled, n[name]).otherwise(o[name])
        audit.append(F.struct(F.lit(name).alias("key"), F.when(changed, text).alias("value")))

    has_image = F.coalesce(n["image_url"], F.lit("")) != ""
    first_image = has_image & o["image_url"].isNull()
    other_image = has_image & o["image_url"].isNotNull() & (n["image_url"] != o["image_url"])
    forced = other_image if force_image_update else F.lit(False)
    image_text = F.when(first_image, _updated(n["source_name"])).when(
        forced, _merged(source_now, n["source_name"], "force_replaced")
    )
    audit.append(F.struct(F.lit("image_url").alias("key"), image_text.alias("value")))
    values["image_url"] = F.when(first_image | forced, n["image_url"]).otherwise(o["image_url"])
    appended = F.when(
        other_image & ~forced, _one_image(n["image_url"], _or_unknown(n["source_name"]))
    ).otherwise(F.array().cast(IMAGE_LIST))
    values["image_urls"] = union_images(union_images(o["image_urls"], appended), n["image_urls"])
    values["data_confidence"] = F.when(new_rank > old_rank, n["data_confidence"]).otherwise(o["data_confidence"])
    empty = F.create_map().cast("map<string,string>")
    values["field_status"] = overlay(F.coalesce(o["field_status"], empty), _drop_nulls(audit))
    return both.select(
        *[
            F.when(o.isNull(), n[c]).when(n.isNull(), o[c]).otherwise(values.get(c, o[c])).alias(c)
            for c in columns
        ]
    )


# --- ordered fold -----------------------------------------------------------

_INITIAL = -1
_FOLDED = {"city_id", *MERGED_FIELDS, "image_url", "image_urls", "data_confidence", "field_status"}


def _prefix(rows: DataFrame, chunk_rows: int) -> DataFrame:
    """Adds the chunk number; a chunk holds at most ``chunk_rows`` sequence
    numbers, so no task ever sees more rows of one city than that."""
    return rows.withColumn("chunk", F.floor(F.col("seq") / chunk_rows))


def _staged(base: DataFrame, incoming: DataFrame, seq: str, columns: list[str]) -> DataFrame:
    """Base rows, numbered before all others, and the incoming rows of a city; written once, since every step of a fold reads them."""
    rows = base.select(*columns, F.lit(_INITIAL).cast("long").alias("seq")).unionByName(
        incoming.where(F.coalesce("city_id", F.lit("")) != "").select(*columns, F.col(seq).cast("long").alias("seq"))
    )
    return saved(rows, "fold-rows")


def _with_carry(rows: DataFrame, carry: DataFrame) -> DataFrame:
    """Rows and one row per chunk, before all others of its chunk, that holds the state of the chunks before.

    Windows over a chunk then see that state without a join.
    """
    marked = rows.withColumn("is_carry", F.lit(False))
    return marked.unionByName(carry.withColumn("is_carry", F.lit(True)), allowMissingColumns=True)


def fold_records(
    base: DataFrame,
    incoming: DataFrame,
    seq: str = "seq",
    chunk_rows: int = 100_000,
    force_image_update: bool = False,
) -> DataFrame:
    """All incoming rows applied to the base in ``seq`` order.

    ``seq`` is a unique, non-negative number in arrival order.  The result
    equals applying the rows one after another, but is computed as a two-level
    prefix scan: windows run inside chunks of a city, one summary row per chunk
    carries the state (highest rank, last value of every field) to the next and
    is the first row that the next chunk's windows see, and the final values are
    plain aggregates.  A city with a third of all
    rows is therefore spread over many tasks.  Columns that are never merged
    keep their first value.  Image lists are folded by ``fold_images``.
    """
    kept = [c for c in base.columns if c not in _FOLDED]
    columns = ["city_id", *MERGED_FIELDS, "image_url", "data_confidence", "field_status", *kept]
    return _fold_fields(_staged(base, incoming, seq, columns), kept, chunk_rows, force_image_update)


def _fold_fields(staged: DataFrame, kept: list[str], chunk_rows: int, force_image_update: bool) -> DataFrame:
    types = {f.name: f.dataType for f in staged.schema.fields}
    rows = _prefix(staged, chunk_rows).withColumn("rank", confidence_rank(F.col("data_confidence")))
    chunk = Window.partitionBy("city_id", "chunk").orderBy("seq")
    before = chunk.rowsBetween(Window.unboundedPreceding, -1)
    city = Window.partitionBy("city_id")
    chunks = city.orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)

    # Level 1: highest rank of all earlier chunks, then of earlier rows.
    # Without a base row the first incoming row is the initial state.
    carry = rows.groupBy("city_id", "chunk").agg(F.max("rank").alias("r"), F.min("seq").alias("s"))
    carry = carry.select("city_id", "chunk", F.max("r").over(chunks).alias("rank"), F.min("s").over(city).alias("start"))
    rows = _with_carry(rows, carry).withColumns({"earlier": F.max("rank").over(before), "start": F.max("start").over(before)})
    rows = rows.where("NOT is_carry").withColumn("initial", F.col("seq") == F.col("start"))
    rows = rows.withColumn("applies", F.col("initial") | (F.col("rank") >= F.col("earlier")))

    # Level 2: last value of every field before each row.  A struct keeps a
    # stored value apart from "no value yet".
    def stored(name: str) -> Column:
        value = F.struct(F.col(name).alias("v"))
        return F.when(F.col("applies") & ~_empty(F.col(name), types[name]), value)

    first = F.struct(*[F.col(n) for n in (*MERGED_FIELDS, "field_status", *kept)])
    has_image = F.col("image_url").isNotNull() & (F.col("initial") | (F.col("image_url") != ""))
    rows = rows.select(
        "city_id", "chunk", "seq", "initial", "rank", "data_confidence",
        F.when(F.col("initial"), first).alias("first"),
        F.col("source_name").alias("source_in"),
        *[stored(n).alias(n) for n in MERGED_FIELDS],
        # The initial source counts even when it is blank.
        F.when(F.col("initial"), F.struct(F.col("source_name").alias("v")))
        .otherwise(stored("source_name")).alias("source"),
        # An image counts whatever the confidence.
        F.when(has_image, F.struct(F.col("image_url").alias("v"))).alias("image"),
    )
    rows = saved(rows, "fold-applied")
    tracked = [*MERGED_FIELDS, "source", "image"]
    carry = rows.groupBy("city_id", "chunk").agg(
        *[F.max_by(F.col(n), F.when(F.col(n).isNotNull(), F.col("seq"))).alias(n) for n in tracked]
    )
    carry = carry.select(
        "city_id", "chunk",
        *[F.last(n, ignorenulls=True).over(chunks).alias(n) for n in tracked],
    )
    rows = _with_carry(rows, carry)
    rows = rows.select("*", *[F.last(n, ignorenulls=True).over(before).alias(f"prev_{n}") for n in tracked]).where("NOT is_carry")

    # Change events and final values.
    source_in = F.col("source_in")
    source_before = F.col("prev_source.v")
    source_after = F.coalesce(F.col("source.v"), source_before)
    events, finals = [], []
    for at, name in enumerate(MERGED_FIELDS):
        new, old = F.col(name), F.col(f"prev_{name}")
        previous = source_after if at > _SOURCE_AT else source_before
        text = F.when(old.isNull(), _updated(source_in)).when(
            _differs(new["v"], old["v"], types[name]), _merged(previous, source_in)
        )
        events.append(F.when(new.isNotNull() & ~F.col("initial"), text).alias(f"event_{name}"))
        finals.append(F.max_by(new, F.when(new.isNotNull(), F.col("seq"))).alias(f"last_{name}"))
    replaced = F.when(F.col("image.v") != F.col("prev_image.v"), _merged(source_after, source_in, "force_replaced"))
    image_text = F.when(F.col("prev_image").isNull(), _updated(source_in)).when(F.lit(force_image_update), replaced)
    events.append(F.when(F.col("image").isNotNull() & ~F.col("initial"), image_text).alias("event_image_url"))
    audited = [*MERGED_FIELDS, "image_url"]
    choose = F.max_by if force_image_update else F.min_by
    folded = (
        rows.select("*", *events)
        .groupBy("city_id")
        .agg(
            *finals,
            *[
                F.max_by(f"event_{n}", F.when(F.col(f"event_{n}").isNotNull(), F.col("seq"))).alias(f"event_{n}")
                for n in audited
            ],
            choose(F.col("image.v"), F.when(F.col("image").isNotNull(), F.col("seq"))).alias("image_url"),
            F.min_by("first", F.col("seq")).alias("first"),
            # The earliest row of the highest rank names the confidence.
            F.max_by("data_confidence", F.struct("rank", -F.col("seq"))).alias("data_confidence"),
        )
    )
    audit = _drop_nulls([F.struct(F.lit(n).alias("key"), F.col(f"event_{n}").alias("value")) for n in audited])
    empty = F.create_map().cast("map<string,string>")
    return folded.select(
        "city_id",
        *[
            F.when(F.col(f"last_{n}").isNotNull(), F.col(f"last_{n}.v")).otherwise(F.col(f"first.{n}")).alias(n)
            for n in MERGED_FIELDS
        ],
        "image_url",
        "data_confidence",
        overlay(F.coalesce("first.field_status", empty), audit).alias("field_status"),
        *[F.col(f"first.{c}").alias(c) for c in kept],
    )


def merge_all(
    base: DataFrame,
    incoming: DataFrame,
    seq: str = "seq",
    force_image_update: bool = False,
    chunk_rows: int = 100_000,
) -> DataFrame:
    """Base records after all incoming rows in ``seq`` order, one row per city, in the columns of ``base``."""
    kept = [c for c in base.columns if c not in _FOLDED]
    columns = ["city_id", *MERGED_FIELDS, "image_url", "image_urls", "data_confidence", "field_status", *kept]
    staged = _staged(base, incoming, seq, columns)
    fields = _fold_fields(staged, kept, chunk_rows, force_image_update)
    _, images = _fold_images(staged, force_image_update)
    # The list is a column of the record, so the distinct urls of a city meet here.
    entry = F.struct("seq", "idx", F.struct("url", "source").alias("image"))
    lists = images.groupBy("city_id").agg(F.sort_array(F.collect_list(entry)).alias("entries"))
    listed = F.transform("entries", lambda e: e["image"]).cast(IMAGE_LIST)
    merged = fields.join(lists, "city_id", "left")
    none = F.array().cast(IMAGE_LIST)
    return merged.withColumn("image_urls", F.coalesce(listed, none)).select(*base.columns)


def fold_images(
    base: DataFrame, incoming: DataFrame, seq: str = "seq", force_image_update: bool = False
) -> tuple[DataFrame, DataFrame]:
    """(primary, images) after applying all incoming rows in order.

    A forced update makes the last image the primary one and lists no primary
    image; else the first one stays and later ones are listed.

    ``primary`` is (city_id, image_url); ``images`` has one row per distinct
    url of a city with its sort position (seq, idx), the long form of the
    image list.  Both are plain aggregates.
    """
    return _fold_images(_staged(base, incoming, seq, ["city_id", "image_url", "image_urls", "source_name"]), force_image_update)


def _fold_images(rows: DataFrame, force_image_update: bool) -> tuple[DataFrame, DataFrame]:
    # The initial row counts even with an empty text; later ones need a url.
    usable = F.col("image_url").isNotNull() & ((F.col("seq") == _INITIAL) | (F.col("image_url") != ""))
    first_rows = rows.groupBy("city_id").agg(
        (F.max_by if force_image_update else F.min_by)("image_url", F.when(usable, F.col("seq"))).alias("primary_url")
    )
    primary = first_rows.select("city_id", F.col("primary_url").alias("image_url"))
    head = _one_image(F.col("image_url"), _or_unknown(F.col("source_name")))
    listed = F.coalesce("image_urls", F.array().cast(IMAGE_LIST))
    exploded = rows.select(
        "city_id", "seq", "image_url",
        F.posexplode(F.concat(head, listed)).alias("idx", "image"),
    ).where(F.col("image.url").isNotNull() & ~((F.col("idx") == 0) & (F.col("image.url") == "")))
    # Combine before looking at the primary image: one row per url and kind.
    offers = exploded.groupBy("city_id", F.col("image.url").alias("url"), (F.col("idx") == 0).alias("is_head")).agg(
        F.min(F.struct("seq", "idx", F.col("image.source").alias("source"))).alias("at")
    )
    # A row's own image joins the list only when it is not the primary one.
    own = F.lit(False) if force_image_update else F.col("url") != F.col("primary_url")
    kept = offers.join(first_rows, "city_id").where(~F.col("is_head") | own)
    images = kept.groupBy("city_id", "url").agg(F.min("at").alias("at"))
    return primary, images.select("city_id", "url", "at.seq", "at.idx", "at.source")


# --- single image offers ----------------------------------------------------


def tour_image(first_image: Column) -> Column:
    """Valid image URL of a tour record, else null."""
    return F.when(is_valid_url(first_image), strip(first_image))


def apply_image(records: DataFrame, url: str, source: str) -> DataFrame:
    """Applies one offered image per record (columns ``url`` and ``source``).

    An encyclopedia image always becomes the primary one, any other image only
    when there is none; the list never repeats a url; an invalid url changes
    nothing.
    """
    offered, origin = F.col(url), F.col(source)
    valid = is_valid_url(offered)
    primary = F.when(valid & ((origin == "wikipedia") | F.col("image_url").isNull()), offered).otherwise(
        F.col("image_url")
    )
    listed = F.when(valid, union_images(F.col("image_urls"), _one_image(offered, origin))).otherwise(
        F.col("image_urls")
    )
    return records.withColumns({"image_url": primary, "image_urls": listed}).drop(url, source)


# --- whole-row replacement --------------------------------------------------


def replace_records(existing: DataFrame, incoming: DataFrame, order: str, key: str = "city_id") -> DataFrame:
    """Incoming rows replace existing ones as a whole; the last one wins."""
    return upsert(existing, incoming, [order], [key])


def first_city_by_name(cities: DataFrame, order: str, name: str = "city_name_ko") -> DataFrame:
    """One city per name: the first in ``order``."""
    return pick_per_key(cities, [name], F.col(order), last=False)


def match_details(details: DataFrame, cities: DataFrame, order: str) -> DataFrame:
    """Detail files with the first city of the same Korean name."""
    first = first_city_by_name(cities.select("city_name_ko", "city_id", "prefecture_id", order), order)
    return details.join(first.drop(order), "city_name_ko", "left")


def count_known(details: DataFrame, cities: DataFrame) -> DataFrame:
    """One row: how many detail results belong to a known city."""
    known = details.join(cities.select("city_id").distinct(), "city_id", "left_semi")
    return known.agg(F.count("*").alias("records_processed"))
