"""Keyed items: last-write-wins upsert, index-shaped queries, maintenance."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripweave.functions.dates import iso_month
from tripweave.functions.text import or_default

KEYS = ("PK", "SK")


def pick_per_key(rows: DataFrame, keys: Sequence[str], order: Column, last: bool = True) -> DataFrame:
    """Whole row with the greatest (or least) ``order`` of every key.

    A plain aggregate combines before the shuffle, so a key that owns a third
    of all rows sends one row per map task instead of its whole group.
    """
    # SQL text, for a call per column takes longer than the rows of a small batch.
    names = {c: "`" + c.replace("`", "``") + "`" for c in rows.columns}
    others = ", ".join(quoted for c, quoted in names.items() if c not in keys)
    choose = F.max_by if last else F.min_by
    return (
        rows.groupBy(*keys)
        .agg(choose(F.expr(f"struct({others})"), order).alias("kept"))
        .selectExpr(*[quoted if c in keys else f"kept.{quoted}" for c, quoted in names.items()])
    )


def has_key(keys: Sequence[str] = KEYS) -> Column:
    """A row can be stored when no key part is null or empty."""
    ok = F.lit(True)
    for key in keys:
        ok = ok & (F.coalesce(F.col(key), F.lit("")) != "")
    return ok


def rejected_rows(rows: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Rows that cannot be stored, with the reason."""
    return rows.where(~has_key(keys)).withColumn("error", F.lit("missing key"))


def upsert(
    existing: DataFrame, incoming: DataFrame, order: Sequence[str], keys: Sequence[str] = KEYS
) -> DataFrame:
    """Existing items overlaid with incoming ones; the last write wins.

    ``order`` names the incoming columns that put its rows in write order; they
    are stored only if the existing items have them.  Attributes missing on one
    side become null.  Existing items are unique by key, so only the incoming
    rows are aggregated and the store is merely anti-joined with their keys.
    """
    stored = [c for c in incoming.columns if c not in order or c in existing.columns]
    new = incoming.where(has_key(keys)).select(*stored, F.struct(*order).alias("_order"))
    new = pick_per_key(new, keys, F.col("_order")).drop("_order")
    kept = existing.join(new.select(*keys), list(keys), "left_anti").select(*existing.columns)
    return kept.unionByName(new, allowMissingColumns=True)


def load_summary(rows: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """One row: loaded and failed counts and the run status."""
    counts = rows.agg(
        F.count_if(has_key(keys)).alias("loaded"), F.count_if(~has_key(keys)).alias("load_failed")
    )
    return counts.withColumn("status_code", F.when(F.col("load_failed") == 0, 200).otherwise(207))


def load_failures(rows: DataFrame, limit: int = 20, keys: Sequence[str] = KEYS) -> DataFrame:
    """First failed rows of a run report."""
    return rejected_rows(rows, keys).orderBy(*keys).limit(limit)


def backfill_index_keys(items: DataFrame) -> DataFrame:
    """Index keys for rows that have no ``domain_sort_key`` yet."""
    missing = F.col("domain_sort_key").isNull()
    ident = F.coalesce(
        F.nullif("content_id", F.lit("")), F.nullif("entity_id", F.lit("")), F.lit("UNKNOWN")
    )
    generic = F.concat(F.coalesce("entity_type", F.lit("")), F.lit("#"), ident)
    # Both data models may be stored; each names the start date its own way.
    starts = [iso_month(F.col(c)) for c in ("eventstartdate", "event_start_date") if c in items.columns]
    month = F.coalesce(F.col("month").try_cast("int"), *starts, F.lit(0))
    festival = F.format_string("FESTIVAL#%02d#%s", month, F.coalesce("content_id", F.lit("")))
    province = F.coalesce(
        F.nullif("province_key", F.lit("")), F.nullif("province", F.lit("")), F.lit("UNKNOWN")
    )
    new = {
        "city_key": or_default(F.col("PK"), "UNKNOWN"),
        "province_key": province,
        "gsi_sk": F.when(F.col("entity_type") == "festival", festival).otherwise(generic),
        "domain_sort_key": generic,
    }
    return items.withColumns(
        {name: F.when(missing, col).otherwise(F.col(name)) for name, col in new.items()}
    )


# --- queries ----------------------------------------------------------------


def city_items(items: DataFrame, pk: str, prefix: str = "") -> DataFrame:
    """Items of a city in sort-key order, optionally of one key prefix."""
    out = items.where(F.col("PK") == pk)
    if prefix:
        out = out.where(F.col("SK").startswith(prefix))
    return out.orderBy("SK")


def get_item(items: DataFrame, pk: str, sk: str) -> DataFrame:
    return items.where((F.col("PK") == pk) & (F.col("SK") == sk))


def city_items_between(items: DataFrame, pk: str, low: str, high: str) -> DataFrame:
    """Items of a city whose sort key lies in a closed range."""
    return items.where((F.col("PK") == pk) & F.col("SK").between(low, high)).orderBy("SK")


def city_domain_items(items: DataFrame, city_key: str, prefix: str = "") -> DataFrame:
    """Items of a city by domain sort key."""
    out = items.where(F.col("city_key") == city_key)
    if prefix:
        out = out.where(F.col("domain_sort_key").startswith(prefix))
    return out.orderBy("domain_sort_key")


def province_items(items: DataFrame, province_key: str, prefix: str = "") -> DataFrame:
    """Items of a province by domain sort key."""
    out = items.where(F.col("province_key") == province_key)
    if prefix:
        out = out.where(F.col("domain_sort_key").startswith(prefix))
    return out.orderBy("domain_sort_key", "PK")


def entity_items(items: DataFrame, entity_type: str) -> DataFrame:
    return items.where(F.col("entity_type") == entity_type)


def festivals_in_month(
    items: DataFrame, month: int, classification_status: str | None = "succeeded"
) -> DataFrame:
    """Festivals starting in a month (0: undated).

    Only classified ones by default; ``None`` turns that filter off.
    """
    out = items.where(
        (F.col("entity_type") == "festival") & F.col("gsi_sk").startswith(f"FESTIVAL#{month:02d}")
    )
    if classification_status is not None:
        out = out.where(F.col("festival_theme_classification.status") == classification_status)
    return out.orderBy("gsi_sk")


def count_items(items: DataFrame, *keys: str) -> DataFrame:
    """Count-only form of a query."""
    return items.groupBy(*keys).agg(F.count("*").alias("item_count"))


def in_province(items: DataFrame, province_id: str | None, column: str = "province_key") -> DataFrame:
    """Items whose province equals the given one; no id keeps everything."""
    return items.where(F.col(column) == province_id) if province_id else items


def in_provinces(items: DataFrame, names: Sequence[str]) -> DataFrame:
    """Items whose province text or key mentions one of the names."""
    hit = F.lit(False)
    for name in names:
        for column in ("province", "province_key"):
            hit = hit | F.contains(F.coalesce(column, F.lit("")), F.lit(name))
    return items.where(hit)


# --- maintenance ------------------------------------------------------------


def split_by_province(items: DataFrame, keep: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(kept, removed): rows of a province outside ``keep`` are removed, rows
    without a province stay."""
    stays = F.col("province_key").isNull() | F.col("province_key").isin(*keep)
    return items.where(stays), items.where(~stays)


def removal_report(removed: DataFrame) -> DataFrame:
    return removed.groupBy("province_key").agg(F.count("*").alias("item_count")).orderBy("province_key")


MISSING = "(NO_ATTR)"


def province_profile(items: DataFrame) -> DataFrame:
    """Item counts per province, most frequent first."""
    return (
        items.groupBy(F.coalesce("province_key", F.lit(MISSING)).alias("province_key"))
        .agg(F.count("*").alias("item_count"))
        .orderBy(F.desc("item_count"), "province_key")
    )


def without_province(items: DataFrame, limit: int = 3) -> DataFrame:
    """Sample rows that carry no province."""
    columns = ("PK", "SK", "city_key", "province", "city_name_ko", "entity_type")
    return items.where(F.col("province_key").isNull()).select(*columns).orderBy("PK", "SK").limit(limit)
