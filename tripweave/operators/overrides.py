"""Contact overrides: values that hold for a time and take precedence over stored ones."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripweave.session import saved

CONTACTS = ("tel", "homepage", "email")


def apply_overrides(items: DataFrame, overrides: DataFrame, fields: Sequence[str] = CONTACTS, key: str = "content_id", as_of: str = "as_of") -> DataFrame:
    """Items with overridden fields and ``override_audit``, a list of texts in the order of ``fields``.

    ``overrides`` is (key, field, value, valid_from, valid_to, precedence,
    source); both days belong to the interval, a null is an open end.  The
    override that holds on an item's ``as_of`` day with the highest precedence
    wins, of equal ones the one that began last, then the smallest source, then
    the smallest value.  A null value removes the field.  Items without key or day,
    and overrides of other fields or that end before they begin, change nothing.

    Both sides meet by key and month: an interval is laid out over its months as
    far as items have days, so a key with a long history does not pair all its
    overrides with all its items.
    """
    columns = items.columns
    numbered = saved(items.select(F.struct(*(F.col(f"`{c}`") for c in columns)).alias("item"), F.monotonically_increasing_id().alias("number")), "override-items")
    days = numbered.select("number", F.col(f"item.`{key}`").alias("key"), F.col(f"item.`{as_of}`").cast("date").alias("day")).dropna()
    month = lambda d: F.year(d) * 12 + F.month(d)
    span = days.agg(F.min(month("day")).alias("low"), F.max(month("day")).alias("high"))
    held = overrides.where(F.col("field").isin(*fields)).select(
        F.col(key).alias("key"), "field", "value", F.col("valid_from").cast("date").alias("since"), F.col("valid_to").cast("date").alias("till"),
        "precedence", "source",
    )
    held = held.where("key IS NOT NULL AND (since IS NULL OR till IS NULL OR since <= till)")
    low = F.greatest(F.coalesce(month("since"), F.lit(0)), span.select("low").scalar())
    high = F.least(F.coalesce(month("till"), F.lit(1 << 30)), span.select("high").scalar())
    laid = held.withColumns({"_low": low, "_high": high}).where("_low <= _high").withColumn("month", F.explode(F.sequence("_low", "_high")))
    met = days.withColumn("month", month("day")).join(laid.drop("_low", "_high"), ["key", "month"])
    valid = met.where("(since IS NULL OR since <= day) AND (till IS NULL OR day <= till)")
    began = F.coalesce(F.datediff("since", F.lit("1970-01-01")), F.lit(-(1 << 30)))
    rank = F.struct((-F.coalesce("precedence", F.lit(-(1 << 30)))).alias("p"), (-began).alias("s"), F.coalesce("source", F.lit("")).alias("o"), "value")
    best = valid.groupBy("number", "field").agg(F.min_by(F.struct("value", "since", "till", "precedence", "source"), rank).alias("o"))
    won = best.groupBy("number").agg(F.map_from_entries(F.collect_list(F.struct("field", "o"))).alias("won"))  # one per field at most
    joined = numbered.join(won, "number", "left")
    text = lambda c: F.coalesce(c.cast("string"), F.lit("-"))
    made, audits = {}, []
    for name in fields:
        own, found = F.col(f"item.`{name}`"), F.element_at("won", F.lit(name))
        made[name] = F.when(found.isNotNull(), found["value"]).otherwise(own)
        audits.append(
            F.when(
                found.isNotNull() & ~found["value"].eqNullSafe(own),
                F.concat(
                    F.lit(f"{name}: "), text(own), F.lit(" -> "), text(found["value"]), F.lit(" ("), text(found["source"]), F.lit(", precedence "),
                    text(found["precedence"]), F.lit(", "), text(found["since"]), F.lit(" to "), text(found["till"]), F.lit(")"),
                ),
            )
        )
    kept = [made[c].alias(c) if c in made else F.col(f"item.`{c}`").alias(c) for c in columns if c != "override_audit"]
    return joined.select(*kept, F.array_compact(F.array(*audits)).alias("override_audit"))
