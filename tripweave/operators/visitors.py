"""Daily visitor counts to monthly and annual statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripweave.functions.dates import month_grid
from tripweave.functions.numbers import round_cents
from tripweave.operators.keyvalue import pick_per_key

# Segment codes of the daily feed.
SEGMENTS = ((1, "locals"), (2, "out_of_town"), (3, "foreigners"))
# Sums run over exact decimals, so neither task order nor a retry can change
# the last digit of a total.
EXACT = "decimal(28,10)"


def daily_by_city(daily: DataFrame, districts: DataFrame) -> DataFrame:
    """Daily rows of mapped districts with the English city name.

    ``daily`` has signgu_code, date, tou_div_cd, tou_num; districts without an
    entry are dropped.  The mapping is one row per code; Spark broadcasts it
    when its measured size allows.
    """
    names = districts.select(F.col("code").alias("signgu_code"), "city_name_en", "province_id")
    return daily.withColumn("signgu_code", F.trim("signgu_code")).join(names, "signgu_code")


def complete_cities(monthly: DataFrame) -> DataFrame:
    """Cities whose statistics already cover twelve months."""
    return monthly.groupBy("city_name_en").agg(F.count("*").alias("n")).where("n >= 12").select("city_name_en")


def skip_complete(daily: DataFrame, existing_monthly: DataFrame) -> DataFrame:
    """Daily rows of cities that still have to be collected."""
    return daily.join(complete_cities(existing_monthly), "city_name_en", "left_anti")


def _segment_sums() -> list[Column]:
    value = F.col("tou_num").cast(EXACT)
    return [
        F.coalesce(F.sum(F.when(F.col("tou_div_cd") == code, value)), F.lit(0).cast(EXACT)).alias(name)
        for code, name in SEGMENTS
    ]


def _with_measures(rows: DataFrame, *keys: str) -> DataFrame:
    """Rounded totals and daily averages of the three exact segment sums."""
    names = [name for _, name in SEGMENTS]
    sums = {**{n: n for n in names}, "total": " + ".join(names)}
    raw = [f"cast({e} AS double) AS {n}" for n, e in sums.items()]
    raw += [f"cast({e} AS double) / days AS {n}_avg" for n, e in sums.items()]
    # Two steps, so that the rounding rule reads plain columns.
    unrounded = rows.selectExpr(*keys, "days", *raw)
    rounded = [
        round_cents(c).alias(alias)
        for n in names
        for c, alias in ((n, f"{n}_total"), (f"{n}_avg", f"{n}_daily_avg"))
    ]
    return unrounded.select(
        *keys, "days", *rounded,
        round_cents("total").alias("total_visitors"), round_cents("total_avg").alias("total_daily_avg"),
    )


def monthly_sums(daily: DataFrame) -> DataFrame:
    """Exact segment sums per city, year and month; other codes are ignored."""
    return (
        daily.where(F.col("tou_div_cd").isin(*[c for c, _ in SEGMENTS]))
        .groupBy("city_name_en", F.year("date").alias("year"), F.month("date").alias("month_no"))
        .agg(*_segment_sums())
    )


def monthly_statistics(daily: DataFrame) -> DataFrame:
    """Statistics of the months that have data."""
    dated = monthly_sums(daily).selectExpr(
        "*",
        "format_string('%04d-%02d', year, month_no) AS month",
        "day(last_day(make_date(year, month_no, 1))) AS days",
    )
    return _with_measures(dated, "city_name_en", "year", "month")


def dense_statistics(daily: DataFrame) -> DataFrame:
    """Twelve months per city and year; months without data are zero.

    The at most twelve monthly sums of a city year are kept as a map and read
    back over the calendar grid, so no grid has to be joined.  A city whose
    rows all carry other segment codes still gets its twelve zero rows.
    """
    monthly = daily.groupBy(
        "city_name_en", F.year("date").alias("year"), F.month("date").alias("month_no")
    ).agg(*_segment_sums())
    names = [name for _, name in SEGMENTS]
    yearly = monthly.groupBy("city_name_en", "year").agg(
        F.map_from_entries(F.collect_list(F.struct("month_no", F.struct(*names)))).alias("by_month")
    )
    grid = yearly.select("city_name_en", "year", "by_month", F.inline(month_grid("year")))
    filled = grid.selectExpr(
        "city_name_en", "year", "month", "days",
        *[f"coalesce(try_element_at(by_month, month_no).{n}, cast(0 AS {EXACT})) AS {n}" for n in names],
    )
    return _with_measures(filled, "city_name_en", "year", "month")


_ANNUAL = ("locals", "out_of_town", "foreigners", "total_visitors")


def annual_statistics(monthly: DataFrame, *more: Column) -> DataFrame:
    """Annual totals and daily averages from (rounded) monthly rows.

    With dense months the averages cover the whole year, otherwise the days of
    the months present.  ``more`` aggregates are carried along.
    """
    sums = monthly.groupBy("city_name_en", "year").agg(
        F.sum("days").cast("int").alias("days"),
        *[F.expr(f"cast(sum(cast({_total(n)} AS {EXACT})) AS double)").alias(n) for n in _ANNUAL],
        *more,
    )
    carried = sums.columns[3 + len(_ANNUAL) :]
    averaged = sums.selectExpr("*", *[f"{n} / days AS {n}_avg" for n in _ANNUAL])
    return averaged.select(
        "city_name_en", "year", "days",
        *[round_cents(n).alias(_total(n)) for n in _ANNUAL],
        *[round_cents(f"{n}_avg").alias(f"{n}_daily_avg") for n in _ANNUAL],
        *carried,
    )


def _total(name: str) -> str:
    return name if name == "total_visitors" else f"{name}_total"


def statistics_envelope(monthly: DataFrame) -> DataFrame:
    """One nested row per city and year: two maps and the monthly list."""
    measures = [c for c in monthly.columns if c not in ("city_name_en", "year")]
    months = F.array_sort(F.collect_list(F.struct(*measures))).alias("monthly_statistics")
    annual = annual_statistics(monthly, months)

    def as_map(columns: list[str]) -> Column:
        return F.create_map(*[x for n, c in zip(_ANNUAL, columns) for x in (F.lit(n), F.col(c))])

    return annual.select(
        "city_name_en", "year",
        as_map([_total(n) for n in _ANNUAL]).alias("annual_totals"),
        as_map([f"{n}_daily_avg" for n in _ANNUAL]).alias("annual_daily_averages"),
        "monthly_statistics",
    )


def replace_statistics(existing: DataFrame, new: DataFrame) -> DataFrame:
    """Statistics of re-collected cities replace the old ones."""
    collected = new.select("city_name_en").distinct()
    return existing.join(collected, "city_name_en", "left_anti").unionByName(new)


def last_city_per_name(cities: DataFrame, order: str) -> DataFrame:
    """City metadata keyed by English name; unnamed rows drop, the last wins."""
    named = cities.where(F.coalesce("city_name_en", F.lit("")) != "")
    return pick_per_key(named, ["city_name_en"], F.col(order)).drop(order)


# Notes on the missing half of a merged city.
NO_METADATA = "Wikipedia metadata not yet collected for this municipality."
NO_STATISTICS = "Visitor statistics not yet collected for this municipality."


def final_cities(cities: DataFrame, statistics: DataFrame) -> DataFrame:
    """City metadata and visitor statistics side by side.

    Both inputs hold one row per city_name_en.  A missing side is null and
    marked incomplete.
    """
    meta = cities.select("city_name_en", F.struct(*cities.columns).alias("meta"))
    stats = statistics.select(
        "city_name_en",
        F.struct(*[c for c in statistics.columns if c != "city_name_en"]).alias("visitor_statistics"),
    )
    joined = meta.join(stats, "city_name_en", "full_outer")
    no_meta, no_stats = F.col("meta").isNull(), F.col("visitor_statistics").isNull()
    return joined.select(
        "city_name_en",
        "meta",
        F.when(no_meta, F.lit("incomplete")).alias("meta_status"),
        F.when(no_meta, F.lit(NO_METADATA)).alias("meta_note"),
        "visitor_statistics",
        F.when(no_stats, F.lit("incomplete")).alias("statistics_status"),
        F.when(no_stats, F.lit(NO_STATISTICS)).alias("statistics_note"),
        F.when(no_meta, F.lit("visitor_only"))
        .when(no_stats, F.lit("wikipedia_only"))
        .otherwise(F.lit("merged"))
        .alias("outcome"),
    )


def merge_outcomes(final: DataFrame) -> DataFrame:
    """One row: merged, one-sided and total counts."""
    return final.agg(
        *[
            F.count_if(F.col("outcome") == o).alias(f"{o}_count")
            for o in ("merged", "wikipedia_only", "visitor_only")
        ],
        F.count("*").alias("total"),
    )
