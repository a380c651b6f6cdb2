"""Crowding and novelty scores of cities from monthly visitors.

Scores are shares: the part of a reference group that is smaller, plus half of
what is equal.  The groups are cities' months of one region and season (crowding)
and the cities of the country by their mean month (novelty).  Quantile sketches,
merged like sums, give each score within ``1 / accuracy``; for the cities asked
for, a second pass counts exactly.  A month without a row is unknown: it is no
zero, takes no part, and a city with fewer than ``least_months`` has no score.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripweave.session import saved

ACCURACY = 1000  # the rank of a sketched quantile is right within 1 / ACCURACY
STEPS = 100


def with_season(monthly: DataFrame) -> DataFrame:
    """Adds ``season`` to rows with a ``month`` as yyyymm; null for any other text."""
    month = F.expr("try_cast(substr(month, 5, 2) AS int)")
    season = (
        F.when(~F.col("month").rlike("^[0-9]{6}$"), None)
        .when(month.between(3, 5), "spring").when(month.between(6, 8), "summer").when(month.between(9, 11), "autumn")
        .when(month.isin(12, 1, 2), "winter")
    )
    return monthly.withColumn("season", season)


def _sketches(rows: DataFrame, keys: list[str], value: str, accuracy: int) -> DataFrame:
    shares = F.array(*(F.lit(i / STEPS) for i in range(STEPS + 1)))
    return rows.groupBy(*keys).agg(F.percentile_approx(value, shares, accuracy).alias("quantiles"), F.count("*").alias("size"))


def _sketched_share(value: Column, quantiles: Column) -> Column:
    """Share of the values that are smaller, and half of those that are equal, as the quantiles tell."""
    steps = F.array(*(F.lit(2**i) for i in reversed(range(STEPS.bit_length()))))

    def leading(fits) -> Column:
        """How many of the rising quantiles fit, by halving."""
        return F.aggregate(steps, F.lit(0), lambda at, step: F.when(fits(F.get(quantiles, at + step - 1)), at + step).otherwise(at))

    below, upto = leading(lambda q: q < value), leading(lambda q: q <= value)
    return F.least(F.greatest((below + upto - 1) / (2 * STEPS), F.lit(0.0)), F.lit(1.0))


def exact_shares(rows: DataFrame, asked: DataFrame, keys: list[str], value: str) -> DataFrame:
    """keys, value, share for every distinct value of ``asked``.

    The distinct values of ``rows`` are counted and dealt by range over the tasks,
    a large group over several.  A running total inside a range, on top of what
    the group's earlier ranges hold, gives what is smaller; no group is held whole.
    """
    counts = rows.dropna(subset=[*keys, value]).groupBy(*keys, value).agg(F.count("*").alias("_n"))
    ranged = saved(counts.repartitionByRange(*keys, value).withColumn("_range", F.spark_partition_id()), "crowding-ranges")
    group, earlier = Window.partitionBy(*keys), (Window.unboundedPreceding, -1)
    ranges = ranged.groupBy(*keys, "_range").agg(F.sum("_n").alias("_held")).select(
        *keys, "_range", F.sum("_held").over(group).alias("_size"), F.sum("_held").over(group.orderBy("_range").rowsBetween(*earlier)).alias("_before")
    )
    within = Window.partitionBy(*keys, "_range").orderBy(value).rowsBetween(*earlier)
    told = ranged.withColumn("_less", F.sum("_n").over(within)).join(ranges, [*keys, "_range"])
    less = F.coalesce("_before", F.lit(0)) + F.coalesce("_less", F.lit(0))
    shares = told.select(*keys, value, ((less + F.col("_n") / 2) / F.col("_size")).alias("share"))
    return shares.join(asked.select(*keys, value).distinct(), [*keys, value], "left_semi")


def crowding_scores(
    monthly: DataFrame, least_months: int = 6, tested: DataFrame | None = None, accuracy: int = ACCURACY
) -> DataFrame:
    """city, region, months, crowding_score, novelty_score, peak_season, exact of every city of a region.

    ``monthly`` is (city, region, month, visitors), one row per city and month
    (yyyymm).  ``crowding_score`` is the mean over a city's months of their share
    in their region and season; ``novelty_score`` is 1 minus the share of the
    city's mean month among all cities; ``peak_season`` has the highest mean share
    (ties: first by name).  Scores have four places.  Cities in ``tested``
    (city) are counted exactly, the others are within 1 / STEPS + 1 / accuracy.
    Rows without city, region, visitors or a readable month take no part.
    """
    known = with_season(monthly).where("city IS NOT NULL AND region IS NOT NULL AND visitors IS NOT NULL AND season IS NOT NULL")
    rows = saved(known.select("city", "region", "season", F.col("visitors").cast("double").alias("visitors")), "crowding-months")
    cities = rows.groupBy("city", "region").agg(F.avg("visitors").alias("mean"), F.count("*").alias("months"))
    cities = saved(cities.where(F.col("months") >= least_months), "crowding-cities")
    if tested is None:
        return _sketched_scores(rows, cities, cities, accuracy)
    names = saved(tested.select("city").distinct(), "crowding-tested")
    made = _sketched_scores(rows, cities, cities.join(names, "city", "left_anti"), accuracy)
    asked_cities = cities.join(names, "city", "left_semi")
    asked = rows.join(asked_cities.select("city", "region"), ["city", "region"], "left_semi")
    months = asked.join(exact_shares(rows, asked, ["region", "season"], "visitors"), ["region", "season", "visitors"])
    ranks = exact_shares(cities.withColumn("all", F.lit(1)), asked_cities.withColumn("all", F.lit(1)), ["all"], "mean")
    means = asked_cities.join(ranks.select("mean", F.col("share").alias("rank")), "mean")
    exact = _scores(months.select("city", "region", "season", "visitors", "share"), means).withColumn("exact", F.lit(True))
    return made.select(exact.columns).union(exact)


def _sketched_scores(rows: DataFrame, cities: DataFrame, told: DataFrame, accuracy: int) -> DataFrame:
    """Scores of the ``told`` cities, by sketches of all ``rows`` and ``cities``."""
    by_group = _sketches(rows, ["region", "season"], "visitors", accuracy)
    overall = _sketches(cities.withColumn("all", F.lit(1)), ["all"], "mean", accuracy)
    share = _sketched_share(F.col("visitors"), F.col("quantiles"))
    scored = rows.join(told.select("city", "region"), ["city", "region"], "left_semi")
    months = scored.join(by_group, ["region", "season"]).select("city", "region", "season", "visitors", share.alias("share"))
    means = told.withColumn("all", F.lit(1)).join(overall, "all").select(
        "city", "region", "months", "mean", _sketched_share(F.col("mean"), F.col("quantiles")).alias("rank")
    )
    return _scores(months, means).withColumn("exact", F.lit(False))


def _scores(months: DataFrame, means: DataFrame) -> DataFrame:
    """Means of shares per city; shares are added as millionths, so that order cannot change a digit."""
    units = F.round(F.col("share") * 1_000_000).cast("long")
    seasons = months.groupBy("city", "region", "season").agg(F.sum(units).alias("units"), F.count("*").alias("n"))
    mean = F.round(F.col("units") / F.col("n")).cast("long")
    cities = seasons.groupBy("city", "region").agg(
        F.sum("units").alias("units"), F.sum("n").alias("n"), F.min_by("season", F.struct((-mean).alias("less"), "season")).alias("peak_season")
    )
    return means.join(cities, ["city", "region"]).select(
        "city", "region", F.col("months").cast("long").alias("months"), F.round(F.col("units") / F.col("n") / 1_000_000, 4).alias("crowding_score"),
        F.round(1 - F.col("rank"), 4).alias("novelty_score"), "peak_season",
    )
