"""Cities judged by their attractions: scores with a breakdown, theme profiles and their similarity."""

from __future__ import annotations

from collections.abc import Iterator, Mapping

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripweave.session import saved

FLUSH = 200_000  # rows that a task holds before it hands them on
LISTED = 1024  # cities of a theme that travel in one list
SHORT = 32_000  # a weight of 1 as a short
DEALT = 8  # tasks of the pairs for each core
FANS = 256  # groups of tasks whose lists are merged first


def bounded_top_n(rows: DataFrame, n: int) -> DataFrame:
    """key, top: the ``n`` highest values of every key, highest first, ties by smaller id.

    ``rows`` is (key string, value long, id string); rows with a null take no
    part.  Lists are merged like sums: each task keeps its best per key, groups
    of tasks merge theirs, and the groups' lists merge at last.  No task ever
    holds all rows of a key.
    """

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fan = TaskContext.get().partitionId() % FANS
        held: pd.DataFrame | None = None

        def out(best: pd.DataFrame) -> pa.RecordBatch:
            return pa.RecordBatch.from_pandas(best.assign(fan=fan).astype({"fan": "int32"}), preserve_index=False)

        for batch in batches:
            own = batch.to_pandas()
            held = own if held is None else pd.concat([held, own])
            held = held.sort_values(["key", "value", "id"], ascending=[True, False, True]).groupby("key", sort=False).head(n)
            if len(held) > FLUSH:
                yield out(held)
                held = None
        if held is not None and len(held):
            yield out(held)

    usable = rows.select("key", F.col("value").cast("long"), "id").dropna()
    kept = usable.mapInArrow(local, "key string, value long, id string, fan int")
    entry = F.struct((-F.col("value")).alias("less"), "id")
    some = kept.groupBy("key", "fan").agg(F.slice(F.sort_array(F.collect_list(entry)), 1, n).alias("top"))
    whole = some.groupBy("key").agg(F.slice(F.sort_array(F.flatten(F.collect_list("top"))), 1, n).alias("top"))
    return whole.select("key", F.transform("top", lambda e: F.struct((-e["less"]).alias("value"), e["id"].alias("id"))).alias("top"))


# --- score --------------------------------------------------------------------

# Weight of each part, in hundredths.
PARTS = {"seed": 35, "evidence": 25, "personal": 20, "coverage": 10, "completeness": 10}


def city_scores(attractions: DataFrame, theme_weights: Mapping[str, float], n: int = 5, cap: float = 1.0) -> DataFrame:
    """city_id, attractions, seed, evidence, personal, coverage, completeness, score, top.

    ``attractions`` is (place, city_id, themes, similarity, completeness): how
    near a place is to the query and how many of its fields are filled, both 0
    to 1.  Parts of a city, each with four places:

    * seed: mean similarity of its ``n`` best places
    * personal: mean of the ``n`` best places' weights of their themes, each capped
    * evidence: log(1 + attractions) against the city with most
    * coverage: share of the wanted themes (weight above 0) that its places carry
    * completeness: mean over all places

    Means over n count missing places as 0, so a city with one good place does
    not beat one with five.  ``top`` lists the places behind ``personal``.  Rows
    without city take no part.
    """
    rows = attractions.where("city_id IS NOT NULL").select(
        F.col("city_id").cast("string").alias("key"), F.col("place").cast("string").alias("id"),
        F.array_distinct(F.coalesce("themes", F.array().cast("array<string>"))).alias("themes"), "similarity", "completeness",
    )
    per_theme = F.create_map(*(F.lit(x) for t, w in theme_weights.items() for x in (t, round(w * 1000))))
    liked = F.aggregate("themes", F.lit(0).cast("long"), lambda sum_, t: sum_ + F.coalesce(F.element_at(per_theme, t), F.lit(0)))
    capped = F.least(liked, F.lit(round(cap * 1000)).cast("long"))
    personal = bounded_top_n(rows.select("key", capped.alias("value"), "id"), n)
    seeds = bounded_top_n(rows.select("key", F.round(F.col("similarity") * 1000).alias("value"), "id"), n)
    wanted = [t for t, w in theme_weights.items() if w > 0]
    has = [F.max(F.when(F.array_contains("themes", t), 1).otherwise(0)) for t in wanted]
    thousandths = F.round(F.coalesce("completeness", F.lit(0.0)) * 1000).cast("long")
    totals = rows.groupBy("key").agg(
        F.count("*").alias("attractions"), F.sum(thousandths).alias("_filled"),
        (sum(has[1:], has[0]) if has else F.max(F.lit(0))).alias("_themes"),
    )
    joined = saved(
        totals.join(personal.withColumnRenamed("top", "_personal"), "key", "left").join(seeds.withColumnRenamed("top", "_seeds"), "key", "left"),
        "city-totals",
    )
    most = joined.agg(F.max("attractions")).scalar()

    def mean(top: str) -> F.Column:
        total = F.aggregate(F.coalesce(top, F.array().cast("array<struct<value:bigint,id:string>>")), F.lit(0).cast("long"), lambda s, e: s + e["value"])
        return total / (1000 * n)

    parts = {
        "seed": mean("_seeds"),
        "evidence": F.log1p("attractions") / F.log1p(most),
        "personal": mean("_personal"),
        "coverage": F.col("_themes") / len(wanted) if wanted else F.lit(1.0),
        "completeness": F.col("_filled") / (1000 * F.col("attractions")),
    }
    shown = joined.select(
        F.col("key").alias("city_id"), "attractions", *(F.round(v, 4).cast("decimal(7,4)").alias(p) for p, v in parts.items()),
        F.coalesce("_personal", F.array().cast("array<struct<value:bigint,id:string>>")).alias("top"),
    )
    score = sum((F.col(p) * F.lit(w).cast("decimal(3,0)") for p, w in PARTS.items()), F.lit(0).cast("decimal(3,0)")) / 100
    return shown.withColumn("score", score.cast("decimal(9,6)"))


# --- profiles -----------------------------------------------------------------


def theme_profiles(tagged: DataFrame) -> DataFrame:
    """city_id, theme, places, cities, weight: what is special about a city, from rows (city_id, theme), one per place and theme.

    The weight is the count times log(cities / cities that have the theme); the
    weights of a city have length 1.  A theme of all cities weighs nothing; a
    city with nothing else has weights of 0.
    """
    counts = saved(
        tagged.where("city_id IS NOT NULL AND theme IS NOT NULL").groupBy("city_id", "theme").agg(F.count("*").alias("places")), "theme-counts"
    )
    spread = counts.groupBy("theme").agg(F.count("*").alias("cities"))
    cities = counts.select(F.count_distinct("city_id")).scalar()
    raw = counts.join(spread, "theme").withColumn("_raw", F.col("places") * F.ln(cities / F.col("cities")))
    length = F.sqrt(F.sum(F.col("_raw") * F.col("_raw")).over(Window.partitionBy("city_id")))
    return raw.select(
        "city_id", "theme", "places", "cities", F.when(length > 0, F.col("_raw") / length).otherwise(0.0).alias("weight")
    )


def similar_cities(profiles: DataFrame, least: float) -> DataFrame:
    """city_a, city_b, similarity (six places) of all pairs whose profiles have a cosine of ``least`` or more; a before b.

    Themes are ordered from the rarest.  A profile is cut where what follows is
    shorter than a quarter of ``least``: common themes, which weigh little, lie
    behind the cut and bring no cities together.  Two cuts hide at most half of
    ``least``, so the products before the cuts must make the other half; only
    pairs that do are computed in full.  No pair is lost.

    Pairs are not moved one by one.  A city is its hash there and a weight is
    rounded up to a short, so sums are never too small.  The cities of a theme are
    lists of about ``LISTED``; the rest of a list goes to each of its cities, where
    products are added up.
    """
    if not 0 < least <= 1:
        raise ValueError("a similarity is above 0 and at most 1")
    rest = Window.partitionBy("city_id").orderBy("cities", "theme").rowsBetween(0, Window.unboundedFollowing)
    left = F.sum(F.col("weight") * F.col("weight")).over(rest).alias("_left")
    weights = saved(profiles.where("weight > 0").select("city_id", "theme", "cities", "weight", left), "theme-weights")
    head = weights.where(F.col("_left") >= (least / 4) ** 2 * (1 - 1e-6))
    parts = F.ceil(F.col("cities") / LISTED).cast("int")
    entry = F.struct(F.hash("city_id").alias("no"), F.least(F.ceil(F.col("weight") * SHORT), F.lit(SHORT)).cast("short").alias("w"))
    lists = head.groupBy("theme", parts.alias("_parts"), F.pmod(F.hash("city_id"), parts).alias("_part")).agg(
        F.sort_array(F.collect_list(entry)).alias("_list")
    )
    lists = saved(lists, "theme-lists")
    own = lists.select(F.posexplode("_list").alias("_i", "_e"), "_list").select("_e", F.expr("slice(_list, _i + 2, size(_list))").alias("_later"))
    large = lists.where("_parts > 1")
    other = large.select("theme", F.col("_part").alias("_other"), F.col("_list").alias("_theirs"))
    across = large.join(other, "theme").where("_part <> _other").select(F.explode("_list").alias("_e"), "_theirs")
    across = across.select("_e", F.filter("_theirs", lambda e: e["no"] > F.col("_e.no")).alias("_later"))
    met = own.union(across).where(F.size("_later") > 0).select(
        F.col("_e.no").alias("a"), F.col("_e.w").alias("_w"),
        F.transform("_later", lambda e: e["no"]).alias("b"), F.transform("_later", lambda e: e["w"]).alias("_v"),
    )
    # Few bytes make many pairs, so the tasks are dealt by number, not by bytes.
    spark = profiles.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), DEALT * spark.sparkContext.defaultParallelism)
    dealt = met.repartition(tasks, "a").select("a", "_w", F.inline(F.arrays_zip("b", "_v")))
    held = dealt.groupBy("a", "b").agg(F.sum(F.col("_w").cast("long") * F.col("_v")).alias("_held"))
    pairs = saved(held.where(F.col("_held") >= (least / 2 - 1e-6) * SHORT**2).select("a", "b"), "city-pairs")
    names = saved(weights.select("city_id").distinct().select(F.hash("city_id").alias("no"), "city_id"), "city-numbers")
    named = pairs.join(names.select(F.col("no").alias("a"), F.col("city_id").alias("_one")), "a").join(
        names.select(F.col("no").alias("b"), F.col("city_id").alias("_two")), "b"
    )
    named = named.where("a <> b OR _one < _two")  # two cities may share their hash
    pairs = named.select(F.least("_one", "_two").alias("city_a"), F.greatest("_one", "_two").alias("city_b"))
    first = weights.select(F.col("city_id").alias("city_a"), "theme", F.col("weight").alias("_a"))
    second = weights.select(F.col("city_id").alias("city_b"), "theme", F.col("weight").alias("_b"))
    both = pairs.join(first, "city_a").join(second, ["city_b", "theme"])
    alike = both.groupBy("city_a", "city_b").agg(F.round(F.sum(F.col("_a") * F.col("_b")), 6).alias("similarity"))
    return alike.where(F.col("similarity") >= least)
