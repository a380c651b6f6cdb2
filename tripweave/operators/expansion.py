"""Graph expansion: places reached from seed places over typed edges.

Two places are linked by a common city, theme or month, or by nearness.  Edges
are never written as pairs: a place leads to its hubs (a city, a theme, a month,
a grid cell), and a hub leads to its best ``per_hub`` places, which are chosen
once for all hubs.  A theme that a third of all places carry thus costs a few
rows per task and ``per_hub`` rows after the shuffle.  Visited places and hubs
are left out by anti-joins, so a round works on what is new.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripweave.functions import geo
from tripweave.operators.spatial import Grid
from tripweave.session import saved

WEIGHTS = {"city": 4, "near": 3, "theme": 2, "month": 1}  # what an edge type adds to a place's score


def typed_hubs(places: DataFrame) -> DataFrame:
    """place, type, hub: the city, themes and months of places (place, city_id, themes, months); blank hubs do not link."""
    def hubs(kind: str, values) -> F.Column:
        return F.transform(
            F.coalesce(values, F.array().cast("array<string>")), lambda v: F.struct(F.lit(kind).alias("type"), v.alias("hub"))
        )

    every = F.concat(
        hubs("city", F.array("city_id")),
        hubs("theme", F.col("themes").cast("array<string>")),
        hubs("month", F.col("months").cast("array<string>")),
    )
    linked = places.select("place", F.explode(F.array_distinct(every)).alias("h")).select("place", "h.type", "h.hub")
    return linked.where("trim(hub) <> ''")


def best_members(members: DataFrame, per_hub: int) -> DataFrame:
    """The ``per_hub`` best members of every hub: highest ``rank`` (null last), then smallest place.

    Each task keeps its own best before the shuffle.
    """
    order = Window.partitionBy("type", "hub").orderBy(F.desc_nulls_last("rank"), "place")
    return members.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= per_hub).drop("_n")


def expand(
    places: DataFrame, seeds: DataFrame, rounds: int = 2, per_hub: int = 5, near_m: float = 5000.0,
    weights: Mapping[str, int] = WEIGHTS,
) -> DataFrame:
    """place, depth, types, score of all places reached from ``seeds`` (place) in at most ``rounds`` rounds.

    ``places`` is (place, city_id, themes, months, latitude, longitude, rank),
    unique by place.  Depth 0 are the seeds that are places; ``types`` lists the
    edge types that reach a place in its first round, ``score`` adds up their
    weights.  A near edge leads to the best places of the grid cells around, as
    far as they are within ``near_m``.
    """
    grid = Grid(near_m, depth=0)
    ranked = places.select("place", "rank")
    hubs = saved(typed_hubs(places), "expansion-hubs")
    best = saved(best_members(hubs.join(ranked, "place"), per_hub).drop("rank"), "expansion-best")
    spots = grid.with_cell(places.select("place", "latitude", "longitude", "rank"))
    cells = spots.select("place", "latitude", "longitude", "rank", F.lit("near").alias("type"), F.col("_base").alias("hub"))
    near = saved(
        best_members(cells, per_hub).select(F.col("hub").alias("_cell"), "place", F.col("latitude").alias("_lat"), F.col("longitude").alias("_lon")),
        "expansion-near",
    )
    where = places.select("place", "latitude", "longitude")
    none = F.array().cast("array<string>")
    visited = saved(
        ranked.join(seeds.select("place").distinct(), "place", "left_semi").select(
            "place", F.lit(0).alias("depth"), none.alias("types"), F.lit(0).cast("long").alias("score")
        ),
        "expansion-round",
    )
    frontier, done = visited, None
    weight = F.create_map(*(F.lit(x) for pair in weights.items() for x in pair))
    for depth in range(1, rounds + 1):
        reached = hubs.join(frontier.select("place"), "place").select("type", "hub").distinct()
        if done is not None:
            reached = reached.join(done, ["type", "hub"], "left_anti")
        reached = saved(reached, "expansion-reached")
        done = reached if done is None else done.union(reached)
        by_hub = best.join(reached, ["type", "hub"]).select("place", "type")
        circles = grid.cover(where.join(frontier.select("place"), "place")).select("_cell", "latitude", "longitude")
        away = geo.distance_m(F.col("latitude"), F.col("longitude"), F.col("_lat"), F.col("_lon"))
        by_distance = circles.join(near, "_cell").where(away <= near_m).select("place", F.lit("near").alias("type"))
        found = by_hub.union(by_distance).groupBy("place").agg(F.sort_array(F.collect_set("type")).alias("types"))
        frontier = saved(
            found.join(visited, "place", "left_anti").select(
                "place", F.lit(depth).alias("depth"), "types",
                F.aggregate("types", F.lit(0).cast("long"), lambda sum_, t: sum_ + F.element_at(weight, t)).alias("score"),
            ),
            "expansion-round",
        )
        visited = visited.union(frontier)
    return visited
