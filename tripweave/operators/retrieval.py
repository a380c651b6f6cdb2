"""After retrieval: searches with minimum numbers per theme, and scores with their evidence."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripweave.functions import geo

ALL = ""  # name of the list over all themes


def quota_top_k(
    vectors: DataFrame, query: Sequence[float], k: int, quotas: Mapping[str, int], place: str = "place", themes: str = "themes",
    embedding: str = "embedding",
) -> DataFrame:
    """rank, place, distance, quota_for: the nearest places to ``query``, with at least ``quotas[theme]`` places of each theme.

    One pass over the vectors keeps several lists of nearest places per task, one
    over all and one per wanted theme; a place counts by its nearest vector.  The
    lists merge into: the nearest places of each theme up to its quota (as many
    as there are), then the nearest others up to ``k`` places in all.  Ties go
    to the smaller place; ``quota_for`` lists the themes a place fills.  Vectors
    without direction or of another dimension, and null places, take no part.
    """
    target = np.asarray(query, dtype=np.float64)
    norm = float(np.linalg.norm(target))
    if norm == 0:
        raise ValueError("the query vector has no direction")
    if ALL in quotas:
        raise ValueError("a theme has a name")
    target, size = target / norm, len(target)
    sizes = {ALL: k, **{theme: n for theme, n in quotas.items() if n > 0}}

    def nearest(rows: pd.DataFrame, n: int) -> pd.DataFrame:
        return rows.sort_values(["distance", "place"]).drop_duplicates("place").head(n)

    def local_best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[str, pd.DataFrame] = {}
        for batch in batches:
            flat = batch.column(2).flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            matrix = flat.reshape(batch.num_rows, size)
            lengths = np.sqrt(np.einsum("ij,ij->i", matrix, matrix))
            with np.errstate(invalid="ignore", divide="ignore"):
                distance = np.round(1.0 - np.einsum("ij,j->i", matrix, target) / lengths, 12)
            rows = pd.DataFrame({"place": batch.column(0).to_pandas(), "distance": distance})
            usable = np.isfinite(distance)
            owner = pc.list_parent_indices(batch.column(1)).to_numpy()
            carried = batch.column(1).flatten()
            for name, n in sizes.items():
                inside = usable
                if name != ALL:
                    has = np.zeros(batch.num_rows, bool)
                    has[owner[pc.fill_null(pc.equal(carried, name), False).to_numpy(zero_copy_only=False)]] = True
                    inside = usable & has
                own = rows[inside]
                kept[name] = nearest(pd.concat([kept[name], own]) if name in kept else own, n)
        for name, own in kept.items():
            if len(own):
                columns = [pa.array([name] * len(own)), pa.array(own["place"], kind), pa.array(own["distance"].to_numpy())]
                yield pa.RecordBatch.from_arrays(columns, names=["list", "place", "distance"])

    rows = vectors.where((F.size(embedding) == size) & F.col(place).isNotNull())
    rows = rows.select(F.col(place).alias("place"), F.col(themes).cast("array<string>"), F.col(embedding).cast("array<double>"))
    data_type = rows.schema["place"].dataType
    kind = {"string": pa.string(), "bigint": pa.int64(), "int": pa.int32()}[data_type.simpleString()]
    lists = rows.mapInArrow(local_best, f"list string, place {data_type.simpleString()}, distance double")
    merged = lists.groupBy("list", "place").agg(F.min("distance").alias("distance"))
    order = Window.partitionBy("list").orderBy("distance", "place")
    wanted = F.element_at(F.create_map(*(F.lit(x) for pair in sizes.items() for x in pair)), F.col("list"))
    best = merged.withColumn("n", F.row_number().over(order)).where(F.col("n") <= max(sizes.values())).where(F.col("n") <= wanted)
    # from here on there are at most k rows and the sum of the quotas
    places = best.groupBy("place").agg(
        F.min("distance").alias("distance"),
        F.sort_array(F.collect_set(F.when(F.col("list") != ALL, F.col("list")))).alias("quota_for"),
    )
    taken = F.size("quota_for") > 0
    everything = Window.partitionBy(F.lit(1))
    turn = F.row_number().over(Window.partitionBy(taken).orderBy("distance", "place"))
    filled = places.withColumns({"turn": turn, "reserved": F.count_if(taken).over(everything)})
    chosen = filled.where(taken | (F.col("turn") <= k - F.col("reserved")))
    rank = F.row_number().over(everything.orderBy("distance", "place"))
    return chosen.select(rank.alias("rank"), "place", "distance", "quota_for")


# --- evidence -----------------------------------------------------------------

# Weight of each part of a score, in hundredths.
EVIDENCE = {"vector": 35, "theme": 20, "city": 15, "date": 10, "locality": 10, "completeness": 10}
DETAILS = ("title", "description", "address", "image_url", "theme")


def evidence_scores(
    candidates: DataFrame, themes: Sequence[str] = (), month: int | None = None, city_id: str | None = None,
    near: tuple[float, float] | None = None, reach_m: float = 20000.0, details: Sequence[str] = DETAILS,
    weights: Mapping[str, int] = EVIDENCE,
) -> DataFrame:
    """Candidates with ``score`` and ``evidence``, a list of (part, value, weight, fields, because) in the order of ``weights``.

    Every part is a decimal between 0 and 1 with four places, the score their
    weighted sum with six, so equal candidates score equally in any run:

    * vector: 1 - ``distance`` / 2 (0 without one)
    * theme: wanted themes that the candidate has (1 if none is wanted)
    * city: 1 in the wanted city, 0 in another; if none is wanted, the candidates
      of its city against those of the city with most
    * date: whether ``month`` is among ``months`` or between the start and end
      of an event, which may pass the turn of the year (0.5 if unknown, 1 if no
      month is wanted)
    * locality: 1 - way / ``reach_m`` from ``near``, at least 0 (0.5 without a
      position, 1 if no place is wanted)
    * completeness: filled fields among ``details``
    """
    def share(value: Column) -> Column:
        return F.round(F.greatest(F.least(value, F.lit(1.0)), F.lit(0.0)), 4).cast("decimal(5,4)")

    rows = candidates
    if city_id is None:
        counts = candidates.where("city_id IS NOT NULL").groupBy(F.col("city_id").alias("_city")).agg(F.count("*").alias("_held"))
        most = counts.agg(F.max("_held")).scalar()
        rows = candidates.join(counts, F.col("city_id") == F.col("_city"), "left")
        city = share(F.coalesce(F.col("_held") / most, F.lit(0.0)))
        city_text = F.concat(F.coalesce(F.col("_held"), F.lit(0)).cast("string"), F.lit(" candidates"))
    else:
        city = share(F.when(F.col("city_id") == city_id, 1.0).otherwise(0.0))
        city_text = F.coalesce("city_id", F.lit("unknown"))

    wanted = F.array_distinct(F.array(*map(F.lit, themes))).cast("array<string>")
    held = F.array_sort(F.array_intersect(wanted, F.coalesce("themes", F.array().cast("array<string>"))))
    theme = share(F.size(held) / F.size(wanted)) if themes else share(F.lit(1.0))

    known_months = F.coalesce(F.size("months") > 0, F.lit(False))
    first, last = F.month("event_start_date"), F.month(F.coalesce("event_end_date", "event_start_date"))
    over = F.months_between(F.trunc(F.coalesce("event_end_date", "event_start_date"), "month"), F.trunc("event_start_date", "month"))
    dated = F.col("event_start_date").isNotNull()
    in_event = (over >= 11) | F.when(first <= last, F.lit(month or 0).between(first, last)).otherwise(
        (F.lit(month or 0) >= first) | (F.lit(month or 0) <= last)
    )
    fits = F.when(dated, in_event).when(known_months, F.array_contains(F.col("months").cast("array<int>"), month or 0))
    date = share(F.lit(1.0) if month is None else F.when(fits, 1.0).when(~fits, 0.0).otherwise(0.5))
    date_text = F.when(dated, F.concat_ws(" to ", F.col("event_start_date").cast("string"), F.col("event_end_date").cast("string"))).when(
        known_months, F.concat_ws(",", F.array_sort("months").cast("array<string>"))
    ).otherwise("unknown")

    here = geo.on_earth(F.col("latitude"), F.col("longitude"))
    way = F.when(here, geo.distance_m(F.col("latitude"), F.col("longitude"), *map(F.lit, near))) if near else F.lit(None).cast("double")
    locality = share(F.when(here, 1 - way / reach_m).otherwise(0.5) if near else F.lit(1.0))
    way_text = F.coalesce(F.concat(F.round(way, 0).cast("long").cast("string"), F.lit(" m")), F.lit("unknown" if near else "no place wanted"))

    filled = F.array_compact(F.array(*(F.when(F.trim(F.col(d).cast("string")) != "", F.lit(d)) for d in details)))
    parts = {
        "vector": (share(F.coalesce(1 - F.col("distance") / 2, F.lit(0.0))), ["distance"], F.coalesce(F.round("distance", 6).cast("string"), F.lit("none"))),
        "theme": (theme, ["themes"], F.array_join(held, ",")),
        "city": (city, ["city_id"], city_text),
        "date": (date, ["event_start_date", "event_end_date", "months"], date_text),
        "locality": (locality, ["latitude", "longitude"], way_text),
        "completeness": (share(F.size(filled) / len(details)), list(details), F.array_join(filled, ",")),
    }
    evidence = F.array(
        *(
            F.struct(
                F.lit(name).alias("part"), value.alias("value"), F.lit(weights[name]).alias("weight"),
                F.array(*map(F.lit, fields)).alias("fields"), because.alias("because"),
            )
            for name, (value, fields, because) in ((n, parts[n]) for n in weights)
        )
    )
    scored = rows.withColumn("evidence", evidence)
    zero = F.lit(0).cast("decimal(20,6)")
    total = F.aggregate(
        "evidence", zero, lambda sum_, e: (sum_ + e["value"] * e["weight"].cast("decimal(3,0)") / 100).cast("decimal(20,6)")
    )
    return scored.select(*candidates.columns, total.alias("score"), "evidence")
