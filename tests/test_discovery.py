"""Geohash, radius search, expansion, quota search, evidence, city scores and profiles against plain versions."""

import math
import random
from collections import Counter, defaultdict
from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tripweave.functions import geo
from tripweave.operators import city_scores as cities
from tripweave.operators import expansion, retrieval, spatial


def plain_geohash(lat, lon, size):
    """By halving; longitude 180 is -180."""
    lon = -180.0 if lon == 180 else lon
    sides, code, letter = [[-180.0, 180.0], [-90.0, 90.0]], "", 0
    for bit in range(5 * size):
        side, value = sides[bit % 2], (lon, lat)[bit % 2]
        middle = (side[0] + side[1]) / 2
        side[0 if value >= middle else 1] = middle
        letter = letter * 2 + (value >= middle)
        if bit % 5 == 4:
            code, letter = code + geo.ALPHABET[letter], 0
    return code, sides


def plain_distance(a, b):
    lat1, lon1, lat2, lon2 = map(math.radians, (*a, *b))
    h = math.sin((lat2 - lat1) / 2) ** 2 + math.cos(lat1) * math.cos(lat2) * math.sin((lon2 - lon1) / 2) ** 2
    return round(2 * geo.EARTH_M * math.asin(math.sqrt(min(h, 1.0))), 3)


BORDERS = [
    (0.0, 0.0), (-1e-17, -1e-17), (90.0, 180.0), (-90.0, -180.0), (45.0, 90.0), (math.nextafter(45.0, 0), math.nextafter(90.0, 0)), (22.5, -45.0),
    (89.999999999, 179.999999999), (57.64911, 10.40744), (11.25, math.nextafter(22.5, 30)), (180 / 2**30 - 90, 360 / 2**30 - 180),
]


def test_geohash_equals_halving(spark):
    rng = random.Random(1)
    spots = BORDERS + [(rng.uniform(-90, 90), rng.uniform(-180, 180)) for _ in range(200)]
    spots += [(180 * rng.randrange(2**12) / 2**12 - 90, 360 * rng.randrange(2**12) / 2**12 - 180) for _ in range(100)]
    frame = spark.createDataFrame([(i, *s) for i, s in enumerate(spots)], "i int, latitude double, longitude double")
    box = geo.geohash_box(F.col("geohash"), 12)
    got = spatial.with_geohash(frame).select("geohash", "geohash_prefix", *(c.alias(n) for n, c in box.items()), "i").orderBy("i").collect()
    for spot, r in zip(spots, got, strict=True):
        code, ((west, east), (south, north)) = plain_geohash(*spot, 12)
        assert (r["geohash"], r["geohash_prefix"]) == (code, code[:5])
        assert (r["south"], r["west"], r["north"], r["east"]) == (south, west, north, east)
    assert plain_geohash(57.64911, 10.40744, 11)[0] == "u4pruydqqvj"


def test_geohash_of_odd_positions(value):
    lit = value.lit
    nan = float("nan")
    for lat, lon in ((None, 1.0), (1.0, None), (91.0, 0.0), (0.0, -180.5), (nan, 0.0), (0.0, float("inf"))):
        assert value(geo.geohash(lit(lat).cast("double"), lit(lon).cast("double"), 5)) is None
    assert value(geo.geohash_box(lit("abc"), 3)["south"]) is None and value(geo.geohash_box(lit("u4"), 2)["north"]) == 61.875
    with pytest.raises(ValueError, match="1 to 12"):
        geo.geohash(lit(0.0), lit(0.0), 13)


def test_geohash_range(spark):
    frame = spark.createDataFrame([("u4pru",), ("u4prz9",), ("u4ps",), (None,)], "geohash string")
    assert [r[0] for r in spatial.in_geohash_range(frame, "u4pr").orderBy("geohash").collect()] == ["u4pru", "u4prz9"]


@pytest.mark.parametrize(("radius", "bound", "depth"), [(50_000, 4096, 4), (50_000, 5, 4), (2_000_000, 10, 2), (300, 3, 1), (19_000_000, 20, 3)])
def test_radius_search_equals_brute_force(spark, radius, bound, depth):
    """Clusters, equal places, the poles and the antimeridian; small bounds split cells and number the parts of the last level."""
    rng = random.Random(int(radius) + bound)
    hubs = [(37.5, 127.0), (89.99, 10.0), (-89.9, -170.0), (10.0, 179.999), (-45.0, -180.0), (0.0, 0.0), (90.0, 0.0)]
    near = lambda: rng.choice([0, 1e-4, 1e-2, 0.3]) * rng.uniform(-1, 1)
    spots = []
    for _ in range(220):
        lat, lon = rng.choice(hubs)
        spots.append((min(max(lat + near(), -90.0), 90.0), (lon + near() + 180) % 360 - 180))
    spots += [(37.5, 127.0)] * 40 + [(rng.uniform(-90, 90), rng.uniform(-180, 180)) for _ in range(60)]
    points = [(i, *s) for i, s in enumerate(spots)] + [(900, None, 1.0), (901, 95.0, 1.0), (None, 37.5, 127.0)]
    centers = [(i, *s) for i, s in enumerate(hubs + spots[::17])] + [(500, None, None), (501, 90.0, 123.0), (501, 90.0, 123.0)]
    frame = spark.createDataFrame([(*p, "x", 1) for p in points], "point long, latitude double, longitude double, _leaf string, center int")
    asked = spark.createDataFrame(centers, "center long, latitude double, longitude double")
    got = Counter((r["center"], r["point"], r["distance_m"]) for r in spatial.within_radius(asked, frame, radius, bound, depth).collect())
    want = Counter()
    for c, *a in centers:
        for p, *b in points:
            if None not in a and None not in b and abs(b[0]) <= 90 and (far := plain_distance(a, b)) <= radius:
                want[c, p, far] += 1
    assert {(c, p): n for (c, p, _), n in got.items()} == {(c, p): n for (c, p, _), n in want.items()}
    far = {(c, p): d for c, p, d in want}
    assert all(abs(d - far[c, p]) <= 0.002 for c, p, d in got) and len(got) > 50
    assert spatial.within_radius(asked.limit(0), frame, radius).count() == spatial.within_radius(asked, frame.limit(0), radius).count() == 0


def test_crowded_cells_are_split_to_the_bound(spark):
    """Two thirds of all points in a few metres: no join key holds many more than the bound."""
    rows = [(i, 37.5 + i % 997 * 1e-6, 127.0 + i % 389 * 1e-6) for i in range(4000)] + [(9000 + i, 37.5, 127.0) for i in range(4000)]
    grid = spatial.Grid(100.0)
    placed = grid.with_cell(spark.createDataFrame(rows, "point long, latitude double, longitude double"))
    told = placed.join(grid.crowded(placed, 100), F.col("_base") == F.col("_cell"), "left").withColumn("leaf", grid.leaf())
    parts = F.pmod(F.xxhash64("point", "latitude"), F.coalesce(F.element_at("parts", F.col("leaf")), F.lit(1)))
    assert told.groupBy("_base", "leaf", parts).count().agg(F.max("count")).first()[0] < 170


# --- expansion ------------------------------------------------------------------

PLACES = "place string, city_id string, themes array<string>, months array<int>, latitude double, longitude double, rank double"


def plain_expansion(rows, seeds, rounds, per_hub, near_m):
    hubs, members = defaultdict(set), defaultdict(set)
    for p, city, themes, months, *_ in rows:
        for kind, values in (("city", [city]), ("theme", themes or []), ("month", months or [])):
            for v in values:
                if v is not None and str(v).strip():
                    hubs[p].add((kind, str(v)))
                    members[kind, str(v)].add(p)
    rank = {r[0]: r[6] for r in rows}
    spots = {r[0]: (r[4], r[5]) for r in rows if r[4] is not None and r[5] is not None}
    order = lambda p: (rank[p] is None, -(rank[p] or 0), p)
    best = {h: sorted(m, key=order)[:per_hub] for h, m in members.items()}
    visited = {s: (0, (), 0) for s in seeds if s in rank}
    frontier, done = set(visited), set()
    for depth in range(1, rounds + 1):
        reached = {h for p in frontier for h in hubs[p]} - done
        done |= reached
        found = defaultdict(set)
        for h in reached:
            for p in best[h]:
                found[p].add(h[0])
        for p in frontier & set(spots):
            for q in spots:
                if plain_distance(spots[p], spots[q]) <= near_m:
                    found[q].add("near")
        frontier = {p for p in found if p not in visited}
        for p in frontier:
            visited[p] = depth, tuple(sorted(found[p])), sum(expansion.WEIGHTS[t] for t in found[p])
    return visited


def test_expansion_equals_breadth_first_search(spark):
    """Grid cells hold fewer places than ``per_hub`` here, so that nearness is exact."""
    rng = random.Random(8)
    rows = []
    for i in range(150):
        lat, lon = (rng.uniform(30, 40), rng.choice([rng.uniform(120, 130), 180.0, -179.99])) if i % 9 else (None, None)
        themes = rng.choice([None, [], ["food"], ["sea", "food"], ["", "art"], [None, "sea"]])
        rows.append((f"p{i}", rng.choice([None, "", *(f"c{k}" for k in range(12))]), themes, rng.choice([None, [], [1, 5], [12]]), lat, lon, rng.choice([None, 1.0, 2.0, 3.5])))
    seeds = ["p3", "p3", "p77", "gone"]
    places = spark.createDataFrame(rows, PLACES)
    wanted = spark.createDataFrame([(s,) for s in seeds], "place string")
    got = {r["place"]: (r["depth"], tuple(r["types"]), r["score"]) for r in expansion.expand(places, wanted, 3, 12, 30_000.0).collect()}
    assert got == plain_expansion(rows, seeds, 3, 12, 30_000.0) and len({d for d, _, _ in got.values()}) > 2
    assert expansion.expand(places, wanted.limit(0), 2).count() == expansion.expand(places.limit(0), wanted, 2).count() == 0


# --- retrieval ------------------------------------------------------------------


def plain_quota(rows, query, k, quotas):
    norm = lambda v: math.sqrt(sum(x * x for x in v))
    lists = defaultdict(dict)
    for place, themes, v in rows:
        if place is None or v is None or len(v) != len(query) or not norm(v):
            continue
        far = round(1 - sum(a * b for a, b in zip(v, query, strict=True)) / norm(v) / norm(query), 9)
        for name in {"", *(themes or [])} & {"", *quotas}:
            lists[name][place] = min(lists[name].get(place, 9), far)
    top = {name: sorted((d, p) for p, d in held.items())[: quotas.get(name, k)] for name, held in lists.items()}
    filled = {p: (d, tuple(sorted(n for n in quotas if any(p == q for _, q in top.get(n, ()))))) for t in top.values() for d, p in t}
    taken = {p: x for p, x in filled.items() if x[1]}
    rest = sorted((d, p) for p, (d, f) in filled.items() if not f)[: max(k - len(taken), 0)]
    chosen = sorted([(d, p, f) for p, (d, f) in taken.items()] + [(d, p, ()) for d, p in rest])
    return [(i, p, round(d, 6), f) for i, (d, p, f) in enumerate(chosen, 1)]


@pytest.mark.parametrize(("k", "quotas"), [(10, {"a": 3, "b": 4}), (3, {"a": 4, "b": 5, "none": 2}), (40, {"rare": 1}), (5, {})])
def test_quotas_equal_plain_lists(spark, k, quotas):
    rng = random.Random(k)
    rows = []
    for i in range(300):
        themes = rng.choice([None, [], ["a"], ["b", "a"], [None, "c"]]) if i != 50 else ["rare"]
        v = [rng.choice([-1.0, 0.0, 0.5, 1.0]) for _ in range(4)] if i % 40 else rng.choice([None, [0.0] * 4, [1.0]])
        rows.append((f"p{rng.randrange(150):03d}" if i % 30 else None, themes, v))
    query = [1.0, 0.5, -0.25, 0.125]
    frame = spark.createDataFrame(rows, "place string, themes array<string>, embedding array<float>").repartition(3)
    got = retrieval.quota_top_k(frame, query, k, quotas).orderBy("rank").collect()
    assert [(r["rank"], r["place"], round(r["distance"], 6), tuple(r["quota_for"])) for r in got] == plain_quota(rows, query, k, quotas)
    assert retrieval.quota_top_k(frame.limit(0), query, k, quotas).count() == 0
    with pytest.raises(ValueError, match="direction"):
        retrieval.quota_top_k(frame, [0.0], k, quotas)


def test_evidence_parts(spark):
    rows = [
        ("a", "KR-1", 0.5, ["food", "sea"], [1, 12], 37.5, 127.0, None, None, "t", " ", "x"),
        ("b", "KR-1", None, None, None, None, None, date(2025, 11, 20), date(2026, 2, 1), "t", None, None),
        ("c", "KR-2", 3.0, [], [5], 37.6, 127.0, date(2025, 5, 1), None, None, None, None),
        ("d", None, 0.0, ["art"], [], 95.0, 0.0, date(2024, 3, 1), date(2025, 6, 1), "t", "d", "x"),
    ]
    schema = "place string, city_id string, distance double, themes array<string>, months array<int>, latitude double, longitude double, " \
        "event_start_date date, event_end_date date, title string, description string, address string"  # fmt: skip
    frame = spark.createDataFrame(rows, schema)
    details = ("title", "description", "address")
    scored = {r["place"]: r for r in retrieval.evidence_scores(frame, ["sea", "food", "food", "old"], 1, None, (37.5, 127.0), 20_000, details).collect()}
    values = lambda p: {e["part"]: str(e["value"]) for e in scored[p]["evidence"]}
    assert values("a") == {"vector": "0.7500", "theme": "0.6667", "city": "1.0000", "date": "1.0000", "locality": "1.0000", "completeness": "0.6667"}
    assert values("b") == {"vector": "0.0000", "theme": "0.0000", "city": "1.0000", "date": "1.0000", "locality": "0.5000", "completeness": "0.3333"}
    assert values("c") == {"vector": "0.0000", "theme": "0.0000", "city": "0.5000", "date": "0.0000", "locality": "0.4440", "completeness": "0.0000"}
    assert values("d") == {"vector": "1.0000", "theme": "0.0000", "city": "0.0000", "date": "1.0000", "locality": "0.5000", "completeness": "1.0000"}
    assert scored["a"]["score"] == sum(Decimal(e["value"]) * e["weight"] for e in scored["a"]["evidence"]) / 100
    because = {e["part"]: (e["because"], e["fields"]) for e in scored["b"]["evidence"]}
    assert because["date"][0] == "2025-11-20 to 2026-02-01" and because["city"] == ("2 candidates", ["city_id"]) and because["vector"][0] == "none"
    named = {r["place"]: r for r in retrieval.evidence_scores(frame, city_id="KR-2", details=details).collect()}
    assert [str(named[p]["evidence"][2]["value"]) for p in "abcd"] == ["0.0000", "0.0000", "1.0000", "0.0000"]
    assert all(str(e["value"]) == "1.0000" for r in named.values() for e in r["evidence"] if e["part"] in ("theme", "date", "locality"))
    assert retrieval.evidence_scores(frame.limit(0), ["a"], 1, details=details).count() == 0


# --- cities ---------------------------------------------------------------------


def test_bounded_top_n_equals_sorting(spark, monkeypatch):
    rng = random.Random(3)
    rows = [(rng.choice([None, "hot", "hot", "hot", "x", "y"]), rng.choice([None, *range(9)]), rng.choice([None, *map(str, range(400))])) for _ in range(2000)]
    monkeypatch.setattr(cities, "FANS", 3)
    got = {r["key"]: [(e["value"], e["id"]) for e in r["top"]] for r in cities.bounded_top_n(spark.createDataFrame(rows, "key string, value int, id string").repartition(8), 7).collect()}
    want = defaultdict(list)
    for key, v, i in rows:
        if None not in (key, v, i):
            want[key].append((v, i))
    assert got == {key: sorted(own, key=lambda e: (-e[0], e[1]))[:7] for key, own in want.items()}
    assert cities.bounded_top_n(spark.createDataFrame([], "key string, value int, id string"), 3).count() == 0


def test_city_scores(spark):
    rows = [(f"p{i}", "big", ["food"], 0.1, 1.0) for i in range(50)] + [("q1", "small", ["food", "sea", "food"], 0.9, 0.5), ("q2", "small", None, None, None), ("n", None, ["sea"], 1.0, 1.0)]
    frame = spark.createDataFrame(rows, "place string, city_id string, themes array<string>, similarity double, completeness double")
    got = {r["city_id"]: r for r in cities.city_scores(frame, {"food": 0.5, "sea": 0.8, "art": 0.3, "crowd": -0.4}).collect()}
    part = lambda city: {p: float(got[city][p]) for p in cities.PARTS}
    assert part("big") == {"seed": 0.1, "evidence": 1.0, "personal": 0.5, "coverage": 0.3333, "completeness": 1.0}
    assert part("small") == {"seed": 0.18, "evidence": round(math.log(3) / math.log(51), 4), "personal": 0.2, "coverage": 0.6667, "completeness": 0.25}
    assert [(e["value"], e["id"]) for e in got["small"]["top"]] == [(1000, "q1"), (0, "q2")] and len(got["big"]["top"]) == 5
    assert abs(float(got["big"]["score"]) - (0.35 * 0.1 + 0.25 + 0.2 * 0.5 + 0.1 * 0.3333 + 0.1)) < 1e-9 and set(got) == {"big", "small"}
    assert cities.city_scores(frame.limit(0), {"food": 1.0}).count() == 0


@pytest.mark.parametrize("least", [0.2, 0.55, 0.95])
def test_similar_cities_equal_all_pairs(spark, least):
    rng = random.Random(6)
    rows = [(f"c{i % 40}", "common") for i in range(80)]
    for i in range(40):
        liked = [f"t{rng.randrange(12)}" for _ in range(4)]
        rows += [(f"c{i}", rng.choice(liked)) for _ in range(rng.randrange(9))]
    rows += [(None, "t1"), ("c1", None)]
    profiles = cities.theme_profiles(spark.createDataFrame(rows, "city_id string, theme string"))
    held = defaultdict(Counter)
    for city, theme in rows:
        if city and theme:
            held[city][theme] += 1
    spread = Counter(t for own in held.values() for t in own)
    weights = {c: {t: n * math.log(len(held) / spread[t]) for t, n in own.items()} for c, own in held.items()}
    for own in weights.values():
        length = math.sqrt(sum(w * w for w in own.values()))
        own.update({t: w / length if length else 0.0 for t, w in own.items()})
    got = {(r["city_id"], r["theme"]): r for r in profiles.collect()}
    assert {k: round(r["weight"], 9) for k, r in got.items()} == {(c, t): round(w, 9) for c, own in weights.items() for t, w in own.items()}
    names = sorted(weights)
    alike = {(a, b): round(sum(w * weights[b].get(t, 0) for t, w in weights[a].items()), 6) for i, a in enumerate(names) for b in names[i + 1 :]}
    found = {(r["city_a"], r["city_b"]): r["similarity"] for r in cities.similar_cities(profiles, least).collect()}
    assert found == {p: s for p, s in alike.items() if s >= least} and (found or least > 0.9)


def test_similar_cities_of_themes_with_many_lists(spark, monkeypatch):
    rng = random.Random(8)
    rows = [(f"c{i}", f"t{t}") for i in range(60) for t in rng.sample(range(9), 3)]
    profiles = cities.theme_profiles(spark.createDataFrame(rows, "city_id string, theme string"))
    want = sorted(map(tuple, cities.similar_cities(profiles, 0.3).collect()))
    weights = defaultdict(dict)
    for r in profiles.collect():
        weights[r["city_id"]][r["theme"]] = r["weight"]
    alike = {(a, b): round(sum(w * weights[b].get(t, 0) for t, w in weights[a].items()), 6) for a in weights for b in weights if a < b}
    assert want == sorted((*p, s) for p, s in alike.items() if s >= 0.3)
    monkeypatch.setattr(cities, "LISTED", 4)
    assert sorted(map(tuple, cities.similar_cities(profiles, 0.3).collect())) == want
    moved = []  # pairs are handed on in lists, not one by one
    monkeypatch.setattr(cities, "saved", lambda rows, purpose: moved.append((purpose, rows.count())) or rows)
    cities.similar_cities(profiles, 0.3)
    assert dict(moved)["theme-lists"] < 60 * 3


def test_pairs_of_a_crowd_are_dealt_over_many_tasks(spark):
    at = "long, latitude double, longitude double"
    points = spark.createDataFrame([(i, 37.5, 127.0) for i in range(400)], f"point {at}")
    centers = spark.createDataFrame([(i, 37.5001, 127.0) for i in range(50)], f"center {at}")
    found = spatial.within_radius(centers, points, 100.0, bound=8, depth=1)
    sizes = [r["count"] for r in found.groupBy(F.spark_partition_id().alias("task")).count().collect()]
    assert (sum(sizes), len(sizes) > 8, max(sizes) < 5000) == (50 * 400, True, True), sizes
