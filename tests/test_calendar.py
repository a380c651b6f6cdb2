"""Recurrence rules, crowding scores and contact overrides against plain versions."""

import random
from collections import defaultdict
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from tripweave.operators import crowding, overrides, recurrence
from tripweave.workloads import QUERIES

D = date.fromisoformat
CASES = {
    "fixed": (["2019-10-03", "2020-10-03", "2022-10-03"], "FREQ=YEARLY;INTERVAL=1;BYMONTH=10;BYMONTHDAY=3", ["2023-10-03", "2024-10-03"]),
    "two years": (["2016-05-01", "2018-05-01", "2022-05-01"], "FREQ=YEARLY;INTERVAL=2;BYMONTH=5;BYMONTHDAY=1", ["2024-05-01"]),
    "second saturday": (["2020-05-09", "2021-05-08", "2022-05-14"], "FREQ=YEARLY;INTERVAL=1;BYMONTH=5;BYDAY=2SA", ["2023-05-13", "2024-05-11"]),
    "last sunday": (["2019-11-24", "2020-11-29", "2021-11-28", "2022-11-27"], "FREQ=YEARLY;INTERVAL=1;BYMONTH=11;BYDAY=-1SU", ["2023-11-26", "2024-11-24"]),
    "leap day": (["2012-02-29", "2016-02-29", "2020-02-29"], "FREQ=YEARLY;INTERVAL=4;BYMONTH=2;BYMONTHDAY=29", ["2024-02-29"]),
    "monthly": (["2022-08-31", "2022-10-31", "2022-12-31"], "FREQ=MONTHLY;INTERVAL=2;BYMONTHDAY=31", ["2023-08-31", "2023-10-31", "2023-12-31", "2024-08-31", "2024-10-31", "2024-12-31"]),
    "first friday": (["2022-10-07", "2022-11-04", "2023-11-03"], "FREQ=MONTHLY;INTERVAL=1;BYDAY=1FR", [f"{m}" for m in ("2023-12-01", "2024-01-05", "2024-02-02", "2024-03-01", "2024-04-05", "2024-05-03", "2024-06-07", "2024-07-05", "2024-08-02", "2024-09-06", "2024-10-04", "2024-11-01", "2024-12-06")]),
    "fortnight": (["2024-10-04", "2024-10-18", "2024-11-29"], "FREQ=WEEKLY;INTERVAL=2;BYDAY=FR", ["2024-12-13", "2024-12-27"]),
    "days": (["2024-11-01", "2024-11-11", "2024-12-01"], "FREQ=DAILY;INTERVAL=10", ["2024-12-11", "2024-12-21", "2024-12-31"]),
    "after a pause": (["2001-01-01", "2001-01-08", "2020-06-02", "2021-06-02", "2022-06-02"], "FREQ=YEARLY;INTERVAL=1;BYMONTH=6;BYMONTHDAY=2", ["2023-06-02", "2024-06-02"]),
    "twice only": (["2020-01-01", "2021-01-01"], None, []),
    "no habit": (["2020-01-01", "2020-03-09", "2021-07-31"], None, []),
    "future": (["2028-03-01", "2029-03-01", "2030-03-01"], "FREQ=YEARLY;INTERVAL=1;BYMONTH=3;BYMONTHDAY=1", []),
}
EDITIONS = "festival string, start date, end date, days int, gap string"


def test_rules_and_their_dates(spark):
    rows = [(name, D(s), None, 9, "x") for name, (starts, _, _) in CASES.items() for s in starts] + [
        ("fixed", D("2022-10-03"), D("2022-10-05"), 0, "x"), ("fixed", D("2022-10-03"), D("2022-10-01"), 0, "x"),
        (None, D("2020-01-01"), None, 0, "x"), ("blank", None, None, 0, "x"),
    ]
    rules = recurrence.recurrence_rules(spark.createDataFrame(rows, EDITIONS))
    got = {r["festival"]: r for r in rules.collect()}
    assert {n: r["recurrence_rule"] for n, r in got.items()} == {n: c[1] for n, c in CASES.items()}
    assert (got["fixed"]["days"], got["fixed"]["editions"], got["days"]["days"], got["after a pause"]["editions"]) == (3, 3, 1, 3)
    assert got["after a pause"]["first_start"] == D("2020-06-02")
    dates = defaultdict(list)
    for r in recurrence.next_editions(rules, D("2023-01-01"), D("2024-12-31")).orderBy("start").collect():
        dates[r["festival"]].append(str(r["start"]))
        assert r["end"] == r["start"] + timedelta(days=got[r["festival"]]["days"] - 1)
    assert dates == {n: c[2] for n, c in CASES.items() if c[2]}
    with pytest.raises(ValueError, match="20 years"):
        recurrence.next_editions(rules, D("2000-01-01"), D("2030-01-01"))
    assert recurrence.recurrence_rules(spark.createDataFrame([], EDITIONS)).count() == 0


def test_expanded_dates_obey_the_rule_again(spark):
    """Editions made from a rule give that rule back."""
    rows = [(name, D(s)) for name, (_, _, starts) in CASES.items() if len(starts) > 2 for s in starts]
    editions = spark.createDataFrame(rows, "festival string, start date").withColumn("end", F.lit(None).cast("date"))
    got = {r["festival"]: r["recurrence_rule"] for r in recurrence.recurrence_rules(editions).collect()}
    assert got == {n: CASES[n][1] for n in got if n != "monthly"} | {"monthly": "FREQ=MONTHLY;INTERVAL=2;BYMONTHDAY=31"}


# --- crowding -------------------------------------------------------------------


def months_of(seed):
    rng = random.Random(seed)
    rows = []
    for c in range(40):
        for m in range(24):
            if rng.random() < (0.9 if c % 7 else 0.2):
                rows.append((f"c{c}", f"r{c % 3}", f"{2023 + m // 12}{m % 12 + 1:02d}", rng.choice([float(rng.randrange(30)), None])))
    return rows + [("c1", None, "202301", 5.0), (None, "r1", "202301", 5.0), ("c2", "r2", "2023", 5.0), ("c2", "r2", "202313", 5.0)]


def plain_scores(rows, least):
    season = lambda m: {12: "winter", 1: "winter", 2: "winter"}.get(m, "spring" if m < 6 else "summer" if m < 9 else "autumn")
    known = [(c, r, season(int(m[4:])), v) for c, r, m, v in rows if None not in (c, r, v) and len(m) == 6 and 1 <= int(m[4:]) <= 12]
    groups, cities = defaultdict(list), defaultdict(list)
    for c, r, s, v in known:
        groups[r, s].append(v)
        cities[c, r].append((s, v))
    share = lambda v, own: (sum(x < v for x in own) + sum(x == v for x in own) / 2) / len(own)
    cities = {k: own for k, own in cities.items() if len(own) >= least}
    means = {k: sum(v for _, v in own) / len(own) for k, own in cities.items()}
    made = {}
    for (c, r), own in cities.items():
        parts = [(s, share(v, groups[r, s])) for s, v in own]
        mean = {s: sum(x for t, x in parts if t == s) / sum(t == s for t, _ in parts) for s, _ in parts}
        made[c] = (len(own), sum(x for _, x in parts) / len(parts), 1 - share(means[c, r], list(means.values())), min(mean, key=lambda s: (-round(mean[s], 6), s)))
    return made


def test_crowding_equals_plain_ranks(spark):
    rows = months_of(2)
    frame = spark.createDataFrame([(*r, "x") for r in rows], "city string, region string, month string, visitors double, share string").repartition(3)
    want = plain_scores(rows, 6)
    tested = spark.createDataFrame([(f"c{i}",) for i in range(0, 40, 2)] + [("nowhere",), (None,)], "city string")
    got = {r["city"]: r for r in crowding.crowding_scores(frame, 6, tested).collect()}
    assert set(got) == set(want) and {c for c, r in got.items() if r["exact"]} == {c for c in want if int(c[1:]) % 2 == 0}
    for c, r in got.items():
        n, crowd, novel, peak = want[c]
        close = 1e-4 if r["exact"] else 1 / crowding.STEPS + 1 / crowding.ACCURACY + 1e-4
        assert r["months"] == n and abs(r["crowding_score"] - crowd) <= close and abs(r["novelty_score"] - novel) <= close + (0 if r["exact"] else 0.02)
        assert not r["exact"] or r["peak_season"] == peak
    assert crowding.crowding_scores(frame.limit(0)).count() == crowding.crowding_scores(frame.limit(0), tested=tested).count() == 0


def test_shares_of_a_large_group_hold_no_list_of_it(spark):
    rows = spark.range(3000).select(F.lit("g").alias("g"), (F.col("id") * 7 % 1500).cast("double").alias("v"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # several ranges for the one group
    try:
        told = crowding.exact_shares(rows, rows.where("v % 2 = 0"), ["g"], "v")
        assert {r["v"]: r["share"] for r in told.collect()} == {float(v): (2 * v + 1) / 3000 for v in range(0, 1500, 2)}
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert "collect_list" not in told._jdf.queryExecution().optimizedPlan().toString()


def test_sketched_share_equals_counting_the_quantiles(spark):
    quantiles = sorted(random.Random(4).choice(range(60)) for _ in range(crowding.STEPS + 1))
    rows = spark.range(-1, 62).select(F.col("id").cast("double").alias("v"), F.array(*(F.lit(float(q)) for q in quantiles)).alias("q"))
    for r in rows.select("v", crowding._sketched_share(F.col("v"), F.col("q")).alias("share")).collect():
        both = sum(q < r["v"] for q in quantiles) + sum(q <= r["v"] for q in quantiles)
        assert r["share"] == min(max((both - 1) / (2 * crowding.STEPS), 0.0), 1.0)


def test_crowding_sketch_reads_lineitem_once(spark):
    made = QUERIES["crowding_sketch"](spark, "/root/testdata/sf0.001")
    assert made.count() and not any("lineitem" in f for f in made.inputFiles())  # the sums by month are saved

# --- overrides ------------------------------------------------------------------

ITEM = "content_id string, as_of date, tel string, homepage string, email string, item string, key string"
OVERRIDE = "content_id string, field string, value string, valid_from date, valid_to date, precedence int, source string"


def test_overrides(spark):
    items = [
        ("a", D("2024-05-10"), "old", "h", None, "i", "k"), ("a", D("2024-05-10"), "old", "h", None, "i", "k"), ("a", D("2024-08-01"), "old", "h", "e", "i", "k"),
        ("b", None, "t", None, None, "i", "k"), (None, D("2024-05-10"), "t", None, None, "i", "k"), ("c", D("2024-05-10"), "t", "h", "e", "i", "k"),
    ]
    held = [
        ("a", "tel", "low", None, None, 1, "s"), ("a", "tel", "high", D("2024-05-10"), D("2024-05-10"), 2, "s"),
        ("a", "tel", "over", D("2024-05-11"), None, 9, "s"), ("a", "email", "first", D("2024-01-01"), None, None, "b"),
        ("a", "email", "later", D("2024-02-01"), D("2024-06-30"), None, "z"), ("a", "email", "same", D("2024-02-01"), None, None, "a"),
        ("a", "homepage", None, D("2024-07-01"), None, 0, None), ("a", "fax", "f", None, None, 9, "s"), ("b", "tel", "x", None, None, 9, "s"),
        (None, "tel", "x", None, None, 9, "s"), ("c", "tel", "t", None, None, 1, "s"), ("c", "email", "never", D("2024-06-01"), D("2024-05-01"), 1, "s"),
    ]
    frame, rules = spark.createDataFrame(items, ITEM), spark.createDataFrame(held, OVERRIDE)
    made = overrides.apply_overrides(frame, rules)
    assert made.columns == [*frame.columns, "override_audit"]
    got = sorted(((r["content_id"] or "", str(r["as_of"]), r["tel"], r["homepage"], r["email"], tuple(r["override_audit"])) for r in made.collect()), key=str)
    may = ("a", "2024-05-10", "high", "h", "same", (
        "tel: old -> high (s, precedence 2, 2024-05-10 to 2024-05-10)", "email: - -> same (a, precedence -, 2024-02-01 to -)"))
    august = ("a", "2024-08-01", "over", None, "same", (
        "tel: old -> over (s, precedence 9, 2024-05-11 to -)", "homepage: h -> - (-, precedence 0, 2024-07-01 to -)",
        "email: e -> same (a, precedence -, 2024-02-01 to -)"))
    assert got == sorted([may, may, august, ("b", "None", "t", None, None, ()), ("", "2024-05-10", "t", None, None, ()), ("c", "2024-05-10", "t", "h", "e", ())], key=str)
    assert overrides.apply_overrides(frame.limit(0), rules).count() == 0 and overrides.apply_overrides(frame, rules.limit(0)).count() == 6
