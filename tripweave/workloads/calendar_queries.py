"""Recurrence rules, crowding and novelty, contact overrides."""

from __future__ import annotations

import datetime

from pyspark.sql import functions as F

from tripweave.operators import crowding, overrides, recurrence
from tripweave.session import saved
from tripweave.workloads.registry import query

# Editions: one per order, moved to a day that the customer's habit gives.
_HABIT = """CASE o_custkey % 5
    WHEN 0 THEN make_date({year}, {month}, {day})
    WHEN 1 THEN {nth}
    WHEN 2 THEN make_date({year}, month(o_orderdate), {day})
    WHEN 3 THEN {weekly}
    ELSE cast(o_orderdate AS date) END"""
_PARTS = {
    "year": "cast(year(o_orderdate) AS int)", "month": "cast(o_custkey % 12 + 1 AS int)", "day": "cast(o_custkey % 31 % 28 + 1 AS int)",
}
_SPARK_HABIT = _HABIT.format(
    **_PARTS,
    nth=f"date_add(make_date({_PARTS['year']}, {_PARTS['month']}, 1), cast(pmod(o_custkey % 7 - weekday(make_date({_PARTS['year']}, "
    f"{_PARTS['month']}, 1)), 7) + 7 * (o_custkey % 4) AS int))",
    weekly="date_add(date '1990-01-01', cast(14 * floor(datediff(o_orderdate, date '1990-01-01') / 14) AS int))",
)
_PLAIN_HABIT = _HABIT.format(
    **_PARTS,
    nth=f"make_date({_PARTS['year']}, {_PARTS['month']}, 1) + cast((o_custkey % 7 - isodow(make_date({_PARTS['year']}, {_PARTS['month']}, 1)) + 8) % 7 "
    "+ 7 * (o_custkey % 4) AS int)",
    weekly="date '1990-01-01' + cast(14 * floor((cast(o_orderdate AS date) - date '1990-01-01') / 14) AS int)",
)


def _editions(t):
    rows = t["orders"].select(
        F.col("o_custkey").alias("festival"), F.expr(_SPARK_HABIT).alias("start"), (F.col("o_orderkey") % 4).cast("int").alias("more")
    )
    return rows.select("festival", "start", F.when(F.col("more") > 0, F.expr("date_add(start, more - 1)")).alias("end"))


_RULES = f"""
    editions AS (SELECT o_custkey AS festival, cast({_PLAIN_HABIT} AS date) AS start, greatest(cast(o_orderkey % 4 AS int), 1) AS days FROM {{orders}}),
    starts AS (SELECT festival, start, max(days) AS days, year(start) * 12 + month(start) - 1 AS m FROM editions GROUP BY festival, start),
    gaps AS (SELECT *, start - lag(start) OVER w AS gap, m - lag(m) OVER w AS leap FROM starts WINDOW w AS (PARTITION BY festival ORDER BY start)),
    islands AS (SELECT *, sum(CASE WHEN gap > 1830 THEN 1 ELSE 0 END) OVER (PARTITION BY festival ORDER BY start) AS island FROM gaps),
    lasts AS (SELECT * FROM islands QUALIFY island = max(island) OVER (PARTITION BY festival)),
    facts AS (
      SELECT festival, count(*) AS editions, min(start) AS first_start, max(start) AS last_start, arg_max(days, start) AS days,
        count(DISTINCT month(start)) = 1 AS one_month, count(DISTINCT day(start)) = 1 AS one_day, count(DISTINCT isodow(start)) = 1 AS one_weekday,
        count(DISTINCT (day(start) - 1) // 7) = 1 AS one_nth, min((day(start) - 1) // 7 + 1) AS nth,
        bool_and(month(start + 7) <> month(start)) AS closing, coalesce(min(leap) FILTER (WHERE gap <= 1830), 1) AS least_leap,
        list_reduce(list_concat([0], coalesce(list(DISTINCT gap) FILTER (WHERE gap <= 1830), [])), lambda a, b: gcd(a, b)) AS step_days,
        list_reduce(list_concat([0], coalesce(list(DISTINCT leap) FILTER (WHERE gap <= 1830), [])), lambda a, b: gcd(a, b)) AS step_months,
        max(gap) FILTER (WHERE gap <= 1830) AS longest
      FROM lasts GROUP BY festival),
    named AS (
      SELECT *, one_weekday AND (one_nth OR closing) AS by_day, ['MO', 'TU', 'WE', 'TH', 'FR', 'SA', 'SU'][isodow(last_start)] AS weekday FROM facts),
    rules AS (
      SELECT festival, cast(editions AS int) AS editions, first_start, last_start, days, step_days, step_months, one_nth, nth, by_day, one_day,
        CASE WHEN editions < 3 THEN NULL
          WHEN one_month AND least_leap > 0 AND (one_day OR by_day) THEN concat('FREQ=YEARLY;INTERVAL=', step_months // 12, ';BYMONTH=', month(last_start),
            CASE WHEN one_day THEN concat(';BYMONTHDAY=', day(last_start)) ELSE concat(';BYDAY=', CASE WHEN one_nth THEN nth ELSE -1 END, weekday) END)
          WHEN least_leap > 0 AND (one_day OR by_day) THEN concat('FREQ=MONTHLY;INTERVAL=', step_months,
            CASE WHEN one_day THEN concat(';BYMONTHDAY=', day(last_start)) ELSE concat(';BYDAY=', CASE WHEN one_nth THEN nth ELSE -1 END, weekday) END)
          WHEN step_days % 7 = 0 AND longest <= 26 * step_days THEN concat('FREQ=WEEKLY;INTERVAL=', step_days // 7, ';BYDAY=', weekday)
          WHEN longest <= 31 THEN concat('FREQ=DAILY;INTERVAL=', step_days) END AS rule
      FROM named)"""


@query(f"""
    WITH {_RULES}
    SELECT festival, rule AS recurrence_rule, editions, cast(first_start AS varchar) AS first_start,
      cast(last_start AS varchar) AS last_start, days FROM rules""")
def recurrence_rules(t):
    """Rule of every festival from its editions."""
    rules = recurrence.recurrence_rules(_editions(t))
    return rules.withColumns({c: F.col(c).cast("string") for c in ("first_start", "last_start")})


@query(f"""
    WITH {_RULES},
    horizon AS (SELECT cast(unnest(range(date '2001-01-01', date '2004-01-01', INTERVAL 1 DAY)) AS date) AS d)
    SELECT festival, cast(d AS varchar) AS start, cast(d + days - 1 AS varchar) AS "end" FROM rules, horizon
    WHERE rule IS NOT NULL AND d > last_start AND CASE
      WHEN rule LIKE 'FREQ=DAILY%' THEN (d - last_start) % step_days = 0
      WHEN rule LIKE 'FREQ=WEEKLY%' THEN (d - last_start) % step_days = 0
      ELSE ((year(d) - year(last_start)) * 12 + month(d) - month(last_start)) % step_months = 0
        AND CASE WHEN one_day THEN day(d) = day(last_start)
          ELSE isodow(d) = isodow(last_start) AND CASE WHEN one_nth THEN (day(d) - 1) // 7 + 1 = nth ELSE month(d + 7) <> month(d) END END END""")
def next_festivals(t):
    """Editions that the rules give for three years."""
    rules = recurrence.recurrence_rules(_editions(t))
    made = recurrence.next_editions(rules, datetime.date(2001, 1, 1), datetime.date(2003, 12, 31))
    return made.select("festival", F.col("start").cast("string").alias("start"), F.col("end").cast("string").alias("end"))


# Visitors: quantities shipped by a supplier in a month; the supplier is a city, its nation a region.
_MONTHLY = """
    SELECT cast(l_suppkey AS string) AS city, CASE WHEN s_nationkey = 24 THEN NULL ELSE cast(s_nationkey AS string) END AS region,
      concat(cast(year(l_shipdate) AS string), lpad(cast(month(l_shipdate) AS string), 2, '0')) AS month, sum(l_quantity) AS visitors
    FROM {lineitem} JOIN {supplier} ON s_suppkey = l_suppkey GROUP BY 1, 2, 3"""


@query(f"""
    WITH monthly AS ({_MONTHLY}),
    seasons AS (
      SELECT *, CASE WHEN m BETWEEN 3 AND 5 THEN 'spring' WHEN m BETWEEN 6 AND 8 THEN 'summer' WHEN m BETWEEN 9 AND 11 THEN 'autumn' ELSE 'winter' END AS season
      FROM (SELECT *, cast(substr(month, 5, 2) AS int) AS m FROM monthly WHERE region IS NOT NULL) x),
    shares AS (
      SELECT *, round(((rank() OVER (PARTITION BY region, season ORDER BY visitors) - 1)
        + count(*) OVER (PARTITION BY region, season, visitors) / 2) / count(*) OVER (PARTITION BY region, season) * 1000000) AS units FROM seasons),
    cities AS (SELECT city, region, count(*) AS months, avg(visitors) AS mean FROM seasons GROUP BY city, region HAVING count(*) >= 6),
    ranked AS (
      SELECT *, ((rank() OVER (ORDER BY mean) - 1) + count(*) OVER (PARTITION BY mean) / 2) / count(*) OVER () AS place FROM cities),
    peaks AS (
      SELECT city, region, season FROM (SELECT city, region, season, round(sum(units) / count(*)) AS mean FROM shares GROUP BY ALL)
      QUALIFY row_number() OVER (PARTITION BY city, region ORDER BY mean DESC, season) = 1)
    SELECT r.city, r.region, r.months, round(sum(s.units) / count(*) / 1000000, 4) AS crowding_score, round(1 - any_value(r.place), 4) AS novelty_score,
      any_value(p.season) AS peak_season, true AS exact
    FROM ranked r JOIN shares s USING (city, region) JOIN peaks p USING (city, region) GROUP BY r.city, r.region, r.months""")
def crowding_scores(t):
    """Crowding and novelty of all cities, counted exactly."""
    monthly = saved(t.sql(_MONTHLY), "monthly")
    return crowding.crowding_scores(monthly, tested=monthly.select("city"))


@query(f"SELECT city, true AS close FROM ({_MONTHLY}) m WHERE region IS NOT NULL GROUP BY city HAVING count(*) >= 6")
def crowding_sketch(t):
    """Whether the sketched scores of a city are as near to the exact ones as stated."""
    monthly = saved(t.sql(_MONTHLY), "monthly")
    exact = crowding.crowding_scores(monthly, tested=monthly.select("city")).select("city", F.col("crowding_score").alias("c"), F.col("novelty_score").alias("n"))
    both = crowding.crowding_scores(monthly).join(exact, "city")
    error = 1 / crowding.STEPS + 1 / crowding.ACCURACY + 0.0001
    near = (F.abs(F.col("crowding_score") - F.col("c")) <= error) & (F.abs(F.col("novelty_score") - F.col("n")) <= error)
    return both.select("city", near.alias("close"))


_CONTACT_ITEMS = """
    SELECT cast(c_custkey AS string) AS content_id, c_name AS title, CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE concat('02-', cast(c_custkey AS string)) END AS tel,
      concat('https://h.example.com/', cast(c_custkey AS string)) AS homepage, '' AS email,
      CASE WHEN c_custkey % 23 = 0 THEN NULL ELSE cast('1995-01-01' AS date) + cast(c_custkey % 1000 AS int) END AS as_of
    FROM {customer}"""
_OVERRIDES = """
    SELECT cast(o_custkey AS string) AS content_id,
      CASE o_orderkey % 4 WHEN 0 THEN 'tel' WHEN 1 THEN 'homepage' WHEN 2 THEN 'email' ELSE 'fax' END AS field,
      CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE concat('v', cast(o_orderkey AS string)) END AS value,
      CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE cast(o_orderdate AS date) END AS valid_from,
      CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE cast(o_orderdate AS date) + cast(o_orderkey % 400 - 20 AS int) END AS valid_to,
      cast(o_orderkey % 3 AS int) AS precedence, o_orderpriority AS source
    FROM {orders}"""


def _audit(field: str) -> str:
    return (
        f"CASE WHEN o_{field}.content_id IS NOT NULL AND o_{field}.value IS DISTINCT FROM i.{field} THEN concat('{field}: ', coalesce(i.{field}, '-'), ' -> ', "
        f"coalesce(o_{field}.value, '-'), ' (', o_{field}.source, ', precedence ', o_{field}.precedence, ', ', "
        f"coalesce(cast(o_{field}.valid_from AS varchar), '-'), ' to ', coalesce(cast(o_{field}.valid_to AS varchar), '-'), ')') END"
    )


@query(f"""
    WITH items AS ({_CONTACT_ITEMS}), held AS ({_OVERRIDES}),
    best AS (
      SELECT h.* FROM held h JOIN items i USING (content_id)
      WHERE coalesce(valid_from <= as_of, valid_from IS NULL AND as_of IS NOT NULL) AND coalesce(as_of <= valid_to, valid_to IS NULL AND as_of IS NOT NULL)
        AND coalesce(valid_from <= valid_to, true)
      QUALIFY row_number() OVER (PARTITION BY content_id, field ORDER BY precedence DESC, valid_from DESC NULLS LAST, source, value NULLS FIRST) = 1)
    SELECT i.content_id, i.title, {", ".join(f"CASE WHEN o_{f}.content_id IS NOT NULL THEN o_{f}.value ELSE i.{f} END AS {f}" for f in overrides.CONTACTS)},
      concat_ws(' | ', {", ".join(map(_audit, overrides.CONTACTS))}) AS audit
    FROM items i {" ".join(f"LEFT JOIN best o_{f} ON o_{f}.content_id = i.content_id AND o_{f}.field = '{f}'" for f in overrides.CONTACTS)}""")
def contact_overrides(t):
    """Contacts as of each item's day, with a text per changed field."""
    made = overrides.apply_overrides(t.sql(_CONTACT_ITEMS), t.sql(_OVERRIDES))
    return made.select("content_id", "title", *overrides.CONTACTS, F.array_join("override_audit", " | ").alias("audit"))
