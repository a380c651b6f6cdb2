"""Recurrence rules of festivals: inferred from past editions, written as text, expanded into dates.

The editions of a festival, in order, fall into islands: a pause of more than
``pause_days`` ends one, and the last island counts.  Inside it a rule fits if
every edition obeys it, so missed editions are allowed (the interval is the
greatest common divisor of all gaps).  Rules, the first that fits wins:

* ``FREQ=YEARLY;INTERVAL=n;BYMONTH=m;BYMONTHDAY=d``: a fixed date
* ``FREQ=YEARLY;INTERVAL=n;BYMONTH=m;BYDAY=2SA``: the nth weekday of a month, or
  the last one (``-1SA``)
* ``FREQ=MONTHLY;INTERVAL=n;BYMONTHDAY=d`` and ``FREQ=MONTHLY;INTERVAL=n;BYDAY=2SA``
* ``FREQ=WEEKLY;INTERVAL=n;BYDAY=SA``, if no gap is longer than 26 intervals
* ``FREQ=DAILY;INTERVAL=n``, if no gap is longer than 31 days
"""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DAYS = ("MO", "TU", "WE", "TH", "FR", "SA", "SU")
PAUSE_DAYS = 5 * 366
LONGEST_DAYS = 20 * 366  # of a horizon


def _divisor(values: Column) -> Column:
    """Greatest common divisor of a list of whole numbers; 0 for an empty one."""
    def step(a: Column, b: Column) -> Column:
        # 40 halvings bring any two ints to an end
        pair = F.aggregate(
            F.sequence(F.lit(1), F.lit(48)),
            F.struct(a.alias("a"), b.alias("b")),
            lambda s, _: F.when(s["b"] == 0, s).otherwise(F.struct(s["b"].alias("a"), (s["a"] % F.greatest(s["b"], F.lit(1))).alias("b"))),
        )
        return pair["a"]

    return F.aggregate(values, F.lit(0), step)


def recurrence_rules(editions: DataFrame, least: int = 3, pause_days: int = PAUSE_DAYS) -> DataFrame:
    """festival, recurrence_rule, editions, first_start, last_start, days of every festival with an edition.

    ``editions`` is (festival, start, end), dates; several rows of one start are
    one edition, the longest.  ``editions`` counts those of the last island; with
    fewer than ``least`` of them, or if no rule fits, the rule is null.  ``days``
    is the length of the last edition, 1 without an end.  Rows without festival
    or start take no part.
    """
    known = editions.where("festival IS NOT NULL AND start IS NOT NULL")
    length = F.greatest(F.coalesce(F.datediff("end", "start") + 1, F.lit(1)), F.lit(1))
    # one row per festival and day: a festival has no more rows than the calendar has days
    starts = known.groupBy("festival", "start").agg(F.max(length).alias("days"))
    order = Window.partitionBy("festival").orderBy("start")
    gaps = starts.withColumn("gap", F.datediff("start", F.lag("start").over(order)))
    islands = gaps.withColumn("island", F.sum(F.when(F.col("gap") > pause_days, 1).otherwise(0)).over(order))
    month = F.year("start") * 12 + F.month("start") - 1
    facts = islands.withColumns(
        {
            "gap": F.when(F.col("gap") <= pause_days, F.col("gap")),
            "month": month,
            "leap": F.when(F.col("gap") <= pause_days, month - F.lag(month).over(order)),
            "nth": F.floor((F.dayofmonth("start") - 1) / 7).cast("int") + 1,
            "closing": F.dayofmonth("start") > F.dayofmonth(F.last_day("start")) - 7,
        }
    )
    same = lambda c: F.min(c) == F.max(c)
    # distinct gaps, not editions, are listed; both are bounded by the calendar
    seen = facts.groupBy("festival", "island").agg(
        F.count("*").cast("int").alias("editions"), F.min("start").alias("first_start"), F.max("start").alias("last_start"),
        F.max_by("days", "start").alias("days"), same(F.month("start")).alias("one_month"), same(F.dayofmonth("start")).alias("one_day"),
        same(F.weekday("start")).alias("one_weekday"), same("nth").alias("one_nth"), F.min("nth").alias("nth"), F.every("closing").alias("closing"),
        F.min(F.coalesce("leap", F.lit(1))).alias("least_leap"), _divisor(F.collect_set("gap")).alias("step_days"),
        _divisor(F.collect_set("leap")).alias("step_months"), F.max("gap").alias("longest"),
    )
    last = seen.groupBy("festival").agg(F.max_by(F.struct(*(c for c in seen.columns if c != "festival")), "island").alias("r")).select("festival", "r.*")
    weekday = F.element_at(F.array(*map(F.lit, DAYS)), F.weekday("last_start") + 1)
    text = lambda c: F.col(c).cast("string") if isinstance(c, str) else c.cast("string")
    by_day = F.concat(F.lit(";BYDAY="), F.when(F.col("one_nth"), text("nth")).otherwise("-1"), weekday)
    nth = F.col("one_weekday") & (F.col("one_nth") | F.col("closing"))
    on_date = F.concat(F.lit(";BYMONTHDAY="), text(F.dayofmonth("last_start")))
    every_year = F.concat(F.lit("FREQ=YEARLY;INTERVAL="), text((F.col("step_months") / 12).cast("int")), F.lit(";BYMONTH="), text(F.month("last_start")))
    every_month = F.concat(F.lit("FREQ=MONTHLY;INTERVAL="), text("step_months"))
    rule = (
        F.when(F.col("editions") < least, None)
        .when(F.col("one_month") & (F.col("least_leap") > 0) & F.col("one_day"), F.concat(every_year, on_date))
        .when(F.col("one_month") & (F.col("least_leap") > 0) & nth, F.concat(every_year, by_day))
        .when((F.col("least_leap") > 0) & F.col("one_day"), F.concat(every_month, on_date))
        .when((F.col("least_leap") > 0) & nth, F.concat(every_month, by_day))
        .when((F.col("step_days") % 7 == 0) & (F.col("longest") <= 26 * F.col("step_days")), F.concat(F.lit("FREQ=WEEKLY;INTERVAL="), text((F.col("step_days") / 7).cast("int")), F.lit(";BYDAY="), weekday))
        .when(F.col("longest") <= 31, F.concat(F.lit("FREQ=DAILY;INTERVAL="), text("step_days")))
    )
    return last.select("festival", rule.alias("recurrence_rule"), "editions", "first_start", "last_start", "days")


def next_editions(rules: DataFrame, since: datetime.date, until: datetime.date) -> DataFrame:
    """festival, start, end of all editions that the rules give from ``since`` to ``until``, after the last known one.

    ``rules`` is (festival, recurrence_rule, last_start, days).  Dates that a
    month does not have are left out.  A horizon is 20 years long at most, so a
    festival gives a bounded number of rows.
    """
    if (until - since).days > LONGEST_DAYS:
        raise ValueError("the horizon is longer than 20 years")
    rule, last = F.col("recurrence_rule"), F.col("last_start")
    part = lambda name: F.regexp_extract(rule, f"{name}=([^;]+)", 1)
    number = lambda c: F.expr(f"try_cast(nullif({c}, '') AS int)")
    parsed = rules.where("recurrence_rule IS NOT NULL").select(
        "festival", "days", last.alias("_last"), part("FREQ").alias("_freq"), part("INTERVAL").alias("_step"),
        part("BYMONTHDAY").alias("_day"), F.regexp_extract(rule, "BYDAY=(-?[0-9]+)", 1).alias("_nth"),
    ).withColumns({"_step": number("_step"), "_day": number("_day"), "_nth": number("_nth")})
    first, final = F.greatest(F.date_add("_last", 1), F.lit(since)), F.lit(until)
    months = F.when(F.col("_freq") == "YEARLY", F.col("_step") * 12).when(F.col("_freq") == "MONTHLY", F.col("_step"))
    days = F.when(F.col("_freq") == "WEEKLY", F.col("_step") * 7).when(F.col("_freq") == "DAILY", F.col("_step"))
    month_of = lambda d: F.year(d) * 12 + F.month(d) - 1
    far = parsed.withColumns({"_months": months, "_days": days}).where(first <= final)
    # steps from the last edition on, counted so that the first one falls into the horizon
    skip = F.greatest(F.floor((month_of(first) - month_of(F.col("_last"))) / F.col("_months")), F.lit(0))
    steps = F.floor((month_of(final) - month_of(F.col("_last"))) / F.col("_months"))
    by_month = F.when(steps >= skip, F.transform(F.sequence(skip, steps), lambda k: (month_of(F.col("_last")) + k * F.col("_months")).cast("int")))

    def in_month(m: Column) -> Column:
        begin = F.make_date(F.floor(m / 12).cast("int"), (m % 12 + 1).cast("int"), F.lit(1))
        size = F.dayofmonth(F.last_day(begin))
        offset = F.pmod(F.weekday("_last") - F.weekday(begin), F.lit(7))
        nth = F.when(F.col("_nth") > 0, offset + 7 * (F.col("_nth") - 1) + 1).otherwise(offset + 1 + 7 * F.floor((size - offset - 1) / 7).cast("int"))
        day = F.coalesce("_day", nth)
        return F.when(day <= size, F.date_add(begin, (day - 1).cast("int")))

    skip_days = F.greatest(F.ceil(F.datediff(first, "_last") / F.col("_days")), F.lit(1))
    steps_days = F.floor(F.datediff(final, F.col("_last")) / F.col("_days"))
    by_day = F.when(steps_days >= skip_days, F.transform(F.sequence(skip_days, steps_days), lambda k: F.date_add("_last", (k * F.col("_days")).cast("int"))))
    dates = F.when(F.col("_months").isNotNull(), F.transform(by_month, in_month)).otherwise(by_day)
    made = far.select("festival", "days", "_last", F.explode(dates).alias("start"))
    kept = made.where(F.col("start").between(F.lit(since), F.lit(until)) & (F.col("start") > F.col("_last")))
    return kept.select("festival", "start", F.date_add("start", F.col("days") - 1).alias("end"))
