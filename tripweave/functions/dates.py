"""Calendar scalars.  Dates stay ISO strings, '' means unknown."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tripweave.functions.text import strip

# yyyyMMdd, yyyy-MM-dd or yyyy.MM.dd; one-digit months and days are allowed.
_DATE = (
    r"\A(\d{4})([-.]?)(1[0-2]|0[1-9]|[1-9])\2(3[01]|[12]\d|0[1-9]|[1-9]| [1-9])\z"
)


def strict_iso_date(col: Column) -> Column:
    """ISO date of a real calendar day, else ''."""
    text = strip(F.coalesce(col, F.lit("")))
    ymd = F.concat_ws(
        "-",
        F.regexp_extract(text, _DATE, 1),
        F.regexp_extract(text, _DATE, 3),
        F.trim(F.regexp_extract(text, _DATE, 4)),
    )
    day = F.try_to_date(F.when(text.rlike(_DATE), ymd), "y-M-d")
    return F.coalesce(F.date_format(day, "yyyy-MM-dd"), F.lit(""))


def structural_iso_date(col: Column) -> Column:
    """ISO form by shape only: eight digits or ten dashed characters.

    The calendar is not consulted; use ``strict_iso_date`` for that.
    """
    text = strip(F.coalesce(col, F.lit("")))
    dashed = (F.length(text) == 10) & (F.substring(text, 5, 1) == "-") & (F.substring(text, 8, 1) == "-")
    return (
        F.when(text.rlike(r"\A\d{8}\z"), F.regexp_replace(text, r"\A(\d{4})(\d{2})(\d{2})\z", "$1-$2-$3"))
        .when(dashed, text)
        .otherwise(F.lit(""))
    )


def iso_month(iso: Column) -> Column:
    """Month number of an ISO date, null when there is none."""
    return F.substring(iso, 6, 2).try_cast("int")


def season(month: Column) -> Column:
    """Season of a month; a month outside 1-11 that is not 12 is autumn."""
    return (
        F.when(month.isNull(), F.lit(None).cast("string"))
        .when(month.isin(12, 1, 2), F.lit("winter"))
        .when(month.isin(3, 4, 5), F.lit("spring"))
        .when(month.isin(6, 7, 8), F.lit("summer"))
        .otherwise(F.lit("autumn"))
    )


def calendar_season(month: Column) -> Column:
    """Season of a month, ``unknown`` outside 1-12."""
    return F.when(month.between(1, 12), season(month)).when(month.isNotNull(), F.lit("unknown"))


def visit_months_span(start_iso: Column, end_iso: Column) -> Column:
    """Sorted distinct months touched between two dates, over years."""
    start, end = F.try_to_date(start_iso, "yyyy-MM-dd"), F.try_to_date(end_iso, "yyyy-MM-dd")
    steps = (F.year(end) - F.year(start)) * 12 + F.month(end) - F.month(start)
    first, last = F.month(start), F.month(end)
    # Eleven steps cover every month; otherwise the span is one run of months,
    # or two when it crosses New Year.
    return (
        F.when(steps >= 11, F.sequence(F.lit(1), F.lit(12)))
        .when((steps >= 0) & (first <= last), F.sequence(first, last))
        .when(steps >= 0, F.concat(F.sequence(F.lit(1), last), F.sequence(first, F.lit(12))))
        .otherwise(F.array().cast("array<int>"))
    )


def visit_months_cyclic(start_iso: Column, end_iso: Column) -> Column:
    """Months from start to end, wrapping over New Year; years are ignored."""
    none = F.array().cast("array<int>")
    start, end = iso_month(start_iso), iso_month(end_iso)
    until_december = F.when(start <= 12, F.sequence(start, F.lit(12))).otherwise(none)
    from_january = F.when(end >= 1, F.sequence(F.lit(1), end)).otherwise(none)
    return (
        F.when(start.isNull(), none)
        .when(end.isNull(), F.array(start))
        .when(start <= end, F.sequence(start, end))
        .otherwise(F.concat(until_december, from_january))
    )


def stat_month(col: Column) -> Column:
    """``YYYYMM`` of ``YYYY-MM`` or ``YYYYMM``, else ''."""
    text = strip(F.coalesce(col, F.lit("")))
    dashed = (F.length(text) == 7) & (F.substring(text, 5, 1) == "-")
    return (
        F.when(dashed, F.replace(text, F.lit("-"), F.lit("")))
        .when(text.rlike(r"\A\d{6}\z"), text)
        .otherwise(F.lit(""))
    )


def strict_stat_month(col: Column) -> Column:
    """``YYYYMM`` when the text is digits in one of the two shapes.

    A five-digit text such as ``20261`` is year plus one-digit month.
    """
    text = strip(F.coalesce(col, F.lit("")))
    return (
        F.when(text.rlike(r"\A\d{4}-\d{2}\z"), F.replace(text, F.lit("-"), F.lit("")))
        .when(text.rlike(r"\A\d{6}\z"), text)
        .when(text.rlike(r"\A\d{4}[1-9]\z"), F.regexp_replace(text, r"\A(\d{4})(\d)\z", "$10$2"))
        .otherwise(F.lit(""))
    )


def festival_sort_key(content_id: Column, start_iso: Column) -> Column:
    """``FESTIVAL#MM#id`` of the start month; 00 for undated festivals."""
    long_enough = F.length(F.coalesce(start_iso, F.lit(""))) >= 7
    month = F.coalesce(F.when(long_enough, iso_month(start_iso)), F.lit(0))
    return F.format_string("FESTIVAL#%02d#%s", month, content_id)


def days_in_month(year: Column, month: Column) -> Column:
    return F.day(F.last_day(F.make_date(year, month, F.lit(1))))


def month_grid(year: str) -> Column:
    """``array<struct<month_no,start_ymd,end_ymd,month,days>>`` of the year in
    a column."""
    return F.expr(f"""transform(sequence(1, 12), m -> named_struct(
        'month_no', m,
        'start_ymd', format_string('%04d%02d01', {year}, m),
        'end_ymd', date_format(last_day(make_date({year}, m, 1)), 'yyyyMMdd'),
        'month', format_string('%04d-%02d', {year}, m),
        'days', day(last_day(make_date({year}, m, 1)))))""")


def date_range_text(start: Column, end: Column) -> Column:
    """``start~end`` without a dangling tilde."""
    both = F.concat(F.coalesce(start, F.lit("")), F.lit("~"), F.coalesce(end, F.lit("")))
    return F.regexp_replace(both, r"\A~+|~+\z", "")


def ingest_date_key(col: Column) -> Column:
    """Eight-digit ingest date, null when it is malformed."""
    digits = F.replace(strip(col), F.lit("-"), F.lit(""))
    return F.when(digits.rlike(r"\A\d{8}\z"), digits)
