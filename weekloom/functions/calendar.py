"""Date expressions: mixed-format parsing, week snapping, calendar and holidays."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Accepted layouts; within a shape the first that reads wins, so that an
# ambiguous text is taken day before month.
YEAR_FIRST = ("yyyy-M-d", "yyyy-d-M")
YEAR_LAST = ("d-M-yyyy", "M-d-yyyy")
SHORT_YEAR = ("d-M-yy", "M-d-yy")
COMPACT = ("yyyyMMdd",)
NAMED = ("d-MMM-yyyy", "MMM-d-yyyy", "yyyy-MMM-d", "d-MMM-yy")

# US federal holidays on a fixed day, as (month, day, first year).
FIXED_HOLIDAYS = ((1, 1, 1870), (6, 19, 2021), (7, 4, 1870), (11, 11, 1978), (12, 25, 1870))

# US federal holidays on an n-th weekday, as
# (month, weekday with Monday = 0, first possible day, first year).
FLOATING_HOLIDAYS = (
    (1, 0, 15, 1986),
    (2, 0, 15, 1971),
    (5, 0, 25, 1971),
    (9, 0, 1, 1894),
    (10, 0, 8, 1971),
    (11, 3, 22, 1942),
)


def parse_mixed_date(text: Column, on_error: str = "raise") -> Column:
    """Text in any of the accepted layouts to DATE; null or blank text gives NULL.

    The text's shape picks the layouts: the place of the first separator, a month's name,
    no separator at all, or a year of two digits (2000 to 2099). An ordinary text is read
    at the first attempt and costs no failed parse.
    ``on_error='raise'`` fails the job on the first unreadable text, inside the same
    scan, so no separate counting pass is needed; ``'null'`` turns it into NULL.
    """
    day = F.regexp_replace(F.trim(text), r"[T ]\d{1,2}:.*$", "")
    named = day.rlike("[A-Za-z]{3}")
    # Month names by their first three letters, whatever the case and the separators.
    letters = F.initcap(F.regexp_replace(day, r"(?i)([a-z]{3})[a-z]*", "$1"))
    letters = F.regexp_replace(F.translate(letters, ",", " "), r"[\s./-]+", "-")
    day = F.translate(day, "/.", "--")
    digits = day.rlike(r"^\d{8}$")
    short = day.rlike(r"^\d{1,2}-\d{1,2}-\d{2}$")

    def read(layouts: tuple[str, ...], text: Column = day) -> Column:
        return F.coalesce(*[F.try_to_timestamp(text, F.lit(p)).cast("date") for p in layouts])

    parsed = (
        F.when(named, read(NAMED, letters))
        .when(digits, read(COMPACT))
        .when(short, read(SHORT_YEAR))
        .when(F.instr(day, "-") == 5, read(YEAR_FIRST))
        .otherwise(read(YEAR_LAST))
    )
    if on_error == "null":
        return parsed
    junk = parsed.isNull() & (F.trim(text) != "")
    complaint = F.raise_error(F.concat(F.lit("Unparseable date: "), text)).cast("date")
    return F.when(junk, complaint).otherwise(parsed)


def week_ending(day: Column) -> Column:
    """Snap a date forward to its Saturday; a Saturday stays."""
    return F.next_day(F.date_sub(day, 1), "SAT")


def calendar_columns(day: Column) -> dict[str, Column]:
    month, week = F.month(day), F.weekofyear(day)
    return {
        "month": month,
        "week_of_year": week,
        "year": F.year(day),
        "quarter": F.quarter(day),
        "day_of_week": F.weekday(day),
    }


def cyclical_columns(day: Column) -> dict[str, Column]:
    out = {}
    for name, value, period in (
        ("month", F.month(day), 12),
        ("week_of_year", F.weekofyear(day), 52),
    ):
        angle = value * F.lit(2 * math.pi) / F.lit(period)
        out[f"{name}_sin"] = F.sin(angle)
        out[f"{name}_cos"] = F.cos(angle)
    return out


def weeks_between(later: Column, earlier: Column) -> Column:
    return (F.date_diff(later, earlier) / 7).cast("int")


def holiday_week(week_end: Column) -> Column:
    """1 when the Sunday-to-Saturday week ending at ``week_end`` has a federal holiday.

    Plain date arithmetic, so there is no dimension to ship and nothing to join.
    Every fixed holiday falls in the same year as its Saturday; observed days
    (Friday before, Monday after) never leave the week of the holiday itself.
    """
    hits = []
    for month, day, since in FIXED_HOLIDAYS:
        gap = F.date_diff(week_end, F.make_date(F.year(week_end), F.lit(month), F.lit(day)))
        hits.append(gap.between(0, 6) & (F.year(week_end) >= since))
    for month, weekday, first, since in FLOATING_HOLIDAYS:
        day = F.date_sub(week_end, 5 - weekday)
        hits.append(
            (F.month(day) == month)
            & F.dayofmonth(day).between(first, first + 6)
            & (F.year(day) >= since)
        )
    flag = hits[0]
    for hit in hits[1:]:
        flag = flag | hit
    return flag.cast("int")


def is_federal_holiday(day: Column) -> Column:
    """Day-level test, including the observed Friday or Monday of a weekend holiday."""

    def actual(d: Column) -> Column:
        hits = [
            (F.month(d) == m) & (F.dayofmonth(d) == n) & (F.year(d) >= since)
            for m, n, since in FIXED_HOLIDAYS
        ]
        hits += [
            (F.month(d) == m)
            & (F.weekday(d) == w)
            & F.dayofmonth(d).between(first, first + 6)
            & (F.year(d) >= since)
            for m, w, first, since in FLOATING_HOLIDAYS
        ]
        out = hits[0]
        for hit in hits[1:]:
            out = out | hit
        return out

    friday = (F.weekday(day) == 4) & actual(F.date_add(day, 1))
    monday = (F.weekday(day) == 0) & actual(F.date_sub(day, 1))
    return actual(day) | friday | monday


def federal_holidays(spark: SparkSession, first_year: int, last_year: int) -> DataFrame:
    """The holiday days of a span of years as a table (one row per day)."""
    days = spark.range(1).select(
        F.explode(
            F.sequence(
                F.make_date(F.lit(first_year), F.lit(1), F.lit(1)),
                F.make_date(F.lit(last_year), F.lit(12), F.lit(31)),
            )
        ).alias("holiday")
    )
    return days.filter(is_federal_holiday(F.col("holiday")))
