"""Dates on the axis of a season."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rillflow.config import SEASON_MONTHS


def season(date: Column) -> Column:
    """A season is named by its year."""
    return F.year(date)


def day_of_season(date: Column, first_month: int = SEASON_MONTHS[0]) -> Column:
    """1 on the first day of the season of the date's year; below 1 before it."""
    return F.datediff(date, F.make_date(F.year(date), F.lit(first_month), F.lit(1))) + 1


def in_season(date: Column, months: tuple[int, int] = SEASON_MONTHS) -> Column:
    """Whether the month lies in the inclusive range."""
    return F.month(date).between(*months)


def same_calendar_date(date: Column, target: Column) -> Column:
    """Same month and day in an earlier year. 29 February has no match in other years: no special case."""
    return (F.month(date) == F.month(target)) & (F.dayofmonth(date) == F.dayofmonth(target)) & (date < target)


def season_to_date(date: Column, target: Column, first_month: int = SEASON_MONTHS[0]) -> Column:
    """Whether the date lies in its own year's season, not later in it than the target in its."""
    day = day_of_season(date, first_month)
    return (day >= 1) & (day <= day_of_season(target, first_month))


def in_window(iso: Column, first: str | None = None, last: str | None = None) -> Column:
    """Whether an ISO date as text lies in an inclusive window; an end that is None is open."""
    return iso.between(first or "0000-00-00", last or "9999-99-99")


def spine(spark: SparkSession, first: str, last: str, name: str = "d") -> DataFrame:
    """Every calendar day from first to last."""
    return spark.range(1).select(F.explode(F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"))).alias(name))


def date_token(date: Column) -> Column:
    """The ISO date as base64, for stores that address documents by such tokens."""
    return F.base64(F.encode(F.date_format(date, "yyyy-MM-dd"), "utf-8"))


def parse_day_first(text: Column) -> Column:
    """The date of a line such as 'Date :- 05-09-2024'; null if there is none or it isn't a date."""
    parts = [F.regexp_extract(text, r"(?i)Date\s*:-?\s*(\d{2})-(\d{2})-(\d{4})", k) for k in (3, 2, 1)]
    return F.try_to_timestamp(F.concat_ws("-", *parts), F.lit("yyyy-MM-dd")).cast("date")
