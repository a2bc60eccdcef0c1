"""Attributes of a calendar date."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.functions.times import iso_weekday
from martloom.schemas import DIM_DATES

# The days marked as holidays.
HOLIDAYS = (
    date(2023, 1, 1),
    date(2023, 2, 14),
    date(2023, 3, 17),
    date(2023, 5, 1),
    date(2023, 7, 4),
    date(2023, 11, 23),
    date(2023, 12, 25),
    date(2024, 1, 1),
)

# First month of each season; December belongs to winter.
SEASON_STARTS = {"Spring": 3, "Summer": 6, "Autumn": 9, "Winter": 12}


def season(day: Column) -> Column:
    month = F.month(day)
    label = F.when(month >= SEASON_STARTS["Winter"], "Winter")
    for name in ("Autumn", "Summer", "Spring"):
        label = label.when(month >= SEASON_STARTS[name], name)
    return label.otherwise("Winter")


def week_of_year(day: Column) -> Column:
    """Weeks of seven days counted from January 1st; the rest of the year belongs to week 52 (not ISO)."""
    return F.least(F.lit(52), F.ceil(F.dayofyear(day) / 7)).cast("int")


def with_calendar(days: DataFrame, holidays: tuple[date, ...] = HOLIDAYS) -> DataFrame:
    """The date dimension for a frame with one `date` column."""
    day = F.col("date")
    weekend = iso_weekday(day) >= 6
    holiday = day.isin(list(holidays)) if holidays else F.lit(False)
    attributes = {
        "date": day,
        "day": F.day(day),
        "month": F.month(day),
        "year": F.year(day),
        "quarter": F.quarter(day),
        "day_of_week": iso_weekday(day),
        "day_name": F.date_format(day, "EEEE"),
        "month_name": F.date_format(day, "MMMM"),
        "is_weekend": weekend,
        "is_holiday": holiday,
        "is_business_day": ~weekend & ~holiday,
        "week_of_year": week_of_year(day),
        "season": season(day),
        "fiscal_year": F.year(day),
        "fiscal_quarter": F.quarter(day),
    }
    return days.select(*[attributes[field.name].cast(field.dataType).alias(field.name) for field in DIM_DATES])


def date_range(bounds: DataFrame, first: str, last: str) -> DataFrame:
    """Every day between the two dates of a one-row frame."""
    return bounds.select(F.explode(F.sequence(F.col(first), F.col(last))).alias("date"))
