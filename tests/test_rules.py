"""Business rules at their boundaries, and the calendar."""

from __future__ import annotations

from datetime import date, datetime, timedelta
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from helpers import AS_OF, PARAMS
from martloom.functions import calendar, segments, times
from martloom.schemas import DIM_DATES, MONEY, MONEY_SUM
from martloom.sources.reference import in_memory

# Rows of the calendar (date, weekday, day and month name, weekend, holiday,
# business day, week of year, season, quarter).
CALENDAR = [
    (date(2023, 1, 1), 7, "Sunday", "January", True, True, False, 1, "Winter", 1),
    (date(2023, 1, 2), 1, "Monday", "January", False, False, True, 1, "Winter", 1),
    (date(2023, 1, 7), 6, "Saturday", "January", True, False, False, 1, "Winter", 1),
    (date(2023, 1, 8), 7, "Sunday", "January", True, False, False, 2, "Winter", 1),
    (date(2023, 2, 14), 2, "Tuesday", "February", False, True, False, 7, "Winter", 1),
    (date(2023, 3, 17), 5, "Friday", "March", False, True, False, 11, "Spring", 1),
    (date(2023, 4, 1), 6, "Saturday", "April", True, False, False, 13, "Spring", 2),
    (date(2023, 5, 1), 1, "Monday", "May", False, True, False, 18, "Spring", 2),
    (date(2023, 6, 1), 4, "Thursday", "June", False, False, True, 22, "Summer", 2),
    (date(2023, 8, 15), 2, "Tuesday", "August", False, False, True, 33, "Summer", 3),
    (date(2023, 9, 1), 5, "Friday", "September", False, False, True, 35, "Autumn", 3),
    (date(2023, 11, 23), 4, "Thursday", "November", False, True, False, 47, "Autumn", 4),
    (date(2023, 12, 25), 1, "Monday", "December", False, True, False, 52, "Winter", 4),
    (date(2023, 12, 31), 7, "Sunday", "December", True, False, False, 52, "Winter", 4),
    (date(2024, 1, 1), 1, "Monday", "January", False, True, False, 1, "Winter", 1),
]


def outcomes(spark, kind: T.DataType, values: list, rule) -> list:
    """The rule's result for each value, in order."""
    schema = T.StructType([T.StructField("i", T.IntegerType()), T.StructField("x", kind)])
    df = in_memory(spark, list(enumerate(values)), schema)
    return [row[1] for row in sorted(df.select("i", rule(F.col("x")).alias("y")).collect())]


def money(*texts):
    return [None if text is None else D(text).quantize(D("0.01")) for text in texts]


def test_customer_tier(spark):
    values = money("-1", "0", "0.01", "99.99", "100", "499.99", "500", "999.99", "1000", None)
    assert outcomes(spark, MONEY_SUM, values, lambda x: segments.customer_tier(x, PARAMS)) == [
        "Prospect", "Prospect", "New", "New", "Regular", "Regular", "Premium", "Premium", "VIP", "Prospect",
    ]


def test_monetary_segment(spark):
    values = money("0", "499.99", "500", "999.99", "1000", None)
    assert outcomes(spark, MONEY_SUM, values, lambda x: segments.monetary_segment(x, PARAMS)) == [
        "Low", "Low", "Medium", "Medium", "High", "Low",
    ]


def test_frequency_segment(spark):
    assert outcomes(spark, T.LongType(), [0, 4, 5, 9, 10, None], lambda x: segments.frequency_segment(x, PARAMS)) == [
        "Low", "Low", "Medium", "Medium", "High", "Low",
    ]


def _ago(*days, **more):
    return [None if day is None else AS_OF - timedelta(days=day, **more) for day in days]


def test_recency_segment(spark):
    values = _ago(0, 30, 31, 90, 91, None)
    assert outcomes(spark, T.TimestampNTZType(), values, lambda x: segments.recency_segment(x, PARAMS)) == [
        "Active", "Active", "Warm", "Warm", "Cold", "Cold",
    ]


def test_activity_status(spark):
    values = _ago(30) + _ago(30, seconds=1) + _ago(90) + _ago(90, seconds=1) + [None]
    assert outcomes(spark, T.TimestampNTZType(), values, lambda x: segments.activity_status(x, PARAMS)) == [
        "active", "dormant", "dormant", "inactive", "inactive",
    ]


@pytest.mark.parametrize(
    ("count", "paid", "amount", "expected"),
    [
        (0, None, "10", "unpaid"),
        (1, "10", "10", "fully_paid"),
        (2, "10.01", "10", "fully_paid"),
        (1, "9.99", "10", "partially_paid"),
        (1, None, "10", "partially_paid"),
        (1, "0", "0", "fully_paid"),
    ],
)
def test_order_payment_status(spark, count, paid, amount, expected):
    def cast(text):
        return F.lit(None if text is None else D(text)).cast(MONEY)

    status = segments.order_payment_status(F.lit(count), cast(paid), cast(amount))
    assert spark.range(1).select(status).first()[0] == expected


def test_order_amounts(spark):
    amount, none = F.lit(D("10.00")).cast(MONEY), F.lit(None).cast(MONEY)
    row = spark.range(1).select(
        segments.net_revenue(F.lit("completed"), amount),
        segments.net_revenue(F.lit("pending"), amount),
        segments.paid_amount(F.lit("fully_paid"), amount),
        segments.paid_amount(F.lit("partially_paid"), amount),
        segments.paid_amount(F.lit(None), amount),
        segments.outstanding_amount(amount, none),
        segments.outstanding_amount(amount, F.lit(D("12.50"))),
    )
    assert list(row.first()) == [D("10.00"), D("0"), D("10.00"), D("0"), D("0"), D("10.00"), D("-2.50")]


def test_ratios(spark):
    row = spark.range(1).select(
        segments.percent_of(F.lit(4), F.lit(7)),
        segments.percent_of(F.lit(1), F.lit(0)),
        segments.mean(F.lit(D("1.00")), F.lit(3)),
        segments.days_between_orders(F.lit(5), F.lit(0)),
        segments.days_between_orders(F.lit(5), F.lit(2)),
        segments.avg_order_value(F.lit(D("5.00")), F.lit(0)),
        segments.avg_order_value(F.lit(D("5.00")), F.lit(2)),
    )
    assert list(row.first()) == [57.14, None, 1 / 3, 0.0, 2.5, 0.0, 2.5]


def test_labels(spark):
    kind = T.StringType()
    assert outcomes(
        spark, kind, ["North America", "Europe", "Asia", "South America", "Africa", "Oceania", "Arctic", None],
        segments.continent_group,
    ) == ["NA", "EU", "AS", "SA", "AF", "OC", "Other", "Other"]
    assert outcomes(
        spark, kind, ["High Income", "Upper Middle Income", "Lower Middle Income", None], segments.economic_tier
    ) == ["Tier 1", "Tier 2", "Tier 3", "Tier 3"]
    assert outcomes(spark, kind, ["completed", "failed", None], segments.is_successful_payment) == [1, 0, 0]


def test_days_count_midnights(spark):
    start, end = times.at(datetime(2024, 1, 5, 23)), times.at(datetime(2024, 1, 6, 1))
    row = spark.range(1).select(times.days_between(start, end), times.days_between(end, start)).first()
    assert list(row) == [1, -1]


def test_captured_times(spark):
    values = ["1704067207179575", "-1", "2024-01-01T00:00:07.179575Z", "2024-01-01 00:00:07", "soon", None]
    expected = [
        datetime(2024, 1, 1, 0, 0, 7, 179575), datetime(1969, 12, 31, 23, 59, 59, 999999),
        datetime(2024, 1, 1, 0, 0, 7, 179575), datetime(2024, 1, 1, 0, 0, 7), None, None,
    ]
    assert outcomes(spark, T.StringType(), values, times.captured_time) == expected


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_times_do_not_depend_on_the_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", zone)
        # 2024-03-10 02:30 does not exist in New York.
        values = ["1710037800000000", "2024-03-10 02:30:00"]
        assert outcomes(spark, T.StringType(), values, times.captured_time) == [datetime(2024, 3, 10, 2, 30)] * 2
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_calendar(spark):
    days = in_memory(spark, [(row[0],) for row in CALENDAR], T.StructType([T.StructField("date", T.DateType())]))
    dates = calendar.with_calendar(days)
    assert [(f.name, f.dataType) for f in dates.schema] == [(f.name, f.dataType) for f in DIM_DATES]
    columns = [
        "date", "day_of_week", "day_name", "month_name", "is_weekend", "is_holiday", "is_business_day",
        "week_of_year", "season", "quarter",
    ]
    assert sorted(tuple(row) for row in dates.select(*columns).collect()) == CALENDAR
    assert dates.filter("fiscal_year != year or fiscal_quarter != quarter or day != day(date)").isEmpty()


def test_leap_year_has_52_weeks(spark):
    days = spark.sql("SELECT explode(sequence(date'2024-02-28', date'2024-12-31')) AS date")
    assert calendar.with_calendar(days).selectExpr("max(week_of_year)", "count(*)").first()[:] == (52, 308)


def test_own_holidays(spark):
    days = spark.sql("SELECT date'2024-07-03' AS date")
    row = calendar.with_calendar(days, holidays=(date(2024, 7, 3),)).first()
    assert row.is_holiday and not row.is_business_day
    assert not calendar.with_calendar(days, holidays=()).first().is_holiday


def test_money_is_rounded_half_up(spark):
    values = [1.005, 2.675, 0.125, None]
    assert outcomes(spark, T.DoubleType(), values, lambda x: x.cast(MONEY)) == money("1.01", "2.68", "0.13", None)
