"""Hand-derived results for seven customers, five orders and four payments."""

from __future__ import annotations

from dataclasses import replace
from datetime import date, datetime
from decimal import Decimal as D

import pytest

from helpers import AS_OF, PARAMS, by_key, golden, rows
from martloom.plans import core


def test_dim_customers(spark):
    dim = golden(spark).ref("dim_customers")
    assert dim.columns == core.DIM_CUSTOMERS
    actual = by_key(
        dim, "customer_id", "total_orders", "total_spent", "activity_status", "customer_lifetime_days",
        "customer_tier", "days_between_orders",
    )
    assert actual == {
        1: (2, D("150.50"), "active", 46, "Regular", 23.0),
        2: (1, D("75.25"), "dormant", 5, "New", 5.0),
        3: (1, D("0.00"), "inactive", -65, "Prospect", -65.0),
        4: (1, D("150.75"), "dormant", 5, "Regular", 5.0),
        5: (0, D("0.00"), "inactive", 56, "Prospect", 0.0),
        6: (0, D("0.00"), "inactive", 56, "Prospect", 0.0),
        7: (0, D("0.00"), "inactive", 56, "Prospect", 0.0),
    }
    stamps = by_key(dim, "customer_id", "first_order_date", "last_order_date", "dbt_loaded_at")
    assert stamps[1] == (datetime(2024, 2, 20, 9), datetime(2024, 2, 20, 18), AS_OF)
    assert stamps[5] == (None, None, AS_OF)


def test_customer_metrics(spark):
    actual = by_key(
        golden(spark).ref("customer_metrics"), "customer_id", "avg_order_value", "recency_segment",
        "frequency_segment", "monetary_segment",
    )
    assert actual == {
        1: (75.25, "Active", "Low", "Low"),
        2: (75.25, "Warm", "Low", "Low"),
        3: (0.0, "Cold", "Low", "Low"),
        4: (150.75, "Warm", "Low", "Low"),
        5: (0.0, "Cold", "Low", "Low"),
        6: (0.0, "Cold", "Low", "Low"),
        7: (0.0, "Cold", "Low", "Low"),
    }


@pytest.mark.parametrize("unique_ids", [None, True, False])
def test_fct_orders(spark, unique_ids):
    facts = golden(spark, params=replace(PARAMS, unique_ids=unique_ids)).ref("fct_orders")
    assert facts.columns == core.FCT_ORDERS
    actual = by_key(
        facts, "order_id", "payment_count", "total_paid_amount", "payment_status", "distinct_payment_methods",
        "net_revenue", "paid_amount", "outstanding_amount", "order_day_of_week", "customer_name", "customer_tier",
    )
    assert actual == {
        1: (1, D("100.50"), "fully_paid", 1, D("100.50"), D("100.50"), D("0.00"), 2, "John Doe", "Regular"),
        2: (1, D("75.25"), "fully_paid", 1, D("75.25"), D("75.25"), D("0.00"), 3, "Jane Smith", "New"),
        3: (0, None, "unpaid", 0, D("0.00"), D("0.00"), D("200.00"), 3, "Bob Johnson", "Prospect"),
        4: (1, D("50.00"), "fully_paid", 1, D("50.00"), D("50.00"), D("0.00"), 2, "John Doe", "Regular"),
        5: (1, D("150.75"), "fully_paid", 1, D("150.75"), D("150.75"), D("0.00"), 3, "Alice Brown", "Regular"),
    }


def test_fct_daily_sales(spark):
    assert rows(
        golden(spark).ref("fct_daily_sales"), "order_date", "order_year", "order_month", "daily_orders",
        "daily_customers", "daily_revenue", "avg_order_value", "vip_revenue", "premium_revenue",
    ) == [
        (date(2024, 1, 10), 2024, 1, 2, 2, D("226.00"), 113.0, D("0.00"), D("0.00")),
        (date(2024, 2, 20), 2024, 2, 2, 1, D("150.50"), 75.25, D("0.00"), D("0.00")),
    ]


def test_fct_payments(spark):
    facts = golden(spark).ref("fct_payments")
    assert facts.columns == core.FCT_PAYMENTS
    assert by_key(facts, "payment_id", "order_id", "customer_name", "order_amount", "is_successful_payment") == {
        1: (1, "John Doe", D("100.50"), 1),
        2: (2, "Jane Smith", D("75.25"), 1),
        3: (4, "John Doe", D("50.00"), 1),
        4: (5, "Alice Brown", D("150.75"), 1),
    }


def test_customer_acquisition(spark):
    (row,) = golden(spark).ref("customer_acquisition").collect()
    assert (row.signup_date, row.signup_year, row.signup_month) == (date(2024, 1, 5), 2024, 1)
    assert (row.new_customers, row.activated_customers, row.total_orders_from_cohort) == (7, 4, 5)
    assert row.total_revenue_from_cohort == D("376.50")
    assert row.avg_lifetime_value == pytest.approx(376.5 / 7)
    assert row.avg_orders_per_customer == pytest.approx(5 / 7)
    assert row.activation_rate_percent == 57.14


def test_customer_geography(spark):
    actual = by_key(
        golden(spark).ref("customer_geography"), "country_code", "continent_group", "economic_tier",
        "total_customers", "activation_rate_percent", "vip_rate_percent",
    )
    assert actual == {
        "US": ("NA", "Tier 1", 1, 100.0, 0.0),
        "CA": ("NA", "Tier 1", 1, 100.0, 0.0),
        "GB": ("EU", "Tier 1", 1, 100.0, 0.0),
        "DE": ("EU", "Tier 1", 1, 0.0, 0.0),
        "AU": ("OC", "Tier 1", 1, 100.0, 0.0),
        "BR": ("SA", "Tier 2", 1, 0.0, 0.0),
        "CN": ("AS", "Tier 2", 1, 0.0, 0.0),
    }


def test_default_start_date_cuts_off_order_3(spark):
    dim = golden(spark, params=replace(PARAMS, start_date=datetime(2024, 1, 1))).ref("dim_customers")
    assert by_key(dim, "customer_id", "total_orders", "customer_lifetime_days")[3] == (0, 56)


def test_compact_marts(spark):
    warehouse = golden(spark)
    dim, fct = warehouse.ref("compact_dim_customers"), warehouse.ref("compact_fct_orders")
    assert dim.columns == [
        "customer_id", "customer_name", "email", "country_code", "total_orders", "total_spent",
        "last_order_date", "customer_segment", "processed_at",
    ]
    assert fct.columns == [
        "order_id", "customer_id", "customer_name", "amount", "status", "order_date", "country_code",
        "customer_segment", "processed_at",
    ]
    assert by_key(fct, "order_id", "customer_name", "country_code", "customer_segment")[5] == (
        "Alice Brown", "AU", "Regular",
    )
    assert dim.count() == 7 and fct.count() == 5


def test_invariants(spark):
    warehouse = golden(spark)
    facts = warehouse.ref("fct_orders")
    assert facts.count() == warehouse.ref("stg_orders").count()
    revenue = facts.filter("order_status = 'completed'").selectExpr("sum(net_revenue)").first()[0]
    assert warehouse.ref("fct_daily_sales").selectExpr("sum(daily_revenue)").first()[0] == revenue
    people = warehouse.ref("customer_geography").selectExpr("sum(total_customers)").first()[0]
    assert people == warehouse.ref("dim_customers").count()
    assert facts.filter("outstanding_amount != order_amount - coalesce(total_paid_amount, 0)").isEmpty()
