"""Each check once with clean and once with violating rows."""

from __future__ import annotations

from dataclasses import replace
from datetime import timedelta
from decimal import Decimal as D

import pytest
from pyspark.sql import types as T

from helpers import AS_OF, PARAMS, customer, golden, order, rows
from martloom.functions.cleaning import with_defaults
from martloom.operators import quality
from martloom.plans import checks
from martloom.schemas import CUSTOMERS, DEFAULT_VALUES, ORDERS
from martloom.sources.reference import in_memory


def result(check):
    (row,) = check.collect()
    assert row.passed == (row.violations == 0)
    return row.check_name, row.violations


def customers(spark, *data):
    return in_memory(spark, data, CUSTOMERS)


def orders(spark, *data):
    return in_memory(spark, data, ORDERS)


def test_golden_rows_are_clean(spark):
    built = golden(spark)
    facts, dim = built.ref("fct_orders"), built.ref("dim_customers")
    checks = quality.all_of(
        quality.count_violations("future", quality.future_rows(facts, "ordered_at", PARAMS)),
        quality.count_violations("revenue", quality.revenue_mismatches(facts)),
        quality.count_violations("emails", quality.malformed_emails(dim)),
        quality.not_null("customers", built.source("customers"), ["name", "email"]),
        quality.unique("customers", built.source("customers"), ["id"]),
        quality.references("orders", built.source("orders"), "customer_id", "customers", built.source("customers"), "id"),
        quality.non_negative("orders", built.source("orders"), "amount"),
    )
    assert quality.only_failed(checks).isEmpty()
    quality.require_passed(checks)


def test_floors_and_freshness_fail_on_golden_rows(spark):
    built = golden(spark)
    floors = quality.all_of(
        quality.row_floor("stg_customers", built.ref("stg_customers"), 100),
        quality.row_floor("fct_orders", built.ref("fct_orders"), 500),
        quality.row_floor("exact", built.ref("fct_orders"), 5),
    )
    assert rows(floors) == [("exact", 0, True), ("fct_orders", 495, False), ("stg_customers", 93, False)]
    fresh = quality.freshness("orders", built.source("orders"), "created_at", PARAMS)
    assert result(fresh) == ("orders", 1)
    with pytest.raises(quality.QualityError, match="fct_orders: 495"):
        quality.require_passed(floors)
    with pytest.warns(quality.QualityWarning, match="stg_customers: 93"):
        quality.require_passed(floors, severity="warn")


@pytest.mark.parametrize(("age", "expected"), [(timedelta(hours=2), 0), (timedelta(hours=2, seconds=1), 1)])
def test_freshness_boundary(spark, age, expected):
    df = orders(spark, order(1, 1, "1.00", created=AS_OF - age))
    assert result(quality.freshness("f", df, "created_at", PARAMS))[1] == expected


def test_freshness_of_nothing_fails(spark):
    assert result(quality.freshness("f", orders(spark), "created_at", PARAMS))[1] == 1


def test_future_rows(spark):
    df = orders(spark, order(1, 1, "1", created=AS_OF), order(2, 1, "1", created=AS_OF + timedelta(seconds=1)))
    assert rows(quality.future_rows(df, "created_at", PARAMS), "id") == [(2,)]
    later = replace(PARAMS, as_of=AS_OF + timedelta(days=1))
    assert quality.future_rows(df, "created_at", later).isEmpty()


def test_revenue_mismatches(spark):
    schema = "id int, order_status string, net_revenue decimal(10,2), order_amount decimal(10,2)"
    data = [
        (1, "completed", D("1.00"), D("1.00")),
        (2, "completed", D("0.00"), D("1.00")),
        (3, "pending", D("0.00"), D("1.00")),
        (4, "completed", None, D("1.00")),
    ]
    assert rows(quality.revenue_mismatches(spark.createDataFrame(data, schema)), "id") == [(2,)]


def test_malformed_emails(spark):
    texts = ["a@b.c", "a.b@c", "no at.dot", "a@bc", "@.", None]
    df = customers(spark, *[customer(n, email=text) for n, text in enumerate(texts)])
    assert rows(quality.malformed_emails(df), "id") == [(1,), (2,), (3,)]


def test_not_null(spark):
    df = customers(spark, customer(1, name=None), customer(2, name=None, email=None), customer(3))
    assert rows(quality.not_null("c", df, ["name", "email", "id"])) == [
        ("not_null:c.email", 1, False),
        ("not_null:c.id", 0, True),
        ("not_null:c.name", 2, False),
    ]
    assert rows(quality.not_null("c", customers(spark), ["name"])) == [("not_null:c.name", 0, True)]


def test_unique(spark):
    df = customers(spark, customer(1), customer(1), customer(1), customer(2), customer(None), customer(None))
    assert result(quality.unique("c", df, ["id"])) == ("unique:c.id", 1)
    assert result(quality.unique("c", df, ["id", "name"])) == ("unique:c.id,name", 1)


def test_references(spark):
    parents = customers(spark, customer(1), customer(1), customer(2))
    children = orders(spark, *[order(n, key, "1") for n, key in enumerate([1, 1, 2, 3, 3, 4, None])])
    check = quality.references("orders", children, "customer_id", "customers", parents, "id")
    assert result(check) == ("references:orders.customer_id->customers.id", 3)
    assert result(quality.references("o", orders(spark), "customer_id", "c", parents, "id"))[1] == 0


def test_non_negative(spark):
    df = orders(spark, order(1, 1, "0"), order(2, 1, "-0.01"), order(3, 1, None))
    assert result(quality.non_negative("o", df, "amount")) == ("non_negative:o.amount", 1)


def test_defaults(spark):
    df = customers(spark, customer(1, country=None), customer(2, country="DE"))
    assert rows(with_defaults(df, DEFAULT_VALUES["customers"]), "id", "country_code") == [(1, "US"), (2, "DE")]


def test_schema_of_results(spark):
    check = quality.unique("c", customers(spark, customer(1)), ["id"])
    assert [(f.name, f.dataType) for f in check.schema] == [
        ("check_name", T.StringType()),
        ("violations", T.LongType()),
        ("passed", T.BooleanType()),
    ]


def test_suites_on_golden_rows(spark):
    built = golden(spark)
    assert quality.only_failed(checks.source_checks(built)).isEmpty()
    assert quality.only_failed(checks.mart_checks(built)).isEmpty()
    assert rows(quality.only_failed(checks.monitoring_checks(built)), "check_name", "violations") == [
        ("orders_freshness", 1),
        ("row_floor:dim_customers", 93),
        ("row_floor:fct_orders", 495),
        ("row_floor:stg_customers", 93),
    ]
