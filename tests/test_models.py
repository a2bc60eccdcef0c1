"""Models on rows made for one case each."""

from __future__ import annotations

from dataclasses import replace
from datetime import date, datetime
from decimal import Decimal as D

from helpers import PARAMS, REGISTERED, by_key, customer, golden, order, payment, rows, warehouse


def test_staging_drops_incomplete_rows_and_tidies_text(spark):
    built = warehouse(
        spark,
        customers=[
            customer(1, "  Ann  ", " Ann@Example.COM ", " us "),
            customer(2, name=None),
            customer(3, email=None),
            customer(4, created=None),
            customer(5, country=None),
            customer(6, loaded=datetime(2022, 12, 31)),
            customer(7, loaded=datetime(2023, 1, 1)),
        ],
        orders=[
            order(1, 1, "1.00"),
            order(2, None, "1.00"),
            order(3, 1, None),
            order(4, 1, "1.00", None),
            order(5, 1, "1.00", created=None),
            order(6, 1, "1.00", loaded=None),
        ],
        payments=[
            payment(1, 1, "1.00"),
            payment(2, None, "1.00"),
            payment(3, 1, None),
            payment(4, 1, "1.00", method=None),
            payment(5, 1, "1.00", status=None),
            payment(6, 1, "1.00", created=None),
        ],
    )
    staged = by_key(built.ref("stg_customers"), "customer_id", "customer_name", "email", "country_code", "signup_date")
    assert staged == {
        1: ("Ann", "ann@example.com", "US", date(2024, 1, 5)),
        5: ("N", "a@b.c", None, date(2024, 1, 5)),
        7: ("N", "a@b.c", "US", date(2024, 1, 5)),
    }
    assert rows(built.ref("stg_orders"), "order_id") == [(1,)]
    assert rows(built.ref("stg_payments"), "payment_id") == [(1,)]


def test_payments_of_an_order(spark):
    built = warehouse(
        spark,
        customers=[customer(1)],
        orders=[order(n, 1, "10.00") for n in (1, 2, 3, 4)],
        payments=[
            payment(1, 1, "4.00", "paypal"),
            payment(2, 1, "6.00", "credit_card"),
            payment(3, 2, "12.50", "paypal"),
            payment(4, 3, "9.99", "paypal", status="failed"),
            payment(5, 99, "1.00"),
        ],
    )
    facts = by_key(
        built.ref("fct_orders"), "order_id", "payment_count", "payment_status", "distinct_payment_methods",
        "outstanding_amount", "paid_amount",
    )
    assert facts == {
        1: (2, "fully_paid", 2, D("0.00"), D("10.00")),
        2: (1, "fully_paid", 1, D("-2.50"), D("10.00")),
        3: (1, "partially_paid", 1, D("0.01"), D("0.00")),
        4: (0, "unpaid", 0, D("10.00"), D("0.00")),
    }
    payments = by_key(built.ref("fct_payments"), "payment_id", "customer_name", "is_successful_payment")
    assert payments[5] == (None, 1)
    assert payments[4] == ("N", 0)


def test_orders_of_an_unknown_customer_stay(spark):
    built = warehouse(spark, customers=[customer(1)], orders=[order(1, 1, "5.00"), order(2, 42, "5.00")])
    facts = by_key(built.ref("fct_orders"), "order_id", "customer_name", "customer_tier")
    assert facts == {1: ("N", "New"), 2: (None, None)}


def test_rows_sharing_an_id_see_each_others_children(spark):
    """The roll-up is defined over joined rows: two equal customers count their orders twice."""
    built = warehouse(
        spark,
        customers=[customer(1, "Ann"), customer(1, "Ann"), customer(2, "Bob"), customer(2, "Rob")],
        orders=[order(1, 1, "10.00"), order(2, 2, "20.00"), order(2, 2, "20.00")],
        payments=[payment(1, 2, "15.00")],
    )
    totals = rows(built.ref("int_customer_orders"), "customer_id", "customer_name", "total_orders", "total_spent")
    assert totals == [(1, "Ann", 2, D("20.00")), (2, "Bob", 2, D("40.00")), (2, "Rob", 2, D("40.00"))]
    paid = rows(built.ref("int_order_payments"), "order_id", "payment_count", "total_paid_amount", "payment_status")
    assert paid == [(1, 0, None, "unpaid"), (2, 2, D("30.00"), "fully_paid")]


def test_unmatched_countries(spark):
    built = warehouse(spark, customers=[customer(1, country="XX"), customer(2, country=None), customer(3, country="br")])
    enriched = by_key(
        built.ref("dim_customers_enriched"), "customer_id", "country_name", "continent_group", "economic_tier"
    )
    assert enriched == {1: (None, "Other", "Tier 3"), 2: (None, "Other", "Tier 3"), 3: ("Brazil", "SA", "Tier 2")}
    assert built.ref("customer_geography").count() == 3


def test_sunday_and_month_end(spark):
    built = warehouse(
        spark,
        customers=[customer(1)],
        orders=[order(1, 1, "1.00", created=datetime(2024, 2, 29, 23, 59)), order(2, 1, "1.00", created=datetime(2024, 2, 25))],
    )
    facts = by_key(built.ref("fct_orders"), "order_id", "order_date", "order_month", "order_day_of_week")
    assert facts == {1: (date(2024, 2, 29), 2, 4), 2: (date(2024, 2, 25), 2, 7)}


def test_empty_sources(spark):
    built = warehouse(spark)
    for name in ("dim_customers", "fct_orders", "fct_daily_sales", "fct_payments", "customer_geography"):
        assert built.ref(name).isEmpty()


def test_now_is_the_default_time(spark):
    built = warehouse(spark, customers=[customer(1)], params=replace(PARAMS, as_of=None))
    stamp = built.ref("dim_customers").first().dbt_loaded_at
    assert abs((stamp - datetime.now()).total_seconds()) < 24 * 3600


def test_stored_marts_equal_composed_ones(spark, tmp_path):
    composed, stored = golden(spark), golden(spark, root=str(tmp_path))
    counts = dict(rows(stored.run()))
    assert counts == {
        "dim_customers": 7, "dim_customers_enriched": 7, "fct_orders": 5, "fct_daily_sales": 2, "fct_payments": 4,
        "customer_metrics": 7, "customer_acquisition": 1, "customer_geography": 7, "dim_dates": 112,
        "compact_dim_customers": 7, "compact_fct_orders": 5,
    }
    for name in counts:
        assert rows(stored.ref(name)) == rows(composed.ref(name)), name
        assert stored.ref(name).columns == composed.ref(name).columns
    # A second run replaces the tables.
    assert dict(rows(golden(spark, root=str(tmp_path)).run())) == counts


def test_datasets_by_name_in_sql(spark):
    built = golden(spark)
    built.expose("dim_customers", "fct_orders")
    sql = "SELECT count(*) FROM fct_orders JOIN dim_customers USING (customer_id) WHERE order_status = 'completed'"
    assert spark.sql(sql).first()[0] == 4


def test_models_are_built_once(spark):
    built = golden(spark)
    assert built.ref("dim_customers") is built.ref("dim_customers")
    assert built.source("orders") is built.source("orders")


def test_start_date_is_inclusive(spark):
    cut = replace(PARAMS, start_date=REGISTERED)
    assert warehouse(spark, customers=[customer(1)], params=cut).ref("stg_customers").count() == 1
