"""Core marts: customer dimension, order and payment facts, daily sales, calendar."""

from __future__ import annotations

from typing import TYPE_CHECKING

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.functions.calendar import date_range, with_calendar
from martloom.functions.cleaning import money_total
from martloom.functions.segments import (
    continent_group,
    customer_lifetime_days,
    customer_tier,
    days_between_orders,
    economic_tier,
    is_completed,
    is_successful_payment,
    mean,
    net_revenue,
    no_money,
    outstanding_amount,
    paid_amount,
)
from martloom.functions.times import iso_weekday, now
from martloom.plans.intermediate import parents, with_payments

if TYPE_CHECKING:
    from martloom.params import Params
    from martloom.plans.warehouse import Warehouse

# Column lists are the marts' schema contract, order included.
DIM_CUSTOMERS = [
    "customer_id",
    "customer_name",
    "email",
    "country_code",
    "registered_at",
    "signup_date",
    "total_orders",
    "total_spent",
    "first_order_date",
    "last_order_date",
    "activity_status",
    "customer_lifetime_days",
    "customer_tier",
    "days_between_orders",
    "dbt_loaded_at",
]
DIM_CUSTOMERS_ENRICHED = [
    "customer_id",
    "customer_name",
    "email",
    "country_code",
    "country_name",
    "region",
    "continent",
    "continent_group",
    "currency_code",
    "currency_name",
    "gdp_category",
    "economic_tier",
    "total_orders",
    "total_spent",
    "first_order_date",
    "last_order_date",
    "activity_status",
    "customer_lifetime_days",
    "customer_tier",
    "days_between_orders",
    "registered_at",
    "signup_date",
    "dbt_loaded_at",
]
FCT_ORDERS = [
    "order_id",
    "customer_id",
    "customer_name",
    "customer_tier",
    "activity_status",
    "order_amount",
    "order_status",
    "payment_count",
    "total_paid_amount",
    "payment_status",
    "distinct_payment_methods",
    "net_revenue",
    "paid_amount",
    "outstanding_amount",
    "ordered_at",
    "order_date",
    "order_year",
    "order_month",
    "order_day_of_week",
    "source_loaded_at",
    "dbt_loaded_at",
]
FCT_PAYMENTS = [
    "payment_id",
    "order_id",
    "customer_id",
    "customer_name",
    "customer_tier",
    "payment_amount",
    "payment_method",
    "payment_status",
    "order_amount",
    "order_status",
    "paid_at",
    "payment_date",
    "is_successful_payment",
    "source_loaded_at",
    "dbt_loaded_at",
]


def dim_customers(warehouse: Warehouse) -> DataFrame:
    params = warehouse.params
    lifetime = customer_lifetime_days(F.col("registered_at"), F.col("last_order_date"), params)
    return (
        warehouse.ref("int_customer_orders")
        .withColumns(
            {
                "customer_lifetime_days": lifetime,
                "customer_tier": customer_tier(F.col("total_spent"), params),
                "days_between_orders": days_between_orders(lifetime, F.col("total_orders")),
                "dbt_loaded_at": now(params),
            }
        )
        .select(*DIM_CUSTOMERS)
    )


def dim_customers_enriched(warehouse: Warehouse) -> DataFrame:
    # No broadcast hint: Spark knows the size of the country table and broadcasts it below its threshold.
    countries = warehouse.ref("stg_country_codes").select(
        "country_code", "country_name", "region", "continent", "currency_code", "currency_name", "gdp_category"
    )
    return (
        warehouse.ref("dim_customers")
        .join(countries, "country_code", "left")
        .withColumns(
            {
                "continent_group": continent_group(F.col("continent")),
                "economic_tier": economic_tier(F.col("gdp_category")),
            }
        )
        .select(*DIM_CUSTOMERS_ENRICHED)
    )


def _orders_with_payments(warehouse: Warehouse) -> DataFrame:
    orders = warehouse.ref("stg_orders")
    if warehouse.params.unique_ids:
        return with_payments(parents(warehouse, "stg_orders", orders.columns), warehouse.ref("stg_payments"))
    # Orders meet the roll-up again by id: rows sharing an id all see each other's payments.
    paid = warehouse.ref("int_order_payments").select(
        "order_id", "payment_count", "total_paid_amount", "payment_status", "distinct_payment_methods"
    )
    return orders.join(paid, "order_id", "left")


def of_orders(params: Params) -> dict[str, Column]:
    """Columns of the order fact that follow from its other ones: they need not be shuffled."""
    amount, status, ordered_at = F.col("order_amount"), F.col("order_status"), F.col("ordered_at")
    return {
        "net_revenue": net_revenue(status, amount),
        "paid_amount": paid_amount(F.col("payment_status"), amount),
        "outstanding_amount": outstanding_amount(amount, F.col("total_paid_amount")),
        "order_date": F.to_date(ordered_at),
        "order_year": F.year(ordered_at),
        "order_month": F.month(ordered_at),
        "order_day_of_week": iso_weekday(ordered_at),
        "dbt_loaded_at": now(params),
    }


def fct_orders(warehouse: Warehouse) -> DataFrame:
    customers = warehouse.ref("dim_customers").select(
        "customer_id", "customer_name", "customer_tier", "activity_status"
    )
    # A customer with very many orders fills a partition of its own; adaptive execution splits it.
    orders = _orders_with_payments(warehouse).join(customers, "customer_id", "left")
    return orders.withColumns({"source_loaded_at": F.col("loaded_at"), **of_orders(warehouse.params)}).select(*FCT_ORDERS)


def of_payments(params: Params) -> dict[str, Column]:
    """Columns of the payment fact that follow from its other ones: they need not be shuffled."""
    return {
        "payment_date": F.to_date("paid_at"),
        "is_successful_payment": is_successful_payment(F.col("payment_status")),
        "dbt_loaded_at": now(params),
    }


def fct_payments(warehouse: Warehouse) -> DataFrame:
    payments = warehouse.ref("stg_payments")
    orders = warehouse.ref("fct_orders").select(
        "order_id", "customer_id", "customer_name", "customer_tier", "order_amount", "order_status"
    )
    enriched = payments.join(orders, "order_id", "left")
    return enriched.withColumns({"source_loaded_at": F.col("loaded_at"), **of_payments(warehouse.params)}).select(*FCT_PAYMENTS)


def fct_daily_sales(warehouse: Warehouse) -> DataFrame:
    revenue, tier = F.col("net_revenue"), F.col("customer_tier")
    daily = (
        warehouse.ref("fct_orders")
        .filter(is_completed(F.col("order_status")))
        .groupBy("order_date", "order_year", "order_month")
        .agg(
            F.count("order_id").alias("daily_orders"),
            F.countDistinct("customer_id").alias("daily_customers"),
            money_total(revenue).alias("daily_revenue"),
            F.count("net_revenue").alias("_orders_with_revenue"),
            money_total(F.when(tier == "VIP", revenue).otherwise(no_money())).alias("vip_revenue"),
            money_total(F.when(tier == "Premium", revenue).otherwise(no_money())).alias("premium_revenue"),
        )
    )
    return daily.select(
        "order_date",
        "order_year",
        "order_month",
        "daily_orders",
        "daily_customers",
        "daily_revenue",
        mean(F.col("daily_revenue"), F.col("_orders_with_revenue")).alias("avg_order_value"),
        "vip_revenue",
        "premium_revenue",
        now(warehouse.params).alias("dbt_loaded_at"),
    )


def dim_dates(warehouse: Warehouse) -> DataFrame:
    """The calendar over all days on which there were orders, gaps filled."""
    bounds = warehouse.ref("stg_orders").agg(
        F.min("order_date").alias("first"), F.max("order_date").alias("last")
    )
    return with_calendar(date_range(bounds, "first", "last"))
