"""Marketing marts: customer segments, signup cohorts, geography."""

from __future__ import annotations

from typing import TYPE_CHECKING

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.functions.cleaning import money_total
from martloom.functions.segments import (
    avg_order_value,
    frequency_segment,
    mean,
    monetary_segment,
    no_money,
    percent_of,
    recency_segment,
)
from martloom.functions.times import now

if TYPE_CHECKING:
    from martloom.plans.warehouse import Warehouse


def customer_metrics(warehouse: Warehouse) -> DataFrame:
    params = warehouse.params
    spent, orders = F.col("total_spent"), F.col("total_orders")
    return warehouse.ref("dim_customers").select(
        "customer_id",
        "customer_name",
        "email",
        "customer_tier",
        "activity_status",
        "total_orders",
        "total_spent",
        "first_order_date",
        "last_order_date",
        "customer_lifetime_days",
        "days_between_orders",
        avg_order_value(spent, orders).alias("avg_order_value"),
        recency_segment(F.col("last_order_date"), params).alias("recency_segment"),
        frequency_segment(orders, params).alias("frequency_segment"),
        monetary_segment(spent, params).alias("monetary_segment"),
        now(params).alias("dbt_loaded_at"),
    )


def _count_where(condition: Column) -> Column:
    return F.count(F.when(condition, F.col("customer_id")))


def customer_acquisition(warehouse: Warehouse) -> DataFrame:
    cohorts = (
        warehouse.ref("dim_customers")
        .groupBy("signup_date")
        .agg(
            F.count("customer_id").alias("new_customers"),
            _count_where(F.col("total_orders") > 0).alias("activated_customers"),
            F.sum("total_orders").alias("total_orders_from_cohort"),
            money_total(F.col("total_spent")).alias("total_revenue_from_cohort"),
            F.count(F.lit(1)).alias("_rows"),
        )
    )
    rows = F.col("_rows")
    return cohorts.select(
        "signup_date",
        F.year("signup_date").alias("signup_year"),
        F.month("signup_date").alias("signup_month"),
        "new_customers",
        "activated_customers",
        "total_orders_from_cohort",
        "total_revenue_from_cohort",
        mean(F.col("total_revenue_from_cohort"), rows).alias("avg_lifetime_value"),
        mean(F.col("total_orders_from_cohort"), rows).alias("avg_orders_per_customer"),
        percent_of(F.col("activated_customers"), F.col("new_customers")).alias("activation_rate_percent"),
        now(warehouse.params).alias("dbt_loaded_at"),
    )


def customer_geography(warehouse: Warehouse) -> DataFrame:
    is_vip = F.col("customer_tier") == "VIP"
    places = ["continent", "continent_group", "region", "country_code", "country_name", "economic_tier"]
    regions = (
        warehouse.ref("dim_customers_enriched")
        .groupBy(*places)
        .agg(
            F.count("customer_id").alias("total_customers"),
            _count_where(F.col("total_orders") > 0).alias("active_customers"),
            money_total(F.col("total_spent")).alias("total_revenue"),
            F.sum("total_orders").alias("_orders"),
            F.count(F.lit(1)).alias("_rows"),
            money_total(F.when(is_vip, F.col("total_spent")).otherwise(no_money())).alias("vip_revenue"),
            _count_where(is_vip).alias("vip_customers"),
        )
    )
    total, rows = F.col("total_customers"), F.col("_rows")
    return regions.select(
        *places,
        "total_customers",
        "active_customers",
        "total_revenue",
        mean(F.col("total_revenue"), rows).alias("avg_customer_value"),
        mean(F.col("_orders"), rows).alias("avg_orders_per_customer"),
        "vip_revenue",
        "vip_customers",
        percent_of(F.col("active_customers"), total).alias("activation_rate_percent"),
        percent_of(F.col("vip_customers"), total).alias("vip_rate_percent"),
        now(warehouse.params).alias("dbt_loaded_at"),
    )
