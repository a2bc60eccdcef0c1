"""Compact marts: a small fixed schema for consumers that want one row per customer or order."""

from __future__ import annotations

from typing import TYPE_CHECKING

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.functions.times import now

if TYPE_CHECKING:
    from martloom.plans.warehouse import Warehouse


def compact_dim_customers(warehouse: Warehouse) -> DataFrame:
    return warehouse.ref("dim_customers_enriched").select(
        "customer_id",
        "customer_name",
        "email",
        "country_code",
        "total_orders",
        "total_spent",
        "last_order_date",
        F.col("customer_tier").alias("customer_segment"),
        now(warehouse.params).alias("processed_at"),
    )


def compact_fct_orders(warehouse: Warehouse) -> DataFrame:
    # The compact fact needs nothing of an order's payments, so it starts from the staged orders.
    customers = warehouse.ref("dim_customers_enriched").select(
        "customer_id", "customer_name", "country_code", "customer_tier"
    )
    orders = warehouse.ref("stg_orders").join(customers, "customer_id", "left")
    return orders.select(
        "order_id",
        "customer_id",
        "customer_name",
        F.col("order_amount").alias("amount"),
        F.col("order_status").alias("status"),
        F.col("ordered_at").alias("order_date"),
        "country_code",
        F.col("customer_tier").alias("customer_segment"),
        now(warehouse.params).alias("processed_at"),
    )
