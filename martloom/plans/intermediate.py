"""Roll-ups of the many-side onto customers and orders.

Orders (payments) are aggregated before the join, so the join sees one row per key however many orders
(payments) a customer (an order) has, and the aggregation combines on the map side.

An append-only lake may hold several rows for one id. The roll-up is then defined over the joined rows:
equal parent rows count together. `copies` carries how many there are, instead of joining each of them.
Sources whose ids are unique say so in the parameters and spare that step.
"""

from __future__ import annotations

from typing import TYPE_CHECKING

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.functions.cleaning import money_total
from martloom.functions.segments import activity_status, is_completed, no_money, order_payment_status
from martloom.schemas import MONEY_SUM

if TYPE_CHECKING:
    from martloom.plans.warehouse import Warehouse

CUSTOMER = ["customer_id", "customer_name", "email", "country_code", "registered_at", "signup_date"]
ORDER = ["order_id", "customer_id", "order_amount", "order_status", "ordered_at"]


def parents(warehouse: Warehouse, name: str, columns: list[str]) -> DataFrame:
    """The rows of a staged dataset, whose id comes first, with `copies`, the number of equal ones."""
    rows = warehouse.ref(name)
    if warehouse.params.unique_ids:
        return rows.select(*columns, F.lit(1).alias("copies"))
    return rows.groupBy(*columns).agg(F.count(F.lit(1)).alias("copies"))


def _times_copies(total: Column) -> Column:
    return (total * F.col("copies")).cast(MONEY_SUM)


def int_customer_orders(warehouse: Warehouse) -> DataFrame:
    orders = warehouse.ref("stg_orders")
    completed = F.when(is_completed(F.col("order_status")), F.col("order_amount")).otherwise(no_money())
    per_customer = orders.groupBy("customer_id").agg(
        F.count("order_id").alias("orders"),
        money_total(completed).alias("spent"),
        F.min("ordered_at").alias("first_order_date"),
        F.max("ordered_at").alias("last_order_date"),
    )
    customers = parents(warehouse, "stg_customers", CUSTOMER)
    return customers.join(per_customer, "customer_id", "left").select(
        *CUSTOMER,
        (F.coalesce("orders", F.lit(0)) * F.col("copies")).cast("bigint").alias("total_orders"),
        _times_copies(F.coalesce("spent", no_money())).alias("total_spent"),
        "first_order_date",
        "last_order_date",
        activity_status(F.col("last_order_date"), warehouse.params).alias("activity_status"),
    )


def payments_per_order(payments: DataFrame) -> DataFrame:
    return payments.groupBy("order_id").agg(
        F.count("payment_id").alias("payments"),
        money_total(F.col("payment_amount")).alias("paid"),
        F.max("paid_at").alias("last_payment_date"),
        # a set of few methods, combined on the map side: a distinct count would shuffle the payments twice
        F.size(F.collect_set("payment_method")).alias("methods"),
    )


def with_payments(orders: DataFrame, payments: DataFrame) -> DataFrame:
    """Orders (with `copies`) and what has been paid for them."""
    payment_count = (F.coalesce("payments", F.lit(0)) * F.col("copies")).cast("bigint")
    total_paid = _times_copies(F.col("paid"))
    columns = [name for name in orders.columns if name != "copies"]
    return orders.join(payments_per_order(payments), "order_id", "left").select(
        *columns,
        payment_count.alias("payment_count"),
        total_paid.alias("total_paid_amount"),
        "last_payment_date",
        order_payment_status(payment_count, total_paid, F.col("order_amount")).alias("payment_status"),
        F.coalesce("methods", F.lit(0)).cast("bigint").alias("distinct_payment_methods"),
    )


def int_order_payments(warehouse: Warehouse) -> DataFrame:
    orders = parents(warehouse, "stg_orders", ORDER)
    return with_payments(orders, warehouse.ref("stg_payments"))
