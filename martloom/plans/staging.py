"""Staging: select, rename, clean; one row in, at most one row out."""

from __future__ import annotations

from typing import TYPE_CHECKING

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.functions.cleaning import loaded_since, money, require, tidy, tidy_code, tidy_email
from martloom.functions.times import at

if TYPE_CHECKING:
    from martloom.plans.warehouse import Warehouse


def _recent(warehouse: Warehouse, source: str) -> DataFrame:
    return loaded_since(warehouse.source(source), at(warehouse.params.start_date))


def stg_customers(warehouse: Warehouse) -> DataFrame:
    rows = require(_recent(warehouse, "customers"), "name", "email", "created_at")
    return rows.select(
        F.col("id").alias("customer_id"),
        tidy(F.col("name")).alias("customer_name"),
        tidy_email(F.col("email")).alias("email"),
        tidy_code(F.col("country_code")).alias("country_code"),
        F.col("created_at").alias("registered_at"),
        F.to_date("created_at").alias("signup_date"),
        "loaded_at",
    )


def stg_orders(warehouse: Warehouse) -> DataFrame:
    rows = require(_recent(warehouse, "orders"), "customer_id", "amount", "status", "created_at")
    return rows.select(
        F.col("id").alias("order_id"),
        "customer_id",
        money(F.col("amount")).alias("order_amount"),
        F.col("status").alias("order_status"),
        F.col("created_at").alias("ordered_at"),
        F.to_date("created_at").alias("order_date"),
        "loaded_at",
    )


def stg_payments(warehouse: Warehouse) -> DataFrame:
    rows = require(_recent(warehouse, "payments"), "order_id", "amount", "payment_method", "status", "created_at")
    return rows.select(
        F.col("id").alias("payment_id"),
        "order_id",
        money(F.col("amount")).alias("payment_amount"),
        "payment_method",
        F.col("status").alias("payment_status"),
        F.col("created_at").alias("paid_at"),
        F.to_date("created_at").alias("payment_date"),
        "loaded_at",
    )


def stg_country_codes(warehouse: Warehouse) -> DataFrame:
    return warehouse.source("country_codes").select(
        "country_code",
        "country_name",
        "region",
        "continent",
        "iso_alpha3",
        "currency_code",
        "currency_name",
        "phone_code",
        "gdp_category",
    )
