"""The warehouse's sources, derived from the sample tables (customer, orders, lineitem, events).

customers, orders and payments are views of customer, orders and lineitem; the change feed is a view of
events. Every row of a sample table becomes one source row. Amounts are doubles, as in a lake that was loaded
from files; staging turns them into decimals.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime
from decimal import Decimal
from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from martloom.functions.segments import first_match
from martloom.functions.times import at
from martloom.params import Params
from martloom.schemas import CAPTURED, MONEY
from martloom.sources.reference import COUNTRIES

# The sample's orders end on 2001-08-01 and its amounts are about a thousand times a shop's.
SAMPLE_PARAMS = Params(
    as_of=datetime(2001, 8, 2),
    start_date=datetime(1995, 1, 1),
    tier_vip=Decimal(1_000_000),
    tier_premium=Decimal(500_000),
    tier_regular=Decimal(100_000),
    monetary_high=Decimal(1_000_000),
    monetary_medium=Decimal(500_000),
    # the sample's keys are primary keys
    unique_ids=True,
)

ORDER_STATUS = {"F": "completed", "O": "pending", "P": "shipped"}
PAYMENT_STATUS = {"F": "completed", "O": "pending"}
PAYMENT_METHOD = {"A": "credit_card", "N": "paypal", "R": "bank_transfer"}
# Clicks become empty values (tombstones).
OPERATION = {"signup": "c", "purchase": "u", "view": "r", "error": "d"}


def _translate(column: str, names: dict[str, str]) -> Column:
    return first_match([(F.col(column) == value, name) for value, name in names.items()])


def _country(nation: Column) -> Column:
    """Nations 0-19 are the known countries, 20-23 unknown codes, the others have no country."""
    codes = [row[0] for row in COUNTRIES] + [f"X{n}" for n in range(4)]
    return F.get(F.array(*[F.lit(code) for code in codes]), nation)


@lru_cache
def _schema(spark: SparkSession, path: str) -> StructType:
    return spark.read.parquet(path).schema


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    path = f"{folder}/{name}.parquet"
    return spark.read.schema(_schema(spark, path)).parquet(path)


def customers(customer: DataFrame) -> DataFrame:
    """Names, emails and codes carry the stray spaces and capitals that staging removes. Customers of one
    market segment have an address without a domain suffix."""
    domain = F.when(F.col("c_mktsegment") == "MACHINERY", "@Localhost ").otherwise("@Example.com ")
    registered = at(datetime(1995, 1, 1)) + F.make_dt_interval((F.col("c_custkey") % 50).cast("int"))
    return customer.select(
        F.col("c_custkey").alias("id"),
        F.concat(F.lit("  "), F.col("c_name"), F.lit(" ")).alias("name"),
        F.concat(F.lit(" "), F.replace("c_name", F.lit("#"), F.lit(".")), domain).alias("email"),
        F.concat(F.lit(" "), F.lower(_country(F.col("c_nationkey")))).alias("country_code"),
        registered.alias("created_at"),
        registered.alias("loaded_at"),
    )


def orders(orders: DataFrame) -> DataFrame:
    return orders.select(
        F.col("o_orderkey").alias("id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_totalprice").alias("amount"),
        _translate("o_orderstatus", ORDER_STATUS).alias("status"),
        F.col("o_orderdate").alias("created_at"),
        F.col("o_orderdate").alias("loaded_at"),
    )


def payments(lineitem: DataFrame) -> DataFrame:
    """The id is a label: order and line number do not identify a line of the sample."""
    return lineitem.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("id"),
        F.col("l_orderkey").alias("order_id"),
        F.col("l_extendedprice").alias("amount"),
        _translate("l_returnflag", PAYMENT_METHOD).alias("payment_method"),
        _translate("l_linestatus", PAYMENT_STATUS).alias("status"),
        F.col("l_shipdate").alias("created_at"),
        F.col("l_shipdate").alias("loaded_at"),
    )


def sample_sources(folder: str) -> dict[str, Callable[[SparkSession], DataFrame]]:
    return {
        "customers": lambda spark: customers(_table(spark, folder, "customer")),
        "orders": lambda spark: orders(_table(spark, folder, "orders")),
        "payments": lambda spark: payments(_table(spark, folder, "lineitem")),
    }


def awkward_sources(folder: str) -> dict[str, Callable[[SparkSession], DataFrame]]:
    """The sample with what it lacks: orders in two versions, without customer, below zero and without status, and
    payments of orders that are not there. Every rule is a remainder of the id."""

    def second_version(df: DataFrame) -> DataFrame:
        again = df.filter(F.col("id") % 5 == 0).withColumns({"amount": F.col("amount") + 1, "status": F.lit("shipped")})
        return df.unionByName(again)

    def awkward_orders(spark: SparkSession) -> DataFrame:
        rows = second_version(orders(_table(spark, folder, "orders")))
        strangers = F.when(F.col("id") % 7 == 0, F.col("customer_id") + 1_000_000).otherwise(F.col("customer_id"))
        negative = F.when(F.col("id") % 11 == 0, -F.col("amount")).otherwise(F.col("amount"))
        unset = F.when(F.col("id") % 13 != 0, F.col("status"))
        return rows.withColumns({"customer_id": strangers, "amount": negative, "status": unset})

    def awkward_payments(spark: SparkSession) -> DataFrame:
        missing = F.when(F.col("order_id") % 9 == 0, F.col("order_id") + 100_000_000).otherwise(F.col("order_id"))
        return payments(_table(spark, folder, "lineitem")).withColumn("order_id", missing)

    return sample_sources(folder) | {"orders": awkward_orders, "payments": awkward_payments}


def events(spark: SparkSession, folder: str) -> DataFrame:
    return _table(spark, folder, "events")


def event_stream(spark: SparkSession, folder: str) -> DataFrame:
    # A stream's folder may be a single file only if it is named by a pattern.
    schema = events(spark, folder).schema
    return spark.readStream.schema(schema).parquet(f"{folder}/[e]vents.parquet")


def _captured_row(micros: Column) -> Column:
    user = F.col("user_id").cast("string")
    return F.struct(
        F.col("event_id").alias("id"),
        F.concat(F.lit("User "), user).alias("name"),
        F.concat(F.lit("user."), user, F.lit("@example.com")).alias("email"),
        F.lit("US").alias("country_code"),
        F.col("user_id").alias("customer_id"),
        F.col("user_id").alias("order_id"),
        F.col("value").cast(MONEY).cast("string").alias("amount"),
        F.lit("credit_card").alias("payment_method"),
        F.col("event_type").alias("status"),
        micros.alias("created_at"),
    )


def _source_table() -> Column:
    names = F.array(*[F.lit(name) for name in CAPTURED])
    return F.get(names, (F.col("user_id") % len(CAPTURED)).cast("int"))


def _micros(moment: Column) -> Column:
    since = (moment - at(datetime(1970, 1, 1))).cast("decimal(18,6)") * 1_000_000
    return since.cast("bigint")


def envelope_feed(events: DataFrame) -> DataFrame:
    """Change events with before and after images; times in epoch microseconds, money as text."""
    operation = _translate("event_type", OPERATION)
    row = _captured_row(_micros(F.col("ts")))
    envelope = F.struct(
        F.when(operation.isin("u", "d"), row).alias("before"),
        F.when(operation != "d", row).alias("after"),
        F.struct(_source_table().alias("table")).alias("source"),
        operation.alias("op"),
    )
    return events.select(
        F.col("event_id").cast("string").alias("key"),
        F.when(operation.isNotNull(), F.to_json(envelope)).alias("value"),
        F.concat(F.lit("shop.public."), _source_table()).alias("topic"),
        F.col("ts").alias("timestamp"),
    )


def _version_row() -> Column:
    user = F.col("user_id")
    row = _captured_row(_micros(F.col("ts"))).withField("id", user)
    row = row.withField("customer_id", user - 1).withField("order_id", user - 1)
    return row.withField("status", F.when(F.col("event_type") == "purchase", "completed").otherwise(F.col("event_type")))


def versioned_feed(events: DataFrame, images: bool = True) -> DataFrame:
    """Changes in which one id has many versions: a user is a customer, an order of the customer before, or a payment
    of the order before. Errors delete; clicks are empty values. Has offsets, as brokers do. Without `images` the rows
    before a change are left out, so that a delete has its key only."""
    user, row = F.col("user_id"), _version_row()
    operation = _translate("event_type", OPERATION)
    envelope = F.struct(
        F.when(operation.isin("u", "d") & F.lit(images), row).alias("before"),
        F.when(operation != "d", row).alias("after"),
        F.struct(_source_table().alias("table")).alias("source"),
        operation.alias("op"),
    )
    return events.select(
        user.cast("string").alias("key"),
        F.when(operation.isNotNull(), F.to_json(envelope)).alias("value"),
        F.concat(F.lit("shop.public."), _source_table()).alias("topic"),
        F.col("ts").alias("timestamp"),
        F.col("event_id").alias("offset"),
    )


def chained_feed(events: DataFrame) -> DataFrame:
    """The versions of `versioned_feed` with the images that were there before them: a row's first change, and one after an
    error, creates it; an error deletes it; others update it. Every seventh change is lost. Has offsets."""
    order = Window.partitionBy("user_id").orderBy("ts", "event_id")
    changes = events.filter(F.col("event_type") != "click").withColumn("row", _version_row())
    earlier = changes.withColumns({"type_before": F.lag("event_type").over(order), "row_before": F.lag("row").over(order)})
    created = F.col("type_before").isNull() | (F.col("type_before") == "error")
    operation = F.when(created, "c").when(F.col("event_type") == "error", "d").otherwise("u")
    envelope = F.struct(
        F.when(operation != "c", F.col("row_before")).alias("before"),
        F.when(operation != "d", F.col("row")).alias("after"),
        F.struct(_source_table().alias("table")).alias("source"),
        operation.alias("op"),
    )
    return earlier.filter(F.col("event_id") % 7 != 0).select(
        F.col("user_id").cast("string").alias("key"),
        F.to_json(envelope).alias("value"),
        F.concat(F.lit("shop.public."), _source_table()).alias("topic"),
        F.col("ts").alias("timestamp"),
        F.col("event_id").alias("offset"),
    )


def odd_times_feed(events: DataFrame) -> DataFrame:
    """Flattened records whose times are, in turn, microseconds, nanoseconds, text and no time at all."""
    micros = _micros(F.col("ts"))
    written = F.array(micros.cast("string"), (micros * 1000).cast("string"), F.col("ts").cast("string"), F.lit("soon"))
    row = _captured_row(F.get(written, (F.col("event_id") % 4).cast("int")))
    return events.select(
        F.col("event_id").cast("string").alias("key"),
        F.to_json(row).alias("value"),
        F.concat(F.lit("shop.public."), _source_table()).alias("topic"),
        F.col("ts").alias("timestamp"),
    )


def faulty_feed(events: DataFrame) -> DataFrame:
    """Envelopes of which some, by remainders of the id, are cut short, lack or have an unknown operation, lack the table or
    the row, or have an amount or a time that cannot be read. Others have a field that is not declared."""
    n = F.col("event_id")
    row = _captured_row(F.when(n % 19 == 0, "soon").otherwise(_micros(F.col("ts")).cast("string")))
    row = row.withField("amount", F.when(n % 17 == 0, "cheap").otherwise(row["amount"]))
    row = row.withField("coupon", F.when(n % 6 == 0, F.concat(F.lit("c"), n.cast("string"))))
    operation = F.when(n % 11 == 0, "x").when(n % 7 != 0, "c")
    table = F.when(n % 13 != 0, _source_table())
    envelope = F.struct(F.when(n % 23 != 0, row).alias("after"), F.struct(table.alias("table")).alias("source"), operation.alias("op"))
    value = F.to_json(envelope)
    return events.select(
        n.cast("string").alias("key"),
        F.when(n % 5 == 0, F.substring(value, 1, 10)).otherwise(value).alias("value"),
        F.concat(F.lit("shop.public."), _source_table()).alias("topic"),
        F.col("ts").alias("timestamp"),
    )


def record_feed(events: DataFrame) -> DataFrame:
    """The flattened form of the same changes; deletes have become tombstones."""
    operation = _translate("event_type", OPERATION)
    return events.select(
        F.col("event_id").cast("string").alias("key"),
        F.when(operation.isin("c", "u", "r"), F.to_json(_captured_row(_micros(F.col("ts"))))).alias("value"),
        F.concat(F.lit("shop.public."), _source_table()).alias("topic"),
        F.col("ts").alias("timestamp"),
    )
