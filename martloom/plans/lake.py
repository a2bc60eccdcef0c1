"""The lake: its tables, their initial rows, and copying them to another database."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from martloom.functions.times import now
from martloom.operators.sinks import append_if_empty, copy_to_jdbc, create_namespace, create_table
from martloom.params import Params
from martloom.schemas import CUSTOMERS, ORDERS
from martloom.sources.tables import read_table, row_counts

# The first rows of a new lake.
FIRST_CUSTOMERS = """
    (1, 'John Doe', 'john.doe@example.com', 'US'),
    (2, 'Jane Smith', 'jane.smith@example.com', 'GB'),
    (3, 'Bob Johnson', 'bob.johnson@example.com', 'CA')"""
FIRST_ORDERS = """
    (1, 1, 100.50, 'completed'),
    (2, 2, 75.25, 'pending'),
    (3, 1, 50.75, 'completed')"""


def _stored(schema: StructType) -> StructType:
    """A lake table's columns: the source's, without the load stamp."""
    return StructType([StructField(f.name, f.dataType) for f in schema if f.name != "loaded_at"])


LAKE_TABLES = {"customers": _stored(CUSTOMERS), "orders": _stored(ORDERS)}


def _values(spark: SparkSession, rows: str, columns: str, params: Params) -> DataFrame:
    return spark.sql(f"SELECT * FROM VALUES {rows} AS first({columns})").withColumn("created_at", now(params))


def _typed(df: DataFrame, table: str) -> DataFrame:
    return df.select(*[F.col(field.name).cast(field.dataType) for field in LAKE_TABLES[table]])


@dataclass(frozen=True)
class Lake:
    """Tables of one namespace. `fmt` is any table format installed on the cluster."""

    spark: SparkSession
    namespace: str
    location: str | None = None
    fmt: str = "parquet"

    def name(self, table: str) -> str:
        return f"{self.namespace}.{table}"

    def table(self, table: str) -> DataFrame:
        return read_table(self.spark, self.name(table))

    def create(self) -> None:
        create_namespace(self.spark, self.namespace, self.location)
        for table, schema in LAKE_TABLES.items():
            create_table(self.spark, self.name(table), schema, self.fmt)

    def bootstrap(self, params: Params = Params()) -> None:
        """Create the tables and give empty ones their first rows; repeating it changes nothing."""
        self.create()
        customers = _values(self.spark, FIRST_CUSTOMERS, "id, name, email, country_code", params)
        orders = _values(self.spark, FIRST_ORDERS, "id, customer_id, amount, status", params)
        append_if_empty(_typed(customers, "customers"), self.name("customers"))
        append_if_empty(_typed(orders, "orders"), self.name("orders"))

    def sources(self) -> dict[str, Callable[[SparkSession], DataFrame]]:
        """The tables as sources of a warehouse. They carry no load stamp; a row's own time stands in for it."""

        def reader(table: str) -> Callable[[SparkSession], DataFrame]:
            return lambda spark: read_table(spark, self.name(table)).withColumn("loaded_at", F.col("created_at"))

        return {table: reader(table) for table in LAKE_TABLES}

    def counts(self) -> DataFrame:
        return row_counts({table: self.table(table) for table in LAKE_TABLES})

    def copy_to(self, url: str, properties: Mapping[str, str], tables: Iterable[str] = tuple(LAKE_TABLES)) -> None:
        """Append the whole tables to a database reached over JDBC."""
        copy_to_jdbc({table: self.table(table) for table in tables}, url, properties)
