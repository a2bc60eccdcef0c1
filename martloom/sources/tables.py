"""Stored tables: reading, listing, previewing, counting."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def read_files(spark: SparkSession, path: str, fmt: str = "parquet", schema: StructType | None = None) -> DataFrame:
    reader = spark.read.format(fmt)
    return (reader.schema(schema) if schema else reader).load(path)


def read_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Reference data as a CSV file with a header. The path must be visible to all executors."""
    return spark.read.option("header", True).option("enforceSchema", False).schema(schema).csv(path)


def list_tables(spark: SparkSession, namespace: str) -> DataFrame:
    return spark.sql(f"SHOW TABLES IN {namespace}").filter(~F.col("isTemporary")).select("namespace", "tableName")


def preview(df: DataFrame, key: str, rows: int = 5) -> DataFrame:
    """The first rows by key; each task keeps its first ones, so nothing is sorted whole."""
    return df.orderBy(F.col(key).asc_nulls_last()).limit(rows)


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table_name, row_count), one row per table, counted in one job."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    total = counts[0]
    for other in counts[1:]:
        total = total.unionByName(other)
    return total
