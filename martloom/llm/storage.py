"""Tables in the folder that driver and executors share: they cut lineage and outlive executors."""

from __future__ import annotations

from pyspark.sql import DataFrame

from martloom.operators.scratch import fresh_folder


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """The rows of df, written to the shared folder and read back."""
    spark = df.sparkSession
    folder = fresh_folder(spark, purpose)
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)
