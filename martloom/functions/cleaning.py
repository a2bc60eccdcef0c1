"""Cleaning steps shared by the staging models."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.schemas import MONEY, MONEY_SUM


def tidy(text: Column) -> Column:
    return F.trim(text)


def tidy_email(text: Column) -> Column:
    return F.lower(F.trim(text))


def tidy_code(text: Column) -> Column:
    return F.upper(F.trim(text))


def money(value: Column) -> Column:
    return value.cast(MONEY)


def money_total(value: Column) -> Column:
    """Sum of money. The declared result is decimal(38,2), so no sum of a real data set overflows."""
    return F.sum(value.cast("decimal(28,2)")).cast(MONEY_SUM)


def loaded_since(df: DataFrame, moment: Column) -> DataFrame:
    return df.filter(F.col("loaded_at") >= moment)


def require(df: DataFrame, *columns: str) -> DataFrame:
    """Rows in which all the columns are set, as plain conditions that a scan can take over."""
    for name in columns:
        df = df.filter(F.col(name).isNotNull())
    return df


def with_defaults(df: DataFrame, defaults: dict[str, object]) -> DataFrame:
    """Fill missing values the way the source tables' column defaults would."""
    return df.fillna(defaults)
