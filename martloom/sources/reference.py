"""Reference data that ships with the package, and in-memory rows in general."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from martloom.schemas import COUNTRY_CODES

# Code, name, region, continent, ISO alpha-3, currency code and name, phone code, income group.
COUNTRIES = (
    ("US", "United States", "North America", "North America", "USA", "USD", "US Dollar", "1", "High Income"),
    ("CA", "Canada", "North America", "North America", "CAN", "CAD", "Canadian Dollar", "1", "High Income"),
    ("MX", "Mexico", "North America", "North America", "MEX", "MXN", "Mexican Peso", "52", "Upper Middle Income"),
    ("GB", "United Kingdom", "Western Europe", "Europe", "GBR", "GBP", "British Pound", "44", "High Income"),
    ("DE", "Germany", "Western Europe", "Europe", "DEU", "EUR", "Euro", "49", "High Income"),
    ("FR", "France", "Western Europe", "Europe", "FRA", "EUR", "Euro", "33", "High Income"),
    ("IT", "Italy", "Southern Europe", "Europe", "ITA", "EUR", "Euro", "39", "High Income"),
    ("ES", "Spain", "Southern Europe", "Europe", "ESP", "EUR", "Euro", "34", "High Income"),
    ("RU", "Russia", "Eastern Europe", "Europe", "RUS", "RUB", "Russian Ruble", "7", "Upper Middle Income"),
    ("CN", "China", "East Asia", "Asia", "CHN", "CNY", "Chinese Yuan", "86", "Upper Middle Income"),
    ("JP", "Japan", "East Asia", "Asia", "JPN", "JPY", "Japanese Yen", "81", "High Income"),
    ("KR", "South Korea", "East Asia", "Asia", "KOR", "KRW", "South Korean Won", "82", "High Income"),
    ("IN", "India", "South Asia", "Asia", "IND", "INR", "Indian Rupee", "91", "Lower Middle Income"),
    ("SG", "Singapore", "Southeast Asia", "Asia", "SGP", "SGD", "Singapore Dollar", "65", "High Income"),
    ("AU", "Australia", "Australasia", "Oceania", "AUS", "AUD", "Australian Dollar", "61", "High Income"),
    ("BR", "Brazil", "South America", "South America", "BRA", "BRL", "Brazilian Real", "55", "Upper Middle Income"),
    ("AR", "Argentina", "South America", "South America", "ARG", "ARS", "Argentine Peso", "54", "Upper Middle Income"),
    ("ZA", "South Africa", "Southern Africa", "Africa", "ZAF", "ZAR", "South African Rand", "27", "Upper Middle Income"),
    ("NG", "Nigeria", "West Africa", "Africa", "NGA", "NGN", "Nigerian Naira", "234", "Lower Middle Income"),
    ("EG", "Egypt", "North Africa", "Africa", "EGY", "EGP", "Egyptian Pound", "20", "Lower Middle Income"),
)


def in_memory(spark: SparkSession, rows: Iterable[Sequence], schema: StructType) -> DataFrame:
    """A frame of a few driver-side rows. Spark knows its exact size, so it can decide on broadcasting."""
    columns = list(zip(*rows)) or [()] * len(schema)
    arrow_schema = to_arrow_schema(schema)
    arrays = [pa.array(values, field.type) for values, field in zip(columns, arrow_schema)]
    return spark.createDataFrame(pa.Table.from_arrays(arrays, schema=arrow_schema), schema)


def country_codes(spark: SparkSession) -> DataFrame:
    return in_memory(spark, COUNTRIES, COUNTRY_CODES)
