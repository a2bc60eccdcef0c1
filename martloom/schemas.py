"""Declared schemas of sources, change events and reference data.

Source timestamps carry no zone, so they are TIMESTAMP_NTZ: results do not depend on the session zone.
"""

from pyspark.sql import types as T

# The column names and types below are the sources' contract.
MONEY = T.DecimalType(10, 2)
# Wide enough for any sum of MONEY values.
MONEY_SUM = T.DecimalType(38, 2)


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


CUSTOMERS = _struct(
    id=T.LongType(),
    name=T.StringType(),
    email=T.StringType(),
    country_code=T.StringType(),
    created_at=T.TimestampNTZType(),
    loaded_at=T.TimestampNTZType(),
)

ORDERS = _struct(
    id=T.LongType(),
    customer_id=T.LongType(),
    amount=MONEY,
    status=T.StringType(),
    created_at=T.TimestampNTZType(),
    loaded_at=T.TimestampNTZType(),
)

PAYMENTS = _struct(
    id=T.LongType(),
    order_id=T.LongType(),
    amount=MONEY,
    payment_method=T.StringType(),
    status=T.StringType(),
    created_at=T.TimestampNTZType(),
    loaded_at=T.TimestampNTZType(),
)

# What the source database guarantees; the lake does not, so these drive the quality checks.
PRIMARY_KEYS = {"customers": ["id"], "orders": ["id"], "payments": ["id"]}
UNIQUE_COLUMNS = {"customers": ["email"]}
FOREIGN_KEYS = {"orders": ("customer_id", "customers", "id"), "payments": ("order_id", "orders", "id")}
REQUIRED_COLUMNS = {
    "customers": ["name", "email"],
    "orders": ["customer_id", "amount", "status"],
    "payments": ["order_id", "amount", "payment_method", "status"],
}
NON_NEGATIVE_COLUMNS = {"orders": ["amount"]}
DEFAULT_VALUES = {
    "customers": {"country_code": "US"},
    "orders": {"status": "pending"},
    "payments": {"status": "pending"},
}

COUNTRY_CODES = _struct(
    country_code=T.StringType(),
    country_name=T.StringType(),
    region=T.StringType(),
    continent=T.StringType(),
    iso_alpha3=T.StringType(),
    currency_code=T.StringType(),
    currency_name=T.StringType(),
    phone_code=T.StringType(),
    gdp_category=T.StringType(),
)

DIM_DATES = _struct(
    date=T.DateType(),
    day=T.IntegerType(),
    month=T.IntegerType(),
    year=T.IntegerType(),
    quarter=T.IntegerType(),
    day_of_week=T.IntegerType(),
    day_name=T.StringType(),
    month_name=T.StringType(),
    is_weekend=T.BooleanType(),
    is_holiday=T.BooleanType(),
    is_business_day=T.BooleanType(),
    week_of_year=T.IntegerType(),
    season=T.StringType(),
    fiscal_year=T.IntegerType(),
    fiscal_quarter=T.IntegerType(),
)

# One record layout serves all captured tables: the union of their columns. Money and times stay text
# until they are converted, because connectors encode them in more than one way.
CHANGE_ROW = _struct(
    id=T.LongType(),
    name=T.StringType(),
    email=T.StringType(),
    country_code=T.StringType(),
    customer_id=T.LongType(),
    order_id=T.LongType(),
    amount=T.StringType(),
    payment_method=T.StringType(),
    status=T.StringType(),
    created_at=T.StringType(),
)

CHANGE_ENVELOPE = _struct(
    before=CHANGE_ROW,
    after=CHANGE_ROW,
    source=_struct(table=T.StringType()),
    op=T.StringType(),
)

# Columns of each captured table, as they are stored in the lake.
CAPTURED = {
    "customers": ["id", "name", "email", "country_code", "created_at"],
    "orders": ["id", "customer_id", "amount", "status", "created_at"],
    "payments": ["id", "order_id", "amount", "payment_method", "status", "created_at"],
}
