"""Fixture rows and small comparison helpers."""

from __future__ import annotations

from datetime import datetime
from decimal import Decimal

from pyspark.sql import DataFrame

from martloom import Params, Warehouse
from martloom.schemas import CUSTOMERS, ORDERS, PAYMENTS
from martloom.sources.reference import in_memory

AS_OF = datetime(2024, 3, 1)
REGISTERED = datetime(2024, 1, 5, 22)
PARAMS = Params(as_of=AS_OF, start_date=datetime(2023, 1, 1))


def customer(id, name="N", email="a@b.c", country="US", created=REGISTERED, loaded=REGISTERED):
    return (id, name, email, country, created, loaded)


def order(id, customer_id, amount, status="completed", created=AS_OF, loaded=REGISTERED):
    return (id, customer_id, None if amount is None else Decimal(amount), status, created, loaded)


def payment(id, order_id, amount, method="credit_card", status="completed", created=AS_OF, loaded=REGISTERED):
    return (id, order_id, None if amount is None else Decimal(amount), method, status, created, loaded)


GOLDEN_CUSTOMERS = [
    customer(1, "John Doe", "john.doe@example.com", "US"),
    customer(2, "Jane Smith", "jane.smith@example.com", "GB"),
    customer(3, "Bob Johnson", "bob.johnson@example.com", "CA"),
    customer(4, "Alice Brown", "alice.brown@example.com", "AU"),
    customer(5, "Carlos Silva", "carlos.silva@example.com", "BR"),
    customer(6, "Wei Zhang", "wei.zhang@example.com", "CN"),
    customer(7, "Hans Mueller", "hans.mueller@example.com", "DE"),
]
_T1, _T2, _T3 = datetime(2024, 2, 20, 9), datetime(2024, 1, 10, 12), datetime(2023, 11, 1, 8)
_T4, _T5 = datetime(2024, 2, 20, 18), datetime(2024, 1, 10, 23, 30)
GOLDEN_ORDERS = [
    order(1, 1, "100.50", "completed", _T1, _T1),
    order(2, 2, "75.25", "completed", _T2, _T2),
    order(3, 3, "200.00", "pending", _T3, _T3),
    order(4, 1, "50.00", "completed", _T4, _T4),
    order(5, 4, "150.75", "completed", _T5, _T5),
]
GOLDEN_PAYMENTS = [
    payment(1, 1, "100.50", "credit_card"),
    payment(2, 2, "75.25", "paypal"),
    payment(3, 4, "50.00", "credit_card"),
    payment(4, 5, "150.75", "bank_transfer"),
]


def warehouse(spark, customers=(), orders=(), payments=(), params=PARAMS, root=None) -> Warehouse:
    rows = {"customers": (customers, CUSTOMERS), "orders": (orders, ORDERS), "payments": (payments, PAYMENTS)}
    sources = {
        name: (lambda session, data=data, schema=schema: in_memory(session, data, schema))
        for name, (data, schema) in rows.items()
    }
    return Warehouse(spark, sources, params, root)


def golden(spark, **kwargs) -> Warehouse:
    return warehouse(spark, GOLDEN_CUSTOMERS, GOLDEN_ORDERS, GOLDEN_PAYMENTS, **kwargs)


def rows(df: DataFrame, *columns: str) -> list[tuple]:
    """Rows of the given columns, sorted."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(row) for row in picked.collect()), key=repr)


def by_key(df: DataFrame, key: str, *columns: str) -> dict:
    return {row[0]: tuple(row)[1:] for row in df.select(key, *columns).collect()}


def multiset(df: DataFrame) -> list[tuple]:
    return sorted((tuple(row) for row in df.select(*sorted(df.columns)).collect()), key=repr)
