"""The quality checks of this warehouse, one function per rule; each returns check rows."""

from __future__ import annotations

from collections.abc import Mapping
from typing import TYPE_CHECKING

from pyspark.sql import DataFrame

from martloom import schemas
from martloom.operators import quality
from martloom.plans.intermediate import CUSTOMER, parents

if TYPE_CHECKING:
    from martloom.plans.warehouse import Warehouse

# Least number of rows of the watched tables.
ROW_FLOORS = {"stg_customers": 100, "dim_customers": 100, "fct_orders": 500}

_SOURCES = tuple(schemas.REQUIRED_COLUMNS)


# what the source database guarantees and the lake does not


def not_null(w: Warehouse) -> DataFrame:
    return quality.all_of(
        *[quality.not_null(name, w.source(name), schemas.REQUIRED_COLUMNS[name]) for name in _SOURCES]
    )


def unique_ids(w: Warehouse) -> DataFrame:
    """The ids that marts are joined by."""
    return quality.all_of(*[quality.unique(table, w.source(table), schemas.PRIMARY_KEYS[table]) for table in ("customers", "orders")])


def unique(w: Warehouse) -> DataFrame:
    keys = [(table, columns) for table, columns in schemas.PRIMARY_KEYS.items()]
    others = [(table, [column]) for table, columns in schemas.UNIQUE_COLUMNS.items() for column in columns]
    return quality.all_of(*[quality.unique(table, w.source(table), columns) for table, columns in keys + others])


def referential(w: Warehouse) -> DataFrame:
    return quality.all_of(
        *[
            quality.references(table, w.source(table), column, parent, w.source(parent), key)
            for table, (column, parent, key) in schemas.FOREIGN_KEYS.items()
        ]
    )


def non_negative(w: Warehouse) -> DataFrame:
    return quality.all_of(
        *[
            quality.non_negative(table, w.source(table), column)
            for table, columns in schemas.NON_NEGATIVE_COLUMNS.items()
            for column in columns
        ]
    )


# what the marts must fulfil


def future_orders(w: Warehouse) -> DataFrame:
    return quality.count_violations("future_orders", quality.future_rows(w.ref("fct_orders"), "ordered_at", w.params))


def revenue_mismatch(w: Warehouse) -> DataFrame:
    return quality.count_violations("revenue_mismatch", quality.revenue_mismatches(w.ref("fct_orders")))


def invalid_emails(w: Warehouse) -> DataFrame:
    # the customers of the dimension, without the join that only adds their orders
    customers = parents(w, "stg_customers", CUSTOMER)
    return quality.count_violations("invalid_emails", quality.malformed_emails(customers))


# monitoring


def freshness(w: Warehouse) -> DataFrame:
    return quality.freshness("orders_freshness", w.source("orders"), "created_at", w.params)


def row_floors(w: Warehouse, floors: Mapping[str, int] = ROW_FLOORS) -> DataFrame:
    return quality.all_of(*[quality.row_floor(f"row_floor:{name}", w.ref(name), n) for name, n in floors.items()])


def _row_checks(w: Warehouse, table: str, fresh: bool = False) -> DataFrame:
    return quality.row_checks(
        table,
        w.source(table),
        schemas.REQUIRED_COLUMNS[table],
        schemas.NON_NEGATIVE_COLUMNS.get(table, []),
        quality.Fresh("orders_freshness", "created_at") if fresh and table == "orders" else None,
        w.params,
    )


def source_checks(w: Warehouse, fresh: bool = False) -> DataFrame:
    """Rules on single rows take one scan per table; with `fresh`, the newest order's age is part of it."""
    return quality.all_of(*[_row_checks(w, table, fresh) for table in _SOURCES], unique(w), referential(w))


def mart_checks(w: Warehouse) -> DataFrame:
    return quality.all_of(future_orders(w), revenue_mismatch(w), invalid_emails(w))


def monitoring_checks(w: Warehouse) -> DataFrame:
    return quality.all_of(freshness(w), row_floors(w))


def measured_checks(w: Warehouse, floors: Mapping[str, int] = ROW_FLOORS) -> DataFrame:
    """The marts' checks from what was measured when they were stored: no mart is scanned again."""
    orders, customers = w.measured("fct_orders"), w.measured("dim_customers")
    found = [("future_orders", orders["future_orders"]), ("revenue_mismatch", orders["revenue_mismatch"]), ("invalid_emails", customers["invalid_emails"])]
    stored = [name for name in floors if name in ("fct_orders", "dim_customers")]
    found += [(f"row_floor:{name}", max(floors[name] - w.measured(name)["rows"], 0)) for name in stored]
    rows = [(name, violations, violations == 0) for name, violations in found]
    return w.spark.createDataFrame(rows, "check_name string, violations long, passed boolean")
