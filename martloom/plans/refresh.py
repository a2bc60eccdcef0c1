"""Core marts kept up to date from changed ids, without building them anew.

A change travels along the joins of the marts: an order touches its customer's dimension row, a customer whose name, tier
or activity has changed touches all orders of theirs, an order its payments and its day. Each step is a set of keys; the rows
of these keys are built by the same models as in a full build, over sources cut down to them, and take the place of the
old rows in marts stored in parts by key (`BucketTable`). Parts without an affected key are not written.

Sources give current rows with unique ids (`captured_sources` after `refresh_current`). Columns that follow the moment of
the run are those of the run that built the row last; the sum of refreshes equals a full build for one `as_of`.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.operators.buckets import BucketTable
from martloom.operators.files import delete_folder
from martloom.operators.scratch import fresh_folder
from martloom.params import Params
from martloom.plans.warehouse import Warehouse
from martloom.streaming.commits import CommitLog
from martloom.streaming.router import captured_sources, changed_rows, refresh_current
from martloom.schemas import CAPTURED

KEYS = {"dim_customers": "customer_id", "fct_orders": "order_id", "fct_payments": "payment_id", "fct_daily_sales": "order_date"}
#: What an order takes over from its customer.
TAKEN_OVER = ["customer_name", "customer_tier", "activity_status"]

Sources = Mapping[str, Callable[[SparkSession], DataFrame]]


def _union(*sets: DataFrame) -> DataFrame:
    """Distinct, non-null keys of sets with one column each, which takes the name it has in the first."""
    name = sets[0].columns[0]
    return reduce(DataFrame.unionAll, sets).filter(F.col(name).isNotNull()).distinct()


def _only(rows: DataFrame, column: str, keys: DataFrame) -> DataFrame:
    named = keys.select(F.col(keys.columns[0]).alias(column))
    return rows.join(named, column, "left_semi").select(*rows.columns)


@dataclass
class RefreshedMarts:
    spark: SparkSession
    sources: Sources
    params: Params
    root: str
    buckets: int = 64

    def mart(self, name: str) -> BucketTable:
        return BucketTable(self.spark, f"{self.root}/{name}", KEYS[name])

    def read(self, name: str) -> DataFrame:
        return self.mart(name).read()

    def covers(self) -> int:
        return min(self.mart(name).covers() for name in KEYS)

    def _warehouse(self, rows: Mapping[str, DataFrame] = {}, ready: Mapping[str, DataFrame] = {}) -> Warehouse:
        cut = {name: (lambda spark, df=df: df) for name, df in rows.items()}
        return Warehouse(self.spark, {**self.sources, **cut}, self.params, ready=ready)

    def build(self, covers: int = 0) -> None:
        """All rows of all marts, each mart from those before it."""
        ready: dict[str, DataFrame] = {}
        for name in KEYS:
            built = self._warehouse(ready=ready).ref(name)
            self.mart(name).replace(built, range(self.buckets), covers, self.buckets)
            ready[name] = self.read(name)

    def refresh(self, changed: Mapping[str, DataFrame], covers: int = 0) -> dict[str, int]:
        """Bring the marts up to date after changes of the source rows with the given ids (a column `id` per table);
        how many parts of each mart were written."""
        source = {name: self.sources[name](self.spark) for name in CAPTURED}
        ids = {name: changed[name].select("id").filter(F.col("id").isNotNull()).distinct() for name in CAPTURED}
        folder = fresh_folder(self.spark, "refresh")

        def kept(keys: DataFrame, name: str) -> DataFrame:
            keys.write.parquet(f"{folder}/{name}")
            return self.spark.read.schema(keys.schema).parquet(f"{folder}/{name}")

        written: dict[str, int] = {}

        def put(name: str, rows: DataFrame, keys: DataFrame) -> DataFrame:
            key = KEYS[name]
            written[name] = self.mart(name).replace_keys(rows, keys.select(F.col(keys.columns[0]).alias(key)), covers, self.buckets)
            return self.read(name)

        old = {name: self.read(name) for name in KEYS}
        orders = kept(ids["orders"].select(F.col("id").alias("order_id")), "orders")

        # customers: their own changes, and orders that are, or were, theirs
        now_of = _only(source["orders"], "id", orders).select("customer_id")
        then_of = _only(old["fct_orders"], "order_id", orders).select("customer_id")
        customers = kept(_union(ids["customers"].select(F.col("id").alias("customer_id")), now_of, then_of), "customers")
        few = {"customers": _only(source["customers"], "id", customers), "orders": _only(source["orders"], "customer_id", customers)}
        before = _only(old["dim_customers"], "customer_id", customers).select("customer_id", *TAKEN_OVER)
        dim = put("dim_customers", self._warehouse(few).ref("dim_customers"), customers)
        after = _only(dim, "customer_id", customers).select("customer_id", *TAKEN_OVER)
        # null-safe: a row that came, went, or differs
        other = kept(_union(before.exceptAll(after).select("customer_id"), after.exceptAll(before).select("customer_id")), "other-customers")

        # orders: their own changes, payments that are, or were, theirs, and customers that have changed
        paid = ids["payments"].select(F.col("id").alias("payment_id"))
        of_payments = _only(source["payments"], "id", paid).select("order_id")
        were_of = _only(old["fct_payments"], "payment_id", paid).select("order_id")
        of_customers = _only(source["orders"], "customer_id", other).select(F.col("id").alias("order_id"))
        orders = kept(_union(orders, of_payments, were_of, of_customers), "all-orders")
        few = {"orders": _only(source["orders"], "id", orders), "payments": _only(source["payments"], "order_id", orders)}
        days_before = _only(old["fct_orders"], "order_id", orders).select("order_date")
        facts = put("fct_orders", self._warehouse(few, {"dim_customers": dim}).ref("fct_orders"), orders)

        # payments: their own changes, and orders that have changed
        of_orders = _only(source["payments"], "order_id", orders).select(F.col("id").alias("payment_id"))
        payments = kept(_union(paid, of_orders), "payments")
        few = {"payments": _only(source["payments"], "id", payments)}
        put("fct_payments", self._warehouse(few, {"fct_orders": facts}).ref("fct_payments"), payments)

        # days that affected orders are on, or were on
        days = kept(_union(days_before, _only(facts, "order_id", orders).select("order_date")), "days")
        daily = self._warehouse(ready={"fct_orders": _only(facts, "order_date", days)}).ref("fct_daily_sales")
        put("fct_daily_sales", daily, days)
        delete_folder(self.spark, folder)
        return written


def refresh_captured(spark: SparkSession, lake: str, marts: RefreshedMarts, buckets: int = 64) -> dict[str, int]:
    """Bring the current state of a captured lake, then the marts over it, up to its newest commit.

    The first run builds all. Returns how many parts of each mart were written.
    """
    until, since = CommitLog(spark, lake).state().version, marts.covers()
    for table in CAPTURED:
        refresh_current(spark, lake, table, buckets)
    if since < 0:
        marts.build(until)
        return {name: marts.buckets for name in KEYS}
    changed = {table: changed_rows(spark, lake, table, since, until).select("id") for table in CAPTURED}
    return marts.refresh(changed, until)


def marts_over(spark: SparkSession, lake: str, root: str, params: Params, buckets: int = 64) -> RefreshedMarts:
    return RefreshedMarts(spark, captured_sources(lake), params, root, buckets)
