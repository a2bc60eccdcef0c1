"""Names of datasets and how each is built and stored."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from threading import RLock

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.operators import quality
from martloom.operators.sinks import publish_files
from martloom.params import Params
from martloom.plans import checks, compact, core, intermediate, marketing, staging
from martloom.sources.reference import country_codes
from martloom.sources.tables import row_counts


@dataclass(frozen=True)
class Model:
    build: Callable[[Warehouse], DataFrame]
    layer: str
    order_by: tuple[str, ...] = ()
    tags: frozenset[str] = frozenset()
    stored: bool = False
    # a roll-up with few rows, which are sorted without a range shuffle
    small: bool = False
    # what is measured while a stored mart is written, besides its rows
    measures: Callable[[Params], dict[str, Column]] = lambda params: {}
    # columns that follow from the others, computed behind the range shuffle of a stored mart
    derived: Callable[[Params], dict[str, Column]] = lambda params: {}


def _view(build: Callable, layer: str, *tags: str) -> Model:
    return Model(build, layer, tags=frozenset({layer, *tags}))


def _nothing(params: Params) -> dict[str, Column]:
    return {}


def _mart(
    build: Callable, order_by: str, *tags: str, small: bool = False, measures: Callable = _nothing, derived: Callable = _nothing
) -> Model:
    return Model(build, "analytics", tuple(order_by.split()), frozenset(tags), True, small, measures, derived)


def _of_orders(params: Params) -> dict[str, Column]:
    return {
        "future_orders": F.count_if(quality.in_future("ordered_at", params)),
        "revenue_mismatch": F.count_if(quality.mismatched_revenue()),
        "newest": F.max("ordered_at"),
    }


def _of_customers(params: Params) -> dict[str, Column]:
    return {"invalid_emails": F.count_if(quality.malformed("email"))}


MODELS: dict[str, Model] = {
    "stg_customers": _view(staging.stg_customers, "staging", "customers"),
    "stg_orders": _view(staging.stg_orders, "staging", "orders"),
    "stg_payments": _view(staging.stg_payments, "staging", "payments"),
    "stg_country_codes": _view(staging.stg_country_codes, "staging", "reference", "countries"),
    "int_customer_orders": _view(intermediate.int_customer_orders, "intermediate", "customers", "orders"),
    "int_order_payments": _view(intermediate.int_order_payments, "intermediate", "orders", "payments"),
    "dim_customers": _mart(core.dim_customers, "customer_id", "marts", "core", "dimension", measures=_of_customers),
    "dim_customers_enriched": _mart(
        core.dim_customers_enriched, "customer_id", "marts", "core", "customers", "enriched"
    ),
    "fct_orders": _mart(
        core.fct_orders, "order_date order_id", "marts", "core", "fact", measures=_of_orders, derived=core.of_orders
    ),
    "fct_daily_sales": _mart(core.fct_daily_sales, "order_date", "marts", "core", "aggregated", small=True),
    "fct_payments": _mart(
        core.fct_payments, "payment_date payment_id", "marts", "core", "payments", derived=core.of_payments
    ),
    "customer_metrics": _mart(marketing.customer_metrics, "customer_id", "marts", "marketing", "metrics"),
    "customer_acquisition": _mart(
        marketing.customer_acquisition, "signup_date", "marts", "marketing", "acquisition", small=True
    ),
    "customer_geography": _mart(
        marketing.customer_geography, "continent country_code", "marts", "marketing", "geography", small=True
    ),
    "dim_dates": _mart(core.dim_dates, "date", "marts", "calendar", small=True),
    "compact_dim_customers": _mart(compact.compact_dim_customers, "customer_id", "marts", "compact"),
    "compact_fct_orders": _mart(compact.compact_fct_orders, "order_id", "marts", "compact"),
}


class Warehouse:
    """Datasets by name over a set of named sources.

    `ref` composes a dataset lazily. With a `root` folder (storage all executors reach), marts are written
    there first and read back: every mart is computed once, and later ones start from files. `fmt` is a file format.
    `ready` are datasets that need not be built. `current`: the sources give one row per id by construction.
    """

    def __init__(
        self,
        spark: SparkSession,
        sources: Mapping[str, Callable[[SparkSession], DataFrame]],
        params: Params = Params(),
        root: str | None = None,
        fmt: str = "parquet",
        ready: Mapping[str, DataFrame] | None = None,
        current: bool = False,
    ):
        self.spark = spark
        self.params = params
        self.root = root
        self.fmt = fmt
        self.current = current
        self._sources = {"country_codes": country_codes, **sources}
        self._read: dict[str, DataFrame] = {}
        self._built: dict[str, DataFrame] = dict(ready or {})
        self._measured: dict[str, dict[str, object]] = {}
        self._locks: defaultdict[str, RLock] = defaultdict(RLock)

    def source(self, name: str) -> DataFrame:
        if name not in self._read:
            self._read[name] = self._sources[name](self.spark)
        return self._read[name]

    def path(self, name: str) -> str:
        return f"{self.root}/{MODELS[name].layer}/{name}"

    def ref(self, name: str) -> DataFrame:
        with self._locks[name]:  # marts may be built by several threads
            if name not in self._built:
                model = MODELS[name]
                df = model.build(self)
                if self.root and model.stored:
                    measures, measured = {"rows": F.count(F.lit(1)), **model.measures(self.params)}, {}
                    derived = model.derived(self.params)
                    df = publish_files(
                        df, self.path(name), model.order_by, self.fmt, not model.small, measures, measured, derived=derived
                    )
                    self._measured[name] = measured
                self._built[name] = df
            return self._built[name]

    def measured(self, name: str) -> dict[str, object]:
        """What was measured when this warehouse stored a mart: its rows, and what its model adds."""
        self.ref(name)
        return self._measured[name]

    def run(self, tags: Iterable[str] = ("marts",), gate: str | None = None, side_by_side: int = 4) -> DataFrame:
        """Build every dataset with one of the tags; returns their row counts.

        gate: "error" stops before any mart is built if an id is not unique, "warn" only says so; parameters that state
        unique ids without a gate get "error" where marts are stored. Stored marts that do not depend on each other are
        built `side_by_side`, and are counted as they are written.
        """
        wanted = [name for name, model in MODELS.items() if model.tags & set(tags)]
        if gate is None and self.root and self.params.unique_ids and not self.current:
            gate = "error"
        if gate:
            quality.require_passed(checks.unique_ids(self), gate)
        stored = [name for name in wanted if self.root and MODELS[name].stored]
        with ThreadPoolExecutor(side_by_side) as pool:
            for built in [pool.submit(inheritable_thread_target(self.spark)(self.ref), name) for name in stored]:
                built.result()
        counts = [(name, self._measured[name]["rows"]) for name in stored if name in self._measured]
        seen = {name for name, _ in counts}
        others = {name: self.ref(name) for name in wanted if name not in seen}
        known = self.spark.createDataFrame(counts, "table_name string, row_count long")
        return known.unionByName(row_counts(others)) if others else known

    def expose(self, *names: str) -> None:
        """Make datasets available to SQL under their own names."""
        for name in names:
            self.ref(name).createOrReplaceTempView(name)
