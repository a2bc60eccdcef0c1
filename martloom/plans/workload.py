"""The queries offered over the sample tables, by name: every dataset, check, sink and change-capture path."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import replace
from datetime import datetime, timedelta
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from martloom import schemas
from martloom.functions.calendar import date_range, with_calendar
from martloom.functions.cleaning import with_defaults
from martloom.functions.segments import is_completed
from martloom.functions.times import ago, at
from martloom.operators import quality, sinks
from martloom.operators.distinct import distinct_counts, distinct_states
from martloom.operators.scratch import fresh_folder
from martloom.plans import checks
from martloom.plans.refresh import marts_over, refresh_captured
from martloom.plans.warehouse import Warehouse
from martloom.sources.sample import (
    SAMPLE_PARAMS,
    awkward_sources,
    chained_feed,
    envelope_feed,
    event_stream,
    events,
    faulty_feed,
    odd_times_feed,
    record_feed,
    sample_sources,
    versioned_feed,
)
from martloom.sources.tables import list_tables, preview, read_csv, read_files, read_table, row_counts
from martloom.streaming.changes import each_once, parse_envelopes, parse_records, rejected_envelopes, unknown_fields
from martloom.streaming.continuity import continuity_gaps, read_gaps, row_images, watch_continuity
from martloom.streaming.router import (
    captured_between,
    captured_sources,
    compact_day,
    read_captured,
    read_current,
    refresh_current,
    start_capture,
)

Query = Callable[[SparkSession, str], DataFrame]

DATASETS = [
    "stg_customers",
    "stg_orders",
    "stg_payments",
    "int_customer_orders",
    "int_order_payments",
    "dim_customers",
    "dim_customers_enriched",
    "fct_orders",
    "fct_daily_sales",
    "fct_payments",
    "customer_metrics",
    "customer_acquisition",
    "customer_geography",
    "dim_dates",
    "compact_dim_customers",
    "compact_fct_orders",
]

# Cut-offs inside the sample's time span, so that both outcomes occur.
LATE_START = datetime(1998, 1, 1)
EARLY_AS_OF = datetime(1999, 1, 1)
# The end of the sample's events, and days within them.
CAPTURED_AS_OF = datetime(2024, 2, 1)
# Parts of stored tables of the sample's size.
SAMPLE_BUCKETS = 4
SOME_DAYS = (datetime(2024, 1, 10, 6), datetime(2024, 1, 13))
# Moves the sample's years over those that have holidays.
HOLIDAY_SHIFT = 8401


def money_as_double(df: DataFrame) -> DataFrame:
    """Decimals as doubles, the form in which results are exchanged with other engines."""
    return df.select(
        *[
            F.col(field.name).cast("double").alias(field.name)
            if isinstance(field.dataType, DecimalType)
            else F.col(field.name)
            for field in df.schema
        ]
    )


def sample_warehouse(spark: SparkSession, folder: str, root: str | None = None, **params) -> Warehouse:
    return Warehouse(spark, sample_sources(folder), replace(SAMPLE_PARAMS, **params), root)


def awkward_warehouse(spark: SparkSession, folder: str) -> Warehouse:
    return Warehouse(spark, awkward_sources(folder), replace(SAMPLE_PARAMS, unique_ids=False))


def _awkward(build: Callable[[Warehouse], DataFrame]) -> Query:
    return lambda spark, folder: money_as_double(build(awkward_warehouse(spark, folder)))


def _dataset(name: str, **params) -> Query:
    return lambda spark, folder: money_as_double(sample_warehouse(spark, folder, **params).ref(name))


def _of(build: Callable[[Warehouse], DataFrame], **params) -> Query:
    return lambda spark, folder: money_as_double(build(sample_warehouse(spark, folder, **params)))


# selections from datasets


def country_codes_in_use(w: Warehouse) -> DataFrame:
    """The country table's rows that customers refer to."""
    used = w.ref("stg_customers").select("country_code").distinct()
    return used.join(w.ref("stg_country_codes"), "country_code")


def country_lookup_unmatched(w: Warehouse) -> DataFrame:
    return (
        w.ref("dim_customers_enriched")
        .filter(F.col("country_name").isNull())
        .select("customer_id", "country_code", "continent_group", "economic_tier")
    )


def orders_unpaid(w: Warehouse) -> DataFrame:
    return (
        w.ref("int_order_payments")
        .filter(F.col("payment_status") == "unpaid")
        .select("order_id", "customer_id", "order_amount", "payment_count", "distinct_payment_methods")
    )


def rfm_counts(w: Warehouse) -> DataFrame:
    return (
        w.ref("customer_metrics")
        .groupBy("recency_segment", "frequency_segment", "monetary_segment")
        .agg(F.count(F.lit(1)).alias("customers"))
    )


# quality


def dq_invalid_email_rows(w: Warehouse) -> DataFrame:
    return quality.malformed_emails(w.ref("dim_customers")).select("customer_id", "email")


def dq_defaults(w: Warehouse) -> DataFrame:
    filled = with_defaults(w.source("customers"), schemas.DEFAULT_VALUES["customers"])
    return filled.select("id", F.upper(F.trim("country_code")).alias("country_code"))


def dq_failed_checks(w: Warehouse) -> DataFrame:
    """The failed ones among the source checks, the customers' emails and the freshness of orders."""
    return quality.only_failed(quality.all_of(checks.source_checks(w, fresh=True), checks.invalid_emails(w)))


def dq_revenue_mismatch_violated(w: Warehouse) -> DataFrame:
    """A stored fact may differ from its rule: here the revenue of some orders has been changed."""
    changed = F.when(F.col("order_id") % 17 == 0, F.col("net_revenue") + 1).otherwise(F.col("net_revenue"))
    stored = w.ref("fct_orders").withColumn("net_revenue", changed)
    return quality.count_violations("revenue_mismatch", quality.revenue_mismatches(stored))


def status_defaults(w: Warehouse) -> DataFrame:
    return with_defaults(w.source("orders"), schemas.DEFAULT_VALUES["orders"]).select("id", "customer_id", "amount", "status")


def dim_dates_holidays(w: Warehouse) -> DataFrame:
    """The calendar over the days of the orders, moved to years with holidays."""
    moved = F.date_add("order_date", HOLIDAY_SHIFT)
    bounds = w.ref("stg_orders").agg(F.min(moved).alias("first"), F.max(moved).alias("last"))
    return with_calendar(date_range(bounds, "first", "last"))


# sinks


def _by_day(spark: SparkSession, folder: str) -> DataFrame:
    path = fresh_folder(spark, "by-day")
    sinks.write_by_day(sample_warehouse(spark, folder).ref("stg_customers"), path, "registered_at")
    return read_files(spark, path)


def _sorted(spark: SparkSession, folder: str) -> DataFrame:
    path = fresh_folder(spark, "sorted")
    orders = sample_warehouse(spark, folder).ref("stg_orders")
    return money_as_double(sinks.publish_files(orders, path, ["order_date", "order_id"]))


def _stored_marts(spark: SparkSession, folder: str) -> DataFrame:
    """All marts written in dependency order; their row counts."""
    return sample_warehouse(spark, folder, root=fresh_folder(spark, "marts")).run(gate="error")


def _measured_checks(spark: SparkSession, folder: str) -> DataFrame:
    """The marts' checks, measured while all marts are written."""
    w = sample_warehouse(spark, folder, root=fresh_folder(spark, "marts"), as_of=EARLY_AS_OF)
    w.run(gate="error")
    return checks.measured_checks(w)


def bucketed_warehouse(spark: SparkSession, folder: str, lake: str) -> Warehouse:
    """The sample with orders and payments stored in parts by order: they meet without a shuffle."""
    plain, keys = sample_warehouse(spark, folder), {"orders": "id", "payments": "order_id"}
    buckets = sinks.buckets_for(map(plain.source, keys), SAMPLE_BUCKETS)
    for name, key in keys.items():
        sinks.write_bucketed(plain.source(name), f"{lake}.by_order_{name}", key, buckets)
    by_order = {name: (lambda spark, name=name: read_table(spark, f"{lake}.by_order_{name}")) for name in ("orders", "payments")}
    return Warehouse(spark, sample_sources(folder) | by_order, SAMPLE_PARAMS)


def _bucketed(name: str) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        with _lake(spark) as lake:
            return _kept(money_as_double(bucketed_warehouse(spark, folder, lake).ref(name)))

    return query


def _look_up(spark: SparkSession, folder: str) -> DataFrame:
    """Customers looked up by id in the stored dimension: the first and the last one, and the one between."""
    w, path = sample_warehouse(spark, folder), fresh_folder(spark, "dimension")
    sinks.publish_files(w.ref("dim_customers"), path, ["customer_id"])
    sinks.publish_ranges(spark, path, ["customer_id"])
    first, last = sinks.read_published(spark, path).agg(F.min("customer_id"), F.max("customer_id")).first()
    return money_as_double(sinks.look_up(spark, path, "customer_id", [first, (first + last) // 2, last]))


def _look_up_orders(spark: SparkSession, folder: str) -> DataFrame:
    """All orders of two customers in the fact, which is sorted by day: row groups without them are told by Bloom filters."""
    w, path = sample_warehouse(spark, folder), fresh_folder(spark, "fact")
    sinks.publish_files(w.ref("fct_orders"), path, ["order_date", "order_id"], bloom=["customer_id"])
    sinks.publish_ranges(spark, path, ["customer_id"])
    least, greatest = sinks.read_published(spark, path).agg(F.min("customer_id"), F.max("customer_id")).first()
    return money_as_double(sinks.look_up(spark, path, "customer_id", [least, greatest]))


def _stored(name: str) -> Query:
    """The contents of a mart as they were written and read back."""
    return lambda spark, folder: money_as_double(sample_warehouse(spark, folder, root=fresh_folder(spark, "marts")).ref(name))


@contextmanager
def _lake(spark: SparkSession) -> Iterator[str]:
    """A namespace in the shared folder with empty customers and orders tables, dropped after use."""
    namespace = f"lake_{uuid4().hex}"
    sinks.create_namespace(spark, namespace, fresh_folder(spark, "lake"))
    try:
        sinks.create_table(spark, f"{namespace}.customers", schemas.CUSTOMERS)
        sinks.create_table(spark, f"{namespace}.orders", schemas.ORDERS)
        yield namespace
    finally:
        spark.sql(f"DROP DATABASE {namespace} CASCADE")


def _kept(df: DataFrame) -> DataFrame:
    """The rows as files of their own, which outlive the tables they came from."""
    path = fresh_folder(df.sparkSession, "kept")
    df.write.parquet(path)
    return read_files(df.sparkSession, path)


def _append_twice(spark: SparkSession, folder: str) -> DataFrame:
    orders = sample_warehouse(spark, folder).source("orders")
    with _lake(spark) as lake:
        sinks.append(orders, f"{lake}.orders")
        sinks.append(orders, f"{lake}.orders")
        return _kept(money_as_double(read_table(spark, f"{lake}.orders")))


def _seed_if_empty(spark: SparkSession, folder: str) -> DataFrame:
    customers = sample_warehouse(spark, folder).source("customers")
    with _lake(spark) as lake:
        sinks.append_if_empty(customers, f"{lake}.customers")
        sinks.append_if_empty(customers, f"{lake}.customers")
        return _kept(read_table(spark, f"{lake}.customers"))


def _table_counts(spark: SparkSession, folder: str) -> DataFrame:
    """List the tables of a filled namespace and count their rows."""
    warehouse = sample_warehouse(spark, folder)
    with _lake(spark) as lake:
        for table in ("customers", "orders"):
            sinks.append(warehouse.source(table), f"{lake}.{table}")
        names = [row.tableName for row in list_tables(spark, lake).collect()]
        return _kept(row_counts({name: read_table(spark, f"{lake}.{name}") for name in names}))


def _csv_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    path = fresh_folder(spark, "csv")
    sample_warehouse(spark, folder).ref("dim_dates").write.option("header", True).csv(path)
    return read_csv(spark, path, schemas.DIM_DATES)


# change capture


def _captured(table: str, parse: Callable, feed: Callable, repeatable: bool) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        root = fresh_folder(spark, "capture")
        changes = parse(feed(event_stream(spark, folder)))
        start_capture(changes, f"{root}/lake", f"{root}/progress", repeatable).awaitTermination()
        return money_as_double(read_captured(spark, f"{root}/lake", table))

    return query


def _capture_versions(spark: SparkSession, folder: str) -> str:
    root = fresh_folder(spark, "capture")
    changes = parse_envelopes(versioned_feed(event_stream(spark, folder)), deletes=True)
    start_capture(changes, f"{root}/lake", f"{root}/progress").awaitTermination()
    return f"{root}/lake"


def _current_orders(spark: SparkSession, folder: str) -> DataFrame:
    return money_as_double(read_current(spark, _capture_versions(spark, folder), "orders"))


def _captured_fct_orders(spark: SparkSession, folder: str) -> DataFrame:
    """From change events to the order fact: one row per order, however many versions were captured."""
    sources = captured_sources(_capture_versions(spark, folder))
    return money_as_double(Warehouse(spark, sources, replace(SAMPLE_PARAMS, as_of=CAPTURED_AS_OF)).ref("fct_orders"))


def _two_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Two streams with progress folders of their own write to one lake."""
    root = fresh_folder(spark, "capture")
    for run in range(2):
        some = event_stream(spark, folder).filter(F.col("event_id") % 2 == run)
        start_capture(parse_envelopes(envelope_feed(some)), f"{root}/lake", f"{root}/progress-{run}").awaitTermination()
    return money_as_double(read_captured(spark, f"{root}/lake", "orders"))


def _orders_of_days(spark: SparkSession, folder: str) -> DataFrame:
    root = fresh_folder(spark, "capture")
    changes = parse_envelopes(envelope_feed(event_stream(spark, folder)))
    start_capture(changes, f"{root}/lake", f"{root}/progress").awaitTermination()
    return money_as_double(captured_between(spark, f"{root}/lake", "orders", *SOME_DAYS))


def _redelivered(spark: SparkSession, folder: str) -> DataFrame:
    """A feed that brings every record twice."""
    root, twice = fresh_folder(spark, "capture"), event_stream(spark, folder).unionByName(event_stream(spark, folder))
    changes = parse_envelopes(each_once(envelope_feed(twice), by=("topic", "key")))
    start_capture(changes, f"{root}/lake", f"{root}/progress").awaitTermination()
    return money_as_double(read_captured(spark, f"{root}/lake", "orders"))


def _empty_batch(spark: SparkSession, folder: str) -> DataFrame:
    """A stream whose batch has no row, then one with all rows."""
    root = fresh_folder(spark, "capture")
    for run, some in enumerate((event_stream(spark, folder).filter("event_id < 0"), event_stream(spark, folder))):
        start_capture(parse_envelopes(envelope_feed(some)), f"{root}/lake", f"{root}/progress-{run}").awaitTermination()
    return money_as_double(read_captured(spark, f"{root}/lake", "orders"))


def _compacted(spark: SparkSession, folder: str) -> DataFrame:
    """Two streams bring the same changes without a time; the small folders of such rows are merged."""
    root = fresh_folder(spark, "capture")
    for run in range(2):
        timeless = parse_envelopes(envelope_feed(event_stream(spark, folder))).withColumn("created_at", F.lit(None).cast("timestamp_ntz"))
        start_capture(timeless, f"{root}/lake", f"{root}/progress-{run}").awaitTermination()
    compact_day(spark, f"{root}/lake", "orders", None)
    return money_as_double(read_captured(spark, f"{root}/lake", "orders"))


def _key_deletes(spark: SparkSession, folder: str) -> DataFrame:
    """The current orders where deletes have a key and no image of the row."""
    root = fresh_folder(spark, "capture")
    changes = parse_envelopes(versioned_feed(event_stream(spark, folder), images=False), deletes=True)
    start_capture(changes, f"{root}/lake", f"{root}/progress").awaitTermination()
    return money_as_double(read_current(spark, f"{root}/lake", "orders"))


def _capture_in_parts(spark: SparkSession, folder: str, after_each: Callable[[str], object]) -> str:
    """Two captures into one lake, of two thirds and of one third of the changes, and something done after each."""
    root = fresh_folder(spark, "capture")
    for run, some in enumerate(("event_id % 3 <> 0", "event_id % 3 = 0")):
        changes = parse_envelopes(versioned_feed(event_stream(spark, folder).filter(some)), deletes=True)
        start_capture(changes, f"{root}/lake", f"{root}/progress-{run}").awaitTermination()
        after_each(f"{root}/lake")
    return f"{root}/lake"


def _current_in_parts(refreshes: int) -> Query:
    """The current orders after two captures; refreshed after both, or only after the first."""

    def query(spark: SparkSession, folder: str) -> DataFrame:
        left = iter(range(refreshes))
        lake = _capture_in_parts(spark, folder, lambda lake: next(left, None) is None or refresh_current(spark, lake, "orders", SAMPLE_BUCKETS))
        return money_as_double(read_current(spark, lake, "orders"))

    return query


def _refreshed(name: str) -> Query:
    """A mart that was built after the first capture and refreshed after the second."""

    def query(spark: SparkSession, folder: str) -> DataFrame:
        root, params = fresh_folder(spark, "marts"), replace(SAMPLE_PARAMS, as_of=CAPTURED_AS_OF)
        lake = _capture_in_parts(spark, folder, lambda lake: refresh_captured(spark, lake, marts_over(spark, lake, root, params, SAMPLE_BUCKETS), SAMPLE_BUCKETS))
        return money_as_double(marts_over(spark, lake, root, params).read(name))

    return query


def _customers_by_month(spark: SparkSession, folder: str) -> DataFrame:
    """Distinct customers of each month, from stored bitmaps of its days."""
    path = fresh_folder(spark, "states")
    orders = sample_warehouse(spark, folder).ref("fct_orders").filter(is_completed(F.col("order_status")))
    distinct_states(orders, "customer_id", "order_date", "order_year", "order_month").write.parquet(path)
    return distinct_counts(read_files(spark, path), "monthly_customers", "order_year", "order_month")


def _customers_by_day(w: Warehouse) -> DataFrame:
    orders = w.ref("fct_orders").filter(is_completed(F.col("order_status")))
    return distinct_counts(distinct_states(orders, "customer_id", "order_date"), "daily_customers", "order_date")


def _reject_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Records by reason of rejection; those without one are accepted. The numbers add up to the feed."""
    feed = faulty_feed(events(spark, folder))
    rejected = rejected_envelopes(feed).select("key", "reason")
    return feed.join(rejected, "key", "left").groupBy(F.coalesce("reason", F.lit("accepted")).alias("reason")).agg(F.count(F.lit(1)).alias("records"))


def _unknown_fields(spark: SparkSession, folder: str) -> DataFrame:
    found = unknown_fields(faulty_feed(events(spark, folder)))
    return found.select(F.col("key").cast("bigint").alias("id"), F.explode("fields").alias("field", "content"))


def _gaps(spark: SparkSession, folder: str) -> DataFrame:
    return continuity_gaps(row_images(chained_feed(events(spark, folder))))


def _watched_gaps(spark: SparkSession, folder: str) -> DataFrame:
    """The same feed arrives in two parts, each checked against the last changes of the part before."""
    root, feed = fresh_folder(spark, "continuity"), chained_feed(events(spark, folder))
    for part in (F.col("timestamp") < at(SOME_DAYS[1]), F.col("timestamp") >= at(SOME_DAYS[1])):
        feed.filter(part).write.mode("append").parquet(f"{root}/feed")
        arriving = spark.readStream.schema(feed.schema).parquet(f"{root}/feed")
        watch_continuity(row_images(arriving), root, f"{root}/progress", SAMPLE_BUCKETS).awaitTermination()
    return read_gaps(spark, root)


def _parse_binary(spark: SparkSession, folder: str) -> DataFrame:
    """Keys and values as brokers deliver them."""
    feed = envelope_feed(events(spark, folder))
    binary = feed.withColumns({name: F.col(name).cast("binary") for name in ("key", "value")})
    return money_as_double(parse_envelopes(binary))


def orders_before_now(w: Warehouse) -> DataFrame:
    """Orders that are more than a day old at the real moment of the run."""
    return w.ref("stg_orders").filter(F.col("ordered_at") < ago(w.params, timedelta(days=1))).select("order_id", "order_date")


def _values_and_view(spark: SparkSession, folder: str) -> DataFrame:
    """A dataset as a view under its own name, joined in SQL with inline rows."""
    sample_warehouse(spark, folder).expose("stg_orders")
    return spark.sql("""
        SELECT label, count(*) AS orders, CAST(sum(order_amount) AS DOUBLE) AS amount
        FROM stg_orders JOIN VALUES ('completed', 'done'), ('pending', 'open'), ('shipped', 'open') AS labels(status, label)
            ON order_status = status
        GROUP BY label""")


def queries() -> dict[str, Query]:
    return {
        **{name: _dataset(name) for name in DATASETS},
        "fct_orders_any_ids": _dataset("fct_orders", unique_ids=False),
        "start_date_cutoff": _dataset("stg_orders", start_date=LATE_START),
        "customer_metrics_early": _dataset("customer_metrics", as_of=EARLY_AS_OF),
        "country_codes_in_use": _of(country_codes_in_use),
        "country_lookup_unmatched": _of(country_lookup_unmatched),
        "orders_unpaid": _of(orders_unpaid),
        "rfm_counts": _of(rfm_counts),
        "dq_future_orders": _of(checks.future_orders, as_of=EARLY_AS_OF),
        "dq_revenue_mismatch": _of(checks.revenue_mismatch),
        "dq_invalid_emails": _of(checks.invalid_emails),
        "dq_invalid_email_rows": _of(dq_invalid_email_rows),
        "dq_freshness": _of(checks.freshness),
        "dq_row_floors": _of(checks.row_floors),
        "dq_not_null": _of(checks.not_null),
        "dq_unique": _of(checks.unique),
        "dq_referential": _of(checks.referential),
        "dq_non_negative": _of(checks.non_negative),
        "dq_defaults": _of(dq_defaults),
        "dq_failed_checks": _of(dq_failed_checks),
        "cdc_parse": lambda spark, folder: money_as_double(parse_envelopes(envelope_feed(events(spark, folder)))),
        "cdc_flat_parse": lambda spark, folder: money_as_double(parse_records(record_feed(events(spark, folder)))),
        "cdc_stream_customers": _captured("customers", parse_envelopes, envelope_feed, repeatable=True),
        "cdc_stream_orders": _captured("orders", parse_envelopes, envelope_feed, repeatable=True),
        "cdc_stream_payments": _captured("payments", parse_records, record_feed, repeatable=False),
        "sink_partitioned_roundtrip": _by_day,
        "sink_sorted_roundtrip": _sorted,
        "sink_stored_marts": _stored_marts,
        "append_twice": _append_twice,
        "seed_if_empty": _seed_if_empty,
        "table_counts": _table_counts,
        "csv_roundtrip": _csv_roundtrip,
        "preview": _of(lambda w: preview(w.source("orders"), "id")),
        "cdc_parse_odd_times": lambda spark, folder: parse_records(odd_times_feed(events(spark, folder))).select("id", "created_at"),
        "cdc_stream_two_runs": _two_runs,
        "current_orders": _current_orders,
        "captured_fct_orders": _captured_fct_orders,
        "captured_orders_of_days": _orders_of_days,
        "stored_fct_payments": _stored("fct_payments"),
        "stored_customer_geography": _stored("customer_geography"),
        "fct_orders_repeated_ids": _awkward(lambda w: w.ref("fct_orders")),
        "fct_payments_orphans": _awkward(lambda w: w.ref("fct_payments")),
        "dq_non_negative_violated": _awkward(checks.non_negative),
        "dq_not_null_violated": _awkward(checks.not_null),
        "dq_unique_violated": _awkward(checks.unique),
        "dq_referential_violated": _awkward(checks.referential),
        "dq_revenue_mismatch_violated": _of(dq_revenue_mismatch_violated),
        "status_defaults": _awkward(status_defaults),
        "dim_dates_holidays": _of(dim_dates_holidays),
        "cdc_parse_binary": _parse_binary,
        "cdc_redelivered": _redelivered,
        "cdc_empty_batch": _empty_batch,
        "cdc_reject_counts": _reject_counts,
        "cdc_unknown_fields": _unknown_fields,
        "cdc_continuity_gaps": _gaps,
        "cdc_continuity_stream": _watched_gaps,
        "captured_compacted": _compacted,
        "current_after_key_deletes": _key_deletes,
        "current_orders_refreshed": _current_in_parts(2),
        "current_orders_partly_refreshed": _current_in_parts(1),
        "refreshed_fct_orders": _refreshed("fct_orders"),
        "refreshed_fct_payments": _refreshed("fct_payments"),
        "refreshed_fct_daily_sales": _refreshed("fct_daily_sales"),
        "customers_by_month": _customers_by_month,
        "customers_by_day": _of(_customers_by_day),
        "orders_before_now": _of(orders_before_now, as_of=None),
        "values_and_view": _values_and_view,
        "sink_measured_checks": _measured_checks,
        "bucketed_order_payments": _bucketed("int_order_payments"),
        "bucketed_fct_payments": _bucketed("fct_payments"),
        "customer_look_up": _look_up,
        "customer_orders_look_up": _look_up_orders,
    }
