"""Change capture: parsing, routing, replay."""

from __future__ import annotations

import json
from datetime import date, datetime, timezone
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from helpers import multiset, rows
from martloom import Params, Warehouse
from martloom.functions.times import now
from martloom.operators import quality
from martloom.operators.current import current_rows
from martloom.plans import checks
from martloom.sources.feeds import FEED_SCHEMA, file_feed
from martloom.streaming.changes import parse_envelopes, parse_records
from martloom.streaming.router import (
    captured_between,
    captured_sources,
    compact_day,
    create_captured,
    read_captured,
    rows_of,
    start_capture,
    write_batch,
)

STAMP = datetime(2024, 2, 1, 12)
MICROS = 1_704_499_200_000_000  # 2024-01-06 00:00:00


def change(table, op, after, before=None):
    return json.dumps({"before": before, "after": after, "source": {"table": table}, "op": op})


def person(id, name="Ann", **more):
    return {"id": id, "name": name, "email": "a@b.c", "country_code": "US", "created_at": MICROS, **more}


def sale(id, amount="9.50", **more):
    return {"id": id, "customer_id": 1, "amount": amount, "status": "pending", "created_at": MICROS, **more}


ENVELOPES = [
    change("customers", "c", person(1)),
    change("customers", "u", person(1, "Anna"), before=person(1)),
    change("orders", "r", sale(1)),
    change("orders", "c", sale(2, created_at="2024-01-07T08:00:00")),
    change("payments", "c", {"id": 1, "order_id": 1, "amount": "9.50", "payment_method": "paypal",
                             "status": "completed", "created_at": MICROS}),
    change("orders", "d", None, before=sale(2)),
    change("suppliers", "c", {"id": 9}),
    None,
    "not json {",
    "{}",
]


def feed_rows(values, topic="shop.public.orders"):
    return [(str(n), value, topic, STAMP) for n, value in enumerate(values)]


def feed(spark, values, topic="shop.public.orders"):
    return spark.createDataFrame(feed_rows(values, topic), FEED_SCHEMA)


def write_feed(folder, name, values):
    folder.mkdir(exist_ok=True)
    lines = [
        json.dumps({"key": key, "value": value, "topic": topic, "timestamp": stamp.isoformat() + "Z"})
        for key, value, topic, stamp in feed_rows(values)
    ]
    (folder / name).write_text("\n".join(lines))


def test_envelopes(spark):
    changes = parse_envelopes(feed(spark, ENVELOPES))
    assert rows(changes, "table", "op", "id") == [
        ("customers", "c", 1),
        ("customers", "u", 1),
        ("orders", "c", 2),
        ("orders", "r", 1),
        ("payments", "c", 1),
        ("suppliers", "c", 9),
    ]
    assert rows(rows_of(changes, "customers")) == [
        (1, "Ann", "a@b.c", "US", datetime(2024, 1, 6)),
        (1, "Anna", "a@b.c", "US", datetime(2024, 1, 6)),
    ]
    assert rows(rows_of(changes, "orders")) == [
        (1, 1, D("9.50"), "pending", datetime(2024, 1, 6)),
        (2, 1, D("9.50"), "pending", datetime(2024, 1, 7, 8)),
    ]
    assert rows(rows_of(changes, "payments")) == [(1, 1, D("9.50"), "paypal", "completed", datetime(2024, 1, 6))]


def test_binary_values_as_brokers_deliver_them(spark):
    text = feed(spark, ENVELOPES)
    binary = text.withColumn("value", text.value.cast("binary")).withColumn("key", text.key.cast("binary"))
    assert multiset(parse_envelopes(binary)) == multiset(parse_envelopes(text))


def test_unreadable_fields_become_null(spark):
    changes = parse_envelopes(feed(spark, [change("orders", "c", sale(1, amount="cheap", created_at="soon"))]))
    assert rows(rows_of(changes, "orders")) == [(1, 1, None, "pending", None)]


def test_records(spark):
    values = [json.dumps(sale(1)), None, json.dumps(sale(2, amount=3)), "not json {"]
    changes = parse_records(feed(spark, values))
    assert rows(changes, "table", "id", "amount") == [("orders", 1, D("9.50")), ("orders", 2, D("3.00"))]
    assert "op" not in changes.columns


def test_json_is_parsed_once(spark):
    plan = parse_envelopes(feed(spark, ENVELOPES))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


@pytest.mark.parametrize("repeatable", [True, False])
def test_stream_equals_batch(spark, tmp_path, repeatable):
    write_feed(tmp_path / "feed", "1.json", ENVELOPES[:4])
    write_feed(tmp_path / "feed", "2.json", ENVELOPES[4:])
    lake, progress = str(tmp_path / "lake"), str(tmp_path / "progress")

    def drain():
        changes = parse_envelopes(file_feed(spark, str(tmp_path / "feed"), max_files_per_trigger=1))
        start_capture(changes, lake, progress, repeatable).awaitTermination()

    drain()
    expected = parse_envelopes(feed(spark, ENVELOPES))
    for table in ("customers", "orders", "payments"):
        assert multiset(read_captured(spark, lake, table)) == multiset(rows_of(expected, table))

    # Nothing new: nothing is added. A new file: only its rows are.
    drain()
    assert read_captured(spark, lake, "orders").count() == 2
    write_feed(tmp_path / "feed", "3.json", [change("orders", "c", sale(3))])
    drain()
    assert rows(read_captured(spark, lake, "orders"), "id") == [(1,), (2,), (3,)]
    assert read_captured(spark, lake, "customers").count() == 2


def test_replayed_batch(spark, tmp_path):
    changes = parse_envelopes(feed(spark, ENVELOPES))
    for _ in range(2):
        write_batch(changes, 7, str(tmp_path / "once"))
        write_batch(changes, 7, str(tmp_path / "again"), repeatable=False)
    assert read_captured(spark, str(tmp_path / "once"), "orders").count() == 2
    assert read_captured(spark, str(tmp_path / "again"), "orders").count() == 4


def test_batch_without_rows_writes_nothing(spark, tmp_path):
    write_batch(parse_envelopes(feed(spark, [None, "{}"])), 0, str(tmp_path / "lake"))
    assert not (tmp_path / "lake").exists()


def test_tables_without_events_are_empty(spark, tmp_path):
    write_feed(tmp_path / "feed", "1.json", ENVELOPES[:2])
    lake = str(tmp_path / "lake")
    start_capture(parse_envelopes(file_feed(spark, str(tmp_path / "feed"))), lake, str(tmp_path / "p")).awaitTermination()
    assert read_captured(spark, lake, "payments").count() == 0
    shop = Warehouse(spark, captured_sources(lake), Params(as_of=STAMP, unique_ids=True))
    assert rows(shop.ref("dim_customers"), "customer_name", "total_orders") == [("Anna", 0)]
    assert shop.ref("fct_payments").isEmpty()


def test_a_new_progress_folder_loses_nothing(spark, tmp_path):
    lake = str(tmp_path / "lake")
    for run, values in (("a", [change("orders", "c", sale(1))]), ("b", [change("orders", "c", sale(2))])):
        write_feed(tmp_path / run, "1.json", values)
        changes = parse_envelopes(file_feed(spark, str(tmp_path / run)))
        start_capture(changes, lake, str(tmp_path / f"progress-{run}")).awaitTermination()
    assert rows(read_captured(spark, lake, "orders"), "id") == [(1,), (2,)]


def test_updates_do_not_multiply_and_deletes_count(spark, tmp_path):
    values = [
        change("customers", "c", person(1)),
        change("orders", "c", sale(1)),
        change("orders", "u", sale(1, status="shipped"), before=sale(1)),
        change("orders", "u", sale(1, status="completed"), before=sale(1)),
        change("orders", "c", sale(2)),
        change("orders", "d", None, before=sale(2)),
        change("payments", "c", {"id": 1, "order_id": 1, "amount": "9.50", "payment_method": "paypal", "status": "completed", "created_at": MICROS}),
    ]
    numbered = feed(spark, values).withColumn("offset", F.col("key").cast("long"))
    write_batch(parse_envelopes(numbered, deletes=True), 0, str(tmp_path))
    create_captured(spark, str(tmp_path))
    shop = Warehouse(spark, captured_sources(str(tmp_path)), Params(as_of=STAMP, unique_ids=True))
    assert rows(shop.ref("fct_orders"), "order_id", "order_status", "paid_amount") == [(1, "completed", D("9.50"))]
    assert shop.ref("fct_payments").count() == 1
    assert rows(shop.ref("fct_daily_sales"), "daily_orders", "daily_revenue") == [(1, D("9.50"))]
    assert read_captured(spark, str(tmp_path), "orders").count() == 4  # all versions


def test_current_rows(spark):
    df = spark.createDataFrame(
        [(1, 5, "a", "c"), (1, 6, "b", "u"), (2, 9, "x", "d"), (2, 1, "y", "c"), (3, 1, "p", None), (3, 1, "q", None), (None, 1, "n", "c")],
        "id long, at long, v string, op string",
    )
    for parts in (1, 7):
        got = current_rows(df.repartition(parts), "id", ["at"], F.col("op") == "d")
        assert rows(got, "id", "v") == [(1, "b"), (3, "q")]
    assert current_rows(df.limit(0), "id", ["at"]).isEmpty()


@pytest.mark.parametrize("zone", ["UTC", "America/Los_Angeles"])
def test_times_are_utc_in_every_session_zone(spark, tmp_path, zone):
    write_feed(tmp_path / "feed", "1.json", [change("orders", "c", sale(n)) for n in range(3)])
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", zone)
        lake = str(tmp_path / "lake")
        start_capture(parse_envelopes(file_feed(spark, str(tmp_path / "feed"))), lake, str(tmp_path / "p")).awaitTermination()
        staged = Warehouse(spark, captured_sources(lake), Params(start_date=STAMP)).ref("stg_orders")
        assert staged.count() == 3 and dict(staged.dtypes)["loaded_at"] == "timestamp_ntz"
        assert rows(staged, "ordered_at", "loaded_at")[0] == (datetime(2024, 1, 6), STAMP)
        moment = spark.range(1).select(now(Params())).first()[0]
        assert abs((moment - datetime.now(timezone.utc).replace(tzinfo=None)).total_seconds()) < 600
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_odd_times_are_null(spark):
    odd = ["1704499200000000000", "9" * 30, "-9223372036854775808", "soon", "", None, "99999-01-01", "2024-02-30", MICROS, "2024-01-06T00:00:00"]
    changes = parse_envelopes(feed(spark, [change("orders", "c", sale(n, created_at=value)) for n, value in enumerate(odd)]))
    got = [at for _, at in sorted((r[0], r[1]) for r in changes.select("id", "created_at").collect())]
    assert got == [None] * 8 + [datetime(2024, 1, 6)] * 2


def test_days_prune_and_small_folders_merge(spark, tmp_path):
    root = str(tmp_path)
    for batch in range(3):
        values = [change("orders", "c", sale(batch * 10 + n, created_at=MICROS + n * 43_200_000_000)) for n in range(6)]
        write_batch(parse_envelopes(feed(spark, values)), batch, root, stream="s")
    some = captured_between(spark, root, "orders", datetime(2024, 1, 6, 12), datetime(2024, 1, 7, 12))
    assert sorted(r[0] for r in rows(some, "id")) == [1, 2, 11, 12, 21, 22]
    text = some._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dt" in text
    versions = multiset(read_captured(spark, root, "orders"))
    assert compact_day(spark, root, "orders", date(2024, 1, 6)) == 3
    assert compact_day(spark, root, "orders", date(2024, 1, 6)) == 0
    assert multiset(read_captured(spark, root, "orders")) == versions
    write_batch(parse_envelopes(feed(spark, [change("orders", "c", sale(99))])), 3, root, stream="s")
    assert compact_day(spark, root, "orders", date(2024, 1, 6)) == 2
    assert read_captured(spark, root, "orders").count() == 19


def test_tables_are_partitioned_by_day(spark, tmp_path):
    write_batch(parse_envelopes(feed(spark, ENVELOPES)), 0, str(tmp_path))
    days = sorted(path.name for path in (tmp_path / "orders").iterdir() if path.is_dir())
    assert days == ["dt=2024-01-06", "dt=2024-01-07"]
    plan = spark.read.parquet(str(tmp_path / "orders")).filter("dt = date'2024-01-07'")
    assert "PartitionFilters: [isnotnull(dt" in plan._jdf.queryExecution().executedPlan().toString()
    assert plan.count() == 1


def test_captured_tables_feed_the_warehouse(spark, tmp_path):
    """From change events to marts: an update replaces the row, in the lake it is a further version."""
    write_feed(tmp_path / "feed", "1.json", ENVELOPES)
    lake = str(tmp_path / "lake")
    changes = parse_envelopes(file_feed(spark, str(tmp_path / "feed")))
    start_capture(changes, lake, str(tmp_path / "progress")).awaitTermination()
    assert read_captured(spark, lake, "customers").count() == 2

    shop = Warehouse(spark, captured_sources(lake), Params(as_of=STAMP, unique_ids=True), root=str(tmp_path / "marts"))
    assert shop.ref("dim_customers").select("total_orders").collect() == [(2,)]
    assert rows(shop.ref("int_order_payments"), "order_id", "payment_status") == [(1, "fully_paid"), (2, "unpaid")]
    assert shop.run(["core"], gate="error").count() >= 5

    raw = {t: (lambda s, t=t: read_captured(s, lake, t).withColumn("loaded_at", F.col("created_at"))) for t in ("customers", "orders", "payments")}
    versions = Warehouse(spark, raw, Params(as_of=STAMP))
    assert rows(quality.only_failed(checks.unique(versions)), "check_name") == [("unique:customers.email",), ("unique:customers.id",)]
    with pytest.raises(quality.QualityError, match="unique:customers.id"):
        versions.run(["core"], gate="error")
