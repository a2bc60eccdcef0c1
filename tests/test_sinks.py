"""Sinks, sources and the lake."""

from __future__ import annotations

from collections import Counter
from datetime import date
from decimal import Decimal as D
from pathlib import Path

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from helpers import AS_OF, PARAMS, golden, multiset, order, rows
from martloom import Warehouse
from martloom.operators import scratch, sinks
from martloom.plans.lake import Lake
from martloom.schemas import COUNTRY_CODES, ORDERS
from martloom.sources import feeds, reference, tables


@pytest.fixture
def lake(spark, tmp_path):
    return Lake(spark, f"lake_{tmp_path.name}", str(tmp_path / "warehouse"))


def test_bootstrap_is_repeatable(spark, lake):
    lake.bootstrap(PARAMS)
    lake.bootstrap(PARAMS)
    assert rows(lake.table("customers"), "id", "name", "country_code", "created_at") == [
        (1, "John Doe", "US", AS_OF),
        (2, "Jane Smith", "GB", AS_OF),
        (3, "Bob Johnson", "CA", AS_OF),
    ]
    assert rows(lake.table("orders"), "id", "customer_id", "amount", "status") == [
        (1, 1, D("100.50"), "completed"),
        (2, 2, D("75.25"), "pending"),
        (3, 1, D("50.75"), "completed"),
    ]
    assert rows(tables.list_tables(spark, lake.namespace), "tableName") == [("customers",), ("orders",)]
    assert rows(lake.counts()) == [("customers", 3), ("orders", 3)]


def test_lake_tables_feed_the_warehouse(spark, lake):
    lake.bootstrap(PARAMS)
    totals = rows(Warehouse(spark, lake.sources(), PARAMS).ref("dim_customers"), "customer_id", "total_spent")
    assert totals == [(1, D("151.25")), (2, D("0.00")), (3, D("0.00"))]


def test_append_matches_columns_by_name(spark, lake):
    lake.bootstrap(PARAMS)
    shuffled = lake.table("orders").filter("id = 1").select("created_at", "status", "amount", "customer_id", "id")
    sinks.append(shuffled, lake.name("orders"))
    assert Counter(row[0] for row in lake.table("orders").select("id").collect()) == {1: 2, 2: 1, 3: 1}


def test_append_if_empty_reports(spark, lake):
    lake.create()
    rows_ = golden(spark).source("orders").drop("loaded_at")
    assert sinks.append_if_empty(rows_, lake.name("orders"))
    assert not sinks.append_if_empty(rows_, lake.name("orders"))
    assert lake.table("orders").count() == 5


def test_overwrite_table(spark, lake):
    lake.create()
    name = lake.name("dim")
    for _ in range(2):
        sinks.overwrite_table(golden(spark).ref("dim_customers"), name, ["customer_id"])
    assert multiset(tables.read_table(spark, name)) == multiset(golden(spark).ref("dim_customers"))


def test_a_missing_table_is_an_error(spark, lake):
    with pytest.raises(AnalysisException):
        lake.table("customers").count()


def test_write_by_day_prunes(spark, tmp_path):
    df = golden(spark).ref("stg_orders")
    sinks.write_by_day(df, str(tmp_path), "ordered_at")
    sinks.write_by_day(df, str(tmp_path), "ordered_at")
    stored = tables.read_files(spark, str(tmp_path))
    assert stored.count() == 10
    one_day = stored.filter(F.col(sinks.DAY) == date(2024, 2, 20))
    assert one_day.count() == 4
    assert "PartitionFilters: [isnotnull(dt" in one_day._jdf.queryExecution().executedPlan().toString()


def test_sorted_files_have_narrow_ranges_even_for_one_heavy_day(spark, tmp_path):
    """A third of the rows falls on one day: the day is cut over several files, and files stay sorted."""
    days = F.when(F.col("id") % 3 == 0, F.lit("2024-01-15")).otherwise(
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 31).cast("int"))
    )
    df = spark.range(60_000).select("id", days.cast("date").alias("day"))
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    try:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        spark.conf.set("spark.sql.shuffle.partitions", "10")
        stored = sinks.publish_files(df, str(tmp_path), ["day", "id"])
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert multiset(stored.groupBy("day").count()) == multiset(df.groupBy("day").count())
    per_file = stored.groupBy(F.input_file_name().alias("file")).agg(
        F.count("*").alias("n"), F.countDistinct("day").alias("days")
    )
    files = per_file.collect()
    assert len(files) == 10
    assert max(row.n for row in files) < 12_000
    assert max(row.days for row in files) <= 8


def test_copy_to_jdbc_settings(spark, monkeypatch):
    """No database here: the writer's settings are recorded instead of being saved."""
    saved = []

    def save(writer, *args, **kwargs):
        saved.append(writer.settings)

    def options(writer, **settings):
        writer.settings = settings
        return writer

    monkeypatch.setattr(DataFrameWriter, "options", options)
    monkeypatch.setattr(DataFrameWriter, "save", save)
    monkeypatch.setattr(DataFrameWriter, "format", lambda writer, name: writer if name == "jdbc" else None)
    built = golden(spark)
    sinks.copy_to_jdbc(
        {"customers": built.source("customers"), "orders": built.source("orders")},
        "jdbc:olap://host/analytics",
        {"user": "u", "driver": "org.example.Driver"},
    )
    assert [settings["dbtable"] for settings in saved] == ["customers", "orders"]
    assert saved[0]["url"] == "jdbc:olap://host/analytics" and saved[0]["driver"] == "org.example.Driver"
    assert "numPartitions" not in saved[0]


def test_csv_reference_data(spark, tmp_path):
    countries = reference.country_codes(spark)
    countries.write.option("header", True).csv(str(tmp_path / "countries"))
    assert multiset(tables.read_csv(spark, str(tmp_path / "countries"), COUNTRY_CODES)) == multiset(countries)
    assert countries.count() == 20
    built = golden(spark)
    built._sources["country_codes"] = lambda session: tables.read_csv(session, str(tmp_path / "countries"), COUNTRY_CODES)
    assert multiset(built.ref("dim_customers_enriched")) == multiset(golden(spark).ref("dim_customers_enriched"))


def test_small_tables_are_broadcast_by_size(spark):
    plan = golden(spark).ref("dim_customers_enriched")
    plan.collect()
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin [country_code" in text


def test_in_memory_rows(spark):
    df = reference.in_memory(spark, [order(1, 2, "3.50")], ORDERS)
    assert df.schema == ORDERS
    assert rows(df, "id", "customer_id", "amount") == [(1, 2, D("3.50"))]
    assert reference.in_memory(spark, [], ORDERS).isEmpty()


def test_kafka_feed_needs_its_connector(spark):
    with pytest.raises(AnalysisException, match="kafka"):
        feeds.kafka_feed(spark, "localhost:9092", ["shop.public.orders"], max_offsets_per_trigger=10)


def test_a_failed_rewrite_leaves_the_old_version_readable(spark, tmp_path):
    path = str(tmp_path / "mart")
    old = spark.range(5)
    assert multiset(sinks.publish_files(old, path, ["id"])) == multiset(old)
    broken = spark.range(7).select(F.when(F.col("id") == 3, F.raise_error(F.lit("broken"))).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="broken"):
        sinks.publish_files(broken, path)
    assert multiset(sinks.read_published(spark, path)) == multiset(old)


def test_versions_are_switched_and_old_ones_deleted(spark, tmp_path):
    path = str(tmp_path / "mart")
    first = sinks.publish_files(spark.range(1), path)
    sinks.publish_files(spark.range(2), path, ["id"], ranged=False)
    assert first.count() == 1  # a reader of the version before is not disturbed
    sinks.publish_files(spark.range(3), path)
    assert sinks.read_published(spark, path).count() == 3
    assert len([f for f in (tmp_path / "mart").iterdir() if f.is_dir()]) == 2
    with pytest.raises(FileNotFoundError):
        sinks.read_published(spark, str(tmp_path / "none"))


def test_preview_is_the_first_rows_by_key(spark):
    df = spark.createDataFrame([(5, "e"), (None, "n"), (1, "a"), (3, "c"), (2, "b")], "id long, v string").repartition(3)
    assert rows(tables.preview(df, "id", 3)) == [(1, "a"), (2, "b"), (3, "c")]


def test_scratch_needs_a_shared_folder_unless_the_session_is_local(spark, monkeypatch):
    class Cluster:
        master = "yarn"

        def getConf(self):
            return {}

    class Session:
        sparkContext = Cluster()
        conf = {}

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch.shared_folder(Session())


def test_scratch_is_below_the_configured_folder(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    folder = scratch.fresh_folder(spark, "x")
    assert folder != scratch.fresh_folder(spark, "x")
    if configured:
        assert folder.startswith(configured)


def test_passing_folders_go_when_their_block_ends_and_others_stay(spark):
    before = scratch.fresh_folder(spark, "before")
    spark.range(3).write.parquet(before)
    with pytest.raises(ValueError), scratch.passing_folders(spark):
        inside, unused = scratch.fresh_folder(spark, "inside"), scratch.fresh_folder(spark, "unused")
        spark.range(5).write.parquet(inside)
        assert unused != inside and spark.read.parquet(inside).count() == 5
        raise ValueError("the work failed")
    assert not Path(inside).exists() and spark.read.parquet(before).count() == 3


def _scanned_rows(df) -> int:
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))


def test_a_look_up_by_an_unsorted_column_reads_no_row_group_without_the_value(spark, tmp_path):
    # every file holds the whole range of values, so ranges of files tell nothing
    table = spark.range(0, 40_000, 1, 4).select("id", ((F.col("id") * 7919) % 40_009 * 2).alias("customer_id"))
    scanned = {}
    for bloom in ([], ["customer_id"]):
        path = str(tmp_path / f"bloom-{len(bloom)}")
        with_filters = sinks.publish_files(table, path, ["id"], bloom=bloom)
        assert multiset(with_filters) == multiset(table)
        sinks.publish_ranges(spark, path, ["customer_id"])
        absent, there = (sinks.look_up(spark, path, "customer_id", [value]) for value in (40_001, 7919 * 2))
        assert rows(there) == [(1, 7919 * 2)]
        scanned[len(bloom)] = _scanned_rows(absent)
        assert absent.count() == 0
    assert scanned[1] == 0 < scanned[0]
