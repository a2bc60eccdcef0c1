"""Gaps in chains of change images."""

from __future__ import annotations

import json
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from helpers import rows
from martloom.streaming.continuity import GAPS, LAST, check_batch, continuity_gaps, read_gaps, row_images

START = datetime(2024, 1, 6, 22, 30)


def image(id, n):
    return {"id": id, "amount": str(n), "status": "pending"}


def record(at, op, before=None, after=None, table="orders", id=1):
    shown = {"before": None if before is None else image(id, before), "after": None if after is None else image(id, after)}
    value = json.dumps({**shown, "source": {"table": table}, "op": op})
    return (str(id), value, f"shop.public.{table}", START + timedelta(minutes=20 * at), at)


def feed(spark, records):
    return spark.createDataFrame(records, "key string, value string, topic string, timestamp timestamp_ntz, offset long")


def gaps(spark, records, known=None):
    return rows(continuity_gaps(row_images(feed(spark, records)), known), "id", "sequence", "reason")


WHOLE = [record(0, "c", None, 1), record(1, "u", 1, 2), record(5, "u", 2, 3), record(40, "d", 3), record(41, "c", None, 9), record(200, "u", 9, 9)]


def test_a_whole_chain_has_no_gap(spark):
    assert gaps(spark, WHOLE) == []


@pytest.mark.parametrize(
    "lost, found",
    [(0, (1, "unseen")), (1, (5, "differs")), (2, (40, "differs")), (3, (41, "exists")), (4, (200, "deleted")), (5, None)],
)
def test_a_lost_change_shows_at_the_next_one(spark, lost, found):
    left = [r for i, r in enumerate(WHOLE) if i != lost]
    assert gaps(spark, left) == ([] if found is None else [(1, *found)])


def test_other_records(spark):
    records = [
        record(0, "r", None, 5, id=1), record(1, "u", 5, 6, id=1), record(2, "r", None, 8, id=1),  # a snapshot states rows anew
        record(0, "c", None, 1, id=2), record(1, "u", None, 2, id=2), record(2, "u", 3, 4, id=2),  # without an image before
        record(0, "c", None, 1, table="customers", id=3), record(1, "c", None, 1, table="orders", id=3),  # ids of two tables
        ("4", None, "shop.public.orders", START, 0), ("4", "{", "shop.public.orders", START, 1),
        ("4", json.dumps({"op": "c", "after": image(4, 1)}), "shop.public.orders", START, 2),  # no table
    ]
    assert gaps(spark, records) == [(2, 2, "differs")]
    assert continuity_gaps(row_images(feed(spark, []))).count() == 0


def test_records_of_brokers_are_read(spark):
    plain = feed(spark, WHOLE[1:2])
    binary = plain.withColumns({n: F.col(n).cast("binary") for n in ("key", "value")}).withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    assert rows(continuity_gaps(row_images(binary)), "id", "sequence", "reason") == [(1, 1, "unseen")]


def test_late_changes(spark):
    known = row_images(feed(spark, WHOLE[1:2])).select(*LAST.names)
    assert gaps(spark, [WHOLE[0], WHOLE[2]], known) == [(1, 0, "late")]


@pytest.mark.parametrize("size", [1, 2, 3])
def test_batches_find_what_the_whole_feed_shows(spark, tmp_path, size):
    records = [r for i, r in enumerate(WHOLE) if i not in (1, 4)] + [record(3, "u", 1, 2, id=7), record(90, "u", 3, 4, id=7)]
    records.sort(key=lambda r: r[4])
    for n, first in enumerate(range(0, len(records), size)):
        batch = row_images(feed(spark, records[first : first + size]))
        for _ in range(2):  # a batch that is delivered again changes nothing
            check_batch(batch, n, str(tmp_path), parts=3)
    assert rows(read_gaps(spark, str(tmp_path)), *GAPS.names) == rows(continuity_gaps(row_images(feed(spark, records))), *GAPS.names)


def test_a_failure_after_the_gaps_were_written(spark, tmp_path, monkeypatch):
    from martloom.operators.buckets import BucketTable

    whole, broken = str(tmp_path / "whole"), str(tmp_path / "broken")
    first, second = row_images(feed(spark, WHOLE[:2])), row_images(feed(spark, WHOLE[3:]))
    for root in (whole, broken):
        check_batch(first, 0, root, parts=2)
    check_batch(second, 1, whole, parts=2)
    with monkeypatch.context() as patched:
        patched.setattr(BucketTable, "replace", lambda *_: (_ for _ in ()).throw(OSError("disk")))
        with pytest.raises(OSError):
            check_batch(second, 1, broken, parts=2)
    check_batch(second, 1, broken, parts=2)
    assert rows(read_gaps(spark, broken)) == rows(read_gaps(spark, whole)) and read_gaps(spark, broken).count() == 1


def test_a_row_with_many_changes_is_ordered_hour_by_hour(spark):
    plan = continuity_gaps(row_images(feed(spark, WHOLE)))._jdf.queryExecution().optimizedPlan().toString()
    assert "hour(" in plan
    many = [record(n, "u" if n else "c", n - 1 if n else None, n) for n in range(300) if n % 50 != 49]
    assert gaps(spark, many) == sorted([(1, n, "differs") for n in range(50, 300, 50)], key=repr)
