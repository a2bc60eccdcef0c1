"""Commits of captured tables: whole batches, compaction, the stored current state."""

from __future__ import annotations

import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from helpers import multiset, rows
from martloom.operators.current import current_rows
from martloom.streaming import router
from martloom.streaming.changes import DELETED, parse_envelopes
from martloom.streaming.commits import EVERY, CommitConflict, CommitLog, Part
from martloom.streaming.router import clear_removed, compact_day, read_captured, read_current, refresh_current, write_batch
from test_streaming import ENVELOPES, MICROS, change, feed, sale


def test_a_batch_shows_whole_or_not_at_all(spark, tmp_path, monkeypatch):
    root, written = str(tmp_path), []
    changes = parse_envelopes(feed(spark, ENVELOPES))
    real = router._write

    def fails_at_second(*args):
        if written:
            raise OSError("lost")
        written.append(args)
        real(*args)

    monkeypatch.setattr(router, "_write", fails_at_second)
    with pytest.raises(OSError):
        write_batch(changes, 0, root)
    assert list((tmp_path / "customers").iterdir())  # rows of the first table are there, but nobody sees them
    for table in ("customers", "orders", "payments"):
        assert read_captured(spark, root, table).isEmpty()
    monkeypatch.undo()
    write_batch(changes, 0, root)
    assert [read_captured(spark, root, table).count() for table in ("customers", "orders", "payments")] == [2, 2, 1]


def test_earlier_batches_of_a_stream_are_done(spark, tmp_path):
    root = str(tmp_path)
    for batch in (4, 4, 3):
        write_batch(parse_envelopes(feed(spark, ENVELOPES)), batch, root, stream="s")
    write_batch(parse_envelopes(feed(spark, ENVELOPES)), 0, root, stream="other")
    assert read_captured(spark, root, "orders").count() == 4


def test_two_writers_take_different_numbers(spark, tmp_path, monkeypatch):
    log = CommitLog(spark, str(tmp_path))
    stale = log.state()
    assert log.commit([Part("orders", "2024-01-06", "orders/a")]) == 0
    real, answers = CommitLog.state, [stale]
    monkeypatch.setattr(CommitLog, "state", lambda self: answers.pop() if answers else real(self))
    assert log.commit([Part("orders", None, "orders/b")]) == 1
    assert sorted(log.state().live) == ["orders/a", "orders/b"]
    assert [p.folder for p in log.added("orders", 0, 1)] == ["orders/b"]


def test_states_written_now_and_then_equal_all_commits(spark, tmp_path):
    log, live = CommitLog(spark, str(tmp_path)), set()
    for n in range(2 * EVERY + 3):
        gone = sorted(live)[:2] if n % 5 == 4 else []
        assert log.commit([Part("orders", None, f"orders/{n}")], gone, stream="s", batch=n) == n
        live = (live - set(gone)) | {f"orders/{n}"}
    state = log.state()
    assert set(state.live) == live and state.streams == {"s": 2 * EVERY + 2} and state.version == 2 * EVERY + 2
    assert log.commit([], stream="s", batch=7) is None
    with pytest.raises(CommitConflict):
        log.commit([], ["orders/0"])


def test_compaction_keeps_equal_rows_and_rows_without_a_day(spark, tmp_path):
    root = str(tmp_path)
    values = [change("orders", "c", sale(1)), change("orders", "c", sale(1)), change("orders", "c", sale(2, created_at=None))]
    for batch in range(3):
        write_batch(parse_envelopes(feed(spark, values)), batch, root, stream="s")
    before = multiset(read_captured(spark, root, "orders"))
    planned = read_captured(spark, root, "orders")
    assert compact_day(spark, root, "orders", date(2024, 1, 6)) == 3
    assert compact_day(spark, root, "orders", None) == 3
    assert compact_day(spark, root, "orders", None) == 0
    assert multiset(read_captured(spark, root, "orders")) == before and len(before) == 9
    assert multiset(planned) == before  # a reader with the old plan goes on
    assert refresh_current(spark, root, "orders", 2) > 0
    assert clear_removed(spark, root) == 6 and clear_removed(spark, root) == 0
    assert multiset(read_captured(spark, root, "orders")) == before
    assert rows(read_current(spark, root, "orders"), "id") == [(1,), (2,)]


def test_a_delete_needs_only_its_key(spark, tmp_path):
    values = [change("orders", "c", sale(n)) for n in range(4)] + [change("orders", "d", None)] * 3
    keyed = feed(spark, values).withColumn("offset", F.col("key").cast("long"))
    keys = F.when(F.col("offset") < 4, F.col("key")).otherwise(F.get(F.array(F.lit("1"), F.lit('{"id":2}'), F.lit('{"schema":{},"payload":{"id":3}}')), F.col("offset").cast("int") - 4))
    write_batch(parse_envelopes(keyed.withColumn("key", keys), deletes=True), 0, str(tmp_path))
    assert rows(read_current(spark, str(tmp_path), "orders"), "id") == [(0,)]


def history(seed):
    rng = random.Random(seed)
    commits = []
    for _ in range(6):
        offsets = [rng.randrange(1_000_000) for _ in range(rng.randint(1, 40))]
        commits.append([(o, rng.randint(1, 30), rng.choice("ccuud")) for o in offsets])  # offsets out of order: late versions
    return commits


@pytest.mark.parametrize("seed", [1, 2])
def test_refreshed_state_equals_all_versions(spark, tmp_path, seed):
    root, everything = str(tmp_path), []
    for batch, commit in enumerate(history(seed)):
        values = [(str(i), change("orders", op, None if op == "d" else sale(i, amount=str(o)), before=sale(i)), "t", o) for o, i, op in commit]
        df = spark.createDataFrame(values, "key string, value string, topic string, offset long").withColumn("timestamp", F.lit("2024-02-01").cast("timestamp"))
        parsed = parse_envelopes(df, deletes=True)
        everything.append(parsed)
        write_batch(parsed, batch, root, stream="s")
        if batch % 2 == seed % 2:
            refresh_current(spark, root, "orders", 4)
        if batch == 3:
            compact_day(spark, root, "orders", date(2024, 1, 6))
        whole = everything[0]
        for other in everything[1:]:
            whole = whole.unionByName(other)
        expected = current_rows(whole, "id", ["processed_at", "sequence"], F.col("op") == DELETED)
        assert rows(read_current(spark, root, "orders"), "id", "amount") == rows(expected, "id", "amount")


def test_history_before_the_mark_is_not_read(spark, tmp_path):
    root = str(tmp_path)
    write_batch(parse_envelopes(feed(spark, [change("orders", "c", sale(n)) for n in range(50)])), 0, root, stream="s")
    assert refresh_current(spark, root, "orders", 8) == 8
    assert all("/_current/" in f for f in read_current(spark, root, "orders").inputFiles())
    base = router._base(spark, root, "orders")
    before = base._manifest()["folders"]
    update = feed(spark, [change("orders", "u", sale(7, status="shipped", created_at=MICROS + 1))]).withColumn("offset", F.lit(99))
    write_batch(parse_envelopes(update), 1, root, stream="s")
    read = read_current(spark, root, "orders")
    assert {f.split("/batch=")[1].split("/")[0] for f in read.inputFiles() if "/batch=" in f} == {"1"}
    assert rows(read.filter("status = 'shipped'"), "id") == [(7,)] and read.count() == 50
    assert refresh_current(spark, root, "orders", 8) == 1  # one part is written, the others stay
    after = base._manifest()["folders"]
    assert sum(before[k] != after[k] for k in before) == 1
    assert refresh_current(spark, root, "orders", 8) == 0
