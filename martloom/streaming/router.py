"""Fan-out of parsed changes into one lake table per captured source table, and reading them.

Layout of a captured table: dt=<day of created_at>/stream=<id>/batch=<number>. The day comes first, so a range of times
prunes folders. The stream's own id keeps apart what runs with different progress folders write: their batch numbers both
start at 0. All tables of a batch appear in one commit (`commits`), and readers take the folders that commits name: they see
a batch whole or not at all, a batch that is replayed is there once, and merging small folders changes no row.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from datetime import date, datetime
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import DateType, LongType, StringType, StructField, StructType

from martloom.functions.times import at
from martloom.operators.buckets import BucketTable
from martloom.operators.current import current_rows
from martloom.operators.files import delete_folder, make_folder
from martloom.operators.sinks import DAY
from martloom.schemas import CAPTURED, CUSTOMERS, ORDERS, PAYMENTS
from martloom.streaming.changes import DELETED
from martloom.streaming.commits import CommitLog, Part

STREAM, BATCH = "stream", "batch"
MERGED = "merged"
#: Spark's folder for a null partition value.
NO_DAY = "__HIVE_DEFAULT_PARTITION__"
NEWEST_BY = ("loaded_at", "sequence")

_STORED: Mapping[str, StructType] = {
    table: StructType([*schema, StructField("op", StringType()), StructField("sequence", LongType())])
    for table, schema in {"customers": CUSTOMERS, "orders": ORDERS, "payments": PAYMENTS}.items()
}


def rows_of(changes: DataFrame, table: str) -> DataFrame:
    return changes.filter(F.col("table") == table).select(*CAPTURED[table])


def table_path(root: str, table: str) -> str:
    return f"{root}/{table}"


def create_captured(spark: SparkSession, root: str) -> None:
    """The tables' folders, so that a table without any event yet can be read (and is empty)."""
    for table in CAPTURED:
        make_folder(spark, table_path(root, table))


def _to_store(changes: DataFrame, table: str) -> DataFrame:
    rows = changes.filter(F.col("table") == table).withColumnRenamed("processed_at", "loaded_at")
    if "op" not in rows.columns:
        rows = rows.withColumn("op", F.lit(None).cast("string"))
    return rows.select(*[F.col(field.name).cast(field.dataType) for field in _STORED[table]])


def _write(rows: DataFrame, path: str, stream: str, batch_id: int, fmt: str) -> None:
    placed = rows.withColumns({DAY: F.to_date("created_at"), STREAM: F.lit(stream), BATCH: F.lit(batch_id)})
    writer = placed.hint("rebalance", DAY).write.format(fmt).mode("overwrite").partitionBy(DAY, STREAM, BATCH)
    writer.option("partitionOverwriteMode", "dynamic").save(path)


def _part(table: str, day: date | None, stream: str, batch_id: int) -> Part:
    name = None if day is None else day.isoformat()
    return Part(table, name, f"{table}/{DAY}={name or NO_DAY}/{STREAM}={stream}/{BATCH}={batch_id}")


def write_batch(
    changes: DataFrame, batch_id: int, root: str, repeatable: bool = True, stream: str = "batch", fmt: str = "parquet"
) -> None:
    """Write one micro-batch. The batch is parsed once and kept while its tables are written; then one commit shows them.

    repeatable: a batch of a stream that has been committed (or a later one has) is not written again. Otherwise rows are
    added each time, at least once. In both forms an update adds a row version. fmt: a file format.
    """
    log = CommitLog(changes.sparkSession, root)
    if repeatable and log.state().streams.get(stream, -1) >= batch_id:
        return
    name = stream if repeatable else f"{stream}-{uuid4().hex}"
    kept = changes.filter(F.col("table").isin(*CAPTURED)).persist()
    try:
        # One pass fills the cache and tells which days of which tables the batch touches.
        days = kept.select("table", F.to_date("created_at").alias("day")).distinct().collect()
        for table in CAPTURED:
            if any(row.table == table for row in days):
                _write(_to_store(kept, table), table_path(root, table), name, batch_id, fmt)
        if days:
            parts = [_part(row.table, row.day, name, batch_id) for row in days]
            log.commit(parts, stream=name, batch=batch_id)
    finally:
        kept.unpersist()


def start_capture(
    changes: DataFrame,
    root: str,
    checkpoint: str,
    repeatable: bool = True,
    drain: bool = True,
    interval: str = "10 seconds",
    fmt: str = "parquet",
) -> StreamingQuery:
    """Stream parsed changes into the lake below `root`.

    drain: work off what the feed holds now and stop (scheduled runs); otherwise keep running.
    Progress lives in `checkpoint`; starting again with it continues where the last run ended, under the same id.
    """
    create_captured(changes.sparkSession, root)

    def write(df: DataFrame, batch_id: int) -> None:
        stream = df.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        write_batch(df, batch_id, root, repeatable, stream, fmt)

    trigger = {"availableNow": True} if drain else {"processingTime": interval}
    return (
        changes.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .outputMode("update")
        .trigger(**trigger)
        .start()
    )


def _load(spark: SparkSession, root: str, table: str, parts: Iterable[Part], fmt: str) -> DataFrame:
    schema = StructType([*_STORED[table], *_folders()])
    folders = [f"{root}/{part.folder}" for part in parts]
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).format(fmt).option("basePath", table_path(root, table)).load(folders)


def _stored(spark: SparkSession, root: str, table: str, fmt: str) -> DataFrame:
    return _load(spark, root, table, CommitLog(spark, root).state().parts(table), fmt)


def _folders() -> list[StructField]:
    return [StructField(DAY, DateType()), StructField(STREAM, StringType()), StructField(BATCH, LongType())]


def _not_deleted() -> Column:
    return F.col("op").isNull() | (F.col("op") != DELETED)


def read_captured(spark: SparkSession, root: str, table: str, fmt: str = "parquet") -> DataFrame:
    """All row versions of a captured table, deletions left out."""
    return _stored(spark, root, table, fmt).filter(_not_deleted()).select(*CAPTURED[table])


def captured_between(
    spark: SparkSession, root: str, table: str, since: datetime, until: datetime, fmt: str = "parquet"
) -> DataFrame:
    """Row versions created in [since, until). Only the folders of those days are listed and read."""
    days = F.col(DAY).between(F.lit(since.date()), F.lit(until.date()))
    created = F.col("created_at")
    parts = CommitLog(spark, root).state().parts(table)
    some = [part for part in parts if part.day and since.date().isoformat() <= part.day <= until.date().isoformat()]
    rows = _load(spark, root, table, some, fmt).filter(days & (created >= at(since)) & (created < at(until)))
    return rows.filter(_not_deleted()).select(*CAPTURED[table])


def _base(spark: SparkSession, root: str, table: str) -> BucketTable:
    return BucketTable(spark, f"{root}/_current/{table}", "id", _STORED[table])


def changed_rows(spark: SparkSession, root: str, table: str, after: int, until: int | None = None, fmt: str = "parquet") -> DataFrame:
    """Row versions, deletions too, that commits after `after` brought; up to `until` or the newest commit."""
    log = CommitLog(spark, root)
    parts = log.added(table, after, log.state().version if until is None else until)
    return _load(spark, root, table, parts, fmt).select(*_STORED[table].names)


def refresh_current(spark: SparkSession, root: str, table: str, buckets: int = 64, fmt: str = "parquet") -> int:
    """Merge what was committed since the last refresh into the stored newest versions; how many buckets were written.

    The base is stored in `buckets` parts by a hash of the id, together with the number of the last commit in it. Only
    newer folders are read, and only the parts that hold one of their ids are read and written; the new base is
    switched to in one step. Deletions stay in the base, so that an older version that comes late does not revive a row.
    """
    base, until = _base(spark, root, table), CommitLog(spark, root).state().version
    changes = changed_rows(spark, root, table, base.covers(), until, fmt).filter(F.col("id").isNotNull())
    touched = base.buckets_of(changes, buckets)
    newest = current_rows(base.read(touched).unionByName(changes), "id", NEWEST_BY) if touched else changes
    base.replace(newest, touched, until, buckets)
    return len(touched)


def read_current(spark: SparkSession, root: str, table: str, fmt: str = "parquet") -> DataFrame:
    """The newest version of every row that has not been deleted, with its load stamp. One row per id.

    With a stored base (`refresh_current`) only newer commits are reduced, and met by the rows of their ids; the other
    rows of the base pass through, and the history before it is not read.
    """
    base = _base(spark, root, table)
    log = CommitLog(spark, root)
    if base.covers() < 0:
        newest = current_rows(_stored(spark, root, table, fmt).select(*_STORED[table].names), "id", NEWEST_BY)
    elif parts := log.added(table, base.covers(), log.state().version):
        changes = _load(spark, root, table, parts, fmt).select(*_STORED[table].names)
        ids, rows = changes.select("id").distinct(), base.read()
        met = rows.join(ids, "id", "left_semi").select(*rows.columns).unionByName(changes)
        newest = rows.join(ids, "id", "left_anti").select(*rows.columns).unionByName(current_rows(met, "id", NEWEST_BY))
    else:
        newest = base.read()
    return newest.filter(_not_deleted()).select(*CAPTURED[table], "loaded_at")


def captured_sources(root: str, fmt: str = "parquet") -> dict[str, Callable[[SparkSession], DataFrame]]:
    """The captured tables in their current state as sources of a warehouse: ids are unique, so state it in the
    parameters. Their load stamp is the time of the change event."""

    def reader(table: str) -> Callable[[SparkSession], DataFrame]:
        return lambda spark: read_current(spark, root, table, fmt)

    return {table: reader(table) for table in CAPTURED}


def compact_day(spark: SparkSession, root: str, table: str, day: date | None, fmt: str = "parquet") -> int:
    """Merge the small folders of a day (None: of rows without one) into one; returns how many were merged.

    One commit puts the merged folder in place of the others. No row is changed or dropped, whatever a reader or a
    failure does in between; the old folders stay for readers that still use them, until `clear_removed`.
    """
    log = CommitLog(spark, root)
    name = None if day is None else day.isoformat()
    parts = [part for part in log.state().parts(table) if part.day == name]
    if len(parts) < 2:
        return 0
    merged = f"{MERGED}-{uuid4().hex}"
    _write(_load(spark, root, table, parts, fmt).select(*_STORED[table].names), table_path(root, table), merged, 0, fmt)
    log.commit([_part(table, day, merged, 0)], [part.folder for part in parts], rearranges=True)
    return len(parts)


def clear_removed(spark: SparkSession, root: str, before: int | None = None) -> int:
    """Delete folders that commits before `before` (any commit) removed; how many. Stored bases must cover those commits."""
    log = CommitLog(spark, root)
    state = log.state()
    least = min((base.covers() for base in (_base(spark, root, table) for table in CAPTURED) if base.covers() >= 0), default=state.version)
    old = [folder for folder, version in state.removed.items() if version <= least and (before is None or version < before)]
    for folder in old:
        delete_folder(spark, f"{root}/{folder}")
    if old:
        log.commit(cleared=old, rearranges=True)
    return len(old)
