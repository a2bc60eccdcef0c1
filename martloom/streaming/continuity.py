"""Whether captured changes join up: the image before a change is the row that the change before left.

A change that was lost shows where the next one of its row starts from something else. Only digests of the images are
kept. Changes are ordered by `processed_at` and `sequence`, as everywhere in change capture.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StringType, StructField, StructType, TimestampNTZType

from martloom.functions.segments import first_match
from martloom.operators.buckets import BucketTable
from martloom.operators.current import current_rows
from martloom.operators.files import folders_in
from martloom.schemas import CHANGE_ENVELOPE
from martloom.streaming.changes import DELETED, KEPT_OPERATIONS, key_id, only_where, parsed_values

NEWEST_BY = ("processed_at", "sequence")
#: The last change of every row, as it is kept between batches.
LAST = StructType(
    [
        StructField("row_key", StringType()),
        StructField("op", StringType()),
        StructField("after", StringType()),
        StructField("processed_at", TimestampNTZType()),
        StructField("sequence", LongType()),
    ]
)
GAPS = StructType(
    [
        StructField("table", StringType()),
        StructField("id", LongType()),
        StructField("op", StringType()),
        StructField("reason", StringType()),
        StructField("processed_at", TimestampNTZType()),
        StructField("sequence", LongType()),
    ]
)


def _digest(image: Column) -> Column:
    return F.when(image.isNotNull(), F.md5(F.to_json(image)))


def row_images(feed: DataFrame) -> DataFrame:
    """row_key, table, id, op, before, after, processed_at, sequence of every change in envelope form.

    before and after are digests of the images, null where there is none. Records without an operation, a table or an id
    have no place in a chain and are left out.
    """
    parsed = parsed_values(feed, CHANGE_ENVELOPE, key_id(F.col("key")).alias("key_id"))
    kept = only_where(parsed, F.col("parsed.op").isin(*KEPT_OPERATIONS, DELETED))
    images = kept.select(
        F.col("parsed.source.table").alias("table"),
        F.coalesce("parsed.after.id", "parsed.before.id", "key_id").alias("id"),
        F.col("parsed.op").alias("op"),
        _digest(F.col("parsed.before")).alias("before"),
        _digest(F.col("parsed.after")).alias("after"),
        *NEWEST_BY,
    )
    return images.select(F.concat_ws(":", "table", "id").alias("row_key"), "*").filter("table IS NOT NULL AND id IS NOT NULL")


def _reason(last: Column) -> Column:
    """Why a change does not follow from `last`, the operation and image that its row had before."""
    changes, gone = F.col("op").isin("u", DELETED), last["op"] == DELETED
    return first_match(
        [
            (F.col("late"), "late"),
            (F.col("op") == "r", None),
            (last.isNull() & changes, "unseen"),
            (gone & changes, "deleted"),
            (last.isNotNull() & ~gone & (F.col("op") == "c"), "exists"),
            (last.isNotNull() & ~gone & F.col("before").isNotNull() & ~F.col("before").eqNullSafe(last["after"]), "differs"),
        ]
    )


def continuity_gaps(images: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """The changes that do not follow from the one before, with the reason: table, id, op, reason, processed_at, sequence.

    unseen: the first one of a row is not its creation. deleted: the row had been deleted. exists: a row is created that
    is there. differs: the image before is not the row as it was left. late: not newer than the last known change.
    A change without an image before cannot differ; reading a snapshot (r) states a row anew and follows from anything.
    `known` has the last change of rows seen earlier (LAST).

    A row's changes are compared within each hour first, then only the ends of the hours, so that a row with very many
    changes is not ordered in one task.
    """
    spark = images.sparkSession
    before = spark.createDataFrame([], LAST) if known is None else known
    held = before.select(
        "row_key", F.struct("op", "after").alias("held"), F.struct(*NEWEST_BY).alias("held_at")
    )
    rows = images.join(held, "row_key", "left").withColumn("late", F.coalesce(F.struct(*NEWEST_BY) <= F.col("held_at"), F.lit(False)))
    # changes of the same moment, which a broker's offset excludes, are put in some fixed order
    order = [*NEWEST_BY, "op", "before", "after"]
    left = F.struct("op", "after")
    hour = Window.partitionBy("row_key", "late", F.to_date("processed_at"), F.hour("processed_at")).orderBy(*order)
    inner = rows.withColumns({"last": F.lag(left).over(hour), "ends": F.lead(F.lit(True)).over(hour).isNull()})
    # what an hour's first change follows is known only across hours; others are settled
    opens = F.col("last").isNull()
    settled = inner.withColumn("reason", F.when(~opens | F.col("late"), _reason(F.col("last"))))
    kept = settled.filter(opens | F.col("ends") | F.col("reason").isNotNull())
    earlier = Window.partitionBy("row_key", "late").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    across = F.coalesce(F.last(F.when(F.col("ends"), left), ignorenulls=True).over(earlier), F.col("held"))
    joined = kept.withColumn("across", across)
    found = F.when(opens & ~F.col("late"), _reason(F.col("across"))).otherwise(F.col("reason"))
    return joined.withColumn("reason", found).filter(F.col("reason").isNotNull()).select(*GAPS.names)


def check_batch(images: DataFrame, batch_id: int, root: str, parts: int = 64) -> None:
    """Hold a micro-batch against the last changes stored below `root`, write its gaps and store the new last changes.

    A batch whose last changes are stored is not looked at again. Its gaps are written before, in a folder of the batch:
    after a failure in between, the same ones are found and written again.
    """
    last = BucketTable(images.sparkSession, f"{root}/last", "row_key", LAST)
    if last.covers() >= batch_id:
        return
    kept = images.persist()
    try:
        touched = last.buckets_of(kept, parts)
        known = last.read(touched)
        continuity_gaps(kept, known).write.mode("overwrite").parquet(f"{root}/gaps/batch={batch_id}")
        newest = current_rows(known.unionByName(kept.select(*LAST.names)), "row_key", NEWEST_BY)
        last.replace(newest, touched, batch_id, parts)
    finally:
        kept.unpersist()


def watch_continuity(
    images: DataFrame, root: str, checkpoint: str, parts: int = 64, drain: bool = True, interval: str = "10 seconds"
) -> StreamingQuery:
    """Check a stream of row images (`row_images`) batch by batch. Run it beside the capture, with progress of its own."""
    trigger = {"availableNow": True} if drain else {"processingTime": interval}
    writer = images.writeStream.foreachBatch(lambda df, batch_id: check_batch(df, batch_id, root, parts))
    return writer.option("checkpointLocation", checkpoint).trigger(**trigger).start()


def read_gaps(spark: SparkSession, root: str) -> DataFrame:
    """All gaps found so far."""
    folders = [f"{root}/gaps/{name}" for name in folders_in(spark, f"{root}/gaps")]
    return spark.read.schema(GAPS).parquet(*folders) if folders else spark.createDataFrame([], GAPS)
