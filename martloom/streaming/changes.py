"""Parsing of change events. The same functions serve batch frames and streams.

Input columns are those of a feed: key, value (JSON), topic, timestamp and possibly offset. `sequence` is the offset, or 0
where the feed has none; together with `processed_at` it orders the versions of a row.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType, TimestampNTZType

from martloom.functions.segments import first_match
from martloom.functions.times import captured_time, utc
from martloom.schemas import CHANGE_ENVELOPE, CHANGE_ROW, MONEY

# Created, updated, and read by the initial snapshot; deleted.
KEPT_OPERATIONS = ("c", "u", "r")
DELETED = "d"

# The image before a change is parsed only where deletes are asked for: a delete has no other row.
_WITHOUT_BEFORE = StructType([field for field in CHANGE_ENVELOPE if field.name != "before"])


def parsed_values(feed: DataFrame, schema: StructType, *others: Column) -> DataFrame:
    stamp = F.col("timestamp")
    zoneless = isinstance(feed.schema["timestamp"].dataType, TimestampNTZType)
    return feed.select(
        F.from_json(F.col("value").cast("string"), schema).alias("parsed"),
        *others,
        (stamp if zoneless else utc(stamp)).alias("processed_at"),
        (F.col("offset") if "offset" in feed.columns else F.lit(0)).cast("bigint").alias("sequence"),
    )


def only_where(parsed: DataFrame, condition: Column) -> DataFrame:
    """Rows that meet a condition on `parsed`.

    A plain filter would be pushed below the projection and parse every value a second time; a list of
    one or no element keeps the parsed value.
    """
    others = [name for name in parsed.columns if name != "parsed"]
    return parsed.select(F.explode(F.when(condition, F.array("parsed"))).alias("parsed"), *others)


def _row(record: Column) -> list[Column]:
    converted = {
        "amount": record["amount"].try_cast(MONEY),
        "created_at": captured_time(record["created_at"]),
    }
    return [converted.get(name, record[name]).alias(name) for name in CHANGE_ROW.names]


def key_id(key: Column) -> Column:
    """The id in a record's key: a number, or JSON with a field `id`, possibly within `payload`."""
    text = key.cast("string")
    found = F.coalesce(text.try_cast("bigint").cast("string"), F.get_json_object(text, "$.id"), F.get_json_object(text, "$.payload.id"))
    return found.try_cast("bigint")


def parse_envelopes(feed: DataFrame, deletes: bool = False) -> DataFrame:
    """Envelope form {before, after, source.table, op}: the new row of every create, update and read.

    deletes: also the last row of every delete, marked by its op; without the image before it, the id of the record's
    key stands alone. Unreadable values and empty ones have no operation and drop out (`rejected_envelopes` has them).
    """
    operations = (*KEPT_OPERATIONS, DELETED) if deletes else KEPT_OPERATIONS
    schema, keys = (CHANGE_ENVELOPE, [key_id(F.col("key")).alias("key_id")]) if deletes else (_WITHOUT_BEFORE, [])
    kept = only_where(parsed_values(feed, schema, *keys), F.col("parsed.op").isin(*operations))
    record = F.col("parsed.after")
    if deletes:
        gone = F.col("parsed.op") == DELETED
        record = F.when(gone, F.col("parsed.before")).otherwise(record)
    columns = _row(F.col("record"))
    if deletes:
        columns[0] = F.coalesce(F.col("record.id"), F.when(gone, F.col("key_id"))).alias("id")
    return kept.withColumn("record", record).select(
        *columns,
        F.col("parsed.source.table").alias("table"),
        F.col("parsed.op").alias("op"),
        "processed_at",
        "sequence",
    )


def parse_records(feed: DataFrame) -> DataFrame:
    """Flattened form: the value is the new row itself and the topic ends in the table's name.

    The connector leaves out deletes; their tombstones (null values) are skipped here, and so are values
    that cannot be read (they have no id).
    """
    table = F.element_at(F.split("topic", r"\."), -1).alias("table")
    records = parsed_values(feed.filter(F.col("value").isNotNull()), CHANGE_ROW, table)
    kept = only_where(records, F.col("parsed.id").isNotNull())
    return kept.select(*_row(F.col("parsed")), "table", "processed_at", "sequence")


def each_once(feed: DataFrame, by: Iterable[str] = ("topic", "offset"), within: str = "1 day") -> DataFrame:
    """A feed without records that are delivered again.

    A stream remembers what tells records apart until its clock, the newest timestamp less `within`, has passed them.
    """
    if not feed.isStreaming:
        return feed.dropDuplicates(list(by))
    timed = feed.withColumn("_clock", F.col("timestamp").cast("timestamp"))  # a watermark needs a zone
    return timed.withWatermark("_clock", within).dropDuplicatesWithinWatermark(list(by)).drop("_clock")


def rejected_envelopes(feed: DataFrame) -> DataFrame:
    """Records that bring no row, or a row that lost a value, with the reason: key, topic, value, reason, processed_at.

    Empty values are tombstones and no fault. The first reason that holds is given: the value is no JSON; it has no, or an
    unknown, operation; no table; no row; an amount or a time that cannot be read.
    """
    others = [F.col(name).cast("string").alias(name) for name in ("key", "topic", "value")]
    parsed = parsed_values(feed.filter(F.col("value").isNotNull()), CHANGE_ENVELOPE, *others)
    op = F.col("parsed.op")
    record = F.when(op == DELETED, F.col("parsed.before")).otherwise(F.col("parsed.after"))
    amount, time = record["amount"], record["created_at"]
    reason = first_match(
        [
            (F.try_parse_json("value").isNull(), "not json"),
            (op.isNull(), "no operation"),
            (~op.isin(*KEPT_OPERATIONS, DELETED), "unknown operation"),
            (F.col("parsed.source.table").isNull(), "no table"),
            ((op != DELETED) & (record.isNull() | record["id"].isNull()), "no row"),
            (amount.isNotNull() & amount.try_cast(MONEY).isNull(), "amount"),
            (time.isNotNull() & captured_time(time).isNull(), "time"),
        ]
    )
    return parsed.select("key", "topic", "value", reason.alias("reason"), "processed_at").filter(F.col("reason").isNotNull())


def unknown_fields(feed: DataFrame) -> DataFrame:
    """Fields of new rows that the declared layout lacks: key, topic, fields (a map of JSON texts), processed_at."""
    after = F.from_json(F.get_json_object(F.col("value").cast("string"), "$.after"), "map<string, string>")
    rest = F.map_filter(after, lambda name, _: ~name.isin(*CHANGE_ROW.names))
    stamp = F.col("timestamp")
    zoneless = isinstance(feed.schema["timestamp"].dataType, TimestampNTZType)
    found = feed.select(
        F.col("key").cast("string").alias("key"), "topic", rest.alias("fields"), (stamp if zoneless else utc(stamp)).alias("processed_at")
    )
    return found.filter(F.size("fields") > 0)
