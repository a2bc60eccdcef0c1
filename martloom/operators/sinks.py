"""Writing tables: catalog tables, folders partitioned by day, versioned sorted marts, JDBC copies."""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from martloom.operators.files import delete_folder, read_text, replace_text

DAY = "dt"


# catalog tables


def create_namespace(spark: SparkSession, name: str, location: str | None = None) -> None:
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}{place}")


def create_table(
    spark: SparkSession, table: str, schema: StructType, fmt: str = "parquet", partition_by: Iterable[str] = ()
) -> None:
    """Create a table with a declared schema unless it exists. `fmt` may be any installed table format."""
    columns = ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in schema)
    names = ", ".join(partition_by)
    partitions = f" PARTITIONED BY ({names})" if names else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING {fmt}{partitions}")


def append(df: DataFrame, table: str) -> None:
    """INSERT INTO: columns go by position, so they are put in the table's order first."""
    df.select(*df.sparkSession.table(table).columns).write.insertInto(table)


def append_if_empty(df: DataFrame, table: str) -> bool:
    """Load initial rows once; calling it again changes nothing."""
    if not df.sparkSession.table(table).isEmpty():
        return False
    append(df, table)
    return True


def overwrite_table(df: DataFrame, table: str, order_by: Iterable[str] = (), fmt: str = "parquet") -> None:
    sorted_by(df, order_by).write.format(fmt).mode("overwrite").saveAsTable(table)


# A task sorts its part in some 250 bytes of memory a row. Many more, smaller parts would cost memory where rows are dealt out.
BUCKET_ROWS = 1_250_000


def buckets_for(tables: Iterable[DataFrame], least: int = 1, rows: int = BUCKET_ROWS) -> int:
    """Into how many parts tables that meet by their key are cut, so that the largest has some `rows` rows in one. A part is
    sorted by one task: with a fixed number, the memory of that task would grow with the table. Counts the rows."""
    return max([least, *[math.ceil(table.count() / rows) for table in tables]])


def write_bucketed(df: DataFrame, table: str, key: str, buckets: int) -> None:
    """A catalog table in `buckets` parts by a hash of the key, each sorted by it: tables that share key and number of
    parts are joined, and grouped by the key, without a shuffle. One task per part and range of rows writes."""
    df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key).mode("overwrite").saveAsTable(table)


# folders


def sorted_by(df: DataFrame, order_by: Iterable[str], derived: Mapping[str, Column] | None = None) -> DataFrame:
    """Rows range-partitioned and sorted by the key, so that scans can skip files and row groups.

    End the key with a column that tells the rows of one day or one country apart: a value with very many
    rows is then cut into several ranges instead of ending up in one task.
    `derived` are columns of df that follow from its other ones, and how: they are computed behind the shuffle.
    """
    keys, derived = list(order_by), dict(derived or {})
    if not keys:
        return df
    ranged = df.drop(*derived).repartitionByRange(*[derived.get(name, F.col(name)) for name in keys])
    return ranged.withColumns(derived).select(*df.columns).sortWithinPartitions(*keys)


CURRENT = "_current"
# a mart is written once and read often: zstd files are some 40 % smaller than those of Spark's default codec
COMPRESSED = {"parquet": {"compression": "zstd"}}


def publish_files(
    df: DataFrame,
    path: str,
    order_by: Iterable[str] = (),
    fmt: str = "parquet",
    ranged: bool = True,
    measures: Mapping[str, Column] | None = None,
    measured: dict[str, object] | None = None,
    bloom: Iterable[str] = (),
    derived: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Write a new version of a table below `path`, switch to it, and read it back.

    `measures` are aggregates taken from the rows as they are written, without a scan of their own; their values are put
    into `measured`. `bloom` names columns whose values get a Bloom filter in every row group (Parquet): a look-up by a column
    that the table is not sorted by, such as the orders of a customer, then reads only row groups that may hold the value.
    `derived` columns follow from the others and are computed behind the range shuffle (see sorted_by).

    The old version stays readable until the new one is complete; a failed run leaves it in place. The version
    before the last is deleted. ranged=False sorts a small table within its partitions, without a range shuffle.
    """
    spark, keys = df.sparkSession, list(order_by)
    version, before = f"version={uuid.uuid4().hex}", read_text(spark, f"{path}/{CURRENT}")
    if ranged:
        rows = sorted_by(df, keys, derived) if derived else sorted_by(df, keys)
    else:
        rows = df.coalesce(1).sortWithinPartitions(*keys) if keys else df
    if measures:
        # observed behind the range shuffle, whose sampling runs what lies before it a second time
        observation = Observation()
        rows = rows.observe(observation, *[column.alias(name) for name, column in measures.items()])
    filters = {f"parquet.bloom.filter.enabled#{name}": "true" for name in bloom}
    # sized by the values that are there, instead of for the largest filter allowed
    sized = {"parquet.bloom.filter.adaptive.enabled": "true"} if filters else {}
    rows.write.format(fmt).options(**COMPRESSED.get(fmt, {}), **filters, **sized).save(f"{path}/{version}")
    if measures and measured is not None:
        measured.update(observation.get)
    kept = before.split("\n") if before else []
    replace_text(spark, f"{path}/{CURRENT}", "\n".join([version, *kept[:1]]))
    for old in kept[1:]:
        delete_folder(spark, f"{path}/{old}")
    return read_published(spark, path, fmt)


def read_published(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """The current version of a table written by publish_files."""
    versions = read_text(spark, f"{path}/{CURRENT}")
    if versions is None:
        raise FileNotFoundError(f"nothing has been published in {path}")
    return spark.read.format(fmt).load(f"{path}/{versions.split(chr(10))[0]}")


RANGES = "_ranges"


def publish_ranges(spark: SparkSession, path: str, columns: Iterable[str], fmt: str = "parquet") -> None:
    """Store the least and greatest value of some columns in every file of a table's current version."""
    version = read_text(spark, f"{path}/{CURRENT}").split("\n")[0]
    files = spark.read.format(fmt).load(f"{path}/{version}").groupBy(F.col("_metadata.file_path").alias("file"))
    bounds = [f(name).alias(f"{side}_{name}") for name in columns for side, f in (("least", F.min), ("greatest", F.max))]
    files.agg(*bounds).write.mode("overwrite").parquet(f"{path}/{RANGES}/{version}")


def look_up(spark: SparkSession, path: str, column: str, values: Iterable[object], fmt: str = "parquet") -> DataFrame:
    """The rows of a table's current version with one of a few values of a column; only files whose range may hold
    one are listed and read. Names of those files reach the driver."""
    version, wanted = read_text(spark, f"{path}/{CURRENT}").split("\n")[0], list(values)
    ranges = spark.read.parquet(f"{path}/{RANGES}/{version}")
    may_hold = F.exists(F.array(*map(F.lit, wanted)), lambda v: v.between(F.col(f"least_{column}"), F.col(f"greatest_{column}")))
    files = [row.file for row in ranges.filter(may_hold).select("file").collect()] if wanted else []
    whole = read_published(spark, path, fmt)
    if not files:
        return whole.limit(0)
    return spark.read.schema(whole.schema).format(fmt).load(files).filter(F.col(column).isin(wanted))


def write_by_day(df: DataFrame, path: str, moment: str, mode: str = "append", fmt: str = "parquet") -> None:
    """One folder per day of `moment`. The rebalance hint gathers each day in few files and, through
    adaptive execution, splits a day that is too large for one task."""
    days = df.withColumn(DAY, F.to_date(moment)).hint("rebalance", DAY)
    days.write.format(fmt).mode(mode).partitionBy(DAY).save(path)


# other databases


def copy_to_jdbc(
    tables: Mapping[str, DataFrame],
    url: str,
    properties: Mapping[str, str],
    mode: str = "append",
    connections: int | None = None,
    batch_rows: int = 10_000,
) -> None:
    """Copy whole tables to a database, executors writing in parallel, one connection per task.

    `connections` bounds how many there are at a time for a database that cannot bear more: rows are then dealt
    over that many tasks (the scan and all before it keep their own).
    Like any JDBC append it adds the rows again when it is repeated, or when a task is retried after its
    commit; `mode="overwrite"` empties the target tables (keeping their definition) and is repeatable.
    """
    for name, df in tables.items():
        writer = (df.repartition(connections) if connections else df).write.format("jdbc").mode(mode)
        settings = {
            "url": url,
            "dbtable": name,
            "batchsize": batch_rows,
            "truncate": "true",
            **properties,
        }
        writer.options(**settings).save()
