"""The newest version of every row of an append-only table."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def current_rows(df: DataFrame, key: str, newest_by: Iterable[str | Column], deleted: Column | None = None) -> DataFrame:
    """One row per key: the one with the greatest `newest_by`; none where that one is a deletion.

    Versions are reduced on the map side, so one shuffle carries at most a row per key and task, however many
    versions a key has. Rows without a key identify nothing and are left out. Versions that are equal in
    `newest_by` are told apart by a 64-bit hash of their contents, so every run picks the same one.
    """
    row = F.struct(*df.columns)
    newest = F.max_by(row, F.struct(*newest_by, F.xxhash64(*df.columns)))
    current = df.filter(F.col(key).isNotNull()).groupBy(F.col(key).alias("_key")).agg(newest.alias("_row")).select("_row.*")
    return current if deleted is None else current.filter(~F.coalesce(deleted, F.lit(False)))
