"""Exact distinct counts from states that can be merged: bitmaps of integer ids, one per group and range of ids.

A state is a table (keys, id_range, ids) with a bitmap of 32768 ids in each row. States of disjoint or overlapping data are
merged by OR, so the count of a month comes from the states of its days, and yesterday's states are never computed again.
Null ids count for nothing; a group that has only such ids keeps a row and counts 0.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RANGE, IDS = "id_range", "ids"


def distinct_states(rows: DataFrame, id_column: str, *keys: str) -> DataFrame:
    """One row per group and range of ids; combined on the map side."""
    return rows.groupBy(*keys, F.bitmap_bucket_number(id_column).alias(RANGE)).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(id_column)).alias(IDS)
    )


def merged_states(states: DataFrame, *keys: str) -> DataFrame:
    """States of coarser groups: keys may be any columns of the states."""
    return states.groupBy(*keys, RANGE).agg(F.bitmap_or_agg(IDS).alias(IDS))


def distinct_counts(states: DataFrame, name: str, *keys: str) -> DataFrame:
    """The number of distinct ids of each group."""
    return merged_states(states, *keys).groupBy(*keys).agg(F.sum(F.bitmap_count(IDS)).cast("bigint").alias(name))
