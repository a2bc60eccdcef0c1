"""Data-quality checks. Each returns rows of (check_name, violations, passed)."""

from __future__ import annotations

import warnings
from dataclasses import dataclass
from datetime import timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.functions.cleaning import require
from martloom.functions.times import ago, now
from martloom.params import Params


class QualityError(Exception):
    """Raised by `require_passed` with the failed checks."""


class QualityWarning(UserWarning):
    """Issued by `require_passed` with severity "warn"."""


def _result(name: str | Column, counted: DataFrame) -> DataFrame:
    label = F.lit(name) if isinstance(name, str) else name
    violations = F.coalesce(F.col("violations"), F.lit(0)).cast("bigint")
    return counted.select(
        label.alias("check_name"), violations.alias("violations"), (violations == 0).alias("passed")
    )


def count_violations(name: str, failing: DataFrame) -> DataFrame:
    return _result(name, failing.agg(F.count(F.lit(1)).alias("violations")))


def all_of(*checks: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, checks)


def only_failed(checks: DataFrame) -> DataFrame:
    """Empty if everything passed."""
    return checks.filter(F.col("violations") > 0)


def require_passed(checks: DataFrame, severity: str = "error") -> None:
    """Stop with an error naming the failed checks, or with severity "warn" only warn about them.

    One row per failed check reaches the driver. The rows behind a failure are a frame of their own (see
    below) and can be stored with any sink.
    """
    failed = only_failed(checks).collect()
    if not failed:
        return
    message = ", ".join(f"{row.check_name}: {row.violations}" for row in failed)
    if severity == "warn":
        warnings.warn(message, QualityWarning, stacklevel=2)
    else:
        raise QualityError(message)


# rows that break a rule (keep them, or count them with `count_violations`)


def in_future(moment: str, params: Params) -> Column:
    return F.col(moment) > now(params)


def mismatched_revenue() -> Column:
    return (F.col("order_status") == "completed") & (F.col("net_revenue") != F.col("order_amount"))


def malformed(email: str) -> Column:
    return ~F.col(email).like("%@%.%")


def future_rows(df: DataFrame, moment: str, params: Params) -> DataFrame:
    return df.filter(in_future(moment, params))


def revenue_mismatches(orders: DataFrame) -> DataFrame:
    return orders.filter(mismatched_revenue())


def malformed_emails(df: DataFrame, email: str = "email") -> DataFrame:
    return df.filter(malformed(email))


def negative_values(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column) < 0)


def repeated(df: DataFrame, columns: list[str]) -> DataFrame:
    """Values in more than one row, with their number of rows; nulls do not collide."""
    return require(df, *columns).groupBy(*columns).count().filter(F.col("count") > 1)


# whole checks


def freshness(name: str, df: DataFrame, moment: str, params: Params, within: timedelta = timedelta(hours=2)) -> DataFrame:
    """Fails unless there is a row from the last `within`."""
    newest = df.filter(F.col(moment) >= ago(params, within)).agg(F.max(moment).alias("newest"))
    return _result(name, newest.select(F.col("newest").isNull().cast("bigint").alias("violations")))


def row_floor(name: str, df: DataFrame, minimum: int) -> DataFrame:
    """Violations are the rows missing to the floor."""
    return _result(
        name, df.agg(F.greatest(F.lit(minimum) - F.count(F.lit(1)), F.lit(0)).alias("violations"))
    )


def not_null(table: str, df: DataFrame, columns: list[str]) -> DataFrame:
    """One result per column, counted in a single pass."""
    counts = df.agg(*[F.count_if(F.col(name).isNull()).alias(name) for name in columns])
    per_column = counts.select(
        F.explode(
            F.array(*[F.struct(F.lit(name).alias("name"), F.col(name).alias("violations")) for name in columns])
        ).alias("column")
    ).select("column.name", "column.violations")
    return _result(F.concat(F.lit(f"not_null:{table}."), F.col("name")), per_column)


@dataclass(frozen=True)
class Fresh:
    """A freshness rule: fails unless `moment` of some row lies within the last `within`."""

    name: str
    moment: str
    within: timedelta = timedelta(hours=2)


def row_checks(
    table: str, df: DataFrame, required: list[str], non_negative: list[str], fresh: Fresh | None, params: Params
) -> DataFrame:
    """Not-null, non-negative and freshness results of a table, all from one pass over it."""
    counts = {f"not_null:{table}.{c}": F.count_if(F.col(c).isNull()) for c in required}
    counts |= {f"non_negative:{table}.{c}": F.count_if(F.col(c) < 0) for c in non_negative}
    if fresh:
        recent = F.count_if(F.col(fresh.moment) >= ago(params, fresh.within))
        counts[fresh.name] = (recent == 0).cast("bigint")
    results = F.array(*[F.struct(F.lit(name).alias("name"), n.cast("bigint").alias("violations")) for name, n in counts.items()])
    one_row = df.agg(results.alias("results"))
    return _result(F.col("name"), one_row.select(F.explode("results").alias("result")).select("result.*"))


def unique(table: str, df: DataFrame, columns: list[str]) -> DataFrame:
    """Violations are the values that occur more than once."""
    return count_violations(f"unique:{table}.{','.join(columns)}", repeated(df, columns))


def references(
    table: str, child: DataFrame, foreign_key: str, parent_table: str, parent: DataFrame, key: str
) -> DataFrame:
    """Violations are the child rows without a parent; a null key refers to nothing and passes.

    Both sides are reduced to one row per key before they meet, so no key is heavy in the join.
    """
    wanted = require(child, foreign_key).groupBy(F.col(foreign_key).alias("key")).count()
    known = parent.select(F.col(key).alias("key")).distinct()
    orphans = wanted.join(known, "key", "left_anti").agg(F.sum("count").alias("violations"))
    return _result(f"references:{table}.{foreign_key}->{parent_table}.{key}", orphans)


def non_negative(table: str, df: DataFrame, column: str) -> DataFrame:
    return count_violations(f"non_negative:{table}.{column}", negative_values(df, column))
