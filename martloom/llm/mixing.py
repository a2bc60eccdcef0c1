"""Mixing sources to target weights: how often each document is repeated so that sources reach their token targets.

Sizes are summed per source, targets follow from the weights by levelling under a cap, and each document is taken
floor(rate) times plus once more with probability equal to the fraction, decided by a hash of its id and a seed.

Defined results: a null or empty text has size 0 and counts nothing; a null source is a source of its own, sorted last; a
source of size 0 has rate 0. Rows with equal ids (null included) share their draw; repeated rows count as rows. An empty
table gives no rows. Other columns pass through `mix_documents`;
names that begin with two underscores are reserved.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martloom.llm.storage import stored

WORD = r"[^\x20\x09-\x0D]+"


def size_of(text: Column) -> Column:
    """Number of words of a text."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def draw(doc_id: Column, seed: int) -> Column:
    """A number in [0, 1) that depends on id and seed only."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("null")))
    return F.conv(F.substring(F.md5(key.cast("binary")), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def source_targets(sizes: DataFrame, weights: list[int], share: float, most: float) -> DataFrame:
    """source, source_size -> target: weights repeat over the sources in code point order, null last.

    Targets sum to share * all sizes, none is above most * its source's size, and the excess of those at the limit is
    shared by weight among the rest. One row per source: the windows see aggregated sources only.
    """
    ordered = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.pmod(F.row_number().over(ordered) - 1, F.lit(len(weights))) + 1).cast("int"))
    every = Window.partitionBy()
    limits = (
        sizes.withColumn("weight", weight)
        .withColumn("cap", F.col("source_size") * F.lit(float(most)))
        .withColumn("total", F.sum("source_size").over(every) * F.lit(float(share)))
        .withColumn("reach", F.col("cap") / F.col("weight"))
    )
    below = Window.orderBy("reach", "weight", F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    level = (F.col("total") - F.coalesce(F.sum("cap").over(below), F.lit(0.0))) / (
        F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(below), F.lit(0))
    )
    free = limits.withColumn("level", level).withColumn("free", F.col("level") < F.col("reach"))
    # The first level that is below its own limit holds for all sources behind it.
    settled = free.withColumn("level", F.min(F.when(F.col("free"), F.struct("reach", "level"))).over(every)["level"])
    target = F.when(F.col("level").isNull() | (F.col("reach") <= F.col("level")), F.col("cap")).otherwise(F.col("weight") * F.col("level"))
    return settled.select("source", "source_size", target.alias("target"))


def with_copies(documents: DataFrame, weights: list[int], share: float = 1.5, most: float = 2.0, seed: int = 0) -> DataFrame:
    """documents (doc_id, text, source, ...) with size, source_size, target and copies, as one struct column `__mix`."""
    size = size_of(F.col("text"))
    sizes = documents.groupBy("source").agg(F.sum(size).alias("source_size"))
    # one row per source; as a stored table its size is known, so Spark broadcasts it where it is small
    targets = stored(source_targets(sizes, weights, share, most), "targets").select(
        F.col("source").alias("__source"), F.struct("source_size", "target").alias("__mix")
    )
    joined = documents.join(targets, documents["source"].eqNullSafe(targets["__source"]), "left").drop("__source")
    total, target = F.col("__mix.source_size"), F.col("__mix.target")
    rate = F.when(total > 0, target / total).otherwise(0.0)
    extra = F.when(draw(F.col("doc_id"), seed) < rate - F.floor(rate), 1).otherwise(0)
    return joined.withColumn(
        "__mix",
        F.struct(size.alias("size"), total.alias("source_size"), target.alias("target"), (F.floor(rate) + extra).cast("long").alias("copies")),
    )


def mix_report(documents: DataFrame, weights: list[int], share: float = 1.5, most: float = 2.0, seed: int = 0) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, copies and the words taken from it."""
    mixed = with_copies(documents.select("doc_id", "text", "source"), weights, share, most, seed)
    taken = F.col("__mix.size") * F.col("__mix.copies")
    return mixed.select("doc_id", "__mix.size", "__mix.source_size", "__mix.target", "__mix.copies", taken.alias("taken"))


def mix_documents(documents: DataFrame, weights: list[int], share: float = 1.5, most: float = 2.0, seed: int = 0) -> DataFrame:
    """The mix itself: every document as often as it is taken, with its own columns."""
    mixed = with_copies(documents, weights, share, most, seed)
    repeated = mixed.withColumn("__copy", F.explode(F.array_repeat(F.lit(0), F.col("__mix.copies").cast("int"))))
    return repeated.drop("__mix", "__copy")
