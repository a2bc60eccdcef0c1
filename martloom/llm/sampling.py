"""Folds and bounded training samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def held_out(doc_id: Column) -> Column:
    """Whether a row is kept from training: crc32 of the id as text, modulo 4, is 2. False for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _fit_rows(rows: DataFrame, label: str, longest: int, seed: int) -> DataFrame:
    fit = rows.filter(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & F.col("text").isNotNull())
    fit = fit.filter(F.char_length("text") <= longest)
    return fit.select("doc_id", "text", label, F.xxhash64(F.lit(seed), F.col("doc_id")).alias("draw"))


def _of_ids(fit: DataFrame, chosen: DataFrame) -> DataFrame:
    """All rows of the chosen ids. The first pass sees ids only, so that no text goes through a join for it."""
    ids = sorted({r["doc_id"] for r in chosen.select("doc_id").collect()})  # as many as the bound says
    return fit.filter(F.col("doc_id").isin(ids))


def _collected(bounded: DataFrame, label: str) -> list[tuple[str, object]]:
    found = bounded.select("doc_id", "text", label).collect()
    found.sort(key=lambda r: (r["doc_id"], r["text"], str(r[label])))
    return [(r["text"], r[label]) for r in found]


def class_sample(rows: DataFrame, label: str, per_class: int, longest: int, seed: int) -> list[tuple[str, object]]:
    """(text, label) of at most `per_class` rows of each label, chosen by a hash of the id, in a fixed order.

    The one bounded part of a fit: at most per_class texts a label, each of at most `longest` code points (longer ones
    are left out of the sample, whole). `rows` has doc_id, text and the label; null ids, texts and labels are left out. Rows
    that share an id are ranked by their texts, so the bound holds however often an id is repeated.
    """

    def first(df: DataFrame, *ties: Column | str) -> DataFrame:
        order = Window.partitionBy(label).orderBy("draw", "doc_id", *ties)
        return df.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= per_class)

    fit = _fit_rows(rows, label, longest, seed)
    near = _of_ids(fit, first(fit.select("doc_id", label, "draw")))
    return _collected(first(near, F.xxhash64("text")), label)


def row_sample(rows: DataFrame, label: str, most: int, longest: int, seed: int) -> list[tuple[str, object]]:
    """As class_sample, but at most `most` rows of all labels together, in their natural proportions."""
    fit = _fit_rows(rows, label, longest, seed)
    near = _of_ids(fit, fit.select("doc_id", "draw").orderBy("draw", "doc_id").limit(most))
    return _collected(near.orderBy("draw", "doc_id", F.xxhash64("text"), label).limit(most), label)
