"""URL filter: ordered host/path rules, and an exact list of keys held in a cascade of Bloom filters.

Level 1 encodes the listed keys, level 2 the other keys of the universe that pass level 1 by mistake, level 3 the listed
keys that pass level 2 by mistake, and so on until no key passes by mistake. For every key of the universe the answer is
exact. The cascade is broadcast only while its size is within `max_bytes`; larger lists are joined by key.

Defined results: a null url, or one without `://`, has an empty host and path (its key is the empty string). Repeated urls
get equal verdicts. Keys outside the universe may be judged wrongly, so the universe must be that of the judged table.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.llm.storage import stored
from martloom.llm.texts import mix

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    allow: bool
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z in lower case) and path of a url; both empty if it is null or has no `://`."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def first_rule(host: Column, path: Column, rules: list[Rule]) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits; null where none does."""
    text = verdict = None
    for rule in sorted(rules, key=lambda r: len(r.text)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        word = "allow" if rule.allow else "block"
        text = F.when(fits, rule.text).otherwise(F.lit(None) if text is None else text)
        verdict = F.when(fits, word).otherwise(F.lit(None) if verdict is None else verdict)
    none = F.lit(None).cast("string")
    return (none if text is None else text.cast("string")), (none if verdict is None else verdict.cast("string"))


def _positions(h1: np.ndarray, h2: np.ndarray, size: int, hashes: int, number: int) -> Iterator[np.ndarray]:
    first = mix(h1.view(np.uint64) + np.uint64(number * 0x9E3779B97F4A7C15 % 2**64))
    step = mix(h2.view(np.uint64) ^ first) | np.uint64(1)
    for i in range(hashes):
        yield mix(first + step * np.uint64(i)) % np.uint64(size)


def _hits(level: tuple, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
    bits, size, hashes, number = level
    hit = np.ones(len(h1), dtype=bool)
    for p in _positions(h1, h2, size, hashes, number):
        hit &= (bits[p >> np.uint64(6)] >> (p & np.uint64(63)) & np.uint64(1)).astype(bool)
    return hit


def contains(levels: list[tuple], h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
    """Whether each key is listed: the first level that a key misses decides, else the last level."""
    answer = np.zeros(len(h1), dtype=bool)
    left = np.arange(len(h1))
    for level in levels:
        hit = _hits(level, h1[left], h2[left])
        answer[left[~hit]] = level[3] % 2 == 0
        left = left[hit]
    answer[left] = len(levels) % 2 == 1
    return answer


def hash_columns(key: Column) -> tuple[Column, Column]:
    return F.xxhash64(key), F.xxhash64(F.lit(7), key)


def _encode(keys: DataFrame, n: int, number: int, bits_per_key: float) -> tuple:
    size = max(64, math.ceil(n * bits_per_key))
    hashes = max(1, round(bits_per_key * math.log(2)))

    def bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filled = np.zeros(-(-size // 64), dtype=np.uint64)
        for batch in batches:
            h1, h2 = (batch.column(i).to_numpy() for i in (0, 1))
            for p in _positions(h1, h2, size, hashes, number):
                np.bitwise_or.at(filled, p >> np.uint64(6), np.uint64(1) << (p & np.uint64(63)))
        at = np.flatnonzero(filled)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(filled[at].view(np.int64))], ["at", "word"])

    words = keys.select("h1", "h2").mapInArrow(bits, "at long, word long").groupBy("at").agg(F.bit_or("word").alias("word"))
    found = words.toArrow()  # at most size / 64 rows
    filled = np.zeros(-(-size // 64), dtype=np.uint64)
    filled[found.column("at").to_numpy()] = found.column("word").to_numpy().view(np.uint64)
    return filled, size, hashes, number


def build_cascade(keys: DataFrame, bits_per_key: float = 6.0, max_bytes: int = 64 << 20) -> list[tuple] | None:
    """Cascade over keys (h1, h2, listed), one row per key. None if its levels together would exceed max_bytes.

    Every level is counted before it is encoded: level 2 holds some 6 % of all other keys, however few are listed.
    """
    listed = keys.filter("listed")
    n, held = listed.count(), 0.0
    if n * bits_per_key / 4 > max_bytes:
        return None
    levels: list[tuple] = []
    inside, outside = listed, keys.filter("NOT listed")
    while n:
        held += n * bits_per_key / 8
        if held > max_bytes:
            return None
        levels.append(_encode(inside, n, len(levels) + 1, bits_per_key))
        passing = stored(outside.filter(_passes(outside, levels[-1])), "cascade-level")
        inside, outside = passing, inside
        n = passing.count()
    return levels


def _passes(df: DataFrame, level: tuple) -> Column:
    held = df.sparkSession.sparkContext.broadcast(level)

    @F.pandas_udf("boolean")
    def passes(h1: pd.Series, h2: pd.Series) -> pd.Series:
        return pd.Series(_hits(held.value, h1.to_numpy(), h2.to_numpy()))

    return passes("h1", "h2")


def thin_hosts(pages: DataFrame, least_pages: int, least_chars: int, percent: int) -> DataFrame:
    """Hosts (`host`) that mostly serve thin pages, from pages (url, html).

    A page is thin if its html without tags has fewer than `least_chars` code points (null: none). A host counts if it has
    `least_pages` rows or more and `percent` of them or more are thin. Urls without a host are no host.
    """
    host, _ = host_and_path(F.col("url"))
    chars = F.char_length(F.regexp_replace(F.coalesce("html", F.lit("")), "<[^>]*>", ""))
    counts = (
        pages.select(host.alias("host"), (chars < least_chars).cast("long").alias("thin"))
        .groupBy("host")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("thin").alias("thin"))
    )
    return counts.filter((F.col("host") != "") & (F.col("n") >= least_pages) & (100 * F.col("thin") >= percent * F.col("n"))).select("host")


def mark_listed(df: DataFrame, key: str, listed: DataFrame, max_bytes: int = 64 << 20) -> DataFrame:
    """df with a boolean `listed`: whether its key is a key of `listed` (one column). Null keys are not listed."""
    held = "__key"
    known = listed.select(F.col(listed.columns[0]).alias(held)).filter(F.col(held).isNotNull())
    h1, h2 = hash_columns(F.col(held))
    universe = (
        df.select(F.col(key).alias(held), F.lit(False).alias("listed"))
        .filter(F.col(held).isNotNull())
        .unionByName(known.withColumn("listed", F.lit(True)))
        .groupBy(h1.alias("h1"), h2.alias("h2"))
        .agg(F.max("listed").alias("listed"))
    )
    levels = build_cascade(stored(universe, "url-keys"), max_bytes=max_bytes)
    if levels is None:
        marks = known.distinct().withColumn("listed", F.lit(True))
        return df.join(marks, df[key] == marks[held], "left").drop(held).withColumn("listed", F.coalesce("listed", F.lit(False)))
    shared = df.sparkSession.sparkContext.broadcast(levels)

    @F.pandas_udf("boolean")
    def is_listed(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series(contains(shared.value, a.to_numpy(), b.to_numpy()))

    h1, h2 = hash_columns(F.coalesce(F.col(key), F.lit("")))
    return df.withColumn("listed", F.when(F.col(key).isNull(), False).otherwise(is_listed(h1, h2)))


def judge_urls(pages: DataFrame, rules: list[Rule], listed: DataFrame, max_bytes: int = 64 << 20) -> DataFrame:
    """page_id, host, path, rule and verdict of every page: the longest rule's verdict, else block if its key is listed.

    A key is host || path. `listed` has one column of keys.
    """
    host, path = host_and_path(F.col("url"))
    parts = pages.select("page_id", host.alias("host"), path.alias("path"))
    parts = parts.withColumn("key", F.concat("host", "path"))
    rule, verdict = first_rule(F.col("host"), F.col("path"), rules)
    marked = mark_listed(parts, "key", listed, max_bytes)
    method = F.when(F.col("listed"), "block").otherwise("allow")
    return marked.select("page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, method).alias("verdict"))
