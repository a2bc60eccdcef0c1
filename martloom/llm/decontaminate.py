"""Benchmark decontamination: windows of documents as long as a benchmark item and similar to it.

Words are runs of letters and digits (ASCII in lower case; other characters count as letters). For every item size, the
windows of that many words get a 64-bit SimHash of their weighted shingles (five words; all words of a shorter item). The
items' fingerprints stand in a multi-index: cut into RADIUS + 1 blocks, two fingerprints within RADIUS bits agree in at
least one, so looking up each block finds every item within the radius. The radius is wide: at similarity 0.8 two
fingerprints differ in 9 to 10 bits, with a deviation of about 3 (4 with very uneven weights), and the blocks mostly spread
an item's size; the Hamming check decides. Items of at most SHORT words have too few votes a bit for a radius and are
looked up by their shingles. Candidates are verified by the exact weighted Jaccard similarity of the shingle sets; weights
are inverse document frequencies over the benchmark. A window that shares no shingle with any item of its size has
similarity 0 and is not fingerprinted.

The benchmark goes to the tasks in blocks of at most BLOCK items, whatever its size. Shingles are counted once over all of
it, so the weights, and with them the similarities, do not depend on the blocks. The counted shingles (16 bytes each) and
the blocks pass through the driver.

Defined results: null or empty texts and items match nothing; equal items each match; items that share an id, or have none,
are one, which matches where the most similar of them does; repeated rows match alike; an empty benchmark or table gives no
rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.llm.texts import Words, gram_hashes, mix, ranged_hash, slices

SHINGLE = 5
RADIUS = 24
#: Items of at most so many words (eight shingles) are found by any shingle, without fingerprints.
SHORT = 12
#: Items broadcast at once; a larger benchmark is searched in several passes.
BLOCK = 50_000
_FILTER_BITS = 20
_PLAIN = np.arange(256, dtype=np.uint8)
_PLAIN[:0x30] = _PLAIN[0x3A:0x41] = _PLAIN[0x5B:0x61] = _PLAIN[0x7B:0x80] = 0x20
_PLAIN[0x41:0x5B] += 0x20
_EDGES = np.linspace(0, 64, RADIUS + 2).round().astype(int)


def plain_words(data: np.ndarray, offsets: np.ndarray) -> Words:
    return Words(_PLAIN[data], offsets, False)


def simhash(shingles: np.ndarray, weights: np.ndarray) -> int:
    bits = (shingles[:, None] >> np.arange(64, dtype=np.uint64)[None, :]) & np.uint64(1)
    votes = np.where(bits == 1, weights[:, None], -weights[:, None]).sum(axis=0)
    return int(sum(1 << i for i in np.flatnonzero(votes > 0).tolist()))


def _blocks(fingerprint: int) -> list[tuple[int, int]]:
    return [(b, fingerprint >> int(_EDGES[b]) & ((1 << int(_EDGES[b + 1] - _EDGES[b])) - 1)) for b in range(RADIUS + 1)]


def _item_shingles(text: str | None) -> tuple[int, int, np.ndarray]:
    """Words of an item, words of its shingles, and its distinct shingles."""
    raw = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), dtype=np.uint8)
    words = plain_words(raw, np.array([0, len(raw)]))
    size = len(words.starts)
    n = min(SHINGLE, size)
    return size, n, np.unique(shingles_of(words.hashes(), words.first, n)[0]) if size else np.zeros(0, dtype=np.uint64)


@dataclass(frozen=True)
class Weights:
    """Inverse document frequencies of the shingles of the whole benchmark, by sorted shingle; others have `other`."""

    shingles: np.ndarray
    values: np.ndarray
    other: float

    def of(self, grams: np.ndarray) -> np.ndarray:
        if not len(self.shingles):
            return np.full(len(grams), self.other)
        spot = np.minimum(np.searchsorted(self.shingles, grams), len(self.shingles) - 1)
        return np.where(self.shingles[spot] == grams, self.values[spot], self.other)


def shingle_weights(benchmark: DataFrame) -> Weights:
    def shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text in batch.column(0).to_pylist():
                size, _, grams = _item_shingles(text)
                if size:  # the null counts the items
                    yield pa.RecordBatch.from_arrays([pa.array([None, *grams.view(np.int64).tolist()], pa.int64())], ["shingle"])

    counts = benchmark.select("text").mapInArrow(shingles, "shingle long").groupBy("shingle").count().toArrow()
    every, seen = counts.column("shingle"), counts.column("count").to_numpy()
    item = every.is_null().to_numpy()
    total, held = int(seen[item].sum()), every.drop_null().to_numpy().astype(np.int64).view(np.uint64)
    order = np.argsort(held)
    values = 1 + np.log((1 + total) / (1 + seen[~item]))
    return Weights(held[order], values[order], float(1 + np.log(1 + total)))


def benchmark_index(items: list[tuple[int, str]], weights: Weights) -> dict:
    """Plain arrays and dictionaries, to be broadcast: sizes, shingle sets, fingerprints and their blocks."""
    prepared = []
    for item_id, text in items:
        size, n, grams = _item_shingles(text)
        if size:
            prepared.append((item_id, size, n, grams))
    index: dict[tuple[int, int, int], list[int]] = {}
    by_gram: dict[tuple[int, int], list[int]] = {}
    entries, holders = [], {}
    for k, (item_id, size, n, grams) in enumerate(prepared):
        w = weights.of(grams)
        fingerprint = simhash(grams, w)
        entries.append((item_id, size, frozenset(grams.tolist()), float(w.sum()), fingerprint))
        if size <= SHORT:
            for g in grams.tolist():
                by_gram.setdefault((size, g), []).append(k)
        else:
            for block, value in _blocks(fingerprint):
                index.setdefault((size, block, value), []).append(k)
        for g in grams.tolist():
            holders.setdefault(g, set()).add(size)
    known = np.array(sorted(holders), dtype=np.uint64)
    bits = np.zeros(1 << _FILTER_BITS, dtype=bool)
    bits[(known & np.uint64((1 << _FILTER_BITS) - 1)).astype(np.int64)] = True
    return {
        "entries": entries, "index": {at: np.array(ks) for at, ks in index.items()}, "by_gram": by_gram,
        "marks": np.array([mark for *_, mark in entries], dtype=np.uint64), "known": known, "bits": bits,
        "holders": {g: sorted(s) for g, s in holders.items()}, "lengths": sorted({n for _, _, n, _ in prepared}),
    }


def shingles_of(hashes: np.ndarray, first: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingles of n words and the word each starts at; one-word shingles are the words."""
    if n == 1:
        return mix(hashes), np.arange(len(hashes))
    return gram_hashes(hashes, first, n)


def _windows(index: dict, words: Words, hashes: np.ndarray) -> dict[tuple[int, int, int], None]:
    """(document, size, first word) of the windows that share a shingle with an item of their size."""
    windows: dict[tuple[int, int, int], None] = {}
    for n in index["lengths"]:
        grams, at = shingles_of(hashes, words.first, n)
        maybe = np.flatnonzero(index["bits"][(grams & np.uint64((1 << _FILTER_BITS) - 1)).astype(np.int64)])
        if not len(maybe):
            continue
        spot = np.minimum(np.searchsorted(index["known"], grams[maybe]), len(index["known"]) - 1)
        hits = maybe[index["known"][spot] == grams[maybe]]
        docs = np.searchsorted(words.first, at[hits], side="right") - 1
        for gram, place, d in zip(grams[hits].tolist(), at[hits].tolist(), docs.tolist()):
            low, high = int(words.first[d]), int(words.first[d + 1])
            for size in index["holders"][gram]:
                if min(SHINGLE, size) == n:
                    for start in range(max(low, place + n - size), min(place, high - size) + 1):
                        windows[d, size, start] = None
    return windows


def _candidates(index: dict, size: int, grams: np.ndarray, each: list[float]) -> list[int]:
    """Items of the size that may be similar: within the radius, or, of a short size, with a shingle of the window."""
    if size <= SHORT:
        return sorted({k for g in grams.tolist() for k in index["by_gram"].get((size, g), ())})
    fingerprint = simhash(grams, np.array(each))
    met = [index["index"][size, *at] for at in _blocks(fingerprint) if (size, *at) in index["index"]]
    if not met:
        return []
    ks = np.concatenate(met)
    return sorted(set(ks[np.bitwise_count(index["marks"][ks] ^ np.uint64(fingerprint)) <= RADIUS].tolist()))


def find_leaks(index: dict, weights: Weights, words: Words, least: float) -> dict[int, dict[int, tuple[float, int]]]:
    """Per document: item -> (similarity, first word) of its most similar window, the first of equals."""
    hashes = words.hashes()
    found: dict[int, dict[int, tuple[float, int]]] = {}
    for d, size, start in sorted(_windows(index, words, hashes)):
        n = min(SHINGLE, size)
        part = hashes[start : start + size]
        grams = np.unique(shingles_of(part, np.array([0, size]), n)[0])
        each = weights.of(grams).tolist()
        for k in _candidates(index, size, grams, each):
            item_id, _, held, total, _ = index["entries"][k]
            shared = sum(w for g, w in zip(grams.tolist(), each) if g in held)
            similarity = shared / (total + sum(each) - shared)
            best = found.setdefault(d, {})
            if similarity >= least and similarity > best.get(item_id, (0.0, 0))[0]:
                best[item_id] = (similarity, start - int(words.first[d]))
    return found


_LEAKS = "array<struct<item_id: long, similarity: double, first_word: long>>"
_LEAK_TYPE = pa.list_(pa.struct([("item_id", pa.int64()), ("similarity", pa.float64()), ("first_word", pa.int64())]))


def leaks(documents: DataFrame, benchmark: DataFrame, least: float = 0.8) -> Column:
    """The items that stand in the column `text`, as an array of (item_id, similarity, first_word), by block and item."""
    items = benchmark.filter(F.col("text").isNotNull()).select("item_id", "text").orderBy("item_id", "text")
    weights = shingle_weights(benchmark)
    # plain arrays: broadcast values are pickled by name, and the tasks may not have this module
    held = documents.sparkSession.sparkContext.broadcast((weights.shingles, weights.values, weights.other))
    found, block = [], []
    for row in items.toLocalIterator():
        block.append((row["item_id"], row["text"]))
        if len(block) == BLOCK:
            found.append(_leaks_of(documents, benchmark_index(block, weights), held, least))
            block = []
    if block or not found:
        found.append(_leaks_of(documents, benchmark_index(block, weights), held, least))
    return F.concat(*found)


def _best_of_each(found: Column) -> Column:
    """By item, the most similar window, the first of equals: an id may occur in several blocks."""
    turned = F.transform(found, lambda x: F.struct(x["item_id"].alias("item_id"), (-x["similarity"]).alias("unlike"), x["first_word"].alias("first_word")))
    ordered = F.array_sort(turned)
    first = F.filter(ordered, lambda x, i: (i == 0) | ~x["item_id"].eqNullSafe(F.get(ordered, i - 1)["item_id"]))
    return F.transform(first, lambda x: F.struct(x["item_id"], (-x["unlike"]).alias("similarity"), x["first_word"])).cast(_LEAKS)


def _leaks_of(documents: DataFrame, index: dict, weights: Broadcast, least: float) -> Column:
    shared = documents.sparkSession.sparkContext.broadcast(index)

    @F.arrow_udf(_LEAKS)
    def search(texts: pa.Array) -> pa.Array:
        out: list[list[dict]] = []
        held = Weights(*weights.value)
        for _, data, offsets in slices(pa.RecordBatch.from_arrays([texts], ["text"])):
            words = plain_words(data, offsets)
            found = find_leaks(shared.value, held, words, least)
            for d in range(len(words.counts)):
                best = sorted(found.get(d, {}).items(), key=lambda item: (item[0] is not None, item[0] or 0))
                out.append([{"item_id": k, "similarity": s, "first_word": at} for k, (s, at) in best])
        return pa.array(out, _LEAK_TYPE)

    return search(F.col("text"))


def leak_report(documents: DataFrame, benchmark: DataFrame, least: float = 0.8) -> DataFrame:
    """doc_id, item_id, similarity and first_word: a row for every item found in a document."""
    narrow = documents.select("doc_id", "text")
    found = narrow.select("doc_id", leaks(narrow, benchmark, least).alias("found"))
    return found.select("doc_id", F.explode(_best_of_each(F.col("found"))).alias("leak")).select("doc_id", "leak.*")


def decontaminate(documents: DataFrame, benchmark: DataFrame, least: float = 0.8) -> DataFrame:
    """The documents in which no benchmark item stands."""
    return documents.filter(F.size(leaks(documents, benchmark, least)) == 0)
