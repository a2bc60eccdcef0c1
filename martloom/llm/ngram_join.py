"""Near-duplicate join: documents whose sets of word n-grams have a Jaccard similarity of at least percent / 100.

Equal sets form one class, and classes are joined. The n-grams of a class are ordered rare first, and two similar classes
must share one in their prefixes, so the prefixes are joined on the n-gram and each candidate pair is verified once, on the
whole sets. Before that, candidates are dropped by

* length: similar sets differ little in size;
* position: what may still be shared behind the positions of a shared n-gram must suffice;
* suffix: a parity sketch of each set (one bit per part of the hash space, set if it holds an odd number of n-grams)
  bounds the Hamming distance of two sets from below. A sketch of 64 * SKETCH bits goes along in the join; pairs that
  pass are held against sketches with as many bits as the sets have n-grams.

Rarity is the number of n-grams in the same one of BUCKETS parts of the hash space, over all documents: a table of fixed
size, broadcast. Any order gives the same result; a rarer-first order gives fewer candidates.

A group of near copies would give all its pairs. So first every class meets just two classes of each of its n-grams' groups,
chosen by hash in one of CHOICES ways; what that links forms components; only pairs of classes in different components are then enumerated. Links
inside a component change nothing about the components, so the result is that of all pairs. Such a pair is emitted at its
first common n-gram: every row carries the LATEST shared n-grams before its own, and rows that have one of those in common
are not joined. (Only behind a gap of more than LATEST is a pair met again, and made one afterwards.) Hot n-grams are
combined before the shuffle, and the joins on them can be split by adaptive execution.

Defined results: words are `[^\\x20\\x09-\\x0D]+` after A-Z are lower-cased; fewer than n words make one n-gram; no words, or
a null text, make an empty set, linked with nothing. Rows with equal ids count as rows; the id of a component is the
smallest id in it (null if all are). An empty table gives no rows. Sets are told apart by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martloom.llm.bits import bit_filter, in_filter
from martloom.llm.components import components
from martloom.llm.storage import stored
from martloom.llm.texts import Words, gram_hashes, kept_offsets, mix, ranged_hash, signed, word_runs

BUCKETS = 1 << 18
SKETCH = 8
#: Ways to choose the two classes that the others of an n-gram's group meet first; n-grams are dealt among them.
CHOICES = 16
#: Shared n-grams of a class that a row of the last join carries; they bound its size, not the result.
LATEST = 16
#: Bits of the broadcast filters of shared n-grams and of classes to be verified. Their size is fixed; with more entries
#: than bits they let more rows through to the joins behind them, which are exact.
SHARED_BITS = 1 << 25
FILTER_BITS = 1 << 25


class GramSets:
    """Sets of n-grams of a run of documents: document d has values[offsets[d]:offsets[d + 1]], ascending."""

    def __init__(self, words: Words, n: int):
        hashes = words.hashes()
        grams, _ = gram_hashes(hashes, words.first, n)
        counts = np.diff(kept_offsets(words, n))
        short = np.flatnonzero((words.counts > 0) & (words.counts < n))
        docs = np.repeat(np.arange(len(counts)), counts)
        if len(short):
            whole = ranged_hash(hashes, words.first[short], words.first[short + 1])
            grams, docs = np.concatenate([grams, mix(whole ^ np.uint64(0xA5A5))]), np.concatenate([docs, short])
        order = np.lexsort((grams, docs))
        grams, docs = grams[order], docs[order]
        new = np.ones(len(grams), dtype=bool)
        new[1:] = (grams[1:] != grams[:-1]) | (docs[1:] != docs[:-1])
        self.values, self.docs = grams[new], docs[new]
        self.sizes = np.bincount(self.docs, minlength=len(counts)).astype(np.int64)
        self.offsets = np.concatenate([[0], np.cumsum(self.sizes)])

    def classes(self) -> np.ndarray:
        """A hash of each set (of an empty set: of no meaning)."""
        sums = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(mix(self.values + np.uint64(0x51ED)))])
        return signed(mix(sums[self.offsets[1:]] - sums[self.offsets[:-1]] + self.sizes.astype(np.uint64)))

    def sketches(self) -> np.ndarray:
        """(documents, SKETCH) 64-bit words of parities."""
        bits = 64 * SKETCH
        place = self.docs * bits + (self.values >> np.uint64(40)).astype(np.int64) % bits
        odd = (np.bincount(place, minlength=len(self.sizes) * bits) & 1).astype(np.uint8)
        return np.packbits(odd.reshape(len(self.sizes), bits), axis=1).view(np.int64)


    def wide_sketches(self) -> list[bytes]:
        """Parities in 64 * SKETCH bits, doubled until there are as many as n-grams."""
        out = []
        for low, high in zip(self.offsets[:-1].tolist(), self.offsets[1:].tolist()):
            bits = 64 * SKETCH
            while bits < high - low:
                bits *= 2
            place = (self.values[low:high] >> np.uint64(40)).astype(np.int64) % bits
            out.append(np.packbits((np.bincount(place, minlength=bits) & 1).astype(np.uint8)).tobytes())
        return out


def distance_at_least(a: bytes, b: bytes) -> int:
    """A lower bound of the Hamming distance of two sets; a longer sketch is folded to the length of the shorter."""
    x, y = (np.frombuffer(s, dtype=np.uint8) for s in (a, b))
    while len(x) != len(y):
        if len(x) > len(y):
            x = x[: len(x) // 2] ^ x[len(x) // 2 :]
        else:
            y = y[: len(y) // 2] ^ y[len(y) // 2 :]
    return int(np.bitwise_count(x ^ y).sum())


def buckets_of(values: np.ndarray) -> np.ndarray:
    return (values & np.uint64(BUCKETS - 1)).astype(np.int64)


def prefix_length(size, percent: int):
    """How many of the rarest n-grams of a set must be looked at."""
    return size - (percent * size + 99) // 100 + 1


def _profiles(documents: DataFrame, n: int) -> DataFrame:
    """A row per document (id, key, class, size, sketch), and rows of n-gram counts per bucket (bucket, count)."""
    kind = documents.schema["doc_id"].dataType
    names = [f"s{i}" for i in range(SKETCH)]

    def profile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros(BUCKETS, dtype=np.int64)
        for batch in batches:
            ids, keys = (batch.column(batch.schema.get_field_index(c)) for c in ("doc_id", "key"))
            for rows, words in word_runs(batch, lower=True):
                sets = GramSets(words, n)
                totals += np.bincount(buckets_of(sets.values), minlength=BUCKETS)
                sketches = sets.sketches()
                yield pa.RecordBatch.from_arrays(
                    [ids[rows], keys[rows], pa.array(sets.classes(), mask=sets.sizes == 0), pa.array(sets.sizes)]
                    + [pa.array(sketches[:, i]) for i in range(SKETCH)]
                    + [pa.array(sets.wide_sketches(), pa.binary()), pa.nulls(len(sets.sizes), pa.int32())],
                    ["doc_id", "key", "class", "size", *names, "wide", "bucket"],
                )
        at = np.flatnonzero(totals)
        if len(at):
            none = pa.nulls(len(at), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(len(at), ids.type), none, none, pa.array(totals[at])]
                + [none] * SKETCH
                + [pa.nulls(len(at), pa.binary()), pa.array(at.astype(np.int32))],
                ["doc_id", "key", "class", "size", *names, "wide", "bucket"],
            )

    schema = f"doc_id {kind.simpleString()}, key long, class long, size long, {', '.join(x + ' long' for x in names)}, wide binary, bucket int"
    return documents.mapInArrow(profile, schema)


def _prefixes(documents: DataFrame, n: int, percent: int, counts, shared=None) -> DataFrame:
    """(gram, class, size, place) of the rarest n-grams of each class; a class at most once per task.

    With `shared`, a broadcast filter, only n-grams that pass it (places are still those among all).
    """

    def prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            for _, words in word_runs(batch, lower=True):
                sets = GramSets(words, n)
                classes = sets.classes()
                fresh = np.zeros(len(classes), dtype=bool)
                for d, (c, size) in enumerate(zip(classes.tolist(), sets.sizes.tolist())):
                    if size and c not in seen:
                        seen.add(c)
                        fresh[d] = True
                order = np.lexsort((sets.values, counts.value[buckets_of(sets.values)], sets.docs))
                place = np.arange(len(order)) - sets.offsets[sets.docs]
                within = fresh[sets.docs] & (place < prefix_length(sets.sizes, percent)[sets.docs])
                grams = signed(sets.values[order])
                if shared is not None:
                    within &= in_filter(shared.value, grams)
                docs = sets.docs[within]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(grams[within]),
                        pa.array(classes[docs]),
                        pa.array(sets.sizes[docs].astype(np.int32)),
                        pa.array(place[within].astype(np.int32)),
                    ],
                    ["gram", "class", "size", "place"],
                )

    return documents.select("text").mapInArrow(prefixes, "gram long, class long, size int, place int")


def _sets_of(documents: DataFrame, n: int, needed: DataFrame) -> DataFrame:
    """(class, grams) of the needed classes, read from one document of each (class, doc_id).

    The document is found by a filter of fixed size. Others that pass it by mistake, and rows with equal ids, give
    sets that are asked for by nobody, or twice.
    """
    spot = F.col("class").bitwiseXOR(F.coalesce(F.col("doc_id").cast("long"), F.lit(0)))
    shared = documents.sparkSession.sparkContext.broadcast(bit_filter(needed.select(spot.alias("spot")), FILTER_BITS))

    def sets_in(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(batch.schema.get_field_index("doc_id")).cast(pa.int64()).fill_null(0).to_numpy()
            for rows, words in word_runs(batch, lower=True):
                sets = GramSets(words, n)
                classes = sets.classes()
                wanted = np.flatnonzero(in_filter(shared.value, classes ^ ids[rows]) & (sets.sizes > 0))
                grams = [signed(sets.values[sets.offsets[d] : sets.offsets[d + 1]]) for d in wanted]
                yield pa.RecordBatch.from_arrays([pa.array(classes[wanted]), pa.array(grams, pa.list_(pa.int64()))], ["class", "grams"])

    return documents.mapInArrow(sets_in, "class long, grams array<long>")


def _may_link(percent: int, a: str, b: str) -> Column:
    """Length and suffix filters on two rows with size and sketch."""
    x, y = F.col(f"{a}.size").cast("long"), F.col(f"{b}.size").cast("long")
    least = F.ceil((x + y) * percent / F.lit(100.0 + percent) - F.lit(1e-9))
    apart = sum((F.bit_count(F.col(f"{a}.s{i}").bitwiseXOR(F.col(f"{b}.s{i}"))) for i in range(SKETCH)), F.lit(0))
    return (100 * F.least(x, y) >= percent * F.greatest(x, y)) & (apart <= x + y - 2 * least)


def _verified(documents: DataFrame, n: int, percent: int, pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs (a, b) whose whole sets are similar enough."""
    ends = pairs.select(F.col("a").alias("class")).union(pairs.select(F.col("b").alias("class"))).distinct()
    needed = stored(ends.join(classes.select("class", "doc_id"), "class"), "needed")
    sets = _sets_of(documents, n, needed)
    with_a = pairs.join(sets.select(F.col("class").alias("a"), F.col("grams").alias("x")), "a")
    both = with_a.join(sets.select(F.col("class").alias("b"), F.col("grams").alias("y")), "b")
    shared = F.size(F.array_intersect("x", "y"))
    union = F.size("x") + F.size("y") - shared
    return both.filter(shared.cast("long") * 100 >= union.cast("long") * percent).select("a", "b").distinct()


def link_classes(documents: DataFrame, n: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """(doc_id, key, size, class) of every row, and (node, root) of the classes that are linked with another.

    The key is a hash of id and text: rows that have both in common are one and the same.
    """
    documents = documents.select("doc_id", "text")
    profiles = stored(_profiles(documents.withColumn("key", F.xxhash64("doc_id", "text")), n), "profiles")
    rows = profiles.filter("bucket IS NULL").drop("bucket")
    summed = profiles.filter("bucket IS NOT NULL").groupBy("bucket").agg(F.sum("size").alias("n")).toArrow()  # at most BUCKETS rows
    table = np.zeros(BUCKETS, dtype=np.int64)
    table[summed.column("bucket").to_numpy()] = summed.column("n").to_numpy()
    counts = documents.sparkSession.sparkContext.broadcast(table)
    sketch = [F.first(f"s{i}").alias(f"s{i}") for i in range(SKETCH)]
    classes = stored(
        rows.filter("class IS NOT NULL").groupBy("class").agg(F.min("doc_id").alias("doc_id"), F.first("size").alias("size"), F.first("wide").alias("wide"), *sketch),
        "classes",
    )

    prefixes = _prefixes(documents, n, percent, counts)
    # two classes of each n-gram's group; groups with the same members choose alike unless their ways differ
    way = F.xxhash64(F.pmod("gram", F.lit(CHOICES)))
    turned = F.col("class").bitwiseXOR(way)
    groups = prefixes.groupBy("gram").agg(F.min(turned).alias("low"), F.max(turned).alias("high")).filter("low < high")
    back = lambda c: F.col(c).bitwiseXOR(way)
    groups = stored(groups.select("gram", back("low").alias("low"), back("high").alias("high")), "groups")
    shared = documents.sparkSession.sparkContext.broadcast(bit_filter(groups.select("gram"), SHARED_BITS))
    members = stored(_prefixes(documents, n, percent, counts, shared).join(groups, "gram"), "members")

    known = classes.drop("doc_id", "wide")
    met = members.select("class", F.explode(F.array("low", "high")).alias("other")).filter("class <> other")
    met = met.select(F.least("class", "other").alias("a"), F.greatest("class", "other").alias("b")).distinct()
    first = stored(_by_wide_sketches(_filtered(met, known, percent), classes, percent), "pairs")
    links = stored(_verified(documents, n, percent, first, classes), "links")
    roots = components(links)

    placed = members.select("gram", "class", "size", "place").join(roots.withColumnRenamed("node", "class"), "class", "left")
    placed = placed.withColumn("root", F.coalesce("root", "class"))
    mixed = placed.groupBy("gram").agg(F.min("root").alias("low"), F.max("root").alias("high")).filter("low < high").select("gram")
    latest = Window.partitionBy("class").orderBy("place").rowsBetween(-LATEST, -1)
    placed = placed.join(mixed, "gram", "left_semi").distinct().withColumn("before", F.collect_list("gram").over(latest))
    open_ = stored(placed.join(known.drop("size"), "class"), "open")
    x, y = F.col("x.size").cast("long"), F.col("y.size").cast("long")
    least = F.ceil((x + y) * percent / F.lit(100.0 + percent) - F.lit(1e-9))
    index_prefix = x - F.ceil(x * 2 * percent / F.lit(100.0 + percent) - F.lit(1e-9)) + 1
    i, j = F.col("x.place"), F.col("y.place")
    may_share = F.least(i, j) + 1 + F.least(x - i - 1, y - j - 1)
    ordered = (x < y) | ((x == y) & (F.col("x.class") < F.col("y.class")))
    candidates = open_.alias("x").join(
        open_.alias("y"),
        (F.col("x.gram") == F.col("y.gram"))
        & (F.col("x.root") != F.col("y.root"))
        & ordered
        & ~F.arrays_overlap("x.before", "y.before")
        & (i < index_prefix)
        & (may_share >= least)
        & _may_link(percent, "x", "y"),
    )
    a, b = F.least("x.class", "y.class").alias("a"), F.greatest("x.class", "y.class").alias("b")
    open_pairs = candidates.select(a, b).distinct().join(first, ["a", "b"], "left_anti")
    second = stored(_by_wide_sketches(open_pairs, classes, percent), "pairs")
    more = stored(_verified(documents, n, percent, second, classes), "links")
    # whole components are contracted to their roots, then joined by the further links
    up = roots.select(F.col("node").alias("a"), F.col("root").alias("b"))
    return rows.select("doc_id", "key", "size", "class"), components(up.unionByName(more))


def _filtered(pairs: DataFrame, known: DataFrame, percent: int) -> DataFrame:
    def end(name: str) -> DataFrame:
        return known.select(F.col("class").alias(name), F.struct(*[c for c in known.columns if c != "class"]).alias(f"of_{name}"))

    joined = pairs.join(end("a"), "a").join(end("b"), "b")
    return joined.filter(_may_link(percent, "of_a", "of_b")).select("a", "b")


def _by_wide_sketches(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    @F.arrow_udf("boolean")
    def near(a: pa.Array, b: pa.Array, most: pa.Array) -> pa.Array:
        return pa.array([distance_at_least(x, y) <= m for x, y, m in zip(a.to_pylist(), b.to_pylist(), most.to_pylist())], pa.bool_())

    def end(name: str) -> DataFrame:
        return classes.select(F.col("class").alias(name), F.struct("size", "wide").alias(f"of_{name}"))

    total = F.col("of_a.size") + F.col("of_b.size")
    least = F.ceil(total * percent / F.lit(100.0 + percent) - F.lit(1e-9))
    joined = pairs.join(end("a"), "a").join(end("b"), "b")
    return joined.filter(near("of_a.wide", "of_b.wide", total - 2 * least)).select("a", "b")


def _rooted(documents: DataFrame, n: int, percent: int) -> DataFrame:
    rows, roots = link_classes(documents, n, percent)
    joined = rows.join(roots, rows["class"] == roots["node"], "left")
    return joined.select("doc_id", "key", "size", F.coalesce("root", "class").alias("root"))


def near_duplicates(documents: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles (size of the set) and component_id of every row of documents (doc_id, text, ...)."""
    rooted = _rooted(documents, n, percent)
    least = stored(rooted.filter("root IS NOT NULL").groupBy("root").agg(F.min("doc_id").alias("component_id")), "least-ids")
    return rooted.join(least, "root", "left").select(
        "doc_id", F.col("size").alias("n_shingles"), F.when(F.col("root").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id")
    )


def one_of_each(documents: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """The documents without their near duplicates: of each component the row with the smallest id stays, with its columns.

    Null ids come last; of rows with equal ids the one whose key is smaller stays, of rows equal in id and text any
    one. Documents with an empty set all stay.
    """
    keys = _rooted(documents, n, percent).groupBy("key").agg(
        F.first("root").alias("root"), F.first("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("rows")
    )
    keys = stored(keys, "keys")
    order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "key", "rows")
    first = keys.filter("root IS NOT NULL").groupBy("root").agg(F.min(order).alias("first"))
    kept = first.select(F.col("first.key").alias("__key"), (F.col("first.rows") == 1).alias("__single")).unionByName(
        keys.filter("root IS NULL").select(F.col("key").alias("__key"), F.lit(True).alias("__single"))
    )
    joined = documents.withColumn("__key", F.xxhash64("doc_id", "text")).join(kept, "__key")
    once = joined.filter("__single").drop("__key", "__single")
    return once.unionByName(joined.filter("NOT __single").dropDuplicates(["__key"]).drop("__key", "__single"))
