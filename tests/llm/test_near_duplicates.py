from __future__ import annotations

import random

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from martloom.llm import ngram_join
from martloom.llm.components import components

SAMPLE = "/root/testdata/sf0.001"


def check(docs, n, percent):
    got = sorted((tuple(r) for r in ngram_join.near_duplicates(docs, n, percent).collect()), key=repr)
    expected = brute.near_duplicates([tuple(r) for r in docs.select("doc_id", "text").collect()], n, percent)
    assert got == sorted(expected, key=repr)
    return got


def copies_of(seed, n, edits):
    rng = random.Random(seed)
    base = [f"w{rng.randrange(4000)}" for _ in range(160)]
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(rng.randrange(edits + 1)):
            w[rng.randrange(len(w))] = f"v{rng.randrange(10**6)}"
        out.append(" ".join(w))
    return out


@pytest.mark.parametrize("n,percent", [(4, 85), (5, 80)])
def test_sample_with_groups_of_near_copies(spark, n, percent):
    docs = spark.read.parquet(f"{SAMPLE}/documents.parquet").select("doc_id", "text")
    near = [*copies_of(1, 60, 6), *copies_of(2, 30, 3)]
    more = spark.createDataFrame([(1000 + i, t) for i, t in enumerate(near)], "doc_id long, text string")
    got = check(docs.unionByName(more).repartition(6), n, percent)
    # there are real groups, and members of them that are linked with nothing
    sizes = np.unique([c for d, _, c in got if d >= 1000], return_counts=True)[1]
    assert sizes.max() > 10 and (sizes == 1).any()


def test_defined_results(spark):
    rows = [
        (9, "A b c d e"), (8, "a B c d e"), (7, "a b c"), (6, "A b  c\n"), (5, "a b"), (4, None), (3, ""), (3, ""), (2, " \t"), (1, "x " * 20_000),
        (0, "x " * 19_000), (None, "a b c"), (None, "only null"), (11, "a\x1cb c d e f"), (7, "a b c"), (12, "É é"), (13, "é é"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    check(docs, 4, 85)
    wide = docs.withColumns({c: F.lit("x") for c in ("size", "class", "root", "gram", "component_id", "node")})
    kept = ngram_join.one_of_each(wide, 4, 85)
    assert kept.columns == wide.columns
    ids = sorted((r["doc_id"] for r in kept.collect()), key=repr)
    assert ids == sorted([8, 6, 5, 4, 3, 3, 2, 0, None, 11, 12, 13], key=repr)


def test_empty_tables(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert ngram_join.near_duplicates(empty, 4, 85).count() == 0
    assert ngram_join.one_of_each(spark.createDataFrame([(1, None)], "doc_id long, text string")).count() == 1


def test_sketches_bound_the_distance_from_below():
    rng = np.random.default_rng(1)
    for shared, own in ((200, 5), (50, 40), (3, 300)):
        common = rng.integers(0, 2**63, shared, dtype=np.uint64)
        a, b = (np.concatenate([common, rng.integers(0, 2**63, own, dtype=np.uint64)]) for _ in range(2))
        sets = ngram_join.GramSets.__new__(ngram_join.GramSets)
        sets.values, sets.docs = np.concatenate([a, b]), np.repeat([0, 1], [len(a), len(b)])
        sets.sizes = np.array([len(a), len(b)])
        sets.offsets = np.array([0, len(a), len(a) + len(b)])
        x, y = sets.sketches()
        assert sum(int(v).bit_count() for v in (x ^ y).view(np.uint64)) <= 2 * own
        assert own // 2 <= ngram_join.distance_at_least(*sets.wide_sketches()) <= 2 * own


def test_wide_sketches_of_different_lengths_are_folded():
    rng = np.random.default_rng(2)
    values = rng.integers(0, 2**63, 1100, dtype=np.uint64)
    sets = ngram_join.GramSets.__new__(ngram_join.GramSets)
    sets.values, sets.offsets = np.concatenate([values[:1000], values]), np.array([0, 1000, 2100])
    small, large = sets.wide_sketches()
    assert (len(small), len(large)) == (128, 256)
    assert 80 <= ngram_join.distance_at_least(small, large) == ngram_join.distance_at_least(large, small) <= 100


@pytest.mark.parametrize("percent", [80, 85, 100])
def test_prefix_is_long_enough(percent):
    for size in range(1, 400):
        least = -(-percent * size // 100)  # similar sets share at least so many
        assert ngram_join.prefix_length(size, percent) == size - least + 1


def test_components(spark):
    rng = random.Random(5)
    links = [(i, i + 1) for i in range(0, 60)] + [(1000, i) for i in range(1001, 1200)] + [(7000 + rng.randrange(40), 7000 + rng.randrange(40)) for _ in range(30)]
    parent = {x: x for link in links for x in link}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        parent[find(a)] = find(b)
    shuffled = {x: hash((x, "s")) for x in parent}
    df = spark.createDataFrame([(shuffled[a], shuffled[b]) for a, b in links], "a long, b long")
    root = {r["node"]: r["root"] for r in components(df).collect()}
    linked = [x for x in parent if any(x in link and link[0] != link[1] for link in links)]
    assert set(root) == {shuffled[x] for x in linked}
    for x in linked:
        for y in linked:
            assert (find(x) == find(y)) == (root[shuffled[x]] == root[shuffled[y]])
    assert components(df.limit(0)).count() == 0
