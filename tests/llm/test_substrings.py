from __future__ import annotations

import hashlib
import random
from collections import Counter

import brute
import pytest
from pyspark.sql import functions as F

from martloom.llm import substrings

SAMPLE = "/root/testdata/sf0.001"


def check(docs, length=35, shard=substrings.SHARD):
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    expected = []
    for (doc_id, _), (words, kept) in zip(rows, brute.kept_words([t for _, t in rows], length)):
        expected.append((doc_id, len(words), len(words) - len(kept), hashlib.sha256(" ".join(kept).encode()).hexdigest()))
    got = [tuple(r) for r in substrings.substring_report(docs, length, shard).collect()]
    assert sorted(got, key=repr) == sorted(expected, key=repr)
    return got


def shared_passages(seed=1, n=60):
    """Documents with one common line in different contexts, common passages cut at odd places, and repeats in themselves."""
    rng = random.Random(seed)
    fresh = lambda k: [f"w{rng.randrange(10**6)}" for _ in range(k)]
    line, long_ = fresh(25), fresh(120)
    out = []
    for i in range(n):
        a, b = sorted(rng.sample(range(121), 2))
        part = long_[a:b]
        words = fresh(rng.randrange(60)) + line + fresh(rng.randrange(50)) + part + fresh(3)
        if i % 7 == 0:
            words += ["so"] * 50 + ["one", "two", "three"] * 30
        if i % 11 == 0:
            words += words[10:60]
        out.append((i, "  ".join(words)))
    return out


@pytest.mark.parametrize("shard", [4000, 10])
def test_sample_and_shared_passages(spark, shard):
    docs = spark.read.parquet(f"{SAMPLE}/documents.parquet").select("doc_id", "text")
    more = spark.createDataFrame([(10_000 + i, t) for i, t in shared_passages()], "doc_id long, text string")
    got = check(docs.unionByName(more).repartition(5), shard=shard)
    assert sum(r[2] for r in got) > 1000


def test_defined_results(spark):
    w = " ".join(f"w{i}" for i in range(40))
    rows = [
        (1, None), (2, ""), (3, w), (4, w + "\x1c"), (4, w), (5, "a " * 34), (6, "b " * 35), (7, "b\n" * 36), (None, w.upper()), (8, " ".join(["x"] * 30_000)),
        (9, "é" * 3 + " " + w), (10, "solo " + " ".join(f"p{i % 5}" for i in range(45))), (3, w),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    check(docs)
    wide = docs.withColumns({c: F.lit("x") for c in ("key", "spans", "anchor", "piece", "start")}).withColumn("n_chars", F.char_length("text"))
    kept = substrings.remove_repeats(wide)
    assert kept.columns == wide.columns and kept.count() == len(rows)
    got = {r["doc_id"]: r for r in kept.collect()}
    assert got[1]["text"] is None and got[5]["text"] == "a " * 34
    assert got[9]["text"] == "ééé" and got[9]["n_chars"] == 3 and got[6]["text"] == ""


def test_empty_table(spark):
    assert substrings.substring_report(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_automaton_counts_repeated_windows():
    rng = random.Random(3)
    for _ in range(60):
        texts = [[rng.randrange(3) for _ in range(rng.randrange(1, 14))] for _ in range(5)]
        weights = [rng.choice([1, 1, 2]) for _ in texts]
        automaton = substrings.Automaton()
        for t, w in zip(texts, weights):
            automaton.add(t, w)
        automaton.finish()
        for length in (2, 4):
            seen = Counter()
            for t, w in zip(texts, weights):
                for i in range(len(t) - length + 1):
                    seen[tuple(t[i : i + length])] += w
            probe = texts[0]
            assert automaton.repeats(probe, length) == [i for i in range(len(probe) - length + 1) if seen[tuple(probe[i : i + length])] > 1]


def test_every_window_is_in_one_piece_and_anchors_depend_on_the_window_only():
    from test_texts import batch_of

    from martloom.llm.texts import word_runs

    texts = [t for _, t in shared_passages(2, 20)]
    anchors = {}
    for _, words in word_runs(batch_of(texts)):
        found = substrings.pieces_of(words, 35)
        covered = Counter()
        for doc, start, windows, anchor in zip(*(found[k].tolist() for k in ("doc", "start", "windows", "anchor"))):
            w = brute.words(texts[doc])
            for i in range(start, start + windows):
                covered[doc, i] += 1
                assert anchors.setdefault(tuple(w[i : i + 35]), anchor) == anchor
        assert covered == Counter({(d, i): 1 for d, t in enumerate(texts) for i in range(len(brute.words(t)) - 34)})
