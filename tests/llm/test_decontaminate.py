from __future__ import annotations

import math
import pickle
import random

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from martloom.llm import decontaminate

SAMPLE = "/root/testdata/sf0.01"


def shingles(w):
    n = min(5, len(w))
    return frozenset(tuple(w[i : i + n]) for i in range(len(w) - n + 1)) if w else frozenset()


def expected(rows, items, least=0.8):
    """Every window of every item's size against the item; the best of each, the first of equals."""
    prepared = [(k, brute.plain_words(t)) for k, t in items if t and brute.plain_words(t)]
    held = [shingles(w) for _, w in prepared]
    seen = {}
    for s in held:
        for g in s:
            seen[g] = seen.get(g, 0) + 1
    total = len(prepared)
    weight = lambda g: 1 + math.log((1 + total) / (1 + seen.get(g, 0)))
    by_gram = {}
    for k, s in enumerate(held):
        for g in s:
            by_gram.setdefault(g, set()).add(k)
    out = {}
    for row, (doc_id, text) in enumerate(rows):
        w = brute.plain_words(text)
        likely = {k for n in range(1, 6) for i in range(len(w) - n + 1) for k in by_gram.get(tuple(w[i : i + n]), ())}
        for k in likely:
            size = len(prepared[k][1])
            for start in range(len(w) - size + 1):
                s = shingles(w[start : start + size])
                both = sum(weight(g) for g in s & held[k])
                similarity = both / (sum(map(weight, s)) + sum(map(weight, held[k])) - both)
                if similarity >= least and similarity > out.get((row, doc_id, prepared[k][0]), (0, 0))[0] + 1e-12:
                    out[row, doc_id, prepared[k][0]] = (similarity, start)
    return sorted((d, i, round(s, 9), at) for (_, d, i), (s, at) in out.items())


def found(docs, benchmark, least=0.8):
    return sorted((r["doc_id"], r["item_id"], round(r["similarity"], 9), r["first_word"]) for r in decontaminate.leak_report(docs, benchmark, least).collect())


def test_sample_against_all_windows(spark):
    docs = spark.read.parquet(f"{SAMPLE}/documents.parquet")
    benchmark = spark.read.parquet(f"{SAMPLE}/benchmark.parquet")
    got = found(docs, benchmark)
    assert got and got == expected([tuple(r) for r in docs.select("doc_id", "text").collect()], [tuple(r) for r in benchmark.collect()])
    clean = decontaminate.decontaminate(docs, benchmark)
    assert clean.columns == docs.columns and clean.count() == docs.count() - len({r[0] for r in got})


def test_recall_of_edited_items(spark):
    """Items with a word changed, dropped or added, within longer documents: at least 0.9 of what all windows find."""
    rng = random.Random(4)
    items = [(i, " ".join(f"w{rng.randrange(3000)}" for _ in range(rng.randrange(15, 60)))) for i in range(60)]
    rows = []
    for i in range(240):
        w = items[i % 60][1].split()
        at = rng.randrange(len(w))
        w = [w, w[:at] + ["new"] + w[at + 1 :], w[:at] + w[at + 1 :], w[:at] + ["new"] + w[at:]][i // 60]
        around = [f"x{rng.randrange(10**6)}" for _ in range(40)]
        rows.append((i, " ".join(around[:20] + w + around[20:])))
    want = {r[:2] for r in expected(rows, items)}
    got = {r[:2] for r in found(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))}
    assert got <= want and len(got) >= 0.9 * len(want) and {(i, i) for i in range(60)} <= got


def test_recall_of_items_at_the_least_similarity(spark):
    """Items with one word changed, all matches at 0.80 to 0.85: none of 400 is lost."""
    rng = random.Random(8)
    items = [(i, " ".join(f"w{rng.randrange(30000)}" for _ in range(52 + i % 8))) for i in range(100)]
    rows = []
    for i in range(400):
        w = items[i % 100][1].split()
        at = rng.randrange(5, len(w) - 5)
        around = [f"x{rng.randrange(10**6)}" for _ in range(10)]
        rows.append((i, " ".join(around[:5] + w[:at] + ["new"] + w[at + 1 :] + around[5:])))
    want = expected(rows, items)
    assert len(want) > 300 and all(0.8 <= s < 0.85 for _, _, s, _ in want)
    assert found(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")) == want


def test_short_items_with_a_common_end(spark):
    """Four rare shingles and a common one that differs, which decides every bit on which the four are even."""
    items = [(i, f"a{i} b{i} c{i} d{i} the right answer is {'yes' if i % 2 else 'no'}") for i in range(300)]
    rows = [(i, f"x {t.rsplit(' ', 1)[0]} {'no' if i % 2 else 'yes'} y") for i, t in items]
    want = expected(rows, items)
    assert len(want) == 300
    assert found(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")) == want


def test_blocks_of_fingerprints_within_the_radius_meet():
    rng = random.Random(2)
    for _ in range(300):
        a = rng.getrandbits(64)
        b = a
        for bit in rng.sample(range(64), decontaminate.RADIUS):
            b ^= 1 << bit
        assert set(decontaminate._blocks(a)) & set(decontaminate._blocks(b))
    assert sum(w.bit_length() for _, w in decontaminate._blocks(2**64 - 1)) == 64


def test_simhash_is_the_sign_of_weighted_votes():
    shingle_hashes = np.array([0b1011, 0b0110, 0b0001], dtype=np.uint64)
    assert decontaminate.simhash(shingle_hashes, np.array([1.0, 1.5, 1.0])) & 0b1111 == 0b0011


def test_defined_results(spark):
    items = [(1, "Alpha beta gamma delta epsilon zeta"), (2, None), (3, ""), (4, "one two"), (5, "one TWO!"), (6, "***"), (None, "null id item here now")]
    rows = [
        (1, None), (2, ""), (3, "x alpha, BETA gamma&&& delta epsilon zeta."), (3, "x alpha, BETA gamma&&& delta epsilon zeta."), (4, "one two"), (None, "one two"),
        (5, "alpha beta gamma delta epsilon"), (6, "w " * 30_000 + "one two"), (7, "one"), (8, "null id item here now"),
    ]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("item_id", F.lit("x")).withColumn("leak", F.lit(0))
    got = sorted(((r["doc_id"], r["item_id"], r["first_word"]) for r in decontaminate.leak_report(docs, benchmark).collect()), key=repr)
    want = [(3, 1, 1), (3, 1, 1), (4, 4, 0), (4, 5, 0), (None, 4, 0), (None, 5, 0), (6, 4, 30_000), (6, 5, 30_000), (8, None, 0)]
    assert got == sorted(want, key=repr)
    assert decontaminate.decontaminate(docs, benchmark).count() == 4
    assert decontaminate.decontaminate(docs, benchmark.limit(0)).count() == len(rows)
    assert decontaminate.leak_report(docs.limit(0), benchmark).count() == 0


@pytest.mark.parametrize("block", [1, 3])
def test_a_large_benchmark_is_searched_in_blocks(spark, monkeypatch, block):
    monkeypatch.setattr(decontaminate, "BLOCK", block)
    items = [(i, f"a{i} b{i} c{i} d{i} e{i} f{i}") for i in range(4)]
    docs = spark.createDataFrame([(9, " ".join(t for _, t in items))], "doc_id long, text string")
    got = found(docs, spark.createDataFrame(items, "item_id long, text string"))
    assert [(r[1], r[3]) for r in got] == [(0, 0), (1, 6), (2, 12), (3, 18)]


def test_similarities_do_not_depend_on_the_blocks(spark, monkeypatch):
    """A common end that fills one block weighs the same in every block."""
    rng = random.Random(6)
    items = [(i, " ".join([f"w{rng.randrange(9999)}" for _ in range(20)] + (["end", "of", "all", "such", "items", "here"] if i < 5 else []))) for i in range(10)]
    rows = [(i, " ".join([*t.split()[1:], "new"])) for i, t in items] + [(20 + i, "new " + " ".join(t.split()[1:])) for i, t in items]
    docs, benchmark = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    want = expected(rows, items)
    assert len(want) >= 10 and found(docs, benchmark) == want
    monkeypatch.setattr(decontaminate, "BLOCK", 3)
    assert found(docs, benchmark) == want


def test_items_without_an_id_or_with_the_same(spark, monkeypatch):
    items = [(None, "a1 b1 c1 d1 e1 f1"), (3, "a2 b2 c2 d2 e2 f2"), (3, "a3 b3 c3 d3 e3 f3"), (3, "a2 b2 c2 d2 e2 f2"), (5, "a4 b4 c4 d4 e4 f4")]
    text = " ".join(t for _, t in items)
    docs = spark.createDataFrame([(9, text), (9, text), (None, items[2][1])], "doc_id long, text string")
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    want = [(9, None, 0), (9, 3, 6), (9, 5, 24)] * 2 + [(None, 3, 0)]
    for block in (decontaminate.BLOCK, 3, 1):
        monkeypatch.setattr(decontaminate, "BLOCK", block)
        got = decontaminate.leak_report(docs, benchmark).collect()
        assert sorted(((r["doc_id"], r["item_id"], r["first_word"]) for r in got), key=repr) == sorted(want, key=repr)


def test_broadcast_weights_are_plain_arrays(spark, monkeypatch):
    """Tasks may lack this module, and broadcast values are pickled by name."""
    sent = []
    context = type(spark.sparkContext)
    real = context.broadcast
    monkeypatch.setattr(context, "broadcast", lambda self, value: (sent.append(value), real(self, value))[1])
    docs = spark.createDataFrame([(1, "a b c d e f")], "doc_id long, text string")
    decontaminate.leak_report(docs, spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")).collect()
    values = [value for value in sent if not isinstance(value, bytes)]  # bytes are functions, which travel with their code
    assert len(values) == 2 and all(b"martloom" not in pickle.dumps(value) for value in values)
