from __future__ import annotations

import random
import re
from collections import Counter

import brute
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from martloom.llm import collocations as co
from martloom.llm.automata import Automaton, Trie


def plain(rows, least, covered, top):
    """rows: (lang, text). The contract, with counters of all n-grams."""
    counts: dict[str, Counter] = {}
    for lang, text in rows:
        held = counts.setdefault("und" if lang is None else lang, Counter())
        for piece in re.split(r"[.,;:!?\n-\r]", (text or "").translate(brute.LOWER)):
            w = re.findall(r"[^ \t]+", piece)
            for n in range(1, 5):
                held.update(tuple(w[i : i + n]) for i in range(len(w) - n + 1))
    out = []
    for lang, held in counts.items():
        n = sum(f for s, f in held.items() if len(s) == 1)
        phrases = {s: f for s, f in held.items() if len(s) > 1 and f >= least}
        scored = []
        for s, a in phrases.items():
            inside = lambda t: any(t[i : i + len(s)] == s for i in range(len(t) - len(s) + 1))  # noqa: B023, E731
            if any(len(t) > len(s) and 100 * f >= covered * a and inside(t) for t, f in phrases.items()):
                continue
            score, _, l, r = min((2_000_000 * a // (held[s[:k]] + held[s[k:]]), k, held[s[:k]], held[s[k:]]) for k in range(1, len(s)))
            scored.append((-score, -a, " ".join(s).encode(), l, r))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, n, -score))
    return sorted(out)


def texts(seed, n, words):
    rng = random.Random(seed)
    vocabulary = [rng.choice(["é", "x", "漢", "W"]) + str(i) for i in range(words)]
    fixed = [" ".join(rng.choices(vocabulary, k=rng.randint(2, 5))) for _ in range(6)]
    rows = []
    for i in range(n):
        parts = [rng.choice(fixed) if rng.random() < 0.4 else rng.choice(vocabulary[: 3 + i % words]) for _ in range(rng.randint(0, 40))]
        rows.append((rng.choice(["en", "en", "de", None, "und", ""]), "".join(p + rng.choice([" ", " ", "  ", "\t", ". ", ",", "\n", "\r\n", " ! "]) for p in parts)))
    return rows


def mined(spark, rows, least=3, covered=80, top=2000, parts=3):
    docs = spark.createDataFrame(rows, "lang string, text string").withColumn("phrase", F.lit("x")).withColumn("n", F.lit(1))
    return sorted(tuple(r) for r in co.collocations(docs.repartition(parts), least, covered, top).collect())


@pytest.mark.parametrize(("seed", "least", "covered", "top"), [(1, 3, 80, 2000), (2, 2, 50, 7), (3, 5, 100, 40)])
def test_against_counters(spark, seed, least, covered, top, monkeypatch):
    monkeypatch.setattr(co, "RUN_BYTES", 700)
    monkeypatch.setattr(co, "HELD_ARCS", 200)
    rows = texts(seed, 150, 25) + [("en", None), (None, ""), ("en", "..."), ("fr", "solo"), ("en", "the the the the " * 300), ("en", "copy of one line " * 3)] + [("en", "copy of one")] * 80
    got = mined(spark, rows, least, covered, top)
    assert got == plain(rows, least, covered, top)
    assert len(got) > 10


def test_many_ranges_and_a_full_filter(spark, monkeypatch):
    monkeypatch.setattr(co, "FILTER_BITS", 64)
    monkeypatch.setattr(co, "RANGE_CHARS", 200)
    rows = texts(4, 120, 12)
    assert mined(spark, rows) == plain(rows, 3, 80, 2000)


def test_defined_results(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(None, None), ("en", "a b")]) == []
    rows = [("en", "A\x0bb a b"), ("en", "a b \x01 ſ K"), (None, "Ab c"), ("und", "ab C"), ("en", "x" * 200_000 + " y"), ("en", "x" * 200_000 + " y")]
    assert mined(spark, rows, least=2) == plain(rows, 2, 80, 2000)
    assert ("und", 1, "ab c", 2, 2, 2, 4, 1_000_000) in mined(spark, rows, least=2)


def test_scores_beyond_64_bits(spark, monkeypatch):
    huge = 4_000_000_000_000_000
    cuts = spark.createDataFrame([("en", "a b", huge, 0, [(1, huge + 7, huge + 1)])], "lang string, phrase string, a long, cover long, cuts array<struct<k: int, l: bigint, r: bigint>>")
    totals = spark.createDataFrame([("en", 9 * huge)], "lang string, n long")
    monkeypatch.setattr(co, "phrase_cuts", lambda documents, least: (cuts, totals))
    row = co.collocations(cuts).first()
    assert row["score"] == 2_000_000 * huge // (2 * huge + 8)


SEQUENCES = st.dictionaries(st.lists(st.sampled_from([b"a", b"b", b"c", "é".encode(), b"aa"]), min_size=1, max_size=4).map(tuple), st.integers(1, 5), max_size=40)


def weights_of(trie):
    out = {}
    for depth in range(len(trie.labels)):
        for labels, w in zip(zip(*[c.tolist() for c in trie.sequences(depth)]), trie.weights[depth].tolist()):
            if w:
                out[tuple(trie.words[i] for i in labels)] = w
    return out


def trie_of(counts):
    return Trie.of([list(s) for s in counts], np.array(list(counts.values()), dtype=np.int64))


@settings(max_examples=80, deadline=None)
@given(st.lists(SEQUENCES, min_size=1, max_size=4), st.lists(st.lists(st.sampled_from([b"a", b"b", b"bb", b"c", b"zz"]), min_size=1, max_size=4), max_size=4))
def test_automata(shards, boundaries):
    shards = [s for s in shards if s]
    automata = [Automaton.from_bytes(trie_of(s).minimal().to_bytes()) for s in shards]
    united = Trie.union(automata)
    total = sum((Counter(s) for s in shards), Counter())
    assert weights_of(united) == dict(total)
    asked = [list(s) for s in total] + [[b"q"], [b"a", b"q"], [b"a", b"a", b"a", b"a", b"a"]]
    assert united.look_up(asked).tolist() == [total[tuple(s)] for s in asked]
    boundaries = sorted(boundaries)
    if shards:
        parts = {}
        for number, part in united.cut(boundaries):
            for s, w in weights_of(Trie.union([part.minimal()])).items():
                assert s not in parts
                parts[s] = (number, w)
        assert parts == {s: (sum(tuple(b) <= s for b in boundaries), w) for s, w in total.items()}


def test_equal_states_are_one():
    counts = {(x, b"of", y): 1 for x in (b"a", b"b", b"c") for y in (b"p", b"q")}
    automaton = trie_of(counts).minimal()
    assert [len(lv.label) for lv in automaton.levels] == [3, 1, 2]
