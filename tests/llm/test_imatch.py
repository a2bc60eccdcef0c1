from __future__ import annotations

import hashlib
import random
from collections import Counter

import pytest
from brute import WORD
from pyspark.sql import functions as F

from martloom.llm import imatch

SAMPLE = "/root/testdata/sf0.001"


def edited(rows):
    """doc_id -> (n_chars, edited text)."""
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] or ""))
    out = []
    for i, (doc_id, text) in enumerate(order):
        text, follower = text or "", order[(i + 1) % len(order)][1] or ""
        half = len(text) // 2
        out.append((doc_id, len(text), text[: len(text) - half] + follower[:half]))
    return out


def checked(rows, got):
    expected = sorted(((d, n, hashlib.sha256(t.encode()).hexdigest()) for d, n, t in edited(rows)), key=repr)
    assert sorted(((r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in got), key=repr) == expected
    assert all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in got)


@pytest.fixture(scope="module")
def sample(spark):
    docs = spark.read.parquet(f"{SAMPLE}/documents.parquet").select("doc_id", "text")
    return [tuple(r) for r in docs.collect()], imatch.imatch_report(docs).collect()


def test_edited_texts_of_the_sample(sample):
    checked(*sample)


def test_equal_texts_have_equal_fingerprints_and_half_edits_are_nearer_than_neighbours(sample):
    rows, got = sample
    text = dict(rows)
    prints = {}
    for r in got:
        assert prints.setdefault(text[r["doc_id"]], r["fingerprint"]) == r["fingerprint"]
    assert sum(r["near_edited"] for r in got) > 3 * sum(r["near_next"] for r in got)
    assert sum(r["near_edited"] for r in got) > 0.2 * len(got)


def test_lexicon_is_the_band_of_all_documents(spark):
    docs = spark.read.parquet(f"{SAMPLE}/documents.parquet")
    counts = Counter()
    for (text,) in docs.select("text").collect():
        counts.update(set(WORD.findall(text.lower())))
    expected = [w for w, n in counts.items() if 0.02 * 200 <= n <= 0.3 * 200]
    hashed = spark.createDataFrame([(w,) for w in expected], "w string").select(F.xxhash64("w").alias("term"))
    got = imatch.lexicon(docs, 0.02, 0.3)
    assert got.count() == len(expected) and got.join(hashed, "term").count() == len(expected)


def smallest_lexicons(terms, families):
    """Per family, the terms that share the most first bits with its number, by trying every length of prefix."""
    out = []
    for number in imatch.numbers(families):
        inside = sorted(terms)
        for j in range(1, 64):
            fewer = [t for t in inside if (t % 2**63) >> (63 - j) == number >> (63 - j)]
            inside = fewer or inside
            if not fewer:
                break
        out.append(sorted((t ^ number) % 2**63 for t in inside))
    return out


def test_marks_are_of_the_smallest_lexicon_with_a_term(spark):
    rng = random.Random(7)
    sets = [[], [5], *([rng.randrange(-(2**63), 2**63) for _ in range(n)] for n in (2, 30, 400))]
    shuffled = [rng.sample(s, len(s)) for s in sets]
    df = spark.createDataFrame([(s, *smallest_lexicons(s, 3)) for s in shuffled], "t array<long>, a array<long>, b array<long>, c array<long>")
    got = df.select(imatch.marks_of(F.col("t"), 3).alias("got"), F.array(*map(F.xxhash64, "abc")).alias("expected")).collect()
    assert all(r["got"] == r["expected"] for r in got) and got[0]["got"] == [imatch.NO_TERM] * 3
    assert len({r["got"][0] for r in got}) == len(got)
    like = df.select(imatch.likeness(F.array(F.lit(42), F.lit(1), F.lit(2)), F.array(F.lit(42), F.lit(1), F.lit(3)))).first()[0]
    assert like == 0.5


def test_the_report_is_i_match_by_brute_force(spark):
    """All fingerprints and likenesses of a small table, from plain Python sets."""
    rng = random.Random(11)
    rows = [(i, " ".join(f"w{int(rng.paretovariate(0.5)) % 300}" for _ in range(rng.randrange(0, 60)))) for i in range(120)]
    got = {r["doc_id"]: r for r in imatch.imatch_report(spark.createDataFrame(rows, "doc_id long, text string"), 0.02, 0.3).collect()}
    changed = {d: t for d, _, t in edited(rows)}
    terms = {k: {d: set(WORD.findall(t.lower())) for d, t in texts.items()} for k, texts in (("own", dict(rows)), ("edited", changed))}
    counts = Counter(w for found in terms["own"].values() for w in found)
    band = {w for w, n in counts.items() if 0.02 * 120 <= n <= 0.3 * 120}
    words = sorted(set().union(*terms["own"].values(), *terms["edited"].values()))
    of = dict(spark.createDataFrame([(w,) for w in words], "w string").select("w", F.xxhash64("w")).collect())
    sets = []
    for kind in ("own", "edited"):
        for d, found in terms[kind].items():
            used = found & band
            if len(used) * imatch.FEW < len(found) or not used:
                used = found
            sets.append((kind, d, smallest_lexicons([of[w] for w in used], imatch.FAMILIES)))
    marks = spark.createDataFrame(sets, "kind string, d long, s array<array<long>>").select("kind", "d", F.transform("s", lambda x: F.xxhash64(x)))
    marks = {(kind, d): m for kind, d, m in marks.collect()}

    def near(a, b):
        either = sum(x != imatch.NO_TERM or y != imatch.NO_TERM for x, y in zip(a, b))
        return sum(x == y != imatch.NO_TERM for x, y in zip(a, b)) / max(either, 1)

    for d, _ in rows:
        assert got[d]["fingerprint"] == "-".join(f"{m % 2**64:X}" for m in marks["own", d])
        assert got[d]["edited_fingerprint"] == "-".join(f"{m % 2**64:X}" for m in marks["edited", d])
        assert got[d]["near_edited"] == near(marks["own", d], marks["edited", d])
        assert got[d]["near_next"] == near(marks["own", d], marks["own", (d - 1) % 120])


def test_a_large_lexicon_is_joined_with_equal_results(spark, sample, monkeypatch):
    monkeypatch.setattr(imatch, "BROADCAST", 0)
    docs = spark.read.parquet(f"{SAMPLE}/documents.parquet").select("doc_id", "text")
    assert sorted(imatch.imatch_report(docs).collect()) == sorted(sample[1])


def test_defined_results(spark):
    rows = [(5, "a b c"), (4, None), (4, ""), (3, "ééé öö\n" * 9), (None, "z z z"), (2, "word " * 30_000), (5, "a b c"), (1, "q"), (7, "🙂🙂 x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("range", F.lit("r")).withColumn("row", F.lit(1))
    got = imatch.imatch_report(docs).collect()
    checked(rows, got)
    assert len({r["fingerprint"] for r in got if r["doc_id"] == 5}) == 1


@pytest.mark.parametrize("rows", [[], [(1, "only one text")], [(None, "a"), (None, "b")]])
def test_small_tables(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    checked(rows, imatch.imatch_report(docs).collect()) if rows else None
    assert imatch.imatch_report(docs).count() == len(rows)


def nearness(spark, rows, of):
    """Mean likeness of neighbouring documents of a group, and the fingerprints by id."""
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = imatch.imatch_report(docs, min_share=0.005).collect()
    checked(rows, got)
    near = [r["near_next"] for r in got if r["doc_id"] in of and r["doc_id"] - 1 in of]
    return sum(near) / len(near)


def others(rng, n):
    return [" ".join(f"w{int(rng.paretovariate(0.6)) % 2000}" for _ in range(120)) for _ in range(n)]


@pytest.mark.parametrize("new", ["n{i}", "w{k}"])
def test_a_third_of_the_rows_are_near_copies(spark, new):
    """Copies with one word changed, into a word of no other row or into one of the band."""
    rng = random.Random(3)
    first = [f"c{k}" for k in range(100)]
    texts = others(rng, 400)
    for i in range(200):
        at = rng.randrange(100)
        texts.append(" ".join(first[:at] + [new.format(i=i, k=rng.randrange(5, 60))] + first[at + 1 :]))
    assert nearness(spark, list(enumerate(texts)), range(400, 600)) > 0.6


def test_a_language_of_a_few_rows(spark):
    rng = random.Random(5)
    texts = others(rng, 600)
    first = [f"ö{k}" for k in range(100)]
    texts += [" ".join(first), " ".join([*first[:50], "ü", *first[51:]])]
    assert nearness(spark, list(enumerate(texts)), range(600, 602)) > 0.6
    assert nearness(spark, list(enumerate(texts)), range(300)) < 0.2
