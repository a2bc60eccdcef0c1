from __future__ import annotations

import brute
from pyspark.sql import functions as F

from martloom.llm import licenses
from martloom.llm.queries import LICENSES

SAMPLE = "/root/testdata/sf0.01"


def matches(words, t, share=0.8):
    """Start -> share of the template's words, every start tried, of starts within the slack the best."""
    shifts = range(-t.slack, t.slack + 1)
    same = lambda at, k: 0 <= at < len(words) and words[at] == t.words[k]
    accepted = {}
    if not {t.words[k] for k in t.mandatory_places()} <= set(words):
        return accepted
    for start in range(len(words)):
        if all(any(all(same(start + k + d, k) for k in ks) for d in shifts) for ks in t.phrase_places()):
            hits = sum(any(same(start + k + d, k) for d in shifts) for k in range(len(t.words)))
            if hits >= len(t.words) - t.may_miss(share):
                accepted[start] = hits / len(t.words)
    rank = lambda s: (-accepted[s], s)
    return {s: h for s, h in accepted.items() if not any(o != s and o in accepted and rank(o) < rank(s) for o in range(s - t.slack, s + t.slack + 1))}


def expected(text):
    w = brute.plain_words(text)
    found = [(t.label, t.base, start, share) for t in LICENSES for start, share in matches(w, t).items()]
    base = [f for f in found if f[1]]
    return (
        len(w), len(base), min((f[2] for f in base), default=None), max((f[2] for f in base), default=None),
        ",".join(sorted({f[0] for f in base})), ",".join(sorted({f[0] for f in found})), max((f[3] for f in found), default=0.0),
    )


def check(docs):
    got = sorted(((r["doc_id"], *tuple(r)[1:]) for r in licenses.license_report(docs, LICENSES).collect()), key=repr)
    assert got == sorted(((d, *expected(t)) for d, t in docs.select("doc_id", "text").collect()), key=repr)
    return got


def test_sample(spark):
    got = check(spark.read.parquet(f"{SAMPLE}/documents.parquet"))
    assert sum(r[2] for r in got) > 10


def test_defined_results_and_templates(spark):
    grant = next(t for t in LICENSES if t.label == "mit-text").text
    rows = [
        (1, None), (2, ""), (2, ""), (3, "!!!"), (4, "MIT License mit LICENSE, mit-license; the MIT\nLicensed"), (5, "gnu general gnu general public license"),
        (6, "x " + grant.upper()), (7, grant.replace("any person", "all people")), (8, grant.replace("hereby", "now")), (9, "license"),
        (10, "cc by nc 4 0 under cc by"), (11, "word " * 30_000 + "Apache License"), (None, "released under the mit license"),
        (12, "licensed under the apache license version 2 0"), (13, "é cc\x7fby"), (14, "apache"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("words", F.lit(1)).withColumn("labels", F.lit("x"))
    got = {r[0]: r for r in check(docs)}
    assert "mit-text" in got[6][6] and "mit-text" in got[7][6] and "mit-text" not in got[8][6]


def test_paragraphs_with_words_put_in_left_out_or_repeated(spark):
    rows, labels = [], []
    for t in licenses.PARAGRAPHS:
        w = t.words
        at = max(t.mandatory_places()) + 1 if max(t.mandatory_places()) + 1 < len(w) else min(t.mandatory_places())
        for changed in (w, ["x", *w, "y"], w[:at] + ["new"] + w[at:], w[:at] + ["one", "more"] + w[at:], w[1:], w[:3] + w[4:] if 3 not in t.mandatory_places() else w, w * 20):
            rows.append((len(rows), " ".join(changed)))
            labels.append(t.label)
    check(docs := spark.createDataFrame(rows, "doc_id long, text string"))
    got = {r["doc_id"]: r["labels"].split(",") for r in licenses.license_report(docs, LICENSES).collect()}
    assert sum(label in got[i] for i, label in enumerate(labels)) >= 0.95 * len(labels)
    versions = {label: got[i] for i, label in enumerate(labels) if i % 7 == 0}
    assert "gpl-2.0-text" not in versions["gpl-3.0-text"] and "gpl-3.0-text" not in versions["agpl-3.0-text"]


def test_texts_without_a_base_phrase_get_labels(spark):
    got = licenses.license_report(spark.read.parquet(f"{SAMPLE}/documents.parquet"), LICENSES)
    assert got.filter("base_labels = '' AND labels = 'all-rights-reserved'").count() > 3


def test_empty_table(spark):
    assert licenses.license_report(spark.createDataFrame([], "doc_id long, text string"), LICENSES).count() == 0


def test_index_holds_the_rarest_words_and_one_more_than_may_be_missed():
    frequencies = {w: i for i, w in enumerate(sorted({w for t in LICENSES for w in t.words}))}
    index = licenses.rare_index(LICENSES, frequencies, 0.8)
    for number, t in enumerate(LICENSES):
        places = [k for entries in index.values() for n, k in entries if n == number]
        assert len(places) == t.may_miss(0.8) + 1
        assert max(frequencies[t.words[k]] for k in places) <= min([frequencies[t.words[k]] for k in range(len(t.words)) if k not in places], default=10**9)
