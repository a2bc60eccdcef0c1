"""The pipeline against brute force, stage by stage, each on what its predecessor kept."""

from __future__ import annotations

from collections import Counter

import brute
import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from martloom.llm import quality
from test_decontaminate import expected as leaks

SAMPLE = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def rows_of(df):
    return [tuple(r) for r in df.select(*COLUMNS).collect()]


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{SAMPLE}/documents.parquet")
    out = [docs]
    for _, stage in corpus_pipeline.STAGES:
        out.append(stage(spark, out[-1], SAMPLE).cache())
    return out


def test_stages_and_columns(stages):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "near_dups", "substrings", "benchmark", "mixing"]
    assert all(df.columns == COLUMNS for df in stages)


def test_quality(spark, stages):
    labels = spark.read.parquet(f"{SAMPLE}/labels.parquet")
    model = quality.learn(stages[0], labels)
    scorer = quality.Scorer(model)
    expected = [r for r in rows_of(stages[0]) if scorer.score(r[1]) >= model["thresholds"][0]]
    assert sorted(rows_of(stages[1])) == sorted(expected) and len(expected) > 100


def test_near_duplicates(stages):
    rows = rows_of(stages[1])
    component = brute.near_duplicates([r[:2] for r in rows], 5, 80)
    assert sorted(rows_of(stages[2])) == sorted(r for r, (d, _, c) in zip(rows, component) if d == c)


def test_substrings(stages):
    rows, want = rows_of(stages[2]), []
    for r, (words, kept) in zip(rows, brute.kept_words([r[1] for r in rows], 35)):
        text = r[1] if len(words) == len(kept) else " ".join(kept)
        want.append((r[0], text, r[2], r[3], r[4] if text is r[1] else len(text)))
    assert sorted(rows_of(stages[3])) == sorted(want)


def test_benchmark(spark, stages):
    items = [tuple(r) for r in spark.read.parquet(f"{SAMPLE}/benchmark.parquet").select("item_id", "text").collect()]
    rows = rows_of(stages[3])
    dirty = {r[0] for r in leaks([r[:2] for r in rows], items)}
    assert dirty and sorted(rows_of(stages[4])) == sorted(r for r in rows if r[0] not in dirty)


def test_mixing_and_run(spark, stages):
    rows, sizes = rows_of(stages[4]), Counter()
    for r in rows:
        sizes[r[3]] += len(brute.words(r[1]))
    target = brute.targets(dict(sizes), corpus_pipeline.SOURCE_WEIGHTS)
    want = Counter({r: brute.copies(r[0], 0, sizes[r[3]], target[r[3]]) for r in rows})
    assert Counter(rows_of(stages[5])) == +want
    assert Counter(rows_of(corpus_pipeline.run(spark, SAMPLE))) == +want


def test_odd_rows_pass_all_stages(spark):
    rows = [(1, None, None, None, None), (1, None, None, None, None), (None, "a b c", "en", "s", 5), (2, "", "de", "s", 0), (3, "word " * 20_000, "en", None, 100_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").withColumn("score", F.lit("x"))
    for df in (docs, docs.limit(0)):
        for _, stage in corpus_pipeline.STAGES:
            df = stage(spark, df, SAMPLE)
            assert df.columns == docs.columns
        assert df.count() <= 2 * len(rows)
