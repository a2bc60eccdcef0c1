"""Language, quality and toxicity: gradients, learned behaviour, held-out accuracy and defined results."""

from __future__ import annotations

import random
from zlib import crc32

import numpy as np
import pytest
from pyspark.sql import functions as F

from martloom.llm import langid, quality, toxicity
from martloom.llm.queries import queries
from martloom.llm.sampling import class_sample, held_out, row_sample

SAMPLE = "/root/testdata/sf0.1"


def test_fold_is_crc32_of_the_id_as_text(spark):
    df = spark.createDataFrame([(i,) for i in [*range(50), -7, None]], "doc_id long")
    for r in df.select("doc_id", held_out(F.col("doc_id")).alias("h")).collect():
        assert r["h"] == (r["doc_id"] is not None and crc32(str(r["doc_id"]).encode()) % 4 == 2)


def test_samples_are_bounded_and_repeatable(spark):
    rows = [(i, f"t{i}", "a" if i % 10 else "b") for i in range(100)] + [(None, "x", "a"), (200, None, "a"), (201, "y", None), (202, "z" * 99, "c")]
    df = spark.createDataFrame(rows, "doc_id long, text string, label string")
    got = class_sample(df, "label", 7, 50, 3)
    assert sorted(y for _, y in got) == ["a"] * 7 + ["b"] * 7
    assert got == class_sample(df.repartition(5), "label", 7, 50, 3)
    assert len(row_sample(df, "label", 20, 50, 3)) == 20 and len(row_sample(df, "label", 500, 50, 3)) == 100
    assert row_sample(df.limit(0), "label", 5, 50, 3) == []


def test_one_id_on_most_rows_keeps_the_bound(spark):
    rows = [(7, f"t{i}", "a") for i in range(3_000)] + [(7, "same", "a")] * 500 + [(i, f"u{i}", "b") for i in range(20)]
    df = spark.createDataFrame(rows, "doc_id long, text string, label string")
    for seed in range(4):
        assert len(row_sample(df, "label", 12, 50, seed)) <= 12
        got = class_sample(df, "label", 12, 50, seed)
        assert sum(y == "a" for _, y in got) <= 12 and sum(y == "b" for _, y in got) == 12


# language


def test_gradients_are_those_of_the_loss():
    rng = np.random.default_rng(0)
    h, langs = 3, 3
    model = {
        "in_f": rng.normal(0, 0.5, (256, 3 * h)), "rec_f": rng.normal(0, 0.5, (h, 3 * h)), "in_b": rng.normal(0, 0.5, (256, 3 * h)),
        "rec_b": rng.normal(0, 0.5, (h, 3 * h)), "out": rng.normal(0, 0.5, (2 * h, langs)), "bias": rng.normal(0, 0.5, langs),
    }
    codes = rng.integers(97, 101, (5, 4)).astype(np.uint8)
    labels = rng.integers(0, langs, 5)

    def loss():
        p = langid.position_labels(model, codes)
        return -np.log(p[:, np.arange(5), labels]).mean()

    grads = langid._gradients(model, codes, labels)
    for name, place in (("in_f", (98, 1)), ("in_f", (97, 5)), ("rec_f", (1, 2)), ("in_b", (99, 7)), ("rec_b", (2, 8)), ("out", (4, 1)), ("bias", (2,))):
        before, step = model[name][place], 1e-2
        model[name][place] = before + step
        high = loss()
        model[name][place] = before - step
        low = loss()
        model[name][place] = before
        assert grads[name][place] == pytest.approx((high - low) / (2 * step), rel=0.05, abs=2e-4)


def test_every_position_of_the_whole_text_counts():
    model = langid.train([("aaa aab " * 20, "x"), ("bbb bba " * 20, "y")], steps=60)
    labeller = langid.Labeller(model)
    assert langid.position_labels(model, np.frombuffer(b"aaab", dtype=np.uint8).reshape(1, -1)).shape == (4, 1, 2)
    tail = "aab " * 10 + "bba " * 4000
    (lang, score), (again, _) = labeller.pool([tail, "aab aaa"])
    assert (lang, again) == ("y", "x") and 0 < score <= 1
    direct = [langid.position_labels(model, np.frombuffer(p, dtype=np.uint8).reshape(1, -1))[:, 0] for p in langid.pieces("bba aab bba")]
    assert labeller.pool(["bba aab bba"])[0][1] == pytest.approx(float(np.concatenate(direct).mean(axis=0).max()), rel=1e-4)
    long_word = "b" * 100
    assert b"".join(langid.pieces(long_word)) == long_word.encode() and max(map(len, langid.pieces(long_word))) == langid.MAX_PIECE


def test_memory_may_run_full(monkeypatch):
    model = langid.train([("aaa aab " * 20, "x"), ("bbb bba " * 20, "y")], steps=30)
    texts = [f"a{i} b{i * 7}" for i in range(40)]
    whole = langid.Labeller(model).pool(texts)
    monkeypatch.setattr(langid, "REMEMBERED", 10)
    labeller = langid.Labeller(model)
    assert [labeller.pool([t])[0][0] for t in texts] == [a for a, _ in whole]


def test_held_out_accuracy_of_language(spark):
    truth = spark.read.parquet(f"{SAMPLE}/documents.parquet").select("doc_id", F.col("lang").alias("truth"))
    got = queries()["op2_language"](spark, SAMPLE).join(truth, "doc_id")
    right, n, rows = got.agg(F.sum(F.when(F.col("held_out") & (F.col("truth") == F.col("lang_pred")), 1)), F.sum(F.col("held_out").cast("int")), F.count("*")).first()
    assert rows == 10_000 and right / n > 0.98


def test_defined_results_of_language(spark):
    rows = [(1, None, "en"), (2, "", "en"), (3, "12 !! 3_4", None), (4, "the words", None), (4, "the words", None), (None, "le mot", "fr")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("score", F.lit("x"))
    nothing = {"langs": []} | {k: v for k, v in langid.train([]).items() if k != "langs"}
    assert {r["lang_pred"] for r in langid.identify(docs, nothing).collect()} == {"und"}
    model = langid.train([("the words of it", "en"), ("le mot que la", "fr")], steps=40)
    got = langid.identify(docs, model).collect()
    assert [r["lang_pred"] for r in got[:3]] == ["und"] * 3 and got[3] == got[4] and len(got) == 6
    assert all(r["lang_pred"] in ("en", "fr") and 0 <= r["score"] <= 1 for r in got[3:])
    assert langid.language_report(docs.limit(0)).count() == 0


# quality


def graded(seed, n):
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        g = rng.randrange(4)
        out.append((" ".join(rng.choice(["good"] * (1 + 3 * g) + ["bad"] * (10 - 3 * g) + ["of", "it"]) for _ in range(60)), g))
    return out


def test_grades_share_weights_and_have_ordered_thresholds():
    model = quality.train(graded(1, 400))
    assert model["grades"] == [0, 1, 2, 3] and (np.diff(model["thresholds"]) > 0).all()
    scorer = quality.Scorer(model)
    test = graded(2, 200)
    at = np.searchsorted(model["thresholds"], [scorer.score(t) for t, _ in test])
    assert (np.abs(at - [g for _, g in test]) <= 1).mean() > 0.97 and (at == [g for _, g in test]).mean() > 0.7


def test_scores_are_the_weighted_features():
    model = quality.train(graded(1, 50), rounds=20)
    for text in ("good good bad", "Új 12 THE!! the&&& x", " ", "of"):
        index, value = quality.features(text)
        assert quality.Scorer(model).score(text) == pytest.approx(float((model["weights"][index] * value).sum()))


def test_expected_grade_and_tail(spark):
    model = {"grades": [0, 1, 2], "weights": np.zeros(quality.DIMENSIONS), "thresholds": np.array([-1.0, 2.0])}
    docs = spark.createDataFrame([(1, "x"), (2, None)], "doc_id long, text string")
    tail = {k: 1 / (1 + np.exp(t)) for k, t in ((1, -1.0), (2, 2.0))}
    for r in quality.grade(docs, model, 2).select("__grade.*").collect():
        assert r["tail"] == pytest.approx(tail[2]) and r["expected_grade"] == pytest.approx(tail[1] + tail[2])


def test_held_out_quality(spark):
    marks = spark.read.parquet(f"{SAMPLE}/labels.parquet")
    got = queries()["op5_quality"](spark, SAMPLE).join(marks, "doc_id").filter("held_out").toPandas()
    assert (got.keep == (got.quality == 1)).mean() > 0.97
    assert got[got.quality == 1].keep.mean() > 0.985
    assert got.expected_grade.between(0, 2).all() and got["tail"].between(0, 1).all()


def test_defined_results_of_quality(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (3, "a b"), (3, "a b"), (None, "w " * 50_000)], "doc_id long, text string")
    docs = docs.withColumn("tail", F.lit("t")).withColumn("grade", F.lit(1)).withColumn("quality", F.lit(0))
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = quality.quality_report(docs, none).collect()
    assert len(got) == 5 and all(r["keep"] and r["tail"] == 1.0 and r["expected_grade"] == 0.0 for r in got)
    odd = spark.createDataFrame([(3, 1, None), (3, None, 1), (None, 0, 0), (1, 0, 0), (2, 0, 1)], "doc_id long, quality int, toxic int")
    kept = quality.keep_good(docs, odd)
    assert kept.columns == docs.columns and kept.count() <= 5
    assert quality.quality_report(docs.limit(0), odd).count() == 0


# toxicity


def pairs(seed, n):
    """Toxic exactly if an insult and a group stand together."""
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        words = [f"w{rng.randrange(30)}" for _ in range(12)]
        insult, group = rng.random() < 0.5, rng.random() < 0.5
        out.append((" ".join(words + ["insult"] * insult + ["group"] * group), int(insult and group)))
    return out


def test_pairs_of_terms_are_learned():
    model = toxicity.train(pairs(1, 800), rounds=200)
    scorer = toxicity.Scorer(model)
    test = pairs(2, 300)
    assert ((scorer.scores([t for t, _ in test]) >= 0.5) == [y == 1 for _, y in test]).mean() > 0.97
    i, g = (scorer.place[toxicity.word_terms(w)[0]] for w in ("insult", "group"))
    assert model["factors"][i] @ model["factors"][g] > 0.3


def test_linear_time_score_is_the_sum_over_pairs():
    model = toxicity.train(pairs(1, 300), rounds=40)
    scorer = toxicity.Scorer(model)
    for text, _ in pairs(3, 10):
        r = scorer.rows(text)
        v = model["factors"][r]
        brute = model["bias"] + model["weights"][r].sum() + sum(v[a] @ v[b] for a in range(len(r)) for b in range(a))
        assert toxicity.pair_score(model, [r])[0] == pytest.approx(brute)


def test_held_out_toxicity(spark):
    marks = spark.read.parquet(f"{SAMPLE}/labels.parquet")
    text = spark.read.parquet(f"{SAMPLE}/documents.parquet").select("doc_id", "text")
    got = queries()["op6_toxicity"](spark, SAMPLE).join(marks, "doc_id").join(text, "doc_id").filter("held_out").toPandas()
    insults = ["loser", "trash", "disgusting", "pathetic", "idiot", "worthless", "clown", "moron", "stupid", "scum"]
    clear = got.text.str.lower().apply(lambda t: sum(w in t for w in insults) >= 2)
    assert got[clear].predicted.mean() > 0.97
    assert got[got.toxic == 0].predicted.mean() < 0.02
    assert ((got.score >= 0.3) == (got.predicted == 1)).all()


def test_defined_results_of_toxicity(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (3, "a b"), (3, "a b"), (None, "w " * 50_000)], "doc_id long, text string")
    docs = docs.withColumn("score", F.lit("t")).withColumn("toxic", F.lit(1))
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = toxicity.toxicity_report(docs, none).collect()
    assert len(got) == 5 and all(r["score"] < 1e-9 and r["predicted"] == 0 for r in got)
    odd = spark.createDataFrame([(3, 1, None), (1, 0, 1), (2, 0, 0), (None, 1, 1)], "doc_id long, quality int, toxic int")
    assert all(0 <= r["score"] <= 1 for r in toxicity.toxicity_report(docs, odd).collect())
    assert toxicity.toxicity_report(docs.limit(0), odd).count() == 0
