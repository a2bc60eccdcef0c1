from __future__ import annotations

import re
from dataclasses import replace
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from martloom.llm import secret_ledger
from martloom.llm.queries import BASE_SECRETS, SECRETS, op12_secret_scan
from martloom.llm.secret_ledger import BlobLedger, Rule

SAMPLE = "/root/testdata/sf0.01"


def any_case(word):
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


ASSIGN = "|".join(any_case(w) for w in ("password", "passwd", "secret", "token")) + "|" + any_case("api") + "_?" + any_case("key")
PLAIN = {
    "assign": (rf"""({ASSIGN})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    "access": (r"AKIA[A-Z0-9]+", 0, 20),
    "hex": (r"[0-9a-f]+", 0, 24),
}


def base(text):
    found = []
    for place, (kind, (pattern, group, least)) in enumerate(PLAIN.items()):
        found += [(m.start(), place, m.end(), kind) for m in re.finditer(pattern, text or "") if len(m.group(group)) >= least]
    return sorted(found)


def expected(doc_id, text):
    found = base(text)
    counts = [sum(f[3] == kind for f in found) for kind in PLAIN]
    return (doc_id, *counts, sha256(",".join(f"{k}:{s}:{e}" for s, _, e, k in found).encode()).hexdigest())


def report(spark, docs, folder, rules=SECRETS):
    ledger = BlobLedger(spark, str(folder), rules, ["doc_id"])
    ledger.ingest(docs)
    return secret_ledger.secret_report(ledger.findings(), BASE_SECRETS, rules).collect()


def check(rows, got):
    assert sorted((tuple(r)[:5] for r in got), key=repr) == sorted((expected(*r) for r in rows), key=repr)
    by_text = {r[0]: r[1] for r in rows}
    for r in got:
        spans = [x.rsplit(":", 2) for x in r["spans"].split(",") if x]
        held = [(int(s), int(e), k) for k, s, e in spans if k in PLAIN]
        if list(by_text).count(r["doc_id"]) == 1 and r["doc_id"] is not None:
            assert held == [(s, e, k) for s, _, e, k in base(by_text[r["doc_id"]])]


def test_sample(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SAMPLE}/documents.parquet").select("doc_id", "text").collect()]
    got = op12_secret_scan(spark, SAMPLE).collect()
    check(rows, got)
    assert sum(r["n_assign"] for r in got) > 5


def test_defined_results(spark, tmp_path):
    texts = [
        None, "", "password=abcdef", "PassWord : 'abc'", "secret=token: abcdefgh", "api_key='x'; APIKEY=\"a.b-c_d=e\"", "AKIA" + "X" * 16, "AKIA" + "X" * 15,
        "xAKIAAKIA" + "0" * 14, "f" * 24, "f" * 23 + "g" + "0" * 30, "é😀 token = abcdef0123456789abcdef0123", "ſecret=abcdefgh toKen=abcdefgh", "token" * 4_000 + "=" + "a" * 9_000,
        "token=\ttab", "passwd\"  =  \"long/enough+value", "z" * 300_000 + " secret:aaaaaa", "ghp_" + "A1" * 20, "https://bob:hunter2@host/x", "-----BEGIN RSA PRIVATE KEY-----",
        "Authorization: Bearer abcdefghijklmnopqrst", "api key=abcdef", "apikeytoken=secret=",
    ]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "password=abcdef"), (None, None), (2, "password=abcdef"), (3, "other"), (99, "password=abcdef")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("blob", F.lit(1)).withColumn("spans", F.lit("x"))
    got = report(spark, docs.repartition(4), tmp_path / "ledger")
    check(rows, got)
    kinds = {x.split(":")[0] for r in got for x in r["spans"].split(",") if x}
    assert {"github", "login", "pem", "bearer"} <= kinds
    row = next(r for r in got if r["doc_id"] == 11)
    assert row["spans"] == f"assign:3:{len(texts[11])},hex:11:{len(texts[11])}"


def test_empty_table(spark, tmp_path):
    assert report(spark, spark.createDataFrame([], "doc_id long, text string"), tmp_path / "ledger") == []


def test_only_unread_blobs_and_changed_rules_are_scanned(spark, tmp_path):
    folder = str(tmp_path / "ledger")
    schema = "path string, version int, text string"
    rules = [Rule("digits", r"\d{4,}"), Rule("word", r"key\w+")]
    ledger = BlobLedger(spark, folder, rules, ["path", "version"])
    ledger.ingest(spark.createDataFrame([("a", 1, "keyring 1234"), ("b", 1, "keyring 1234"), ("c", 1, "none")], schema))
    assert sorted(tuple(r["rules"]) for r in ledger.scans().collect()) == [("digits@1", "word@1")] * 2
    ledger.ingest(spark.createDataFrame([("a", 2, "none"), ("d", 1, "keys 77777"), ("e", 1, "keys 77777")], schema))
    assert ledger.scans().count() == 3  # one new blob
    found = {(r["path"], r["version"]): sorted((s["rule"], s["start"], s["end"]) for s in r["spans"]) for r in ledger.findings().collect()}
    assert found["a", 1] == found["b", 1] == [("digits@1", 8, 12), ("word@1", 0, 7)] and found["a", 2] == [] and len(found) == 6
    # a rule in a new version reads every blob that comes along again, the unchanged rule none
    newer = BlobLedger(spark, folder, [replace(rules[0], pattern=r"\d{5,}", version=2), rules[1]], ["path", "version"])
    newer.ingest(spark.createDataFrame([("a", 3, "keyring 1234"), ("d", 2, "keys 77777")], schema))
    assert sorted(tuple(r["rules"]) for r in newer.scans().collect())[:2] == [("digits@1", "word@1")] * 2
    assert sum(tuple(r["rules"]) == ("digits@2",) for r in newer.scans().collect()) == 2
    found = {(r["path"], r["version"]): {s["rule"] for s in r["spans"]} for r in newer.findings().collect()}
    assert found["a", 3] == {"word@1"} and found["e", 1] == {"digits@2", "word@1"}


def test_many_new_blobs_go_by_a_join(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(secret_ledger, "FEW", 2)
    rows = [(i, f"token=value{i % 7}") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    ledger = BlobLedger(spark, str(tmp_path / "ledger"), SECRETS, ["doc_id"])
    ledger.ingest(docs)
    assert ledger.scans().count() == 7
    check(rows, secret_ledger.secret_report(ledger.findings(), BASE_SECRETS, SECRETS).collect())


def test_a_failed_run_is_no_commit(spark, tmp_path, monkeypatch):
    folder = str(tmp_path / "ledger")
    ledger = BlobLedger(spark, folder, SECRETS, ["doc_id"])
    docs = spark.createDataFrame([(1, "token=abcdef")], "doc_id long, text string")
    monkeypatch.setattr(secret_ledger, "replace_text", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        ledger.ingest(docs)
    monkeypatch.undo()
    assert ledger.scans().count() == 0
    ledger.ingest(docs)
    assert ledger.scans().count() == 1 and ledger.findings().count() == 1
