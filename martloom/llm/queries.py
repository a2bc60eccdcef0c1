"""The registered queries of this package: each operator with its production parameters over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from martloom.llm import collocations, decontaminate, fim, imatch, langid, licenses, mixing, ngram_join, quality, secret_ledger, substrings, toxicity, urls
from martloom.operators.scratch import fresh_folder

URL_RULES = [
    urls.Rule(True, "org", "/"),
    urls.Rule(False, "example.org", "/es/"),
    urls.Rule(False, "example.org", "/en/1"),
    urls.Rule(True, "com", "/fr/"),
    urls.Rule(False, "com", "/de/"),
]
#: Hosts with such a label are listed, and hosts that mostly serve thin pages; the list holds the keys of their pages.
LISTED_HOST = r"(^|\.)ads-"
THIN_HOSTS = {"least_pages": 3, "least_chars": 900, "percent": 20}
SOURCE_WEIGHTS = [5, 2, 1]
LICENSES = [
    licenses.Template("gpl", "gnu general public license", base=True),
    licenses.Template("apache", "apache license", base=True),
    licenses.Template("cc-by", "cc by", base=True),
    licenses.Template("mit", "mit license", base=True),
    licenses.Template("gpl-3.0", "this work is licensed under the gnu general public license version 3", ("gnu general public license version 3",)),
    licenses.Template("apache-2.0", "licensed under the apache license version 2 0", ("apache license version 2 0",)),
    licenses.Template("cc-by-nc-4.0", "licensed under cc by nc 4 0", ("cc by nc",)),
    licenses.Template("mit-notice", "released under the mit license", ("mit license",)),
    licenses.Template("mpl-2.0", "subject to the terms of the mozilla public license v 2 0", ("mozilla public license",)),
    licenses.Template("all-rights-reserved", "all rights reserved", ("all rights reserved",)),
    *licenses.PARAGRAPHS,
]

BASE_SECRETS = [
    secret_ledger.Rule(
        "assign",
        r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        group=2,
        least=6,
        any_case=True,
        needles=("passw", "secret", "token", "api"),
    ),
    # runs are taken whole, so the least length may stand in the pattern
    secret_ledger.Rule("access", r"AKIA[A-Z0-9]{16,}", needles=("akia",)),
    secret_ledger.Rule("hex", r"(?<![0-9a-f])[0-9a-f]{24,}"),
]
SECRETS = [
    *BASE_SECRETS,
    secret_ledger.Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}", needles=("ghp_", "gho_", "ghu_", "ghs_", "ghr_")),
    secret_ledger.Rule("slack", r"xox[abeoprs]-[A-Za-z0-9-]{10,}", needles=("xox",)),
    secret_ledger.Rule("google", r"AIza[A-Za-z0-9_-]{35}", needles=("aiza",)),
    secret_ledger.Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+", needles=("eyj",)),
    secret_ledger.Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", needles=("private key-----",)),
    secret_ledger.Rule("login", r"[a-z][a-z0-9+.-]*://[^/\s:@]+:[^/\s:@]+@", needles=("://",)),
    secret_ledger.Rule("bearer", r"bearer\x20+[A-Za-z0-9._~+/-]{16,}=*", any_case=True, needles=("bearer",)),
]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages")
    host, path = urls.host_and_path(F.col("url"))
    parts = pages.select(host.alias("host"), path.alias("path"))
    thin = parts.join(urls.thin_hosts(pages, **THIN_HOSTS), "host", "left_semi")
    listed = thin.unionByName(parts.filter(F.col("host").rlike(LISTED_HOST)))
    return urls.judge_urls(pages.select("page_id", "url"), URL_RULES, listed.select(F.concat("host", "path").alias("key")))


def op2_language(spark: SparkSession, folder: str) -> DataFrame:
    return langid.language_report(table(spark, folder, "documents"))


def op3_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix_report(table(spark, folder, "documents"), SOURCE_WEIGHTS)


def op4_imatch(spark: SparkSession, folder: str) -> DataFrame:
    return imatch.imatch_report(table(spark, folder, "documents"))


def op5_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.quality_report(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op6_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.toxicity_report(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op7_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_join.near_duplicates(table(spark, folder, "documents"), n=4, percent=85)


def op8_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.license_report(table(spark, folder, "documents"), LICENSES)


def op9_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return substrings.substring_report(table(spark, folder, "documents"))


def op10_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.leak_report(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op11_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations.collocations(table(spark, folder, "documents"))


def op12_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    ledger = secret_ledger.BlobLedger(spark, fresh_folder(spark, "secrets"), SECRETS, ["doc_id"])
    ledger.ingest(table(spark, folder, "documents"))
    return secret_ledger.secret_report(ledger.findings(), BASE_SECRETS, SECRETS)


def op13_fill_in_middle(spark: SparkSession, folder: str) -> DataFrame:
    return fim.fim_report(table(spark, folder, "documents"))


def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    return corpus_pipeline.run(spark, folder)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_url_filter": op1_url_filter,
        "op2_language": op2_language,
        "op3_mixing": op3_mixing,
        "op4_imatch": op4_imatch,
        "op5_quality": op5_quality,
        "op6_toxicity": op6_toxicity,
        "op7_ngram_join": op7_ngram_join,
        "op8_license_scan": op8_license_scan,
        "op9_substring_dedup": op9_substring_dedup,
        "op10_decontamination": op10_decontamination,
        "op11_collocations": op11_collocations,
        "op12_secret_scan": op12_secret_scan,
        "op13_fill_in_middle": op13_fill_in_middle,
        "pipeline": pipeline,
    }
