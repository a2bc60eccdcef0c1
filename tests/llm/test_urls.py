from __future__ import annotations

import sys
from pathlib import Path

from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parents[2] / "tools"))

from compare import connect, difference  # noqa: E402
from martloom.llm import urls  # noqa: E402
from martloom.llm.oracle import oracle_sql  # noqa: E402
from martloom.llm.queries import URL_RULES, queries  # noqa: E402

SAMPLE = "/root/testdata/sf0.01"


def test_sample(spark):
    assert difference(queries()["op1_url_filter"](spark, SAMPLE), connect(SAMPLE), oracle_sql()["op1_url_filter"]) is None


def test_cascade_is_exact_over_its_universe(spark):
    keys = spark.range(20_000).select(F.concat(F.lit("k"), "id").alias("key"))
    listed = keys.filter("CAST(substr(key, 2) AS INT) % 7 = 0")
    h1, h2 = urls.hash_columns(F.col("key"))
    table = keys.withColumn("listed", F.col("key").substr(2, 9).cast("int") % 7 == 0).select(h1.alias("h1"), h2.alias("h2"), "listed")
    levels = urls.build_cascade(table.cache(), bits_per_key=4.0)
    assert len(levels) > 2
    got = table.toPandas()
    assert (urls.contains(levels, got.h1.to_numpy(), got.h2.to_numpy()) == got.listed.to_numpy()).all()
    assert urls.mark_listed(keys, "key", listed).filter("listed").count() == listed.count()


def test_a_list_beyond_the_bound_is_joined(spark):
    keys = spark.createDataFrame([("a", 1), ("b", 2), ("b", 3), (None, 4)], "key string, listed_before int")
    listed = spark.createDataFrame([("b",), (None,), ("z",), ("b",)], "word string")
    for bound in (0, 1 << 20):
        got = urls.mark_listed(keys, "key", listed, max_bytes=bound)
        assert sorted((r["listed_before"], r["listed"]) for r in got.collect()) == [(1, False), (2, True), (3, True), (4, False)]


def test_defined_results(spark):
    rows = [
        (1, None), (2, "no scheme.org/"), (3, "http://A.ORG"), (4, "http://A.ORG/x?y#z"), (5, "x://b.Example.org/en/12#q"),
        (6, "http://example.org/es/"), (7, "http://notexample.org/es/a"), (8, "http://com/fr/"), (9, "http://Xcom/fr/"),
        (10, "://h?a/b"), (10, "://h?a/b"), (11, "http://l.net/p"), (12, "http://c.com/de/a\nb"), (13, ""),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string").withColumn("verdict", F.lit("x")).withColumn("host", F.lit(1))
    listed = spark.createDataFrame([("l.net/p",), ("h",)], "key string")
    got = sorted(tuple(r) for r in urls.judge_urls(pages, URL_RULES, listed).collect())
    assert got == sorted(
        [
            (1, "", "", None, "allow"), (2, "", "", None, "allow"), (3, "a.org", "", None, "allow"), (4, "a.org", "/x", "org/", "allow"),
            (5, "b.example.org", "/en/12", "example.org/en/1", "block"), (6, "example.org", "/es/", "example.org/es/", "block"),
            (7, "notexample.org", "/es/a", "org/", "allow"), (8, "com", "/fr/", "com/fr/", "allow"), (9, "xcom", "/fr/", None, "allow"),
            (10, "h", "", None, "block"), (10, "h", "", None, "block"), (11, "l.net", "/p", None, "block"),
            (12, "c.com", "/de/a\nb", "com/de/", "block"), (13, "", "", None, "allow"),
        ],
        key=lambda r: r,
    )


def test_empty_table(spark):
    pages = spark.createDataFrame([], "page_id long, url string")
    listed = spark.createDataFrame([], "key string")
    assert urls.judge_urls(pages, URL_RULES, listed).count() == 0


def test_few_listed_keys_among_many_are_joined_once_a_level_is_too_large(spark):
    keys = spark.range(20_000).select(F.concat(F.lit("k"), "id").alias("key"))
    listed = keys.limit(10).cache()
    h1, h2 = urls.hash_columns(F.col("key"))
    table = keys.join(F.broadcast(listed.withColumn("listed", F.lit(True))), "key", "left")
    table = table.select(h1.alias("h1"), h2.alias("h2"), F.coalesce("listed", F.lit(False)).alias("listed"))
    assert urls.build_cascade(table, max_bytes=200) is None  # level 1 has 8 bytes, level 2 some 900
    got = urls.mark_listed(keys, "key", listed, max_bytes=200)
    assert got.count() == 20_000 and got.filter("listed").join(listed, "key").count() == got.filter("listed").count() == 10
