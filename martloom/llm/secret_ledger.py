"""Secret scans over the history of many files: a ledger of blobs, so that a text is read by a rule once.

Every version of every path is recorded with the sha256 of its text, its blob. A blob is scanned only by the rules, in
their present versions, that have not read it yet, however many paths and versions hold it; what is found is stored with
the blob and joined back to all paths. Ledger below a folder:

* versions/<commit>   key columns of the versions and their blob,
* scans/<commit>      blob, the rules that read it in this commit, and the spans they found,
* _commits            the commits that are complete, one name a line, replaced in one step.

A failed run leaves folders that no commit names; repeating it records them anew. One run at a time may write.

Spans are places of code points, end exclusive. Matches of a rule are leftmost and do not overlap; then those whose group is
shorter than `least` are dropped.

Defined results: a null text is an empty one; versions with equal keys and texts stay rows of their own; null keys are
kept; an empty table makes a commit without rows; only the key columns and the text are read, so others may have any name.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import cached_property
from uuid import uuid4

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.operators.files import read_text, replace_text

SPANS = "array<struct<rule: string, start: int, end: int>>"
SCANS = f"blob binary, rules array<string>, spans {SPANS}"
#: New blobs of a commit up to which their ids are broadcast (some 250 bytes each), so that texts already read stay where they are.
FEW = 50_000


@dataclass(frozen=True)
class Rule:
    """`group` of each match must have `least` characters. A text without any of `needles` (lower case) has no match."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0
    any_case: bool = False
    needles: tuple[str, ...] = ()
    version: int = 1

    @property
    def name(self) -> str:
        return f"{self.kind}@{self.version}"

    @cached_property
    def compiled(self) -> re.Pattern:
        return re.compile(self.pattern, re.ASCII | (re.IGNORECASE if self.any_case else 0))

    def spans(self, text: str, lowered: str) -> list[tuple[int, int]]:
        if self.needles and not any(n in lowered for n in self.needles):
            return []
        return [m.span() for m in self.compiled.finditer(text) if m.end(self.group) - m.start(self.group) >= self.least]


def scanned(text: Column, todo: Column, rules: list[Rule]) -> Column:
    """Spans that the rules named in `todo` (comma-joined) find in a text."""
    by_name = {r.name: r for r in rules}

    @F.arrow_udf(SPANS)
    def scan(texts: pa.Array, todos: pa.Array) -> pa.Array:
        offsets, names, starts, ends = [0], [], [], []
        for i in range(len(texts)):  # one text at a time: a batch may hold long ones
            body = texts[i].as_py()
            lowered = body.lower()
            for name in todos[i].as_py().split(","):
                for start, end in by_name[name].spans(body, lowered):
                    names.append(name)
                    starts.append(start)
                    ends.append(end)
            offsets.append(len(names))
        spans = pa.StructArray.from_arrays(
            [pa.array(names, pa.string()), pa.array(starts, pa.int32()), pa.array(ends, pa.int32())], ["rule", "start", "end"]
        )
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), spans)

    return scan(text, todo)


class BlobLedger:
    def __init__(self, spark: SparkSession, folder: str, rules: list[Rule], keys: list[str]):
        self.spark, self.folder, self.rules, self.keys = spark, folder, rules, keys

    def _commits(self) -> list[str]:
        return (read_text(self.spark, f"{self.folder}/_commits") or "").split()

    def _read(self, part: str, schema: str | None = None) -> DataFrame | None:
        paths = [f"{self.folder}/{part}/{commit}" for commit in self._commits()]
        if not paths:
            return None if schema is None else self.spark.createDataFrame([], schema)
        return (self.spark.read.schema(schema) if schema else self.spark.read).parquet(*paths)

    def scans(self) -> DataFrame:
        """A row per blob and commit that read it."""
        return self._read("scans", SCANS)

    def to_scan(self, blobs: DataFrame) -> DataFrame:
        """(blob, todo) of the given blobs that some rule has not read yet in its present version."""
        names = F.array(*[F.lit(r.name) for r in self.rules])
        read = self.scans().groupBy("blob").agg(F.array_distinct(F.flatten(F.collect_list("rules"))).alias("read"))
        known = blobs.select("blob").distinct().join(read, "blob", "left")
        left = F.array_except(names, F.coalesce("read", F.array().cast("array<string>")))
        return known.select("blob", F.array_join(left, ",").alias("todo")).filter("todo <> ''")

    def ingest(self, versions: DataFrame, text: str = "text") -> str:
        """Record versions (key columns, text) and scan what no rule has read; the name of the commit.

        Copies of a text are made one on the map side, before texts are shuffled. Where few blobs are new, their ids
        (their number is known by then) are broadcast, so that only their texts are.
        """
        commit = uuid4().hex
        body = F.coalesce(text, F.lit(""))
        addressed = versions.select(*self.keys, F.unhex(F.sha2(body, 256)).alias("blob"), body.alias("text"))
        addressed.select(*self.keys, "blob").write.parquet(f"{self.folder}/versions/{commit}")
        recorded = self.spark.read.parquet(f"{self.folder}/versions/{commit}")
        self.to_scan(recorded).write.parquet(f"{self.folder}/todo/{commit}")
        todo = self.spark.read.schema("blob binary, todo string").parquet(f"{self.folder}/todo/{commit}")
        texts = addressed.select("blob", "text")
        if todo.count() <= FEW:
            unread = texts.join(F.broadcast(todo), "blob").groupBy("blob").agg(F.first("text").alias("text"), F.first("todo").alias("todo"))
        else:
            unread = texts.groupBy("blob").agg(F.first("text").alias("text")).join(todo, "blob")
        done = unread.select("blob", F.split("todo", ",").alias("rules"), scanned(F.col("text"), F.col("todo"), self.rules).alias("spans"))
        done.write.parquet(f"{self.folder}/scans/{commit}")
        replace_text(self.spark, f"{self.folder}/_commits", "\n".join([*self._commits(), commit]))
        return commit

    def findings(self) -> DataFrame:
        """Key columns of every recorded version, with the spans (rule, start, end) of the present rules in its text."""
        present = [r.name for r in self.rules]
        spans = self.scans().select("blob", F.filter("spans", lambda s: s["rule"].isin(present)).alias("spans")).filter(F.size("spans") > 0)
        found = spans.groupBy("blob").agg(F.flatten(F.collect_list("spans")).alias("spans"))  # a blob is in few commits
        versions = self._read("versions")
        if versions is None:
            raise FileNotFoundError(f"nothing has been recorded in {self.folder}")
        return versions.join(found, "blob", "left").select(*self.keys, "blob", F.coalesce("spans", F.array().cast(SPANS)).alias("spans"))


def listed(spans: Column, rules: list[Rule]) -> Column:
    """kind:start:end of spans, by start and then the order of the rules, comma-joined."""
    order = F.create_map(*[F.lit(x) for i, r in enumerate(rules) for x in (r.name, i)])
    kinds = F.array(*[F.lit(r.kind) for r in rules])
    keyed = F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.element_at(order, s["rule"]).alias("place"), s["end"].alias("end")))
    named = F.transform(F.array_sort(keyed), lambda s: F.concat_ws(":", F.get(kinds, s["place"]), s["start"], s["end"]))
    return F.array_join(named, ",")


def secret_report(findings: DataFrame, base: list[Rule], rules: list[Rule]) -> DataFrame:
    """Counts of the three base kinds, the digest of their spans, and all spans of each document."""
    basic = F.filter("spans", lambda s: s["rule"].isin([r.name for r in base]))

    def count(rule: Rule) -> Column:
        return F.size(F.filter("spans", lambda s: s["rule"] == rule.name)).cast("long").alias(f"n_{rule.kind}")

    return findings.select("doc_id", *map(count, base), F.sha2(listed(basic, rules), 256).alias("base_sha256"), listed(F.col("spans"), rules).alias("spans"))
