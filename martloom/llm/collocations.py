"""Phrase collocations: word sequences that occur together more often than their parts, mined per language.

Counting goes by order. Every task builds weighted acyclic automata (`automata`) of the n-grams of its documents, run by run,
unites them, cuts the union at boundaries of the sorted sequences (language, word, word, ...) and sends each part to the task
of its range, which unites the parts of all tasks and sums their weights. A sequence lies in one range however common it is,
and is one path per sending task. Single words come first, then pairs of words that are frequent, then triples and
quadruples all of whose pairs are: a phrase is not more frequent than its parts, so nothing frequent is left out. Which
words and pairs are frequent is told by a bit filter of fixed size; where it lets others through, they are only counted.

Scores need the counts of the parts of each phrase, which lie in other ranges. Each range asks once for every part of its
phrases, the range of the part composes the acceptor of the questions with its automaton, and the answers go back. A
question carries the count of the most frequent phrase of one word more, which tells whether its subject is covered.

Boundaries are drawn from a sample of documents (`sample` rows expected); they share out the work and do not alter results.

Defined results: texts have A-Z lower-cased and are split at `[.,;:!?\\x0A-\\x0D]` into pieces and those into words
`[^\\x20\\x09]+`; a null text is empty, a null language `und`; equal rows count as often as they stand; languages without
phrases have no rows, nor has an empty table. Only text and lang are read. Words are told apart by 64-bit hashes in a run.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martloom.llm.automata import Automaton, Trie
from martloom.llm.bits import bit_filter, in_filter
from martloom.llm.storage import stored
from martloom.llm.texts import _BYTE_HASH, _LOWER, mix, ranged_hash, slices

#: Bytes of text whose n-grams make one automaton, and arcs a task holds before it sends them off.
RUN_BYTES, HELD_ARCS = 1 << 21, 1 << 22
FILTER_BITS = 1 << 25
#: Characters of text whose n-grams one range is to hold.
RANGE_CHARS = 1 << 26
ORDERS = ((1, 1), (2, 2), (3, 4))
#: Group numbers are order * STRIDE + range.
STRIDE = 1_000_000_000
_BREAK = np.isin(np.arange(256), list(b".,;:!?\n\x0b\x0c\r"))
_SOLID = ~_BREAK & ~np.isin(np.arange(256), list(b" \t"))
_ODD = 0x9E3779B97F4A7C15


def sequence_hash(columns: list[np.ndarray]) -> np.ndarray:
    """Hashes of sequences whose words' hashes are given column by column."""
    total = np.zeros(len(columns[0]), dtype=np.uint64)
    for i, column in enumerate(columns):
        total += column * np.uint64(pow(_ODD, 2 * i + 1, 2**64))
    return mix(total).view(np.int64)


def word_hashes(words: list[bytes]) -> np.ndarray:
    data = np.frombuffer(b"".join(words), dtype=np.uint8)
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)))
    return ranged_hash(_BYTE_HASH[data], np.concatenate([[0], ends[:-1]]).astype(np.int64), ends) if words else np.zeros(0, dtype=np.uint64)


def run_trie(data: np.ndarray, offsets: np.ndarray, langs: list[bytes], order: tuple[int, int], bits: np.ndarray | None) -> Trie:
    """(language, words) of the n-grams of a run of texts, as many as `order` says, with their counts.

    `bits`: filter of the frequent (n - 1)-grams for pairs, of the frequent pairs for longer ones.
    """
    data = _LOWER[data]
    solid = _SOLID[data]
    begins, stops = solid.copy(), solid.copy()
    begins[1:] &= ~solid[:-1]
    stops[:-1] &= ~solid[1:]
    inner = offsets[1:-1]
    inner = inner[(inner > 0) & (inner < len(data))]
    begins[inner], stops[inner - 1] = solid[inner], solid[inner - 1]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    doc = np.searchsorted(offsets, starts, side="right") - 1
    piece = np.cumsum(_BREAK[data])[starts] + doc  # both ascend: equal only within a piece
    hashes = ranged_hash(_BYTE_HASH[data], starts, ends)
    names = sorted(set(langs))
    lang = np.fromiter((names.index(x) for x in langs), dtype=np.int64, count=len(langs))[doc]
    lang_hash = word_hashes(names)[lang] if names else np.zeros(0, dtype=np.uint64)

    n = len(starts)
    reach = np.ones(n, dtype=np.int64)  # words from here on that may be one n-gram
    if bits is not None:
        next_too = np.zeros(n, dtype=bool)
        next_too[:-1] = piece[1:] == piece[:-1]
        if order[0] == 2:
            known = in_filter(bits, sequence_hash([lang_hash, hashes]))
            next_too[:-1] &= known[1:] & known[:-1]
        else:
            at = np.flatnonzero(next_too)
            next_too[at] = in_filter(bits, sequence_hash([lang_hash[at], hashes[at], hashes[at + 1]]))
        for k in range(1, min(order[1], n)):
            reach[: n - k] += (reach[: n - k] == k) & next_too[k - 1 : n - 1]
    at = np.flatnonzero(reach >= order[0])
    reach = reach[at]
    needed = np.zeros(n, dtype=bool)
    for k in range(order[1]):
        needed[at[reach > k] + k] = True
    spots = np.flatnonzero(needed)
    _, first, which = np.unique(hashes[spots], return_index=True, return_inverse=True)
    text = data.tobytes()
    found = [text[a:b] for a, b in zip(starts[spots[first]].tolist(), ends[spots[first]].tolist())]
    words = sorted({*found, *names})
    place = {w: i for i, w in enumerate(words)}
    label = np.zeros(n, dtype=np.int64)
    label[spots] = np.fromiter((place[w] for w in found), dtype=np.int64, count=len(found))[which]
    columns = [np.fromiter((place[x] for x in names), dtype=np.int64, count=len(names))[lang[at]]]
    amounts = [np.zeros(len(at), dtype=np.int64)]
    for k in range(order[1]):
        column = np.full(len(at), -1, dtype=np.int64)
        column[reach > k] = label[at[reach > k] + k]
        columns.append(column)
        amounts.append(((reach > k) & (k + 1 >= order[0])).astype(np.int64))
    return Trie.grown(words, columns, amounts)


def _lang_bytes(langs: pa.Array) -> list[bytes]:
    return [b"und" if x is None else x.encode() for x in langs.to_pylist()]


def _runs(batches: Iterator[pa.RecordBatch], order: tuple[int, int], filter_) -> Iterator[Trie]:
    bits = filter_.value if filter_ is not None else None
    for batch in batches:
        langs = batch.column(batch.schema.get_field_index("lang"))
        for rows, data, offsets in slices(batch, limit=RUN_BYTES):
            yield run_trie(data, offsets, _lang_bytes(langs[rows]), order, bits)


def _sequences(trie: Trie, depth: int) -> list[list[bytes]]:
    columns = [[trie.words[i] for i in c.tolist()] for c in trie.sequences(depth)]
    return [list(s) for s in zip(*columns)]


def _boundaries(sample: DataFrame, order: tuple[int, int], filter_, ranges: int) -> list[list[bytes]]:
    """Sequences that part those of the sample evenly; at most 64 a range and sampled task reach the driver."""
    most = 64 * ranges

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [t.minimal() for t in _runs(batches, order, filter_)]
        if held:
            trie = Trie.union(held)
            found = _sequences(trie, order[0])
            found = found[:: max(len(found) // most, 1)]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.list_(pa.binary()))], ["key"])

    found = sorted([r["key"] for r in sample.coalesce(1).mapInArrow(keys, "key array<binary>").toArrow().to_pylist()])
    return [found[i * len(found) // ranges] for i in range(1, ranges)] if len(found) >= ranges else []


def _sent(documents: DataFrame, order: tuple[int, int], filter_, boundaries) -> DataFrame:
    """(range, piece): parts of the automata of each task."""

    def pieces(held: list[Automaton]) -> Iterator[pa.RecordBatch]:
        for number, part in Trie.union(held).cut(boundaries.value):
            yield pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), pa.array([part.minimal().to_bytes()], pa.binary())], ["range", "piece"])

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[Automaton] = []
        arcs = 0
        for trie in _runs(batches, order, filter_):
            held.append(trie.minimal())
            arcs += sum(map(len, trie.labels))
            if arcs > HELD_ARCS:
                yield from pieces(held)
                held, arcs = [], 0
        if held:
            yield from pieces(held)

    return documents.mapInArrow(send, "range long, piece binary")


COUNTED = "kind string, group long, lang string, phrase string, f long, hash long, home long"


def _group_of(sequence: list[bytes], bounds: dict[int, list[list[bytes]]]) -> int:
    words = len(sequence) - 1
    order = next(i for i, (low, high) in enumerate(ORDERS) if low <= words <= high)
    return order * STRIDE + bisect_right(bounds[order], sequence)


def _frequent(sent: DataFrame, number: int, least: int, bounds) -> DataFrame:
    """The union of each range: its frequent phrases, what they ask for, and the words of each language (order 1)."""
    low, _ = ORDERS[number]

    def unite(key: tuple, table: pa.Table) -> pa.Table:
        trie = Trie.union([Automaton.from_bytes(x.as_py()) for x in table.column("piece")])
        home = number * STRIDE + key[0].as_py()
        rows: list[tuple] = []
        asked: dict[tuple[bytes, ...], int] = {}
        if low == 1 and len(trie.labels) > 1:
            totals = np.zeros(len(trie.labels[0]), dtype=np.int64)
            np.add.at(totals, trie.parents[1], trie.weights[1])
            rows += [("total", home, trie.words[w].decode(), None, n, None, None) for w, n in zip(trie.labels[0].tolist(), totals.tolist())]
        hashes = word_hashes(trie.words)
        for depth in range(low, len(trie.labels)):
            often = np.flatnonzero(trie.weights[depth] >= least)
            columns = [c[often] for c in trie.sequences(depth)]
            keys = sequence_hash([hashes[c] for c in columns])
            for *labels, f, h in zip(*[c.tolist() for c in columns], trie.weights[depth][often].tolist(), keys.tolist()):
                s = [trie.words[i] for i in labels]
                rows.append(("phrase", home, s[0].decode(), b" ".join(s[1:]).decode(), f, h, None))
                for k in range(2, len(s)):
                    for part, nearly in ((s[:k], k == len(s) - 1), ([s[0], *s[k:]], k == 2)):
                        cover = f if nearly else 0
                        asked[tuple(part)] = max(asked.get(tuple(part), 0), cover)
        rows += [("ask", _group_of(list(s), bounds.value), s[0].decode(), b" ".join(s[1:]).decode(), f, None, home) for s, f in asked.items()]
        names = [c.split()[0] for c in COUNTED.split(", ")]
        kinds = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
        return pa.Table.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows) if rows else [[]] * 7, kinds)], names)

    return sent.groupBy("range").applyInArrow(unite, COUNTED)


def _split(table: pa.Table) -> list[list[bytes]]:
    """Sequences of (lang, phrase) rows."""
    return [[a.encode(), *b.encode().split(b" ")] for a, b in zip(table.column("lang").to_pylist(), table.column("phrase").to_pylist())]


def _answers(counted: DataFrame) -> DataFrame:
    """(group, lang, phrase, f, cover): the count of each part, for the group that asked, and for the part's own group
    the greatest count among the phrases of one word more around it."""

    def answer(phrases: pa.Table, asks: pa.Table) -> pa.Table:
        if not len(asks):
            return pa.Table.from_arrays([pa.array([], t) for t in (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64())], names)
        trie = Trie.of(_split(phrases), phrases.column("f").to_numpy())
        sequences = _split(asks)
        counts = trie.look_up(sequences)
        cover: dict[tuple[bytes, ...], int] = {}
        for s, f in zip(sequences, asks.column("f").to_pylist()):
            if f:
                cover[tuple(s)] = max(cover.get(tuple(s), 0), f)
        n, own = len(asks), asks.column("group")[0].as_py()
        return pa.Table.from_arrays(
            [
                pa.array([*asks.column("home").to_pylist(), *[own] * len(cover)], pa.int64()),
                pa.array([*asks.column("lang").to_pylist(), *[s[0].decode() for s in cover]], pa.string()),
                pa.array([*asks.column("phrase").to_pylist(), *[b" ".join(s[1:]).decode() for s in cover]], pa.string()),
                pa.array([*counts.tolist(), *[0] * len(cover)], pa.int64()),
                pa.array([*[0] * n, *cover.values()], pa.int64()),
            ],
            names,
        )

    names = ["group", "lang", "phrase", "f", "cover"]
    phrases, asks = counted.filter("kind = 'phrase'").select("group", "lang", "phrase", "f"), counted.filter("kind = 'ask'")
    asks = asks.select("group", "lang", "phrase", "f", "home")
    return phrases.groupBy("group").cogroup(asks.groupBy("group")).applyInArrow(answer, "group long, lang string, phrase string, f long, cover long")


def _cuts(counted: DataFrame, answers: DataFrame) -> DataFrame:
    """(lang, phrase, a, cover, cuts): counts of both sides of every cut of the phrases of two words or more."""

    def join(phrases: pa.Table, given: pa.Table) -> pa.Table:
        parts = Trie.of(_split(given), given.column("f").to_numpy()) if len(given) else None
        covers = Trie.of(_split(given), given.column("cover").to_numpy()) if len(given) else None
        sequences = _split(phrases)
        left = [(i, s[:k], [s[0], *s[k:]]) for i, s in enumerate(sequences) for k in range(2, len(s))]
        l = parts.look_up([x[1] for x in left]).tolist() if left else []
        r = parts.look_up([x[2] for x in left]).tolist() if left else []
        cuts: list[list[dict]] = [[] for _ in sequences]
        for (i, first, _), x, y in zip(left, l, r):
            cuts[i].append({"k": len(first) - 1, "l": x, "r": y})
        cover = covers.look_up(sequences).tolist() if covers else [0] * len(sequences)
        return pa.Table.from_arrays(
            [phrases.column("lang"), phrases.column("phrase"), phrases.column("f"), pa.array(cover, pa.int64()),
             pa.array(cuts, pa.list_(pa.struct([("k", pa.int32()), ("l", pa.int64()), ("r", pa.int64())])))],
            ["lang", "phrase", "a", "cover", "cuts"],
        )

    phrases = counted.filter(f"kind = 'phrase' AND group >= {STRIDE}").select("group", "lang", "phrase", "f")
    schema = "lang string, phrase string, a long, cover long, cuts array<struct<k: int, l: bigint, r: bigint>>"
    return phrases.groupBy("group").cogroup(answers.groupBy("group")).applyInArrow(join, schema)


def _wide(c: Column) -> Column:
    return c.cast("decimal(20,0)")


def phrase_cuts(documents: DataFrame, least: int = 30, sample: int = 2000) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, a, cover, cuts) of every phrase of 2 to 4 words with a >= least, and (lang, n) of all languages."""
    spark = documents.sparkSession
    documents = documents.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    size = documents.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(F.length("text")), F.lit(0)).alias("chars")).first()
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), size["chars"] // RANGE_CHARS)
    sampled = stored(documents.sample(min(1.0, sample / max(size["rows"], 1)), seed=1), "phrase-sample")
    counted, filter_, bounds = None, None, {}
    for number, order in enumerate(ORDERS):
        bounds[number] = _boundaries(sampled, order, filter_, ranges)
        sent = _sent(documents, order, filter_, spark.sparkContext.broadcast(bounds[number]))
        here = stored(_frequent(sent, number, least, spark.sparkContext.broadcast(dict(bounds))), f"phrases-{order[0]}")
        filter_ = spark.sparkContext.broadcast(bit_filter(here.filter("kind = 'phrase'").select("hash"), FILTER_BITS))
        counted = here if counted is None else counted.unionByName(here)
    answers = stored(_answers(counted), "phrase-answers")
    return _cuts(counted, answers), counted.filter("kind = 'total'").groupBy("lang").agg(F.sum("f").alias("n"))


def collocations(documents: DataFrame, least: int = 30, covered: int = 80, top: int = 2000) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the first `top` phrases of each language.

    The score is floor(2000000 a / (l + r)) of the cut where it is lowest. Phrases inside a longer one with at least
    `covered` per cent of their count are left out. Products are decimals of up to 29 digits.
    """
    cuts, totals = phrase_cuts(documents, least)
    scored = F.transform(
        "cuts",
        lambda c: F.struct(
            F.call_function("div", F.lit(2_000_000).cast("decimal(7,0)") * _wide(F.col("a")), _wide(c["l"]) + _wide(c["r"])).cast("long").alias("score"),
            c["k"].alias("k"),
            c["l"].alias("l"),
            c["r"].alias("r"),
        ),
    )
    open_ = cuts.filter(100 * _wide(F.col("cover")) < covered * _wide(F.col("a")))
    best = open_.select("lang", "phrase", "a", F.array_min(scored).alias("best")).select("lang", "phrase", "a", "best.l", "best.r", "best.score")
    # first within each of many parts of a language, so that few rows of a large one meet in a task
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    parts = int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    part = best.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(parts)))
    ahead = part.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).filter(F.col("rank") <= top)
    first = ahead.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).filter(F.col("rank") <= top)
    return first.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
