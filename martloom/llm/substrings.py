"""Substring dedup: words covered by a window of `length` consecutive words that also starts anywhere else are removed.

Suffix automata over all the text would meet every document with every shard. Here the reference holds only the text that
can repeat. Every window has an anchor, the smallest hash among its grams of GRAM words, so equal windows have equal
anchors. Runs of windows with one anchor are pieces. Anchors that occur once are left out; a piece that occurs twice as it
is repeats throughout. What is left, distinct pieces that share an anchor, is dealt into shards by anchor. Each shard is
the reference of one suffix automaton with occurrence counts, and its pieces are streamed through it: where the longest
match of at least `length` words occurs twice, the window repeats. Shards have a bounded number of pieces, so an automaton
is small, and it is built where its pieces are: broadcasting all of them would grow with the corpus. An anchor with more
pieces than a shard may hold (a line that stands in very many contexts) is decided by counting the hashes of its windows,
which is combined before the shuffle.

Defined results: words are `[^\\x20\\x09-\\x0D]+`, unchanged; a null text has none; texts of fewer than `length` words keep
all. Rows with equal ids count as rows; an empty table gives no rows. Words are compared by 64-bit hashes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.llm.storage import stored
from martloom.llm.texts import gram_hashes, kept_offsets, ranged_hash, signed, word_runs

GRAM = 8
#: Windows of one piece; a piece's windows are bits of a long.
PIECE = 32
#: Pieces of a shard, at most (but for the last anchor dealt into it).
SHARD = 4000


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of values[i:i + width] for every i."""
    low, have = values, 1
    while 2 * have <= width:
        low = np.minimum(low[:-have], low[have:])
        have *= 2
    if have < width:
        low = np.minimum(low[: len(values) - width + 1], low[width - have : width - have + len(values) - width + 1])
    return low


def pieces_of(words, length: int) -> dict[str, np.ndarray]:
    """Pieces of a run of documents: doc, start (word in the document), windows, anchor, piece (hash) and weight."""
    hashes = words.hashes()
    n = len(hashes)
    empty = {k: np.zeros(0, dtype=np.int64) for k in ("doc", "start", "windows", "weight")} | {k: np.zeros(0, dtype=np.uint64) for k in ("anchor", "piece")}
    if n < length:
        return empty
    grams, at = gram_hashes(hashes, words.first, GRAM)
    dense = np.full(n - GRAM + 1, np.iinfo(np.uint64).max, dtype=np.uint64)
    dense[at] = grams
    low = sliding_min(dense, length - GRAM + 1)
    counts = np.maximum(words.counts - length + 1, 0)
    if not counts.sum():
        return empty
    doc = np.repeat(np.arange(len(counts)), counts)
    before = np.cumsum(counts) - counts
    window = np.arange(len(doc)) - before[doc] + words.first[doc]
    anchor = low[window]
    new = np.ones(len(doc), dtype=bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (doc[1:] != doc[:-1])
    run = np.flatnonzero(new)
    into = np.arange(len(doc)) - run[np.cumsum(new) - 1]
    begins = np.flatnonzero(into % PIECE == 0)
    size = np.diff(np.concatenate([begins, [len(doc)]]))
    start, anchors = window[begins], anchor[begins]
    end = start + size + length - 1
    # a piece in which its anchor stands twice may repeat a window within itself
    known, number = np.unique(dense, return_inverse=True)
    keys = np.sort(number.astype(np.int64) * n + np.arange(len(dense)))
    place = np.searchsorted(known, anchors) * n
    twice = np.searchsorted(keys, place + end - GRAM + 1) - np.searchsorted(keys, place + start) > 1
    return {
        "doc": doc[begins], "start": start - words.first[doc[begins]], "windows": size, "anchor": anchors,
        "piece": ranged_hash(hashes, start, end), "weight": 1 + twice,
    }


def _pieces(documents: DataFrame, length: int) -> DataFrame:
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(batch.schema.get_field_index("key")).to_numpy()
            for rows, words in word_runs(batch):
                found = pieces_of(words, length)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(signed(found["anchor"])),
                        pa.array(signed(found["piece"])),
                        pa.array(keys[rows][found["doc"]]),
                        pa.array(found["start"].astype(np.int32)),
                        pa.array(found["windows"].astype(np.int32)),
                        pa.array(found["weight"].astype(np.int32)),
                    ],
                    ["anchor", "piece", "key", "start", "windows", "weight"],
                )

    return documents.select("key", "text").mapInArrow(cut, "anchor long, piece long, key long, start int, windows int, weight int")


class Automaton:
    """A suffix automaton of weighted sequences, with the number of times each state's strings occur."""

    def __init__(self) -> None:
        self.next: list[dict[int, int]] = [{}]
        self.link, self.len, self.count = [-1], [0], [0]

    def _state(self, length: int, link: int, onward: dict[int, int]) -> int:
        self.next.append(onward)
        self.link.append(link)
        self.len.append(length)
        self.count.append(0)
        return len(self.len) - 1

    def _split(self, p: int, word: int, q: int) -> int:
        clone = self._state(self.len[p] + 1, self.link[q], dict(self.next[q]))
        self.link[q] = clone
        while p != -1 and self.next[p].get(word) == q:
            self.next[p][word] = clone
            p = self.link[p]
        return clone

    def add(self, words: list[int], weight: int) -> None:
        last = 0
        for word in words:
            q = self.next[last].get(word)
            if q is not None:
                last = q if self.len[q] == self.len[last] + 1 else self._split(last, word, q)
            else:
                state = self._state(self.len[last] + 1, 0, {})
                p = last
                while p != -1 and word not in self.next[p]:
                    self.next[p][word] = state
                    p = self.link[p]
                if p != -1:
                    q = self.next[p][word]
                    self.link[state] = q if self.len[q] == self.len[p] + 1 else self._split(p, word, q)
                last = state
            self.count[last] += weight

    def finish(self) -> None:
        """Sums the occurrences of longer strings into their suffixes."""
        for state in sorted(range(1, len(self.len)), key=self.len.__getitem__, reverse=True):
            if self.link[state] > 0:
                self.count[self.link[state]] += self.count[state]

    def repeats(self, words: list[int], length: int) -> list[int]:
        """Starts of the windows of `length` words that occur at least twice in the reference."""
        state, matched, found = 0, 0, []
        for i, word in enumerate(words):
            while state and word not in self.next[state]:
                state = self.link[state]
                matched = self.len[state]
            if word in self.next[state]:
                state, matched = self.next[state][word], matched + 1
            while state and self.len[self.link[state]] >= length:
                state = self.link[state]
                matched = min(matched, self.len[state])
            if matched >= length and self.count[state] > 1:
                found.append(i - length + 1)
        return found


def _shard_masks(length: int):
    def masks(rows: pd.DataFrame) -> pd.DataFrame:
        automaton = Automaton()
        texts = [w.tolist() for w in rows["words"]]
        for words, times in zip(texts, rows["times"]):
            automaton.add(words, int(times))
        automaton.finish()
        out = [
            (a, p, sum(1 << s for s in automaton.repeats(words, length)))
            for a, p, times, words in zip(rows["anchor"], rows["piece"], rows["times"], texts)
            if times == 1
        ]
        return pd.DataFrame(out, columns=["anchor", "piece", "mask"]).astype("int64")

    return masks


def _contents(documents: DataFrame, pieces: DataFrame, length: int) -> DataFrame:
    """Pieces (anchor, piece, times, n, key, start, windows) with their words (hashes), read from the documents of their keys."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            wanted = batch.column(batch.schema.get_field_index("wanted"))
            for rows, words in word_runs(batch):
                hashes = signed(words.hashes())
                out = []
                for d, items in enumerate(wanted[rows].to_pylist()):
                    for item in items:
                        at = words.first[d] + item["start"]
                        part = hashes[at : at + item["windows"] + length - 1]
                        out.append((item["anchor"], item["piece"], item["times"], item["n"], part))
                columns = list(zip(*out)) or [[]] * 5
                kinds = [pa.int64()] * 4 + [pa.list_(pa.int64())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(column), kind) for column, kind in zip(columns, kinds)], ["anchor", "piece", "times", "n", "words"]
                )

    asked = pieces.groupBy("key").agg(F.collect_list(F.struct("anchor", "piece", "times", "n", "start", "windows")).alias("wanted"))
    return documents.join(asked, "key").mapInArrow(read, "anchor long, piece long, times long, n long, words array<long>")


def repeated_windows(documents: DataFrame, length: int, shard: int = SHARD) -> DataFrame:
    """(key, spans): for the documents (key, doc_id, text) with repeated windows, their (start, mask) pairs."""
    cut = _pieces(documents, length)
    often = cut.groupBy("anchor").agg(F.sum("weight").alias("n")).filter("n > 1").select("anchor")
    pieces = stored(cut.join(often, "anchor", "left_semi"), "pieces")
    distinct = stored(
        pieces.groupBy("anchor", "piece").agg(
            F.count(F.lit(1)).alias("times"), F.max("weight").alias("weight"), F.min(F.struct("key", "start", "windows")).alias("place")
        ),
        "distinct-pieces",
    )
    groups = distinct.groupBy("anchor").agg(F.min("times").alias("least"), F.count(F.lit(1)).alias("n"), F.max("weight").alias("weight"))
    # a group is open if a piece occurs once and the others, or the piece itself, may repeat some of its windows
    open_groups = stored(groups.filter("least = 1 AND (n > 1 OR weight > 1)").select("anchor", "n"), "open-groups")
    total = open_groups.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    open_pieces = distinct.join(open_groups, "anchor").select("anchor", "piece", "times", "n", "place.*")
    read = _contents(documents, open_pieces, length)

    shards = max(1, -(-total * 2 // shard))
    by_automaton = (
        read.filter(F.col("n") <= shard)
        .select(F.pmod(F.xxhash64("anchor"), F.lit(shards)).alias("shard"), "anchor", "piece", "times", "words")
        .groupBy("shard")
        .applyInPandas(_shard_masks(length), "anchor long, piece long, mask long")
    )
    window = F.transform(F.sequence(F.lit(0), F.size("words") - length), lambda i: F.xxhash64(F.slice("words", i + 1, length)))
    crowded = read.filter(F.col("n") > shard).select("anchor", "piece", "times", F.posexplode(window).alias("at", "window"))
    repeated = crowded.groupBy("anchor", "window").agg(F.sum("times").alias("n")).filter("n > 1").select("anchor", "window")
    by_count = (
        crowded.filter("times = 1")
        .join(repeated, ["anchor", "window"], "left_semi")
        .groupBy("anchor", "piece")
        .agg(F.bit_or(F.expr("shiftleft(1L, at)")).alias("mask"))
    )
    open_masks = by_automaton.filter("mask <> 0").unionByName(by_count)

    whole = distinct.filter("times > 1").select("anchor", "piece", F.expr("shiftleft(1L, place.windows) - 1").alias("mask"))
    masks = whole.unionByName(open_masks)
    return pieces.join(masks, ["anchor", "piece"]).groupBy("key").agg(F.collect_list(F.struct("start", "mask")).alias("spans"))


def _covered(n: int, spans: list[dict], length: int) -> np.ndarray:
    edges = np.zeros(n + 1, dtype=np.int64)
    for span in spans:
        mask, start = span["mask"], span["start"]
        while mask:
            if mask & 1:
                edges[start] += 1
                edges[start + length] -= 1
            mask >>= 1
            start += 1
    return np.cumsum(edges[:-1]) > 0


def without_repeats(documents: DataFrame, length: int = 35, shard: int = SHARD) -> DataFrame:
    """documents with a struct column `__kept`: n_words, n_removed and, where words were removed, the kept text.

    The kept words are joined by one space; where nothing was removed the kept text is null.
    """
    keyed = documents.withColumn("__key", F.xxhash64("doc_id", "text"))
    narrow = keyed.select(F.col("__key").alias("key"), "doc_id", "text")
    spans = repeated_windows(narrow, length, shard)

    @F.arrow_udf("n_words long, n_removed long, text string")
    def keep(texts: pa.Array, found: pa.Array) -> pa.Array:
        out = []
        for rows, words in word_runs(pa.RecordBatch.from_arrays([texts], ["text"])):
            for d, marked in enumerate(found[rows].to_pylist()):
                n, text, removed = int(words.counts[d]), None, 0
                if marked:
                    gone = _covered(n, marked, length)
                    removed = int(gone.sum())
                    left = words.first[d] + np.flatnonzero(~gone)
                    data = words.data
                    text = b" ".join(data[a:b].tobytes() for a, b in zip(words.starts[left], words.ends[left])).decode()
                out.append({"n_words": n, "n_removed": removed, "text": text})
        return pa.array(out, pa.struct([("n_words", pa.int64()), ("n_removed", pa.int64()), ("text", pa.string())]))

    found = spans.select(F.col("key").alias("__key"), F.col("spans").alias("__spans"))
    return keyed.join(found, "__key", "left").withColumn("__kept", keep("text", "__spans")).drop("__key", "__spans")


def substring_report(documents: DataFrame, length: int = 35, shard: int = SHARD) -> DataFrame:
    """doc_id, n_words, n_removed and the SHA-256 of the kept words of every row."""
    kept = without_repeats(documents.select("doc_id", "text"), length, shard)
    # where nothing went, the words joined by one space
    plain = F.trim(F.regexp_replace(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+", " "))
    return kept.select("doc_id", "__kept.n_words", "__kept.n_removed", F.sha2(F.coalesce("__kept.text", plain), 256).alias("kept_sha256"))


def remove_repeats(documents: DataFrame, length: int = 35, shard: int = SHARD) -> DataFrame:
    """The documents with repeated passages taken out of their texts (and n_chars, if there is one, counted anew)."""
    kept = without_repeats(documents, length, shard)
    text = F.coalesce("__kept.text", "text")
    changes = {"text": text}
    if "n_chars" in documents.columns:
        changes["n_chars"] = F.when(F.col("__kept.text").isNull(), F.col("n_chars")).otherwise(F.char_length("__kept.text").cast(documents.schema["n_chars"].dataType))
    return kept.withColumns(changes).drop("__kept").select(*documents.columns)
