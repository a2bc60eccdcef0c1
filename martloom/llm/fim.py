"""Fill-in-middle: a text is cut into prefix, middle and suffix at unit ends, and the parts are put in another order.

Every character has a class (line end, blank, sentence end, letter, digit, sign, other), and a wavelet matrix over the
classes of a run of texts answers rank(class, place) in as many steps as a class has bits. A unit ends behind any character
of some classes, so the units up to a place are the sum of those classes' ranks. The cut behind the k-th unit is found by
select where one class ends units (lines), and by bisection on the summed ranks otherwise; all texts of a run at once.

Which ends are cut follows from hashes of the id: with h1 to h4 the first four 8-digit groups of the hex sha256 of
"<seed>:<id>" as integers and n units, the prefix ends after min(h1 % (n + 1), h2 % (n + 1)) units and the middle after the
larger; h3 % 100 >= rate leaves the text plain; h4 % 100 < spm gives the form spm, else psm.

Defined results: a null text is an empty one; an empty text, or one that contains a mark, stays plain; a null id is hashed
as the word null; equal rows give equal results; units and places are counted in code points; an empty table gives no rows.
Only doc_id and text are read, so other columns may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache
from itertools import permutations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LINE_END, BLANK, SENTENCE_END, LETTER, DIGIT, SIGN, OTHER = range(7)
CLASS_BITS = 3
#: Classes whose characters end a unit: `[^\n]*\n|[^\n]+` for lines, and so on.
LINES, SENTENCES, WORDS = (LINE_END,), (LINE_END, SENTENCE_END), (LINE_END, BLANK)
#: Bytes of text for which one wavelet matrix is built; a longer text has one of its own.
RUN_BYTES = 1 << 20


@cache
def class_table() -> np.ndarray:
    """The class of each code point up to 0xFFFF; those beyond count as 0xFFFF, which is no character."""

    def one(c: str) -> int:
        if c == "\n":
            return LINE_END
        if c.isspace():
            return BLANK
        if c in ".!?。！？":
            return SENTENCE_END
        if c.isalpha():
            return LETTER
        if c.isdecimal():
            return DIGIT
        return SIGN if c.isprintable() else OTHER

    return np.fromiter((one(chr(c)) for c in range(0x10000)), dtype=np.uint8, count=0x10000)


class BitRow:
    """Bits with rank and select: ones up to each 64-bit word are counted beforehand."""

    def __init__(self, bits: np.ndarray):
        packed = np.packbits(bits, bitorder="little")
        self.words = np.zeros(len(bits) // 64 + 1, dtype=np.uint64)
        self.words.view(np.uint8)[: len(packed)] = packed
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)])
        self.zeros = len(bits) - int(self.before[-1])

    def ones_to(self, at: np.ndarray) -> np.ndarray:
        word = at >> 6
        low = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & low)

    def place_of(self, bit: int, k: np.ndarray) -> np.ndarray:
        """Place of the k-th (from 0) one or zero."""
        before = self.before if bit else np.arange(len(self.before)) * 64 - self.before
        word = np.searchsorted(before, k, side="right") - 1
        left = k - before[word]
        held = self.words[word] if bit else ~self.words[word]
        at = np.zeros_like(left)
        for width in (32, 16, 8, 4, 2, 1):  # the half of the word that holds it
            low = np.bitwise_count((held >> at.astype(np.uint64)) & np.uint64((1 << width) - 1))
            right = left >= low
            left, at = left - np.where(right, low, 0), at + np.where(right, width, 0)
        return word * 64 + at


class WaveletMatrix:
    def __init__(self, classes: np.ndarray):
        self.rows = []
        for level in reversed(range(CLASS_BITS)):
            bits = (classes >> level & 1).astype(bool)
            self.rows.append(BitRow(bits))
            classes = np.concatenate([classes[~bits], classes[bits]])

    def _down(self, kind: int, at: np.ndarray) -> np.ndarray:
        for level, row in zip(reversed(range(CLASS_BITS)), self.rows):
            ones = row.ones_to(at)
            at = row.zeros + ones if kind >> level & 1 else at - ones
        return at

    def rank(self, kind: int, at: np.ndarray) -> np.ndarray:
        """How many of the first `at` characters are of a class."""
        return self._down(kind, at) - self._down(kind, np.zeros(1, dtype=np.int64))

    def select(self, kind: int, k: np.ndarray) -> np.ndarray:
        """Place of the k-th (from 0) character of a class, which must exist."""
        at = self._down(kind, np.zeros(1, dtype=np.int64)) + k
        for level, row in zip(range(CLASS_BITS), reversed(self.rows)):
            bit = kind >> level & 1
            at = row.place_of(bit, at - row.zeros if bit else at)
        return at

    def ends_to(self, unit: tuple[int, ...], at: np.ndarray) -> np.ndarray:
        """How many of the first `at` characters end a unit."""
        return sum(self.rank(kind, at) for kind in unit)

    def behind_end(self, unit: tuple[int, ...], k: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """The place behind the k-th (from 1, of all texts) unit end, which lies in [low, high)."""
        if len(unit) == 1:
            return self.select(unit[0], k - 1) + 1
        low, high = low.copy(), high.copy()
        while (low < high).any():  # the least place with k ends before it
            middle = (low + high) >> 1
            enough = self.ends_to(unit, middle) >= k
            low, high = np.where(enough | (low >= high), low, middle + 1), np.where(enough, middle, high)
        return low


def cuts_of(texts: list[str], unit: tuple[int, ...], h1: np.ndarray, h2: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Units, end of the prefix and end of the middle of each text, in code points."""
    points = np.frombuffer("".join(texts).encode("utf-32-le"), dtype=np.uint32)
    matrix = WaveletMatrix(class_table()[np.minimum(points, 0xFFFF)])
    edges = np.concatenate([[0], np.cumsum(np.fromiter(map(len, texts), dtype=np.int64, count=len(texts)))])
    start, stop = edges[:-1], edges[1:]
    ends = matrix.ends_to(unit, edges)
    full = np.diff(ends)
    last = np.maximum(stop - 1, start)
    open_end = (stop > start) & (matrix.ends_to(unit, stop) == matrix.ends_to(unit, last))
    n = full + open_end

    def cut(k: np.ndarray) -> np.ndarray:
        place = np.where(k == 0, start, stop)
        inside = np.flatnonzero((k > 0) & (k <= full))
        place[inside] = matrix.behind_end(unit, (ends[:-1] + k)[inside], start[inside], stop[inside])
        return place - start

    a, b = h1 % (n + 1), h2 % (n + 1)
    return n, cut(np.minimum(a, b)), cut(np.maximum(a, b))


def _runs(texts: pa.Array) -> Iterator[slice]:
    sizes = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False)) if len(texts) else np.zeros(0)
    at = 0
    while at < len(texts):
        done = sizes[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(sizes, done + RUN_BYTES, side="right")))
        yield slice(at, to)
        at = to


def cut_places(text: Column, h1: Column, h2: Column, unit: tuple[int, ...]) -> Column:
    """Struct of units, prefix_end and middle_end of a text that is not null."""

    @F.arrow_udf("struct<units: bigint, prefix_end: bigint, middle_end: bigint>")
    def places(texts: pa.Array, first: pa.Array, second: pa.Array) -> pa.Array:
        h = [x.to_numpy(zero_copy_only=False) for x in (first, second)]
        found = [cuts_of(texts[s].to_pylist(), unit, h[0][s], h[1][s]) for s in _runs(texts)]
        columns = [np.concatenate([f[i] for f in found]) if found else np.zeros(0, dtype=np.int64) for i in range(3)]
        return pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in columns], ["units", "prefix_end", "middle_end"])

    return places(text, h1, h2)


@dataclass(frozen=True)
class Marks:
    """Words that stand before the parts. None may begin within or behind another's start, so that parts can be told apart."""

    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"

    def __post_init__(self):
        marks = (self.prefix, self.suffix, self.middle)
        overlaps = any(a[i:] == b[: len(a) - i] for a in marks for b in marks for i in range(1, len(a)))
        if not all(marks) or overlaps or any(a in b for a, b in permutations(marks, 2)):
            raise ValueError(f"marks overlap: {marks}")


def fill_in_middle(
    documents: DataFrame, unit: tuple[int, ...] = LINES, seed: int = 7, rate: int = 100, spm: int = 50, marks: Marks = Marks()
) -> DataFrame:
    """doc_id, n (units), form (plain, psm or spm), prefix_chars, middle_chars (null if plain) and output of every document."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))), 256)
    hashed = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), digest.alias("digest"))
    h = [F.conv(F.substring("digest", 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]
    placed = hashed.select("doc_id", "text", h[2].alias("h3"), h[3].alias("h4"), cut_places(F.col("text"), h[0], h[1], unit).alias("cut"))
    text = F.col("text")
    marked = text.contains(marks.prefix) | text.contains(marks.suffix) | text.contains(marks.middle)
    plain = (text == "") | marked | (F.col("h3") % 100 >= rate)
    a, b = F.col("cut.prefix_end").cast("int"), F.col("cut.middle_end").cast("int")
    rest = F.char_length(text) - b
    prefix, middle, suffix = text.substr(F.lit(1), a), text.substr(a + 1, b - a), text.substr(b + 1, rest)
    before, behind, between = F.lit(marks.prefix), F.lit(marks.suffix), F.lit(marks.middle)
    form = F.when(plain, "plain").when(F.col("h4") % 100 < spm, "spm").otherwise("psm")
    formed = placed.withColumn("form", form)
    is_plain = F.col("form") == "plain"
    output = (
        F.when(is_plain, text)
        .when(F.col("form") == "psm", F.concat(before, prefix, behind, suffix, between, middle))
        .otherwise(F.concat(behind, suffix, before, prefix, between, middle))
    )
    return formed.select(
        "doc_id",
        F.col("cut.units").alias("n"),
        "form",
        F.when(~is_plain, F.col("cut.prefix_end")).alias("prefix_chars"),
        F.when(~is_plain, F.col("cut.middle_end") - F.col("cut.prefix_end")).alias("middle_chars"),
        output.alias("output"),
    )


def restored(output: Column, form: Column, marks: Marks = Marks()) -> Column:
    """The text that an output of a form was made of."""

    def parts(first: str, second: str) -> tuple[Column, Column, Column]:
        body = F.substr(output, F.lit(len(first) + 1))
        a = F.substring_index(body, second, 1)
        body = F.substr(body, F.char_length(a) + len(second) + 1)
        b = F.substring_index(body, marks.middle, 1)
        return a, b, F.substr(body, F.char_length(b) + len(marks.middle) + 1)

    prefix, suffix, middle = parts(marks.prefix, marks.suffix)
    psm = F.concat(prefix, middle, suffix)
    suffix, prefix, middle = parts(marks.suffix, marks.prefix)
    return F.when(form == "plain", output).when(form == "psm", psm).otherwise(F.concat(prefix, middle, suffix))


def fim_report(documents: DataFrame) -> DataFrame:
    made = fill_in_middle(documents)
    return made.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )
