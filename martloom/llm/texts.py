"""Words and word hashes of Arrow text columns, vectorised over the bytes of many documents at once.

White space is \\x20 and \\x09-\\x0D, which are single bytes in UTF-8, so all work is on bytes. A null text has no words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text handled at once; temporary arrays take some 60 times as much.
SLICE_BYTES = 1 << 18

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20
_BYTE_HASH = np.random.default_rng(20240301).integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_ROOT = 0x9E3779B97F4A7C15
_INVERSE = pow(_ROOT, -1, 2**64)
_powers: dict[int, np.ndarray] = {}


def mix(h: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit hashes."""
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xFF51AFD7ED558CCD)
    return h ^ (h >> np.uint64(32))


def powers(base: int, n: int) -> np.ndarray:
    """base ** 0 ... base ** (n - 1), modulo 2 ** 64."""
    known = _powers.get(base)
    if known is None or len(known) < n:
        size = max(n, SLICE_BYTES + 1)
        known = np.empty(size, dtype=np.uint64)
        known[0], filled = 1, 1
        while filled < size:
            more = min(filled, size - filled)
            known[filled : filled + more] = known[:more] * np.uint64(pow(base, filled, 2**64))
            filled += more
        if n <= 1 << 22:
            _powers[base] = known
    return known[:n]


def ranged_hash(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of values[start:end] for each range: equal ranges of values have equal hashes."""
    n = len(values)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(values * powers(_ROOT, n), out=sums[1:])
    return mix((sums[ends] - sums[starts]) * powers(_INVERSE, n + 1)[starts] + (ends - starts).astype(np.uint64))


class Words:
    """The words of a run of documents. `first[d]:first[d + 1]` are the words of document d."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, lower: bool):
        self.data = _LOWER[data] if lower else data
        self.offsets = offsets
        solid = ~_SPACE[data]
        begins, stops = solid.copy(), solid.copy()
        begins[1:] &= ~solid[:-1]
        stops[:-1] &= ~solid[1:]
        edges = offsets[:-1][offsets[1:] > offsets[:-1]]
        begins[edges] = solid[edges]
        edges = offsets[1:][offsets[1:] > offsets[:-1]] - 1
        stops[edges] = solid[edges]
        self.starts = np.flatnonzero(begins)
        self.ends = np.flatnonzero(stops) + 1
        self.first = np.searchsorted(self.starts, offsets)
        self.counts = np.diff(self.first)

    def hashes(self) -> np.ndarray:
        return ranged_hash(_BYTE_HASH[self.data], self.starts, self.ends)

    def document(self, d: int) -> bytes:
        return self.data[self.offsets[d] : self.offsets[d + 1]].tobytes()


def slices(batch: pa.RecordBatch, column: str = "text", limit: int = SLICE_BYTES) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
    """Runs of rows of about `limit` bytes: the rows, the bytes of their texts, and the offsets of each text."""
    texts = batch.column(batch.schema.get_field_index(column))
    if pa.types.is_large_string(texts.type):
        texts = texts.cast(pa.string())
    n = len(texts)
    if n == 0:
        return
    raw = texts.buffers()
    offsets = np.frombuffer(raw[1], dtype=np.int32)[texts.offset : texts.offset + n + 1].astype(np.int64)
    data = np.frombuffer(raw[2], dtype=np.uint8) if raw[2] is not None else np.zeros(0, dtype=np.uint8)
    at = 0
    while at < n:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1)
        low = offsets[at]
        yield slice(at, to), data[low : offsets[to]], offsets[at : to + 1] - low
        at = to


def word_runs(batch: pa.RecordBatch, lower: bool = False) -> Iterator[tuple[slice, Words]]:
    for rows, data, offsets in slices(batch):
        yield rows, Words(data, offsets, lower)


def gram_hashes(words: np.ndarray, first: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of n consecutive words that lie in one document, and the index of their first word."""
    total = len(words) - n + 1
    if total <= 0:
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
    grams = np.zeros(total, dtype=np.uint64)
    for k in range(n):
        grams += words[k : k + total] * np.uint64(pow(_ROOT, 2 * k + 1, 2**64))
    inside = np.ones(total, dtype=bool)
    for k in range(1, n):  # a gram that reaches over the end of a document is none
        edges = first[1:-1] - k
        inside[edges[(edges >= 0) & (edges < total)]] = False
    at = np.flatnonzero(inside)
    return mix(grams[at]), at


def signed(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)


def kept_offsets(words: Words, n: int) -> np.ndarray:
    """Offsets of the n-grams of each document in what gram_hashes returns."""
    return np.concatenate([[0], np.cumsum(np.maximum(words.counts - n + 1, 0))])
