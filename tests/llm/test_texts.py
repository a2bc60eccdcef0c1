from __future__ import annotations

import numpy as np
import pyarrow as pa
from brute import LOWER, words
from hypothesis import given, settings
from hypothesis import strategies as st

from martloom.llm.texts import gram_hashes, kept_offsets, ranged_hash, word_runs

TEXT = st.none() | st.text(alphabet="aB é\t\n\x0b\x1c日.", max_size=30)


def batch_of(texts):
    return pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], ["text"])


@settings(max_examples=80, deadline=None)
@given(st.lists(TEXT, min_size=1, max_size=12), st.booleans())
def test_words_and_hashes(texts, lower):
    found, hashes = [], {}
    for rows, run in word_runs(batch_of(texts), lower):
        h = run.hashes()
        for d in range(len(run.counts)):
            at = range(run.first[d], run.first[d + 1])
            found.append([run.data[run.starts[i] : run.ends[i]].tobytes().decode() for i in at])
            for word, i in zip(found[-1], at):
                assert hashes.setdefault(word, h[i]) == h[i]
    expected = [words(t.translate(LOWER) if t and lower else t) for t in texts]
    assert found == expected
    assert len(set(hashes.values())) == len(hashes)


@settings(max_examples=50, deadline=None)
@given(st.lists(TEXT, min_size=1, max_size=12), st.integers(1, 4))
def test_grams_stay_in_their_document(texts, n):
    seen = {}
    for _, run in word_runs(batch_of(texts)):
        grams, at = gram_hashes(run.hashes(), run.first, n)
        offsets = kept_offsets(run, n)
        flat = [run.data[a:b].tobytes() for a, b in zip(run.starts, run.ends)]
        for d in range(len(run.counts)):
            mine = [tuple(flat[i : i + n]) for i in at[offsets[d] : offsets[d + 1]]]
            w = flat[run.first[d] : run.first[d + 1]]
            assert mine == [tuple(w[i : i + n]) for i in range(len(w) - n + 1)]
        for g, i in zip(grams.tolist(), at):
            assert seen.setdefault(tuple(flat[i : i + n]), g) == g
    assert len(set(seen.values())) == len(seen)


def test_slices_cover_long_texts_and_sliced_batches():
    texts = ["a b"] * 5 + ["x " * 400_000] + [None, "", "c d e"]
    counts = [int(c) for _, run in word_runs(batch_of(texts).slice(2)) for c in run.counts]
    assert counts == [2, 2, 2, 400_000, 0, 0, 3]


def test_ranges_with_equal_values_are_equal():
    values = np.array([5, 6, 7, 5, 6, 7, 5], dtype=np.uint64)
    h = ranged_hash(values, np.array([0, 3, 1, 0]), np.array([3, 6, 4, 2]))
    assert h[0] == h[1] and len(set(h.tolist())) == 3
