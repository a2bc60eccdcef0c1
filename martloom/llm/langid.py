"""Language identification by a bidirectional gated recurrent network over bytes, trained here by backpropagation through time.

A text is lower-cased and read word by word (pieces of at most MAX_PIECE bytes). Over the bytes of a piece two gated
recurrent units run, one forward and one backward; their states label every byte position with a distribution over the
learned languages. A document's distribution is the mean over all its positions, so its whole text counts. The labels of a
piece depend on the piece alone, so each distinct piece is run once and weighed by how often it stands in the document.

Defined results: `und` with score 0 for a null text, a text without a letter, and where nothing was learned; repeated rows
get equal results; an empty table gives no rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.llm.sampling import class_sample, held_out

MAX_PIECE = 24
#: Distinct pieces a task remembers; the memory is emptied when it is full.
REMEMBERED = 200_000


def pieces(text: str) -> list[bytes]:
    words = text.lower().encode("utf-8", "surrogatepass").split()
    if all(len(w) <= MAX_PIECE for w in words):
        return words
    return [w[i : i + MAX_PIECE] for w in words for i in range(0, len(w), MAX_PIECE)]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def run_gates(inputs: np.ndarray, recurrent: np.ndarray, codes: np.ndarray, keep: bool = False):
    """States (B, T, H) of a gated recurrent unit over codes (B, T); with `keep` also what its gradient needs."""
    width = recurrent.shape[0]
    state = np.zeros((len(codes), width), dtype=np.float32)
    states = np.empty((codes.shape[1], len(codes), width), dtype=np.float32)
    kept = []
    for t in range(codes.shape[1]):
        into = inputs[codes[:, t]]
        back = state @ recurrent
        gates = _sigmoid(into[:, : 2 * width] + back[:, : 2 * width])
        update, reset = gates[:, :width], gates[:, width:]
        new = np.tanh(into[:, 2 * width :] + reset * back[:, 2 * width :])
        if keep:
            kept.append((state, update, reset, new, back[:, 2 * width :]))
        state = new + update * (state - new)
        states[t] = state
    return (states, kept) if keep else states


def gate_gradient(recurrent, codes, kept, above, d_inputs, d_recurrent) -> None:
    """Adds the gradients of one unit, back through time. above: (T, B, H), the gradients at its states."""
    width = recurrent.shape[0]
    ahead = np.zeros_like(above[0])
    for t in reversed(range(codes.shape[1])):
        state, update, reset, new, back = kept[t]
        d = above[t] + ahead
        d_new = d * (1 - update) * (1 - new * new)
        d_update = d * (state - new) * update * (1 - update)
        d_reset = d_new * back * reset * (1 - reset)
        np.add.at(d_inputs, codes[:, t], np.concatenate([d_update, d_reset, d_new], axis=1))
        d_back = np.concatenate([d_update, d_reset, d_new * reset], axis=1)
        d_recurrent += state.T @ d_back
        ahead = d * update + d_back @ recurrent.T


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def position_labels(model: dict, codes: np.ndarray) -> np.ndarray:
    """(T, B, languages): the distribution at every byte of pieces of one length, codes (B, T)."""
    ahead = run_gates(model["in_f"], model["rec_f"], codes)
    behind = run_gates(model["in_b"], model["rec_b"], codes[:, ::-1])[::-1]
    width = ahead.shape[2]
    return _softmax(ahead @ model["out"][:width] + behind @ model["out"][width:] + model["bias"])


def train(samples: list[tuple[str, str]], width: int = 8, steps: int = 700, batch: int = 192, seed: int = 1) -> dict:
    """The network's arrays and `langs`, from (text, lang) pairs."""
    langs = sorted({lang for _, lang in samples})
    rng = np.random.default_rng(seed)
    n = max(1, len(langs))
    scale = lambda *shape: rng.normal(0, 0.3, shape).astype(np.float32)
    model = {
        "in_f": scale(256, 3 * width), "rec_f": scale(width, 3 * width), "in_b": scale(256, 3 * width),
        "rec_b": scale(width, 3 * width), "out": scale(2 * width, n), "bias": np.zeros(n, dtype=np.float32),
    }
    by_length: dict[int, Counter] = {}
    for text, lang in samples:
        for piece, count in Counter(pieces(text)).items():
            by_length.setdefault(len(piece), Counter())[piece, langs.index(lang)] += count
    lengths = sorted(by_length)
    if len(langs) < 2 or not lengths:
        return model | {"langs": langs}
    totals = np.zeros(len(langs))
    for counts in by_length.values():
        for (_, label), count in counts.items():
            totals[label] += count
    data = []
    for length in lengths:
        found = sorted(by_length[length].items())
        codes = np.frombuffer(b"".join(p for (p, _), _ in found), dtype=np.uint8).reshape(-1, length)
        labels = np.array([label for (_, label), _ in found])
        weight = np.array([c for _, c in found]) / np.maximum(totals[labels], 1)
        data.append((codes, labels, np.cumsum(weight)))
    share = np.array([d[2][-1] for d in data])
    share /= share.sum()
    first, second = ({k: np.zeros_like(v) for k, v in model.items()} for _ in range(2))
    for step in range(1, steps + 1):
        codes, labels, sums = data[rng.choice(len(data), p=share)]
        at = np.minimum(np.searchsorted(sums, rng.random(batch) * sums[-1]), len(labels) - 1)
        grads = _gradients(model, codes[at], labels[at])
        rate = 0.02 * (1 - step / (steps + 1)) + 0.001
        for k, g in grads.items():
            first[k] += 0.1 * (g - first[k])
            second[k] += 0.01 * (g * g - second[k])
            model[k] -= rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-7)
    return model | {"langs": langs}


def _gradients(model: dict, codes: np.ndarray, labels: np.ndarray) -> dict:
    """Gradients of the mean cross entropy over all positions."""
    ahead, kept_f = run_gates(model["in_f"], model["rec_f"], codes, keep=True)
    turned = codes[:, ::-1]
    behind, kept_b = run_gates(model["in_b"], model["rec_b"], turned, keep=True)
    both = np.concatenate([ahead, behind[::-1]], axis=2)
    error = _softmax(both @ model["out"] + model["bias"])
    error[:, np.arange(len(labels)), labels] -= 1
    error /= codes.size
    grads = {k: np.zeros_like(v) for k, v in model.items()}
    flat = both.reshape(-1, both.shape[2])
    grads["out"] += flat.T @ error.reshape(-1, error.shape[2])
    grads["bias"] += error.sum(axis=(0, 1))
    above = error @ model["out"].T
    width = ahead.shape[2]
    gate_gradient(model["rec_f"], codes, kept_f, above[:, :, :width], grads["in_f"], grads["rec_f"])
    gate_gradient(model["rec_b"], turned, kept_b, above[::-1, :, width:], grads["in_b"], grads["rec_b"])
    return grads


class Labeller:
    """Pools the labels of documents; remembers the sums of pieces already run."""

    def __init__(self, model: dict):
        self.model = model
        self.forget()

    def forget(self) -> None:
        self.known: dict[bytes, int] = {}
        self.sums = np.zeros((1024, len(self.model["langs"])), dtype=np.float32)

    def learn(self, new: list[bytes]) -> None:
        need = len(self.known) + len(new)
        if need > len(self.sums):
            self.sums = np.concatenate([self.sums, np.zeros((max(need, len(self.sums)), self.sums.shape[1]), dtype=np.float32)])
        new.sort(key=len)
        at = 0
        while at < len(new):
            length = len(new[at])
            to = at
            while to < len(new) and len(new[to]) == length and to - at < 2048:
                to += 1
            codes = np.frombuffer(b"".join(new[at:to]), dtype=np.uint8).reshape(-1, length)
            rows = np.arange(len(self.known), len(self.known) + to - at)
            self.sums[rows] = position_labels(self.model, codes).sum(axis=0)
            self.known.update(zip(new[at:to], rows.tolist()))
            at = to

    def pool(self, texts: Iterable[str | None]) -> list[tuple[str, float]]:
        counted = [Counter(pieces(t)) if t is not None and any(map(str.isalpha, t)) else None for t in texts]
        fresh = set().union(*(c.keys() for c in counted if c)) - self.known.keys()
        if len(self.known) + len(fresh) > REMEMBERED:
            self.forget()
            fresh = set().union(*(c.keys() for c in counted if c))
        self.learn(list(fresh))
        langs, answers = self.model["langs"], []
        for counts in counted:
            if not counts or not langs:
                answers.append(("und", 0.0))
                continue
            rows = np.fromiter(map(self.known.__getitem__, counts), dtype=np.int64, count=len(counts))
            times = np.fromiter(counts.values(), dtype=np.float64, count=len(counts))
            pooled = times @ self.sums[rows]
            best = int(pooled.argmax())
            answers.append((langs[best], float(min(1.0, pooled[best] / pooled.sum()))))
        return answers


def text_runs(batch: pa.RecordBatch, limit: int = 1 << 20) -> Iterator[list[str | None]]:
    """The texts of a batch as Python strings, some `limit` characters at a time."""
    column = batch.column(batch.schema.get_field_index("text"))
    run, held = [], 0
    for value in column:
        text = value.as_py()
        run.append(text)
        held += len(text or "")
        if held >= limit:
            yield run
            run, held = [], 0
    if run:
        yield run


def identify(documents: DataFrame, model: dict) -> DataFrame:
    """doc_id, lang_pred and score of every row of documents (doc_id, text)."""
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labeller = Labeller(shared.value)
        for batch in batches:
            answers = [a for run in text_runs(batch) for a in labeller.pool(run)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(batch.schema.get_field_index("doc_id")),
                    pa.array([a for a, _ in answers], pa.string()),
                    pa.array([s for _, s in answers], pa.float64()),
                ],
                ["doc_id", "lang_pred", "score"],
            )

    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.select("doc_id", "text").mapInArrow(label, f"doc_id {kind}, lang_pred string, score double")


def language_report(documents: DataFrame, per_class: int = 120, longest: int = 20_000, seed: int = 1) -> DataFrame:
    """Learns from the rows that are not held out and labels all rows."""
    learn = documents.select("doc_id", "text", "lang").filter(~held_out(F.col("doc_id")))
    model = train(class_sample(learn, "lang", per_class, longest, seed), seed=seed)
    found = identify(documents, model)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
