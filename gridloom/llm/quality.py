"""Byte-level convolutional network for text quality.

Bytes are embedded, filters of eight bytes run over them in steps of four, and
each of the overlapping chunks that cover the whole document keeps the largest
and the mean response of every filter. A small layer turns a chunk into one
value; the largest and the mean value of all chunks give the probability.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.llm.common import SLICE_ROWS, give_back
from gridloom.llm.learning import Adam, is_held_out, sigmoid, sparing_threshold, training_rows

SIZE = 8  # of a byte's embedding
STEP = 4  # bytes between two places of a filter, which covers two steps
FILTERS = 24
HALF = 32  # filter places in half a chunk: chunks of 256 bytes overlap by half
HIDDEN = 12
EPOCHS = 9
CUT = 0.5  # a score from here on is good
# The cut spares so much of label 1 in the held-back fifth, as long as it rejects so
# much of what it would reject where precision and recall are best together.
SPARED = 0.995
KEPT = 0.9
SCORED_BYTES = 1 << 18  # held at a time; a longer document is scored in pieces

PIECE = HALF * STEP


@dataclass
class Model:
    weights: dict[str, np.ndarray]
    shift: float = 0.0


def padded(text: bytes) -> bytes:
    """At least one chunk, and whole halves: zero bytes follow the text."""
    return text + b"\0" * (max(2 * PIECE, -(-len(text) // PIECE) * PIECE) - len(text))


def _after(w: dict[str, np.ndarray]) -> np.ndarray:
    """What follows a document's last step: zero bytes, never another document."""
    return w["bytes"][np.zeros(STEP, np.int64)].reshape(1, -1)


def _last_steps(docs: list[np.ndarray]) -> np.ndarray:
    """The last step of each document among those of all in a row."""
    return np.cumsum([len(d) // STEP for d in docs]) - 1


def _halves(w: dict[str, np.ndarray], data: np.ndarray, last: np.ndarray, keep: bool = False):
    """Largest and mean response of every filter in each half chunk."""
    x = w["bytes"][data].reshape(-1, STEP * SIZE)
    z = x @ w["first"] + w["shift"]
    following = np.concatenate([x[1:], _after(w)]) @ w["second"]
    following[last] = _after(w) @ w["second"]
    z += following
    np.maximum(z, 0, out=z)
    z = z.reshape(-1, HALF, FILTERS)
    return z.max(axis=1), z.mean(axis=1), (x, z) if keep else None


def _chunks(w: dict[str, np.ndarray], top: np.ndarray, mean: np.ndarray):
    """Value of each chunk of two neighbouring halves."""
    features = np.concatenate([np.maximum(top[:-1], top[1:]), (mean[:-1] + mean[1:]) / 2], axis=1)
    hidden = np.maximum(features @ w["hidden"] + w["hidden_shift"], 0)
    return features, hidden, hidden @ w["value"]


def train(rows: list[tuple[str, int, str | None]], *, seed: int = 5, epochs: int = EPOCHS) -> Model:
    """Fit on four fifths of the sample; the last fifth sets the score that 0.5
    stands for. Without both labels every document scores next to 1."""
    rng = np.random.default_rng(seed)
    scale = lambda *shape: (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)
    w = {
        "bytes": scale(256, SIZE) * 8, "first": scale(STEP * SIZE, FILTERS), "second": scale(STEP * SIZE, FILTERS),
        "shift": np.zeros(FILTERS, np.float32), "hidden": scale(2 * FILTERS, HIDDEN),
        "hidden_shift": np.zeros(HIDDEN, np.float32), "value": scale(HIDDEN),
        "out": np.array([0.5, 0.5, 0], np.float32),
    }
    model = Model(w)
    labels = np.array([r[1] for r in rows])
    if len(set(labels.tolist())) < 2:
        w["out"][:] = 0, 0, 10
        return model
    docs = [np.frombuffer(padded(r[0].encode("utf-8", "surrogatepass")), np.uint8) for r in rows]
    order = rng.permutation(len(rows))
    check, fit = order[: len(rows) // 5], order[len(rows) // 5:]
    balance = np.array([len(fit) / 2 / max(1, (labels[fit] == v).sum()) for v in (0, 1)])
    adam = Adam(w, 0.004)
    for _ in range(epochs):
        rng.shuffle(fit)
        for at in range(0, len(fit), 32):
            some = fit[at:at + 32]
            _learn(w, adam, [docs[i] for i in some], labels[some], balance[labels[some]])
    if len(set(labels[check].tolist())) < 2:  # too few labels to hold some back
        check = order
    raw = np.array([_logit(w, [docs[i]])[0] for i in check])
    model.shift = -sparing_threshold(-raw, 1 - labels[check], SPARED, KEPT)
    return model


def _spans(docs: list[np.ndarray]):
    """Chunks of each document among those of all halves in a row; the ones that
    would reach over a border are in none."""
    starts = np.cumsum([0, *(len(d) // PIECE for d in docs)])
    return [(int(a), int(b) - 1) for a, b in zip(starts, starts[1:])]


def _logit(w: dict[str, np.ndarray], docs: list[np.ndarray]) -> np.ndarray:
    top, mean, _ = _halves(w, np.concatenate(docs), _last_steps(docs))
    values = _chunks(w, top, mean)[2]
    pooled = np.array([(values[a:b].max(), values[a:b].mean(), 1) for a, b in _spans(docs)])
    return pooled @ w["out"]


def _learn(w, adam: Adam, docs: list[np.ndarray], labels: np.ndarray, weight: np.ndarray) -> None:
    data = np.concatenate(docs)
    last = _last_steps(docs)
    top, mean, (x, z) = _halves(w, data, last, keep=True)
    features, hidden, values = _chunks(w, top, mean)
    spans = _spans(docs)
    best = np.array([a + int(values[a:b].argmax()) for a, b in spans])
    pooled = np.array([(values[i], values[a:b].mean(), 1) for i, (a, b) in zip(best, spans)], np.float32)
    error = ((sigmoid(pooled @ w["out"]) - labels) * weight / len(docs)).astype(np.float32)
    to_values = np.zeros(len(values), np.float32)
    for e, i, (a, b) in zip(error, best, spans):
        to_values[a:b] += e * w["out"][1] / (b - a)
        to_values[i] += e * w["out"][0]
    gradients = {"out": pooled.T @ error, "value": hidden.T @ to_values}
    to_hidden = np.outer(to_values, w["value"]) * (hidden > 0)
    gradients |= {"hidden": features.T @ to_hidden, "hidden_shift": to_hidden.sum(axis=0)}
    to_features = to_hidden @ w["hidden"].T
    to_max, to_mean = to_features[:, :FILTERS], to_features[:, FILTERS:] / 2
    halves_max, halves_mean = np.zeros_like(top), np.zeros_like(mean)
    left = top[:-1] >= top[1:]
    halves_max[:-1] += to_max * left
    halves_max[1:] += to_max * ~left
    halves_mean[:-1] += to_mean
    halves_mean[1:] += to_mean
    dz = np.repeat(halves_mean[:, None, :] / HALF, HALF, axis=1)
    where = z.argmax(axis=1)
    n, f = np.indices(where.shape)
    dz[n, where, f] += halves_max
    dz *= z > 0
    dz = dz.reshape(-1, FILTERS)
    at_ends = dz[last].sum(axis=0, keepdims=True)
    inner = dz.copy()
    inner[last] = 0
    gradients |= {"shift": dz.sum(axis=0), "first": x.T @ dz,
                  "second": x[1:].T @ inner[:-1] + _after(w).T @ at_ends}
    dx = dz @ w["first"].T
    dx[1:] += inner[:-1] @ w["second"].T
    dx = dx.reshape(-1, SIZE)
    gradients["bytes"] = np.stack(
        [np.bincount(data, dx[:, i], 256) for i in range(SIZE)], axis=1).astype(np.float32)
    gradients["bytes"][0] += (at_ends @ w["second"].T).reshape(STEP, SIZE).sum(axis=0)
    adam.step(gradients)


class _Scorer:
    def __init__(self, model: Model):
        self.w, self.shift = model.weights, model.shift

    def _long(self, data: bytes) -> float:
        """A document in pieces; neighbouring pieces share a half, so every chunk is seen once."""
        total, count, best, at = 0.0, 0, -np.inf, 0
        halves = len(data) // PIECE
        step = SCORED_BYTES // PIECE
        while at < halves - 1:
            end = min(halves, at + step)
            # One more half is read, for filters that reach over the end of the last one.
            piece = np.frombuffer(data[at * PIECE:min(halves, end + 1) * PIECE], np.uint8)
            top, mean, _ = _halves(self.w, piece, _last_steps([piece]))
            values = _chunks(self.w, top[:end - at], mean[:end - at])[2]
            total, count, best = total + values.sum(), count + len(values), max(best, values.max())
            at = end - 1
        return float(np.array([best, total / count, 1]) @ self.w["out"])

    def scores(self, texts: list[str]) -> np.ndarray:
        out, held, docs, at = np.zeros(len(texts)), 0, [], []

        def flush():
            if docs:
                out[at] = _logit(self.w, docs)
                docs.clear(), at.clear()

        for i, text in enumerate(texts):
            data = padded(text.encode("utf-8", "surrogatepass"))
            if len(data) > SCORED_BYTES:
                out[i] = self._long(data)
                continue
            if held + len(data) > SCORED_BYTES:
                flush()
                held = 0
            docs.append(np.frombuffer(data, np.uint8))
            at.append(i)
            held += len(data)
        flush()
        return sigmoid(out - self.shift)


def scorer(model: Model):
    """A column function from whole texts to scores; null counts as empty."""
    held: list[_Scorer] = []

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        if not held:
            give_back()
            held.append(_Scorer(model))
        found = [np.empty(0)]
        for at in range(0, len(texts), SLICE_ROWS):
            found.append(held[0].scores(["" if t is None else t for t in texts.slice(at, SLICE_ROWS).to_pylist()]))
        return pa.array(np.concatenate(found), pa.float64())

    return score


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    return train(training_rows(docs, labels, "quality", folds=3, held=1))


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Score of every whole text.

    Result per row: ``doc_id``, ``held_out`` (its fold is not learned from),
    ``score`` (0 to 1), ``predicted`` (score of at least 0.5). Null counts as
    empty text, which is scored as a chunk of zero bytes. Repeated rows and
    null keys give a row each; other columns are ignored; an empty table gives
    none. Without labels of both kinds all score next to 1.
    """
    scored = docs.select("doc_id", scorer(fit(docs, labels))(F.col("text")).alias("score"))
    return scored.select(
        "doc_id", is_held_out(F.col("doc_id"), 3, 1).alias("held_out"), "score",
        (F.col("score") >= CUT).cast("int").alias("predicted"),
    )


def good_only(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows, with all their columns, that score at least 0.5."""
    name = "__quality"
    while name in docs.columns:
        name += "_"
    scored = docs.withColumn(name, scorer(fit(docs, labels))(F.col("text")))
    return scored.where(F.col(name) >= CUT).select(*[F.col(f"`{c}`") for c in docs.columns])
