"""Convolutional text classifier over hashed word embeddings.

A word is the sum of hashed embeddings of itself and of its beginnings, so that
inflected and unseen forms share what was learned. Filters of several widths
run over the words of the whole document, each keeps its largest response, and
a logistic layer combines them. Starting weights come from a bounded sample;
then every labelled row is learned from by tasks whose weights are averaged, and
all rows of a held-back fifth set the thresholds.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.taskcontext import TaskContext

from gridloom.llm.common import BROADCAST_BYTES, SLICE_ROWS, give_back, slices
from gridloom.llm.learning import (
    Adam,
    best_cut,
    best_threshold,
    is_held_out,
    known_labels,
    sigmoid,
    sparing_cut,
    sparing_threshold,
    training_rows,
)
from gridloom.session import materialise

BUCKETS = 1 << 16
SIZE = 8
WIDTHS = (1, 2, 3)
FILTERS = 8
BEGINNINGS = (4, 5, 6)
EPOCHS = 6
RATE = 0.01
LATER_RATE = 0.004  # of the tasks that go on from common weights
TASK_ROWS = 2048  # a task goes on over at least so many rows, if there are as many
LEARNED_ROWS = 6000  # a smaller table is passed over again up to so many rows,
PASSES = 3  # and at most so often
BINS = 256  # of a logit's unit, in the counts that set thresholds
CHUNK = 1 << 15  # numbers that are added up as one row
CUT = 0.3  # a score from here on is toxic
# The cut spares so much of label 0 in the held-back fifth, as long as it keeps so
# much of what it would catch where precision and recall are best together.
SPARED = 0.995
KEPT = 0.9
CACHED_WORDS = 300_000
BATCH_WORDS = 200_000  # in documents held at a time
LEAST_LABELS = 20  # of each kind, for a language to get a threshold of its own

_SPACE = bytes(b if b >= 128 or chr(b).isalnum() or b == 39 else 32 for b in range(256))


def words_of(text: str) -> list[bytes]:
    return text.lower().encode("utf-8", "surrogatepass").translate(_SPACE).split()


def hashes_of(word: bytes) -> list[int]:
    """Buckets of a word and of its beginnings; shorter words repeat themselves."""
    return [xxhash.xxh32_intdigest(word) % BUCKETS] + [
        xxhash.xxh32_intdigest(word[:n], n) % BUCKETS for n in BEGINNINGS
    ]


@dataclass
class Model:
    weights: dict[str, np.ndarray]
    shift: float = 0.0
    thresholds: dict[str, float] | None = None

    def logits(self, vectors: np.ndarray, starts: np.ndarray) -> np.ndarray:
        return _pool(self.weights, vectors, starts)[0] @ self.weights["out"] + self.weights["bias"][0] - self.shift


def _pool(weights: dict[str, np.ndarray], vectors: np.ndarray, starts: np.ndarray, *, where: bool = False):
    """Largest response of each filter in each document, and its place.

    ``vectors``: words of all documents, each document followed by as many
    zero rows as the widest filter has words. Filters start at words and at the
    first zero row; from the others they would reach into the next document.
    """
    pooled, places = [], []
    ends = np.r_[starts[1:], len(vectors)]
    for width in WIDTHS:
        filters = weights[f"filter{width}"]
        z = np.zeros((len(vectors), FILTERS), np.float32) + weights[f"shift{width}"]
        for i in range(width):
            z[:len(vectors) - i] += vectors[i:] @ filters[i]
        for i in range(1, max(WIDTHS)):
            z[ends - i] = -np.inf
        top = np.maximum.reduceat(z, starts, axis=0)
        pooled.append(np.maximum(top, 0))
        if where:
            places.append(np.stack([a + z[a:b].argmax(axis=0) for a, b in zip(starts, ends)]))
    return np.concatenate(pooled, axis=1), places


def _layout(counts: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """First row of each document, and the rows that hold words."""
    pad = max(WIDTHS)
    starts = np.cumsum([0, *(n + pad for n in counts[:-1])])
    rows = np.concatenate([np.arange(n) + s for n, s in zip(counts, starts)]) if counts else np.empty(0, int)
    return starts, rows.astype(np.int64)


def _vectors(table: np.ndarray, ids: np.ndarray, counts: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    starts, rows = _layout(counts)
    vectors = np.zeros((sum(counts) + max(WIDTHS) * len(counts), SIZE), np.float32)
    if len(ids):
        vectors[rows] = table[ids].sum(axis=1) if ids.ndim == 2 else table[ids]
    return vectors, starts, rows


def _first_weights(rng: np.random.Generator) -> dict[str, np.ndarray]:
    scale = lambda *shape: (rng.standard_normal(shape) * 0.1).astype(np.float32)
    weights = {"table": scale(BUCKETS, SIZE), "out": np.full(len(WIDTHS) * FILTERS, 0.5, np.float32),
               "bias": np.full(1, -2.0, np.float32)}
    for width in WIDTHS:
        weights[f"filter{width}"] = scale(width, SIZE, FILTERS) * 3
        weights[f"shift{width}"] = np.zeros(FILTERS, np.float32)
    return weights


def train(rows: list[tuple[str, int, str | None]], *, seed: int = 11, epochs: int = EPOCHS) -> Model:
    """Fit on four fifths of the sample, calibrate on the last.

    Scores are shifted so that ``CUT`` is where precision and recall of label 1
    are best together on the held-back fifth, or higher by the trade-off of
    ``SPARED`` and ``KEPT``; languages with enough labels get a threshold of their
    own. Without both labels, every document scores next to 0.
    """
    rng = np.random.default_rng(seed)
    weights = _first_weights(rng)
    model = Model(weights, thresholds={})
    labels = np.array([r[1] for r in rows])
    if len(set(labels.tolist())) < 2:
        weights["out"][:] = 0
        weights["bias"][:] = -10
        return model
    docs = []
    for text, _, _ in rows:
        found = [hashes_of(w) for w in words_of(text)]
        docs.append(np.array(found, np.int64).reshape(len(found), 1 + len(BEGINNINGS)))
    order = rng.permutation(len(rows))
    check, fit = order[: len(rows) // 5], order[len(rows) // 5:]
    balance = {v: len(fit) / 2 / max(1, (labels[fit] == v).sum()) for v in (0, 1)}
    adam = Adam(weights, RATE)
    for _ in range(epochs):
        rng.shuffle(fit)
        for at in range(0, len(fit), 64):
            _learn(model, adam, [docs[i] for i in fit[at:at + 64]], labels[fit[at:at + 64]], balance)
    raw = np.concatenate([_raw(model, [docs[i] for i in check[at:at + 256]]) for at in range(0, len(check), 256)]) \
        if len(check) else np.empty(0)
    known = labels[check]
    if len(set(known.tolist())) == 2:
        cut = sparing_threshold(raw, known, SPARED, KEPT)
    else:  # too few labels to hold some back
        every = np.concatenate([_raw(model, docs[at:at + 256]) for at in range(0, len(docs), 256)])
        cut = sparing_threshold(every, labels, SPARED, KEPT)
    model.shift = cut - float(np.log(CUT / (1 - CUT)))
    if len(set(known.tolist())) == 2:
        languages = np.array([rows[i][2] or "" for i in check])
        for name in set(languages.tolist()) - {""}:
            own = languages == name
            if min((known[own] == 0).sum(), (known[own] == 1).sum()) >= LEAST_LABELS:
                cut = sigmoid(np.array(best_threshold(raw[own], known[own]) - model.shift))
                model.thresholds[name] = float(np.clip(cut, 0.15, 0.5))
    return model


def _raw(model: Model, docs: list[np.ndarray]) -> np.ndarray:
    counts = [len(d) for d in docs]
    vectors, starts, _ = _vectors(model.weights["table"], np.concatenate(docs), counts)
    return model.logits(vectors, starts)


def _learn(model: Model, adam: Adam, docs: list[np.ndarray], labels: np.ndarray, balance: dict[int, float]
           ) -> dict[str, np.ndarray]:
    w = model.weights
    ids, counts = np.concatenate(docs), [len(d) for d in docs]
    vectors, starts, rows = _vectors(w["table"], ids, counts)
    pooled, places = _pool(w, vectors, starts, where=True)
    score = sigmoid(pooled @ w["out"] + w["bias"][0])
    error = ((score - labels) * np.where(labels == 1, balance[1], balance[0]) / len(docs)).astype(np.float32)
    gradients = {"out": pooled.T @ error, "bias": error.sum(keepdims=True)}
    back = np.outer(error, w["out"]) * (pooled > 0)
    to_vectors: dict[str, list] = {"at": [], "value": []}
    for n, width in enumerate(WIDTHS):
        own, at = back[:, n * FILTERS:(n + 1) * FILTERS], places[n]
        filters = w[f"filter{width}"]
        change = np.zeros_like(filters)
        for i in range(width):
            there = np.minimum(at + i, len(vectors) - 1)
            change[i] = np.einsum("df,dfs->sf", own, vectors[there])
            to_vectors["at"].append(there.ravel())
            to_vectors["value"].append((own[:, :, None] * filters[i].T[None]).reshape(-1, SIZE))
        gradients[f"filter{width}"] = change
        gradients[f"shift{width}"] = own.sum(axis=0)
    word_of = np.full(len(vectors), -1)
    word_of[rows] = np.arange(len(rows))
    at, value = word_of[np.concatenate(to_vectors["at"])], np.concatenate(to_vectors["value"])
    value = value[at >= 0]
    table = np.zeros_like(w["table"])
    for column in ids[at[at >= 0]].T:
        np.add.at(table, column, value)
    gradients["table"] = table
    adam.step(gradients)
    return gradients


class _Scorer:
    def __init__(self, model: Model):
        self.model, self.cache = model, {}
        self.known = np.zeros((1024, SIZE), np.float32)

    def _ids(self, words: list[bytes]) -> np.ndarray:
        cache = self.cache
        if len(cache) > CACHED_WORDS:
            cache.clear()
        found = list(map(cache.get, words))
        if None in found:
            new = list(dict.fromkeys(w for w, known in zip(words, found) if known is None))
            first = len(cache)
            while first + len(new) > len(self.known):
                self.known = np.concatenate([self.known, np.zeros_like(self.known)])
            table = self.model.weights["table"]
            self.known[first:first + len(new)] = table[np.array([hashes_of(w) for w in new])].sum(axis=1)
            cache.update(zip(new, range(first, first + len(new))))
            found = list(map(cache.__getitem__, words))
        return np.array(found, np.int64)

    def logits(self, texts: list[str]) -> np.ndarray:
        out = np.zeros(len(texts))
        for at, docs in _held_words(texts):
            ids = self._ids([w for own in docs for w in own])
            vectors, starts, _ = _vectors(self.known, ids, [len(own) for own in docs])
            out[at:at + len(docs)] = self.model.logits(vectors, starts)
        return out

    def scores(self, texts: list[str]) -> np.ndarray:
        return sigmoid(self.logits(texts))


def _held_words(texts: Iterable[str], most: int | None = None):
    """``(first, words of each)`` of documents that follow one another, up to ``most``
    at a time and about ``BATCH_WORDS`` words."""
    at, held, docs = 0, 0, []
    for text in texts:
        own = words_of(text)
        if docs and (held + len(own) > BATCH_WORDS or len(docs) == most):
            yield at, docs
            at, held, docs = at + len(docs), 0, []
        docs.append(own)
        held += len(own)
    if docs:
        yield at, docs


def scorer(model: Model, *, raw: bool = False):
    """A column function from whole texts to scores, or ``raw`` logits; null counts as empty."""
    held: list[_Scorer] = []

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        if not held:
            give_back()
            held.append(_Scorer(model))
        judge, found = held[0].logits if raw else held[0].scores, [np.empty(0)]
        for at in range(0, len(texts), SLICE_ROWS):
            found.append(judge(["" if t is None else t for t in texts.slice(at, SLICE_ROWS).to_pylist()]))
        return pa.array(np.concatenate(found), pa.float64())

    return score


def threshold(model: Model, language: Column) -> Column:
    """The score from which a document of this language is toxic."""
    found = F.lit(CUT)
    for name, value in sorted((model.thresholds or {}).items()):
        found = F.when(language == name, F.lit(value)).otherwise(found)
    return found


class _Hashes:
    """Buckets of words and of their beginnings, made once for a word."""

    def __init__(self):
        self.cache: dict[bytes, int] = {}
        self.known = np.zeros((1024, 1 + len(BEGINNINGS)), np.int32)

    def of(self, words: list[bytes]) -> np.ndarray:
        cache = self.cache
        if len(cache) > CACHED_WORDS:
            cache.clear()
        new = list(set(words).difference(cache))
        if new:
            first = len(cache)
            while first + len(new) > len(self.known):
                self.known = np.concatenate([self.known, np.zeros_like(self.known)])
            self.known[first:first + len(new)] = [hashes_of(w) for w in new]
            cache.update(zip(new, range(first, first + len(new))))
        return self.known[np.array(list(map(cache.__getitem__, words)), np.int64)].astype(np.int64)


def _going_on(weights: dict[str, np.ndarray], balance: dict[int, float]):
    """Learns from a task's rows, starting at ``weights``, and gives the changes times their counts."""

    def learn(batches):
        give_back()
        own = {name: value.copy() for name, value in weights.items()}
        model, adam, hashes = Model(own), Adam(own, LATER_RATE), _Hashes()
        touched, rows = np.zeros(BUCKETS, np.float32), 0
        for batch in batches:
            texts, labels = (t for part in slices([batch]) for t in part.column("text").to_pylist()), batch.column("label")
            for at, words in _held_words(texts, 64):
                found, own_labels = [hashes.of(w) for w in words], labels.slice(at, len(words)).to_numpy()
                touched += _learn(model, adam, found, own_labels, balance)["table"].any(axis=1)
                rows += len(words)
        if rows:
            change = {name: own[name] - value for name, value in weights.items()}
            change["table"] *= touched[:, None]
            flat = np.concatenate([*((c if n == "table" else c * rows).ravel() for n, c in sorted(change.items())),
                                   touched, [rows]]).astype(np.float32)
            part = TaskContext.get().partitionId()
            for n, at in enumerate(range(0, len(flat), CHUNK)):
                yield pa.record_batch({"chunk": pa.array([n], pa.int32()), "part": pa.array([part], pa.int32()),
                                       "numbers": pa.array([flat[at:at + CHUNK].tobytes()], pa.binary())})

    return learn


def _added(parts: pa.Table) -> pa.Table:
    """The sum of a chunk's numbers over the tasks, in their order."""
    parts = parts.sort_by("part")
    total = sum(np.frombuffer(b.as_py(), np.float32).astype(np.float64) for b in parts.column("numbers"))
    return pa.table({"chunk": parts.column("chunk").slice(0, 1), "numbers": pa.array([total.tobytes()], pa.binary())})


def _round(weights: dict[str, np.ndarray], rows: DataFrame, balance: dict[int, float]) -> dict[str, np.ndarray]:
    """Weights after each task went on from them over its rows.

    An embedding moves by the mean of the tasks' changes weighted by how many
    of their batches touched it, so that a rare word keeps what the few tasks
    with it have learned; other weights by the mean weighted by rows.
    """
    shuffled = rows.sortWithinPartitions(F.xxhash64("doc_id"), "doc_id", "text").select("text", "label")
    parts = shuffled.mapInArrow(_going_on(weights, balance), "chunk int, part int, numbers binary")
    sums = parts.groupBy("chunk").applyInArrow(_added, "chunk int, numbers binary").collect()
    if not sums:
        return weights
    flat = np.concatenate([np.frombuffer(r["numbers"]) for r in sorted(sums, key=lambda r: r["chunk"])])
    touched, count, at, after = flat[-BUCKETS - 1:-1], flat[-1], 0, {}
    for name, value in sorted(weights.items()):
        change = flat[at:at + value.size].reshape(value.shape)
        change = change / (np.maximum(touched, 1)[:, None] if name == "table" else count)
        after[name] = (value + change).astype(np.float32)
        at += value.size
    return after


def _calibrate(model: Model, docs: DataFrame, known: DataFrame) -> None:
    """Set the shift and the thresholds by counts of all ``docs`` with a ``known`` label, in
    steps of 1 / ``BINS``. Texts are scored where they are read; only steps meet the labels."""
    raw = F.greatest(F.lit(-30.0), F.least(F.lit(30.0), scorer(model, raw=True)(F.col("text"))))
    steps = docs.select("doc_id", F.coalesce("lang", F.lit("")).alias("lang"), F.floor(raw * BINS).cast("int").alias("bin"))
    found = steps.join(known, "doc_id").groupBy("lang", "label", "bin").count().collect()

    def counted(some):
        bins = np.unique([r["bin"] for r in some])
        counts = np.zeros((2, len(bins)), np.int64)
        for r in some:
            counts[r["label"], np.searchsorted(bins, r["bin"])] += r["count"]
        return (bins + 0.5) / BINS, counts[0], counts[1]

    model.shift = sparing_cut(*counted(found), SPARED, KEPT) - float(np.log(CUT / (1 - CUT)))
    model.thresholds = {}
    for name in {r["lang"] for r in found} - {""}:
        own = counted([r for r in found if r["lang"] == name])
        if min(own[1].sum(), own[2].sum()) >= LEAST_LABELS:
            cut = sigmoid(np.array(best_cut(*own) - model.shift))
            model.thresholds[name] = float(np.clip(cut, 0.15, 0.5))


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """The model of all labelled rows outside the held-out fold.

    :func:`train` on a bounded sample gives the starting weights. Then tasks
    go on over every row outside a held-back fifth of the keys, in one pass or
    in several over a small table, and the thresholds come from every row of that
    fifth. Where one side lacks a label, all rows are used for both.

    Rows are dealt to the tasks by key. A text is moved once for that, never one of the held-out fold or
    of the held-back fifth, and none without a label as long as the labels are few
    enough to be sent to every task.
    """
    language = F.col("lang") if "lang" in docs.columns else F.lit(None).cast("string")
    known = materialise(known_labels(labels, "toxic", folds=4, held=2), "toxicity-labels")
    back = F.pmod(F.xxhash64(F.lit("held back"), "doc_id"), F.lit(5)) == 0

    few = known.count() * 16 <= BROADCAST_BYTES

    def texts(some: Column) -> DataFrame:
        return docs.where(some & ~is_held_out(F.col("doc_id"), 4, 2)).select(
            "doc_id", F.coalesce("text", F.lit("")).alias("text"), language.alias("lang"))

    def dealt(some: Column, tasks: int) -> DataFrame:
        """Labelled rows, in so many partitions by key."""
        own = texts(some).select("doc_id", "text")
        if few:
            return own.join(F.broadcast(known.where(some)), "doc_id").repartition(tasks, "doc_id")
        labels = known.where(some).repartition(tasks, "doc_id").hint("shuffle_hash")
        return own.repartition(tasks, "doc_id").join(labels, "doc_id")

    counts = docs.select("doc_id").join(known, "doc_id").groupBy(back.alias("back"), "label").count().collect()
    if len({r["label"] for r in counts}) < 2:
        return train([])
    apart = len(counts) == 4
    fitted = ~back if apart else F.lit(True)
    of = {v: sum(r["count"] for r in counts if r["label"] == v and not (apart and r["back"])) for v in (0, 1)}
    total = sum(of.values())
    sample = training_rows(docs.where(fitted), labels, "toxic", folds=4, held=2)
    weights = train(sample).weights if len({r[1] for r in sample}) == 2 else _first_weights(np.random.default_rng(11))
    shares = min(2, max(1, total // (2 * TASK_ROWS)))
    for n in range(shares * max(1, min(PASSES, LEARNED_ROWS // total))):
        share = F.pmod(F.xxhash64(F.lit("share"), "doc_id"), F.lit(shares)) == n % shares
        rows = dealt(fitted & share, max(1, total // shares // TASK_ROWS))
        weights = _round(weights, rows, {v: total / 2 / of[v] for v in of})
    model = Model(weights, thresholds={})
    _calibrate(model, texts(back if apart else F.lit(True)), known)
    return model


def toxicity_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Score of every whole text.

    Result per row: ``doc_id``, ``held_out`` (its fold is not learned from),
    ``score`` (0 to 1), ``predicted`` (score of at least 0.3), and
    ``threshold`` and ``predicted_by_language``, which apply the threshold of
    the document's language. Null and empty texts get the score of a text
    without words. Repeated rows and null keys give a row each; other columns
    are ignored; an empty table gives none. Without labels of both kinds all
    score next to 0.
    """
    model = fit(docs, labels)
    language = F.col("lang") if "lang" in docs.columns else F.lit(None).cast("string")
    scored = docs.select("doc_id", language.alias("lang"), scorer(model)(F.col("text")).alias("score"))
    return scored.select(
        "doc_id", is_held_out(F.col("doc_id"), 4, 2).alias("held_out"), "score",
        (F.col("score") >= CUT).cast("int").alias("predicted"),
        threshold(model, F.col("lang")).alias("threshold"),
        (F.col("score") >= threshold(model, F.col("lang"))).cast("int").alias("predicted_by_language"),
    )


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows, with all their columns, below their language's threshold."""
    model = fit(docs, labels)
    language = F.col("lang") if "lang" in docs.columns else F.lit(None).cast("string")
    name = "__toxicity"
    while name in docs.columns:
        name += "_"
    return docs.withColumn(name, scorer(model)(F.col("text"))).where(F.col(name) < threshold(model, language)).select(
        *[F.col(f"`{c}`") for c in docs.columns])
