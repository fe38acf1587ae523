"""Training rows, folds and the optimiser of the text classifiers."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SAMPLE_PER_CLASS = 2000  # labelled documents that a model is fitted on, for each label
SAMPLE_BYTES = 8192  # longest document of that sample; scoring has no such bound


def fold(key: Column, folds: int) -> Column:
    """Remainder of the checksum of a key in decimal; null for a null key."""
    return F.crc32(key.cast("string").cast("binary")) % folds


def is_held_out(key: Column, folds: int, held: int) -> Column:
    return F.coalesce(fold(key, folds) == held, F.lit(False))


def known_labels(labels: DataFrame, label: str, *, folds: int, held: int, key: str = "doc_id") -> DataFrame:
    """``key`` and ``label`` (0 or 1, the largest given) outside the held-out fold."""
    return (
        labels.where(F.col(label).isin(0, 1) & F.col(key).isNotNull() & ~is_held_out(F.col(key), folds, held))
        .groupBy(key).agg(F.max(label).cast("int").alias("label"))
    )


def training_rows(
    docs: DataFrame,
    labels: DataFrame,
    label: str,
    *,
    folds: int,
    held: int,
    key: str = "doc_id",
    text: str = "text",
    per_class: int = SAMPLE_PER_CLASS,
    most_bytes: int = SAMPLE_BYTES,
) -> list[tuple[str, int, str | None]]:
    """``(text, label, language)`` of a bounded sample outside the held-out fold.

    The sample has at most ``per_class`` keys of each label, chosen by a hash
    among those of documents up to ``most_bytes``, with one document each: the
    first by text and language of those that share a key. Languages serve the thresholds, never the score.
    """
    known = known_labels(labels, label, folds=folds, held=held, key=key)
    language = F.col("lang") if "lang" in docs.columns else F.lit(None).cast("string")
    short = docs.where(F.coalesce(F.octet_length(text), F.lit(0)) <= most_bytes).select(
        key, F.coalesce(F.col(text), F.lit("")).alias("text"), language.alias("lang")
    )
    known = known.join(short.select(key).distinct(), key, "left_semi")
    chosen = None
    for value in (0, 1):
        some = known.where(F.col("label") == value).orderBy(F.xxhash64(key), key).limit(per_class)
        chosen = some if chosen is None else chosen.unionByName(some)
    first = F.min(F.struct("text", "lang"))  # one row per key, so at most 2 x per_class
    rows = short.join(F.broadcast(chosen), key).groupBy(key, "label").agg(first.alias("doc"))
    rows = sorted(rows.select(key, "doc.text", "label", "doc.lang").collect(), key=lambda r: r[key])
    return [(r["text"], r["label"], r["lang"]) for r in rows]


class Adam:
    """The published update, for a dictionary of arrays."""

    def __init__(self, weights: dict[str, np.ndarray], rate: float, decay: float = 0.0):
        self.weights, self.rate, self.decay, self.steps = weights, rate, decay, 0
        self.mean = {k: np.zeros_like(v) for k, v in weights.items()}
        self.square = {k: np.zeros_like(v) for k, v in weights.items()}

    def step(self, gradients: dict[str, np.ndarray]) -> None:
        self.steps += 1
        rate = self.rate * np.sqrt(1 - 0.999**self.steps) / (1 - 0.9**self.steps)
        for k, g in gradients.items():
            g = g + self.decay * self.weights[k]
            self.mean[k] += 0.1 * (g - self.mean[k])
            self.square[k] += 0.001 * (g * g - self.square[k])
            self.weights[k] -= (rate * self.mean[k] / (np.sqrt(self.square[k]) + 1e-8)).astype(np.float32)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def best_threshold(scores: np.ndarray, labels: np.ndarray) -> float:
    """Middle of the gap between two scores where precision and recall of label 1
    are best together; the widest such gap."""
    order = np.argsort(scores)
    s, y = scores[order], labels[order]
    above = np.r_[y[::-1].cumsum()[::-1], 0]  # label 1 from each place on
    taken = np.arange(len(s), -1, -1)
    f1 = 2 * above / np.maximum(taken + y.sum(), 1)
    edges = np.r_[s[0] - 1, s, s[-1] + 1]
    gaps = edges[1:] - edges[:-1]
    places = np.flatnonzero(f1 >= f1.max() - 1e-12)
    at = places[np.argmax(gaps[places])]
    return float((edges[at] + edges[at + 1]) / 2)


def sparing_threshold(scores: np.ndarray, labels: np.ndarray, spared: float, kept: float) -> float:
    """The threshold of :func:`best_threshold`, or a higher one that leaves ``spared``
    of label 0 below it, as far as ``kept`` of the label 1 that the former catches
    stays caught.

    For rows that were not fitted on. Where labels are noisy the highest scores
    of label 0 are those of label 1; the second bound keeps the threshold from
    following them.
    """
    best = best_threshold(scores, labels)
    caught = np.sort(scores[(labels == 1) & (scores >= best)])
    highest = caught[int((1 - kept) * len(caught))] if len(caught) else best
    calm = scores[labels == 0]
    wanted = float(np.quantile(calm, spared)) + 1e-3 if len(calm) else best
    return max(best, min(wanted, float(highest)))


def best_cut(values: np.ndarray, zeros: np.ndarray, ones: np.ndarray) -> float:
    """:func:`best_threshold` over ascending ``values`` with so many rows of each label."""
    above, taken = np.r_[ones[::-1].cumsum()[::-1], 0], np.r_[(zeros + ones)[::-1].cumsum()[::-1], 0]
    f1 = 2 * above / np.maximum(taken + ones.sum(), 1)
    edges = np.r_[values[0] - 1, values, values[-1] + 1]
    gaps = edges[1:] - edges[:-1]
    places = np.flatnonzero(f1 >= f1.max() - 1e-12)
    at = places[np.argmax(gaps[places])]
    return float((edges[at] + edges[at + 1]) / 2)


def sparing_cut(values: np.ndarray, zeros: np.ndarray, ones: np.ndarray, spared: float, kept: float) -> float:
    """:func:`sparing_threshold` over ascending ``values`` with so many rows of each label."""
    best = best_cut(values, zeros, ones)
    caught = np.where(values >= best, ones, 0).cumsum()
    highest = values[np.searchsorted(caught, int((1 - kept) * caught[-1]), "right")] if caught[-1] else best
    calm = zeros.cumsum()
    wanted = values[np.searchsorted(calm, spared * (calm[-1] - 1), "right")] + 1e-3 if calm[-1] else best
    return max(best, min(float(wanted), float(highest)))
