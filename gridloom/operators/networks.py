"""Batch gradients of two classifiers, for :mod:`gridloom.operators.gradient`.

Both expect the columns ``features`` (array) and ``label`` (class code).
"""

from __future__ import annotations

import numpy as np

from gridloom.operators.gradient import Batch, BatchGradient, Model


def log_softmax(scores: np.ndarray) -> np.ndarray:
    shifted = scores - scores.max(axis=1, keepdims=True)
    return shifted - np.log(np.exp(shifted).sum(axis=1, keepdims=True))


def _loss_and_error(scores: np.ndarray, labels: np.ndarray) -> tuple[float, np.ndarray]:
    """Summed negative log-likelihood and its derivative by the scores."""
    if len(labels) and not (0 <= labels.min() and labels.max() < scores.shape[1]):
        raise ValueError(f"labels must be 0 to {scores.shape[1] - 1}")
    logp = log_softmax(scores)
    rows = np.arange(len(labels))
    error = np.exp(logp)
    error[rows, labels] -= 1.0
    return float(-logp[rows, labels].sum()), error


def _inputs(batch: Batch, like: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Features in the precision of the parameters, and class codes."""
    return (
        np.asarray(batch["features"], dtype=like.dtype),
        np.asarray(batch["label"]).astype(np.int64),
    )


def softmax_model(width: int, classes: int = 10) -> Model:
    """Linear classifier with all weights zero."""
    return {"w": np.zeros((width, classes)), "b": np.zeros(classes)}


def softmax_gradient() -> BatchGradient:
    def grad(batch: Batch, params: Model) -> tuple[float, Model]:
        x, y = _inputs(batch, params["w"])
        loss, error = _loss_and_error(x @ params["w"] + params["b"], y)
        return loss, {"w": x.T @ error, "b": error.sum(axis=0)}

    return grad


def hidden_layer_model(
    width: int, hidden: int = 1024, classes: int = 10, *, seed: int = 1, dtype: type = np.float64
) -> Model:
    """One ReLU layer; weights uniform within one over the root of the fan-in.

    ``dtype=np.float32`` halves the work; sums over rows stay in double.
    """
    rng = np.random.default_rng(seed)

    def uniform(fan_in: int, *shape: int) -> np.ndarray:
        bound = 1.0 / np.sqrt(fan_in)
        return rng.uniform(-bound, bound, shape).astype(dtype)

    return {
        "w1": uniform(width, width, hidden),
        "b1": uniform(width, hidden),
        "w2": uniform(hidden, hidden, classes),
        "b2": uniform(hidden, classes),
    }


def hidden_layer_scores(x: np.ndarray, params: Model) -> np.ndarray:
    """Log-probabilities of a batch."""
    hidden = np.maximum(x @ params["w1"] + params["b1"], 0.0)
    return log_softmax(hidden @ params["w2"] + params["b2"])


def hidden_layer_gradient() -> BatchGradient:
    def grad(batch: Batch, params: Model) -> tuple[float, Model]:
        x, y = _inputs(batch, params["w1"])
        active = x @ params["w1"] + params["b1"]
        hidden = np.maximum(active, 0.0)
        loss, error = _loss_and_error(hidden @ params["w2"] + params["b2"], y)
        back = (error @ params["w2"].T) * (active > 0)
        return loss, {
            "w1": x.T @ back,
            "b1": back.sum(axis=0),
            "w2": hidden.T @ error,
            "b2": error.sum(axis=0),
        }

    return grad
