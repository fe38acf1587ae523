"""Training loops and Spark ML's multilayer perceptron."""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass, field

import numpy as np
from pyspark.ml.classification import (
    MultilayerPerceptronClassificationModel,
    MultilayerPerceptronClassifier,
)
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.functions.texts import training_text
from gridloom.operators.batches import WrittenEpoch
from gridloom.operators.evaluate import predict, score_report
from gridloom.operators.gradient import BatchGradient, Descent, Model, loss_and_gradient
from gridloom.session import new_work_folder, remove_work_folder

Scores = Callable[[np.ndarray, Model], np.ndarray]

HISTORY_SCHEMA = "epoch int, batch int, rows_seen long, percent double, loss double, elapsed double"
REPORT_SCHEMA = "epoch int, loss double, correct long, total long, accuracy double"


def fit_perceptron(
    train: DataFrame,
    layers: list[int],
    *,
    max_iter: int,
    block_size: int = 128,
    seed: int = 1234,
) -> MultilayerPerceptronClassificationModel:
    """Fit Spark ML's perceptron on ``(label, features)``."""
    trainer = MultilayerPerceptronClassifier(
        layers=layers, maxIter=max_iter, blockSize=block_size, seed=seed
    )
    return trainer.fit(train)


@dataclass
class Training:
    """A trained model and what was logged on the way."""

    model: Model
    history: list[tuple] = field(default_factory=list)
    reports: list[tuple] = field(default_factory=list)
    total: int = 0

    def history_frame(self, spark: SparkSession) -> DataFrame:
        """``(epoch, batch, rows_seen, percent, loss, elapsed)``."""
        return spark.createDataFrame(self.history, HISTORY_SCHEMA)

    def report_frame(self, spark: SparkSession) -> DataFrame:
        """``(epoch, loss, correct, total, accuracy)`` on the test rows."""
        return spark.createDataFrame(self.reports, REPORT_SCHEMA)

    def log_lines(self, spark: SparkSession) -> DataFrame:
        """``(epoch, batch, line)``: the history as log lines."""
        line = training_text("epoch", "rows_seen", F.lit(self.total), "percent", "loss")
        return self.history_frame(spark).select("epoch", "batch", line.alias("line"))


def train_epochs(
    dataset: DataFrame,
    model: Model,
    grad: BatchGradient,
    desc: Descent,
    *,
    epochs: int = 10,
    batch_size: int | None = None,
    key: list[str] | None = None,
    seed: int = 1,
    log_interval: int = 10,
    test: DataFrame | None = None,
    scores: Scores | None = None,
) -> Training:
    """Train for several epochs and log every ``log_interval`` batches.

    Without ``batch_size`` each epoch is one step over the whole dataset, which
    should be persisted. With it, each epoch shuffles the rows anew by a hash
    of ``key`` and writes them once, in order, so that a step reads its own
    batch and an epoch reads the data once. A step is a Spark job: choose
    batches large enough to keep the cluster busy.

    With ``test`` rows and the model's ``scores`` function (see
    :func:`gridloom.operators.evaluate.predict`) every epoch ends with a report.
    """
    if (test is None) != (scores is None):
        raise ValueError("a test half needs both the rows and the scores of the model")
    if batch_size is not None and not key:
        raise ValueError("batches need the key columns that tell rows apart")
    run = Training(model)
    started = time.monotonic()
    for epoch in range(1, epochs + 1):
        if batch_size is None:
            loss, grads, run.total = loss_and_gradient(dataset, run.model, grad)
            run.model = desc(run.model, grads)
            run.history.append((epoch, 0, run.total, 100.0, loss, time.monotonic() - started))
        else:
            folder = new_work_folder(dataset.sparkSession, "epoch")
            try:
                written = WrittenEpoch(dataset, key, batch_size, folder, seed=seed, epoch=epoch)
                _run_batches(run, written, grad, desc, epoch, log_interval, started)
            finally:
                remove_work_folder(dataset.sparkSession, folder)
        if test is not None:
            run.reports.append((epoch, *evaluate_epoch(test, run.model, scores).first()))
    return run


def _run_batches(
    run: Training, written: WrittenEpoch, grad: BatchGradient, desc: Descent, epoch: int, log_interval: int,
    started: float,
) -> None:
    run.total, seen = written.total, 0
    for b in range(written.n_batches):
        loss, grads, rows = loss_and_gradient(written.batch(b), run.model, grad)
        run.model = desc(run.model, grads)
        if b % log_interval == 0:
            run.history.append(
                (epoch, b, seen, 100.0 * b / written.n_batches, loss, time.monotonic() - started)
            )
        seen += rows


def evaluate_epoch(test: DataFrame, model: Model, scores: Scores) -> DataFrame:
    """The test report of a model."""
    return score_report(predict(test, model, scores))
