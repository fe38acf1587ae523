"""Predictions of a model over a table, and how good they are."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.functions.scaling import row_argmax
from gridloom.operators.gradient import MODEL_BYTES_LIMIT, Model, _column_values


def predict(
    df: DataFrame,
    model: Model,
    scores: Callable[[np.ndarray, Model], np.ndarray],
    features: str = "features",
) -> DataFrame:
    """Add ``logp`` (array of log-probabilities) and ``prediction``."""
    size = sum(np.asarray(v).nbytes for v in model.values())
    if size > MODEL_BYTES_LIMIT:
        raise ValueError(f"a model of {size} bytes is too large to broadcast")
    shared = df.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("array<double>")
    def apply(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            x = _column_values(batch).astype(np.float64)
            out = np.asarray(scores(x, shared.value))
            offsets = np.arange(len(out) + 1, dtype=np.int32) * out.shape[1]
            yield pa.ListArray.from_arrays(pa.array(offsets), pa.array(out.reshape(-1)))

    is_vector = isinstance(df.schema[features].dataType, VectorUDT)
    inputs = vector_to_array(features) if is_vector else F.col(features)
    scored = df.withColumn("logp", apply(inputs))
    return scored.withColumn("prediction", row_argmax("logp"))


def is_correct(prediction: Column | str = "prediction", label: Column | str = "label") -> Column:
    """Whether the prediction equals the label."""
    prediction = F.col(prediction) if isinstance(prediction, str) else prediction
    label = F.col(label) if isinstance(label, str) else label
    return prediction.cast("double") == label.cast("double")


def score_report(df: DataFrame, logp: str = "logp", label: str = "label") -> DataFrame:
    """One row: mean negative log-likelihood, correct, total, accuracy in %.

    The loss is averaged over rows, so a short last batch weighs no more than
    its rows.
    """
    of_label = F.element_at(F.col(logp), F.col(label).cast("int") + 1)
    hit = is_correct(row_argmax(logp), label).cast("long")
    return df.agg(
        F.avg(-of_label).alias("loss"),
        F.sum(hit).alias("correct"),
        F.count("*").alias("total"),
        (F.sum(hit) * 100.0 / F.nullif(F.count("*"), F.lit(0))).alias("accuracy"),
    )


def accuracy(df: DataFrame, prediction: str = "prediction", label: str = "label") -> DataFrame:
    """One row, ``accuracy``: share of rows predicted right."""
    return df.agg(F.avg(is_correct(prediction, label).cast("double")).alias("accuracy"))


def precision(df: DataFrame, prediction: str = "prediction", label: str = "label") -> float:
    """Share of rows predicted right, by Spark ML's evaluator.

    Over all classes at once, precision is accuracy, which is the name the
    evaluator knows it by.
    """
    ready = df.select(
        F.col(prediction).cast("double").alias("prediction"),
        F.col(label).cast("double").alias("label"),
    )
    return MulticlassClassificationEvaluator(metricName="accuracy").evaluate(ready)
