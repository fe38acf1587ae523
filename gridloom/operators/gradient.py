"""Full-batch gradient steps with a user-supplied gradient."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame

from gridloom.operators.combine import CHUNK_SCHEMA, chunk_rows, chunks_of, reduce_chunks

Model = dict[str, np.ndarray]
Batch = dict[str, np.ndarray]

# A batch gradient gets columns as arrays and the parameters, and returns the
# summed loss and summed gradients of the rows.
BatchGradient = Callable[[Batch, Model], tuple[float, Model]]
Descent = Callable[[Model, Model], Model]

# The parameters go to every executor and the gradient back to the driver.
MODEL_BYTES_LIMIT = 512 * 1024 * 1024

# Parameters summed together; one chunk is one reduce key.
CHUNK = 8192


def row_gradient(grad: Callable[[dict, Model], tuple[float, Model]]) -> BatchGradient:
    """Adapt ``grad(row, params) -> (loss, grads)`` on single rows.

    For gradients that only exist per row; a batch gradient is much faster.
    """

    def summed(batch: Batch, params: Model) -> tuple[float, Model]:
        names = list(batch)
        loss, totals = 0.0, {}
        for row in zip(*(batch[n] for n in names)):
            row_loss, grads = grad(dict(zip(names, row)), params)
            loss += row_loss
            for name, g in grads.items():
                totals[name] = totals.get(name, 0.0) + np.asarray(g, dtype=np.float64)
        return loss, totals

    return summed


def _column_values(column: pa.Array) -> np.ndarray:
    """Values of a column; arrays must be whole rows of one width."""
    if column.null_count:
        raise ValueError("a gradient batch holds null rows")
    if pa.types.is_list(column.type) or pa.types.is_large_list(column.type):
        lengths = column.value_lengths().to_numpy(zero_copy_only=False)
        if len(lengths) and (lengths != lengths[0]).any():
            raise ValueError("a gradient batch holds arrays of different lengths")
        flat = column.flatten()
        if flat.null_count:
            raise ValueError("a gradient batch holds null values")
        return flat.to_numpy(zero_copy_only=False).reshape(len(column), -1)
    return column.to_numpy(zero_copy_only=False)


def _flat(grads: Model, shapes: dict[str, tuple[int, ...]]) -> np.ndarray:
    """All gradients in one row, in model order; a parameter without one has 0."""
    unknown = set(grads) - set(shapes)
    if unknown:
        raise ValueError(f"gradients of unknown parameters {sorted(unknown)}")
    parts = []
    for name, shape in shapes.items():
        part = np.asarray(grads[name] if name in grads else np.zeros(shape), np.float64)
        if part.shape != shape:
            raise ValueError(f"gradient of {name} has shape {part.shape}, not {shape}")
        parts.append(part.ravel())
    return np.concatenate(parts)


def with_arrays(df: DataFrame) -> DataFrame:
    """Vector columns as arrays, which Arrow batches can carry."""
    return df.select(
        *(
            vector_to_array(f.name).alias(f.name) if isinstance(f.dataType, VectorUDT) else f.name
            for f in df.schema.fields
        )
    )


def loss_and_gradient(
    dataset: DataFrame,
    model: Model,
    grad: BatchGradient,
    *,
    count: int | None = None,
    tasks: int | None = None,
) -> tuple[float, Model, int]:
    """Mean loss, mean gradients, and the number of rows.

    Each task sums the gradient over its rows and sends it out in chunks of
    parameters. A chunk and a salt are a reduce key, then the chunk alone, so
    the sums over tasks are taken in parallel and no task holds more than its
    chunks; the driver receives one model-sized result. The data keeps its
    partitions, whose number grows with it; ``tasks`` merges them to at most
    so many, which saves traffic (tasks times model size) where a model is
    large and partitions are small. Rows are counted in the same pass.
    """
    totals = partial_sums(dataset, model, grad, tasks=tasks)
    return _divided(totals, model, count)


def partial_sums(
    dataset: DataFrame, model: Model, grad: BatchGradient, *, tasks: int | None = None
) -> pa.Table:
    """Loss, rows and gradient summed over all rows, as chunks."""
    dataset = with_arrays(dataset)
    sc = dataset.sparkSession.sparkContext
    shapes = {name: np.shape(value) for name, value in model.items()}
    size = int(sum(np.prod(s, dtype=np.int64) for s in shapes.values()))
    if size * 8 > MODEL_BYTES_LIMIT:
        raise ValueError(f"a model of {size * 8} bytes is too large to broadcast")
    params = {name: np.asarray(value) for name, value in model.items()}
    shared = sc.broadcast(params)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, loss, rows = np.zeros(size), 0.0, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = {
                name: _column_values(batch.column(name)) for name in batch.schema.names
            }
            batch_loss, grads = grad(columns, shared.value)
            total += _flat(grads, shapes)
            loss += float(batch_loss)
            rows += batch.num_rows
        if rows:
            pieces = [np.array([loss, rows])]
            pieces += [total[i : i + CHUNK] for i in range(0, size, CHUNK)]
            for i, piece in enumerate(pieces):
                yield chunk_rows(i, piece)

    try:
        rows = dataset if tasks is None else dataset.coalesce(tasks)
        return reduce_chunks(rows.mapInArrow(partial, CHUNK_SCHEMA)).toArrow()
    finally:
        shared.unpersist(blocking=True)


def _divided(totals: pa.Table, model: Model, count: int | None) -> tuple[float, Model, int]:
    """Means from sums; ``count`` stands in for the number of rows."""
    if not totals.num_rows:
        raise ValueError("the dataset has no rows")
    shapes = {name: np.shape(value) for name, value in model.items()}
    by_chunk = dict(chunks_of(totals.combine_chunks().to_batches()))
    loss, rows = by_chunk[0]
    divisor = float(count) if count is not None else float(rows)
    flat = np.concatenate([by_chunk[i] for i in sorted(by_chunk) if i > 0]) / divisor
    grads, start = {}, 0
    for name, shape in shapes.items():
        width = int(np.prod(shape, dtype=np.int64))
        grads[name] = flat[start : start + width].reshape(shape)
        start += width
    return float(loss) / divisor, grads, int(round(rows))


def step(
    dataset: DataFrame,
    model: Model,
    grad: BatchGradient,
    desc: Descent,
    *,
    count: int | None = None,
    do_desc: bool = True,
    tasks: int | None = None,
) -> tuple[float, Model, Model]:
    """One step: ``(loss before it, mean gradients, new model)``.

    ``desc(model, grads)`` returns the updated model; the given one is left
    alone. ``do_desc=False`` only evaluates. Persist the dataset when taking
    several steps.
    """
    loss, grads, _ = loss_and_gradient(dataset, model, grad, count=count, tasks=tasks)
    return loss, grads, desc(model, grads) if do_desc else model


def gradient_descent(lr: float) -> Descent:
    """Plain descent."""

    def update(model: Model, grads: Model) -> Model:
        return {n: (v - lr * grads[n]).astype(v.dtype) for n, v in model.items()}

    return update


class Momentum:
    """Descent with momentum; keeps one velocity per parameter."""

    def __init__(self, lr: float = 0.01, momentum: float = 0.5):
        self.lr, self.momentum = lr, momentum
        self.velocity: Model = {}

    def __call__(self, model: Model, grads: Model) -> Model:
        updated = {}
        for name, value in model.items():
            kept = self.velocity.get(name)
            moved = grads[name] if kept is None else self.momentum * kept + grads[name]
            self.velocity[name] = moved
            updated[name] = (value - self.lr * moved).astype(value.dtype)
        return updated
