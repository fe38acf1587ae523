"""Extrema and change counters of columns, from files split between tasks.

How often a running maximum moves over a file is not a sum over its parts. A
part's staircase is: the values, in order, that exceed all values before them
in the part. Two neighbouring parts have the staircase of the first, followed
by what of the second one's lies above it. The rule is associative, so tasks
reduce whatever stretches of a file they read, and staircases of stretches are
put together in order, in two rounds. No file is one task's work.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.functions.texts import column_name
from gridloom.sources.binary import _bytes_block

# Records whose stretches are put together first; files beyond take a second round.
SPAN_RECORDS = 1 << 22


def extremum_moves(
    block: np.ndarray, order: np.ndarray, edge: np.ndarray, rising: bool, step: int = 256
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Rows, columns and values that move the running extremum ``edge``, taking
    the rows of ``block`` in ``order``; ``edge`` is kept up to date.

    Few values do: a stretch of rows is looked into only for the columns whose
    extremum in it lies beyond the edge.
    """
    numbers = block.dtype.kind == "f"
    if rising:
        running, beyond = np.fmax if numbers else np.maximum, np.greater
    else:
        running, beyond = np.fmin if numbers else np.minimum, np.less
    for start in range(0, len(order), step):
        rows = order[start : start + step]
        stretch = block[rows[0] : rows[-1] + 1]
        if len(stretch) != len(rows) or (np.diff(rows) != 1).any():
            stretch = block[rows]
        moving = np.flatnonzero(beyond(running.reduce(stretch, axis=0), edge))
        if len(moving):
            values = stretch[:, moving]
            edges = running.accumulate(np.vstack([edge[moving], values]), axis=0)
            row, col = np.nonzero(beyond(edges[1:], edges[:-1]))
            edge[moving] = edges[-1]
            yield rows[row], moving[col], values[row, col]


def value_block(column: pa.Array) -> np.ndarray:
    """Rows of bytes or of numbers as one array; all of one width, none null."""
    if column.null_count:
        raise ValueError("null rows have no place in a running extremum")
    if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type):
        flat, offsets = _bytes_block(column)
        lengths, flat = np.diff(offsets), flat[offsets[0] : offsets[-1]]
    else:
        lengths, values = column.value_lengths().to_numpy(zero_copy_only=False), column.flatten()
        if values.null_count:
            raise ValueError("null values have no place in a running extremum")
        flat = values.to_numpy(zero_copy_only=False)
    if (lengths != lengths[0]).any():
        raise ValueError("records are of different widths")
    return flat.reshape(len(lengths), -1)


class _Stretch:
    """Staircases of consecutive records of one file."""

    def __init__(self, file, first: int, block: np.ndarray):
        self.file, self.first, self.next = file, first, first
        self.edges = {True: block[0].copy(), False: block[0].copy()}
        every = np.arange(block.shape[1])
        self.steps = {rising: [(every, block[0])] for rising in self.edges}

    def add(self, block: np.ndarray) -> None:
        order = np.arange(len(block))
        for rising, edge in self.edges.items():
            for _, col, values in extremum_moves(block, order, edge, rising):
                self.steps[rising].append((col, values))
        self.next += len(block)

    def rows(self, names: list[str]) -> pa.RecordBatch:
        width = len(self.edges[True])
        stairs = []
        for rising in (True, False):
            col = np.concatenate([c for c, _ in self.steps[rising]])
            values = np.concatenate([v for _, v in self.steps[rising]]).astype(np.float64)
            in_order = np.argsort(col, kind="stable")  # by column, in the order of the records
            offsets = np.concatenate([[0], np.cumsum(np.bincount(col, minlength=width))]).astype(np.int32)
            stairs.append(pa.ListArray.from_arrays(pa.array(offsets), pa.array(values[in_order])))
        file = pa.array([self.file.as_py()], self.file.type)
        return pa.RecordBatch.from_arrays(
            [file.take(pa.array(np.zeros(width, np.int64))), pa.array(np.full(width, self.first)),
             pa.array(np.arange(width, dtype=np.int32)), *stairs], names=names)


def _stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Staircases of every run of consecutive records a task reads."""
    names = ["file", "first", "col", "ups", "downs"]
    current: _Stretch | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        block, recs = value_block(batch.column("v")), batch.column("rec").to_numpy()
        coded = batch.column("file").dictionary_encode()
        files = coded.indices.fill_null(-1).to_numpy(zero_copy_only=False)
        cuts = np.flatnonzero((np.diff(files) != 0) | (np.diff(recs) != 1)) + 1
        for start, stop in zip([0, *cuts], [*cuts, len(recs)]):
            file, first = batch.column("file")[int(start)], int(recs[start])
            if current is not None and (file != current.file or first != current.next):
                yield current.rows(names)
                current = None
            current = current or _Stretch(file, first, block[start : start + 1])
            current.add(block[start:stop])
    if current is not None:
        yield current.rows(names)


def _joined(stairs: str, beyond) -> Column:
    """Staircases of stretches in order, as one."""

    def follow(held: Column, stretch: Column) -> Column:
        last = F.try_element_at(held, F.lit(-1))
        return F.concat(held, F.filter(stretch[stairs], lambda v: last.isNull() | beyond(v, last)))

    return F.aggregate("stretches", F.array().cast("array<double>"), follow)


def extremum_staircases(
    records: DataFrame, *, file: str = "path", rec: str = "rec", values: str = "pixels"
) -> DataFrame:
    """``(file, col, ups, downs)``: per file and column the values that moved the
    running maximum and minimum, in record order, from the first value on.

    ``values``: bytes or arrays of numbers, of one width. Stretches of
    consecutive records are reduced where they are read, which is best for
    tables in file order; any other order gives the same result with more and
    shorter stretches. Null files are a file.
    """
    kind = records.schema[file].dataType.simpleString()
    stretches = records.select(
        F.col(file).alias("file"), F.col(rec).cast("long").alias("rec"), F.col(values).alias("v")
    ).mapInArrow(_stretches, f"file {kind}, first long, col int, ups array<double>, downs array<double>")
    up, down = (lambda v, last: v > last), (lambda v, last: v < last)
    in_order = F.array_sort(F.collect_list(F.struct("first", "ups", "downs"))).alias("stretches")
    spans = stretches.groupBy("file", "col", F.expr(f"first div {SPAN_RECORDS}").alias("span")).agg(in_order)
    spans = spans.select(
        "file", "col", F.col("span").alias("first"), _joined("ups", up).alias("ups"), _joined("downs", down).alias("downs")
    )
    return spans.groupBy("file", "col").agg(in_order).select(
        "file", "col", _joined("ups", up).alias("ups"), _joined("downs", down).alias("downs")
    )


def column_extrema(
    records: DataFrame,
    *,
    file: str = "path",
    rec: str = "rec",
    values: str = "pixels",
    initial: float | None = None,
) -> DataFrame:
    """``(col, name, max, min, max_changed, min_changed)`` over all files.

    The counters say how often, reading each file in record order, a column's
    running maximum (minimum) moved. With ``initial`` both extrema of every
    file start there, so a minimum can never exceed it; without, they start at
    a file's first record, and are those of the data.
    """
    stairs = extremum_staircases(records, file=file, rec=rec, values=values)
    top, low = F.element_at("ups", -1), F.element_at("downs", -1)
    if initial is None:
        rises, falls = F.size("ups") - 1, F.size("downs") - 1
    else:
        start = F.lit(float(initial))
        rises = F.size(F.filter("ups", lambda v: v > start))
        falls = F.size(F.filter("downs", lambda v: v < start))
        top, low = F.greatest(top, start), F.least(low, start)
    return (
        stairs.groupBy("col")
        .agg(
            F.max(top).cast("float").alias("max"), F.min(low).cast("float").alias("min"),
            F.sum(rises.cast("long")).alias("max_changed"), F.sum(falls.cast("long")).alias("min_changed"),
        )
        .select("col", column_name("col").alias("name"), "max", "min", "max_changed", "min_changed")
    )
