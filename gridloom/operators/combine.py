"""Aggregates given by the user's own functions, and sums of large arrays."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Keys a task holds states of before it sends them on.
HELD_KEYS = 100_000

# Groups that the partial results of one key are merged in first.
SALTS = 32

Columns = dict[str, pa.Array]


def aggregate_by_key(
    df: DataFrame,
    keys: list[str],
    values: list[str],
    *,
    create: Callable[[Columns], Any],
    merge: Callable[[Any, Any], Any],
    state: str,
    result: str,
    finish: Callable[[Any], Any] = lambda held: held,
    salts: int = SALTS,
    held_keys: int = HELD_KEYS,
) -> DataFrame:
    """``(*keys, result)``: an aggregate of one's own, combined like Spark's.

    ``create`` makes a state from the ``values`` of some rows of one key, as
    Arrow arrays by column name; ``merge`` joins two states; ``finish`` turns
    the last one into the result. ``state`` and ``result`` are the Spark types
    of what they return. ``merge`` must not care for order or grouping.

    Every task combines its own rows and sends one state per key, or several if
    it meets more than ``held_keys`` keys. States of a key are merged in
    ``salts`` groups and then once more, each time as a stream sorted by key,
    so a key that holds most of the rows is spread, and no task gathers a group.
    """
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    keyed = ", ".join(f"`{k}` {kinds[k]}" for k in keys)
    key_types = _arrow_types(df, keyed)
    state_type = _arrow_types(df, f"state {state}")[0]
    result_type = _arrow_types(df, f"result {result}")[0]

    def batch_of(rows: list[tuple], last: str, kind: pa.DataType) -> pa.RecordBatch:
        columns = list(zip(*rows)) or [()] * (len(keys) + 1)
        arrays = [pa.array(c, t) for c, t in zip(columns, [*key_types, kind])]
        return pa.RecordBatch.from_arrays(arrays, names=[*keys, last])

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, Any] = {}
        for batch in batches:
            for key, rows in _groups(batch, keys):
                own = create({name: batch.column(name).take(rows) for name in values})
                held[key] = merge(held[key], own) if key in held else own
            if len(held) > held_keys:
                yield batch_of([(*k, s) for k, s in held.items()], "state", state_type)
                held.clear()
        if held:
            yield batch_of([(*k, s) for k, s in held.items()], "state", state_type)

    def merged(last: str, kind: pa.DataType, done: Callable[[Any], Any]):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            current, held = None, None
            for batch in batches:
                out = []
                for *key, own in zip(*(batch.column(n).to_pylist() for n in [*keys, "state"])):
                    key = tuple(key)
                    if current is not None and _same(key, current):
                        held = merge(held, own)
                        continue
                    if current is not None:
                        out.append((*current, done(held)))
                    current, held = key, own
                if out:
                    yield batch_of(out, last, kind)
            if current is not None:
                yield batch_of([(*current, done(held))], last, kind)

        return run

    # States cross task borders as Arrow values, so the first merge sees what the last one does.
    states = df.select(*keys, *(v for v in values if v not in keys)).mapInArrow(partial, f"{keyed}, state {state}")
    if salts > 1:
        salted = states.withColumn("__salt", F.pmod(F.spark_partition_id(), F.lit(salts)))
        states = (
            salted.repartition(*keys, "__salt").sortWithinPartitions(*keys, "__salt").drop("__salt")
            .mapInArrow(merged("state", state_type, lambda held: held), f"{keyed}, state {state}")
        )
    return states.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(
        merged("result", result_type, finish), f"{keyed}, result {result}"
    )


def _arrow_types(df: DataFrame, ddl: str) -> list[pa.DataType]:
    return list(df.sparkSession.createDataFrame([], ddl).toArrow().schema.types)


def _same(a: tuple, b: tuple) -> bool:
    """Equal keys; NaN equals itself, as it does where Spark groups."""
    return all(x == y or (x != x and y != y) for x, y in zip(a, b))


def _groups(batch: pa.RecordBatch, keys: list[str]) -> Iterator[tuple[tuple, pa.Array]]:
    """Key and row numbers of every group of a batch."""
    if not batch.num_rows:
        return
    rows = pa.table({**{k: batch.column(k) for k in keys}, "__row": np.arange(batch.num_rows)})
    grouped = rows.group_by(keys).aggregate([("__row", "list")])
    lists = grouped.column("__row_list")
    for i, key in enumerate(zip(*(grouped.column(k).to_pylist() for k in keys))):
        yield key, lists[i].values


# --- arrays summed, or otherwise merged, by chunks ------------------------------------

Merge = Callable[[np.ndarray, np.ndarray], np.ndarray]


def chunk_rows(number: int, values: np.ndarray) -> pa.RecordBatch:
    """One row ``(chunk, sums)``."""
    offsets = pa.array([0, len(values)], pa.int32())
    return pa.RecordBatch.from_arrays(
        [pa.array([number], pa.int32()), pa.ListArray.from_arrays(offsets, pa.array(values))],
        names=["chunk", "sums"],
    )


def chunks_of(batches) -> Iterator[tuple[int, np.ndarray]]:
    for batch in batches:
        for number, sums in zip(batch.column("chunk").to_pylist(), batch.column("sums")):
            yield number, sums.values.to_numpy(zero_copy_only=False)


CHUNK_SCHEMA = "chunk int, sums array<double>"


def reduce_chunks(partials: DataFrame, merge: Merge = np.add, salts: int = SALTS) -> DataFrame:
    """Rows ``(chunk, sums)`` merged to one per chunk.

    Tasks send one row per chunk each, however many tasks there are. Rows of a
    chunk are merged in ``salts`` groups first and these in one, so the longest
    merge grows with the number of tasks over ``salts``, not with it.
    """

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for number, sums in chunks_of(batches):
            totals[number] = merge(totals[number], sums) if number in totals else sums.copy()
        for number, sums in totals.items():
            yield chunk_rows(number, sums)

    salted = partials.withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(salts)))
    few = salted.repartition("chunk", "salt").select("chunk", "sums").mapInArrow(summed, CHUNK_SCHEMA)
    return few.repartition("chunk").mapInArrow(summed, CHUNK_SCHEMA)
