"""What several operators share: tables, sorted groups in tasks, connected components."""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.session import materialise, new_work_folder, remove_work_folder


BROADCAST_BYTES = 32 << 20
SLICE_ROWS = 512  # of an Arrow batch, that become Python objects at a time
BATCH_BYTES = 2 << 20  # of texts that Spark sends to a task at a time


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches in parts of few rows, without a copy, so that a task holds few rows as Python objects."""
    for batch in batches:
        for at in range(0, batch.num_rows, SLICE_ROWS):
            yield batch.slice(at, SLICE_ROWS)


def give_back() -> None:
    """Return what earlier tasks freed to the system.

    A Python worker lives on between tasks and stages, and what its allocators
    keep of theirs counts beside what the next one takes. See :func:`giving_back`.
    """
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(AttributeError, OSError, TypeError):  # an allocator without it
        ctypes.CDLL(None).malloc_trim(0)


def giving_back(task):
    """The task of a worker, which returns what was freed when it begins and ends.

    A worker without a task keeps what it had, beside those that go on.
    """

    def run(batches):
        give_back()
        yield from task(batches)
        give_back()

    return run


def sorted_groups(
    batches: Iterator[pa.RecordBatch], key: str
) -> Iterator[tuple[int | str, dict[str, list]]]:
    """``(key, columns)`` of every run of equal keys in a stream sorted by ``key``.

    A run may span batches. Only one run is held at a time, so callers bound
    the size of a run before they sort.
    """
    current, held = None, None
    for batch in slices(batches):
        columns = {name: batch.column(name).to_pylist() for name in batch.schema.names}
        keys, start = columns[key], 0
        for i in range(1, len(keys) + 1):
            if i < len(keys) and keys[i] == keys[start]:
                continue
            part = {name: values[start:i] for name, values in columns.items()}
            if held is not None and current == keys[start]:
                for name, values in part.items():
                    held[name].extend(values)
            else:
                if held is not None:
                    yield current, held
                current, held = keys[start], part
            start = i
    if held is not None:
        yield current, held


class Forest:
    """Union-find over the rows of one group; the root is the smallest member."""

    def __init__(self, n: int):
        self.parent = list(range(n))

    def root(self, i: int) -> int:
        while self.parent[i] != i:
            self.parent[i] = self.parent[self.parent[i]]
            i = self.parent[i]
        return i

    def join(self, i: int, j: int) -> bool:
        a, b = self.root(i), self.root(j)
        if a == b:
            return False
        self.parent[max(a, b)] = min(a, b)
        return True


def connected_components(edges: DataFrame, left: str, right: str) -> DataFrame:
    """``(node, component)``: the smallest node reachable, for every node of an edge.

    Alternates two rewirings until nothing changes: every node's larger
    neighbours are hung on its smallest one, then its smaller ones are. Each
    round is an aggregate and a join, written to the shared folder, so neither
    links nor components pass through the driver, and the rounds grow with the
    logarithm of the longest chain. Nodes without edges are not listed.
    """
    spark = edges.sparkSession
    links = (
        edges.where(F.col(left) != F.col(right))
        .select(F.greatest(left, right).alias("u"), F.least(left, right).alias("v"))
        .distinct()
    )
    folder = new_work_folder(spark, "components")
    links = materialise(links, "components", folder=folder)
    state = _state(links)
    while state[0]:
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = both.groupBy("u").agg(F.min("v").alias("low"))
        lowest = lowest.select("u", F.least("u", "low").alias("low"))
        large = (
            both.join(lowest, "u")
            .where(F.col("v") > F.col("u"))
            .select(F.col("v").alias("u"), F.col("low").alias("v"))
            .distinct()
        )
        smallest = large.groupBy("u").agg(F.min("v").alias("low"))
        small = (
            large.join(smallest, "u")
            .select(F.when(F.col("v") == F.col("low"), F.col("u")).otherwise(F.col("v")).alias("u"),
                    F.col("low").alias("v"))
            .where("u != v")
            .distinct()
        )
        previous, folder = folder, new_work_folder(spark, "components")
        links = materialise(small, "components", folder=folder)
        remove_work_folder(spark, previous)
        before, state = state, _state(links)
        if state == before:
            break
    roots = links.select("v").distinct()
    return links.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        roots.select(F.col("v").alias("node"), F.col("v").alias("component"))
    )


def _state(links: DataFrame) -> tuple:
    row = links.agg(
        F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
    ).first()
    return row[0], row[1]


def measured(df: DataFrame, row_bytes: int = 16) -> DataFrame:
    """With a broadcast hint if the table, which is already written, is small;
    larger ones are joined by a shuffle."""
    return F.broadcast(df) if df.count() * row_bytes <= BROADCAST_BYTES else df


def arrow_rows(schema: pa.Schema, rows: dict[str, list]) -> pa.RecordBatch:
    return pa.record_batch(
        [pa.array(rows[f.name], type=f.type) for f in schema], schema=schema
    )


def texts_of(column: pa.Array) -> list[str]:
    """Values of a string column with null as empty text."""
    return ["" if t is None else t for t in column.to_pylist()]

