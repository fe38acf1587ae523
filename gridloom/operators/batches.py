"""Shuffled mini-batches."""

from __future__ import annotations

import math
from bisect import bisect_right
from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.operators.index import _ROW_BITS, ordinals
from gridloom.sources.text import random_order


def exact_batches(
    df: DataFrame,
    key: list[str],
    batch_size: int = 64,
    *,
    seed: int = 1,
    epoch: int = 0,
    folder: str | None = None,
) -> DataFrame:
    """Rows in shuffled order with ``position`` and ``batch``.

    The order is by a hash of key, seed and epoch: every row once per epoch,
    every batch full but the last. One range-partitioned sort, no matter how
    large the table. Rows that share a key are ordered by a hash of the whole
    row, so that many rows with one key still spread over partitions.
    """
    order, tie = "__order", "__tie"
    shuffled = ordinals(
        df.select("*", random_order(key, seed, epoch).alias(order), F.xxhash64(*df.columns).alias(tie)),
        [order, tie],
        "position",
        folder=folder,
    )
    return shuffled.drop(order, tie).withColumn(
        "batch", F.floor(F.col("position") / batch_size).cast("long")
    )


def hashed_batches(
    df: DataFrame, key: list[str], n_batches: int, *, seed: int = 1, epoch: int = 0
) -> DataFrame:
    """Rows with a ``batch`` below ``n_batches``, without any shuffle.

    Batches are equal in expectation only; for exact sizes see
    :func:`exact_batches`.
    """
    first60 = F.conv(F.substring(random_order(key, seed, epoch), 1, 15), 16, 10).cast("long")
    return df.withColumn("batch", F.pmod(first60, F.lit(n_batches).cast("long")))


# Rows of an epoch are pruned by row groups of this size when a batch is read.
ROW_GROUP_BYTES = 4 * 1024 * 1024


class WrittenEpoch:
    """All batches of an epoch from one ordered write.

    The rows are sorted as :func:`exact_batches` sorts them and written once,
    numbered inside their partitions. Where a batch starts and ends follows
    from the partition sizes, which are all the driver keeps, one number each.
    A batch is a range of row numbers, and reads the row groups that hold it.
    """

    def __init__(
        self, df: DataFrame, key: list[str], batch_size: int, folder: str, *, seed: int = 1, epoch: int = 0
    ):
        order, tie, self.mark = "__order", "__tie", "__mark"
        self.columns, self.batch_size = df.columns, batch_size
        shuffled = df.select("*", random_order(key, seed, epoch).alias(order), F.xxhash64(*df.columns).alias(tie))
        numbered = shuffled.orderBy(order, tie).select(*df.columns, F.monotonically_increasing_id().alias(self.mark))
        numbered.write.option("parquet.block.size", ROW_GROUP_BYTES).parquet(folder)
        self.rows = df.sparkSession.read.schema(numbered.schema).parquet(folder)
        part = F.shiftright(self.mark, _ROW_BITS).alias("part")
        sizes = sorted(map(tuple, self.rows.groupBy(part).count().collect()))
        self.parts = [p for p, _ in sizes]
        self.starts = [0, *accumulate(n for _, n in sizes)]
        self.total = self.starts[-1]
        self.n_batches = math.ceil(self.total / batch_size)

    def _mark_at(self, position: int) -> int:
        i = bisect_right(self.starts, position) - 1
        return (self.parts[i] << _ROW_BITS) + position - self.starts[i]

    def batch(self, number: int) -> DataFrame:
        """The rows of one batch, the last of which may be short."""
        first = number * self.batch_size
        last = min(first + self.batch_size, self.total) - 1
        own = F.col(self.mark).between(self._mark_at(first), self._mark_at(last))
        return self.rows.where(own).select(*self.columns)
