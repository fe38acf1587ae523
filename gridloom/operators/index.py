"""Dense ordinals, index maps of a column's values, and joining them back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gridloom.session import materialise

# An index map below this many bytes is sent to every executor.
BROADCAST_BYTES = 64 * 1024 * 1024

# A key with more than this share of all rows is hot; fewer than 1 / HOT_SHARE
# keys can be.
HOT_SHARE = 1e-4

# Allowance for an index and a hash-table slot next to the bytes of a key.
ENTRY_BYTES = 48

_ROW_BITS = 33  # monotonically_increasing_id keeps the partition above these


def ordinals(
    df: DataFrame,
    order_by: list[Column | str],
    name: str = "ordinal",
    *,
    kind: str = "long",
    folder: str | None = None,
) -> DataFrame:
    """Zero-based position of every row in the given total order.

    No one-partition window over the rows: the sort is range-partitioned, rows
    are numbered inside their partition, and only the partition sizes (one row
    each) are summed up in order. The sorted table is written out first, so
    both uses of it see the same partitions even if executors are lost.
    """
    mark, part, offset = "__mark", "__part", "__offset"
    placed = materialise(
        df.orderBy(*order_by).withColumn(mark, F.monotonically_increasing_id()),
        "ordinals",
        folder=folder,
    )
    in_part = placed.select(
        *df.columns,
        F.shiftright(mark, _ROW_BITS).cast("int").alias(part),
        F.col(mark).bitwiseAND(F.lit((1 << _ROW_BITS) - 1)).alias(offset),
    )
    starts = (
        in_part.groupBy(part)
        .agg(F.count("*").alias("rows"))
        .select(
            part,
            F.coalesce(
                F.sum("rows").over(
                    W.orderBy(part).rowsBetween(W.unboundedPreceding, -1)
                ),
                F.lit(0),
            ).alias("start"),
        )
    )
    position = F.col("start") + F.col(offset)
    if kind == "int":
        too_many = F.raise_error(F.lit(f"{name}: more than 2^31 rows, use kind='long'"))
        position = F.when(position < 2**31, position).otherwise(too_many.cast("long"))
    return in_part.join(F.broadcast(starts), part).select(
        *df.columns, position.cast(kind).alias(name)
    )


def index_map(
    df: DataFrame,
    key: str,
    index_name: str = "index",
    *,
    kind: str = "int",
    count_name: str | None = None,
) -> DataFrame:
    """``(key, index)``: 0, 1, ... over the distinct values in ascending order.

    The key keeps its type; null gets no index. ``kind="long"`` is for more
    than 2^31 values (an ``int`` index raises beyond them). ``count_name`` adds
    the number of rows per key.
    """
    counted = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("__rows"))
    numbered = ordinals(counted, [key], index_name, kind=kind)
    if count_name:
        return numbered.select(key, index_name, F.col("__rows").alias(count_name))
    return numbered.select(key, index_name)


def zip_index(
    df: DataFrame,
    key: str,
    index_name: str = "index",
    *,
    how: str = "inner",
    kind: str = "int",
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Join a table with the index map of its own column.

    Rows with a null key drop out, or stay without an index with
    ``how="left"``. The size of the map decides how: up to
    ``broadcast_bytes`` it is broadcast, beyond that see
    :func:`join_around_hot_keys`.
    """
    indices = index_map(df, key, index_name, kind=kind, count_name="__rows")
    width = F.octet_length(F.col(key).cast("string")) + ENTRY_BYTES
    size = indices.agg(
        F.coalesce(F.sum(width), F.lit(0)).alias("bytes"),
        F.coalesce(F.max(width), F.lit(0)).alias("widest"),
        F.coalesce(F.sum("__rows"), F.lit(0)).alias("rows"),
    ).first()
    unique = indices.drop("__rows")
    columns = [*df.columns, index_name]
    if size["bytes"] <= broadcast_bytes:
        return df.join(F.broadcast(unique), key, how).select(*columns)
    hot = indices.where(F.col("__rows") > F.lit(HOT_SHARE * size["rows"])).drop("__rows")
    if size["widest"] / HOT_SHARE > BROADCAST_BYTES:
        # Keys so long that even the few hot ones might not fit: adaptive
        # execution splits their partitions.
        return df.join(unique, key, how).select(*columns)
    return join_around_hot_keys(df, unique, hot, key, how).select(*columns)


def join_around_hot_keys(
    rows: DataFrame, unique: DataFrame, hot: DataFrame, key: str, how: str = "inner"
) -> DataFrame:
    """Equi-join to a table unique on ``key`` without moving rows of hot keys.

    ``hot`` are the entries of ``unique`` for keys holding more than
    ``HOT_SHARE`` of the rows, hence fewer than ``1 / HOT_SHARE`` entries:
    they are broadcast and their rows joined in place. Only the rows of other
    keys are shuffled, and none of those keys is large. With ``how="left"``
    rows without a key are set aside as well.
    """
    hot_keys = F.broadcast(hot.select(key))
    warm = rows.join(F.broadcast(hot), key)
    keyed = rows.where(F.col(key).isNotNull())
    cold = keyed.join(hot_keys, key, "left_anti").join(unique.hint("merge"), key, how)
    joined = warm.unionByName(cold)
    if how == "left":
        joined = joined.unionByName(rows.where(F.col(key).isNull()), allowMissingColumns=True)
    return joined
