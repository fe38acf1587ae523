"""Element-wise arithmetic on array columns."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, FloatType

# The range of a pixel byte, and mean and standard deviation of
# pixels already scaled to 0-1.
PIXEL_MIN = 0.0
PIXEL_MAX = 255.0
PIXEL_MEAN = 0.1307
PIXEL_STD = 0.3081

Setting = float | Column

_UNIT = ((np.arange(256) - PIXEL_MIN) / (PIXEL_MAX - PIXEL_MIN)).astype(np.float32)


def _doubles(values: Column | str) -> Column:
    column = F.col(values) if isinstance(values, str) else values
    return column.cast("array<double>")


def _at(setting: Setting, position: Column) -> Column:
    """A scalar for all positions, or the entry of an array column."""
    if isinstance(setting, Column):
        return F.get(setting, position)
    return F.lit(float(setting))


def _ratio_or_zero(x: Column, top: Column, bottom: Column) -> Column:
    """``top / bottom``, 0 where the bottom is 0; a null element stays null."""
    return F.coalesce(
        top / F.nullif(bottom, F.lit(0.0)), F.when(x.isNotNull(), F.lit(0.0))
    )


def _shift_and_divide(values: Column | str, shift: float, divisor: float) -> Column:
    """``(x - shift) / divisor`` by constants, as short as it can be: the
    function runs once per element."""
    if divisor == 0:
        return F.transform(_doubles(values), lambda x: F.when(x.isNotNull(), F.lit(0.0)))
    moved = (lambda x: x - F.lit(float(shift))) if shift else (lambda x: x)
    return F.transform(_doubles(values), lambda x: moved(x) / F.lit(float(divisor)))


def scale(values: Column | str, divisor: float = PIXEL_MAX) -> Column:
    """Every element divided by a constant."""
    return _shift_and_divide(values, 0.0, divisor)


def min_max(
    values: Column | str, low: Setting = PIXEL_MIN, high: Setting = PIXEL_MAX
) -> Column:
    """``(x - low) / (high - low)``, 0 where the two are equal.

    ``low`` and ``high`` are numbers or arrays with one entry per position.
    """
    if not isinstance(low, Column) and not isinstance(high, Column):
        return _shift_and_divide(values, low, high - low)

    def one(x: Column, i: Column) -> Column:
        lo, hi = _at(low, i), _at(high, i)
        return _ratio_or_zero(x, x - lo, hi - lo)

    return F.transform(_doubles(values), one)


def standardise(
    values: Column | str, mean: Setting = PIXEL_MEAN, std: Setting = PIXEL_STD
) -> Column:
    """``(x - mean) / std`` with scalars or per-position arrays; 0 where the
    spread is 0."""
    if not isinstance(mean, Column) and not isinstance(std, Column):
        return _shift_and_divide(values, mean, std)

    def one(x: Column, i: Column) -> Column:
        mu, sigma = _at(mean, i), _at(std, i)
        return _ratio_or_zero(x, x - mu, sigma)

    return F.transform(_doubles(values), one)


def flatten_grid(grid: Column | str) -> Column:
    """An image as rows of pixels laid out as one vector."""
    return F.flatten(grid)


def row_argmax(scores: Column | str) -> Column:
    """Zero-based position of the largest score, the first one of ties."""
    scores = F.col(scores) if isinstance(scores, str) else scores
    return (F.array_position(scores, F.array_max(scores)) - 1).cast("int")


def _pack(values: pa.Array, dtype: str) -> pa.Array:
    if isinstance(values, pa.ChunkedArray):
        values = values.combine_chunks()
    if values.flatten().null_count:
        raise ValueError("cannot pack an array holding nulls")
    size = np.dtype(dtype).itemsize
    flat = np.ascontiguousarray(values.flatten().to_numpy(zero_copy_only=False), dtype)
    lengths = np.asarray(values.value_lengths().fill_null(0), dtype=np.int64)
    offsets = np.concatenate([[0], np.cumsum(lengths * size)]).astype(np.int32)
    mask = None
    if values.null_count:
        mask = pa.array(values.is_valid()).buffers()[1]
    return pa.Array.from_buffers(
        pa.binary(), len(values),
        [mask, pa.py_buffer(offsets.tobytes()), pa.py_buffer(flat.tobytes())],
    )


@F.arrow_udf(BinaryType())
def _pack_big_endian(values: pa.Array) -> pa.Array:
    return _pack(values, ">f4")


@F.arrow_udf(ArrayType(FloatType()))
def _unpack_big_endian(packed: pa.Array) -> pa.Array:
    if isinstance(packed, pa.ChunkedArray):
        packed = packed.combine_chunks()
    width = np.int64 if pa.types.is_large_binary(packed.type) else np.int32
    _, offsets, data = packed.buffers()
    offsets = np.frombuffer(offsets, width)[packed.offset : packed.offset + len(packed) + 1]
    if (np.diff(offsets) % 4).any():
        raise ValueError("packed floats take four bytes each")
    flat = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data else np.empty(0, np.uint8)
    ends = pa.array(((offsets - offsets[0]) // 4).astype(np.int32), mask=_list_mask(packed))
    return pa.ListArray.from_arrays(ends, pa.array(np.frombuffer(flat.tobytes(), ">f4").astype("f4")))


@F.arrow_udf(ArrayType(FloatType()))
def _unit_bytes(column: pa.Array) -> pa.Array:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    width = np.int64 if pa.types.is_large_binary(column.type) else np.int32
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, width)[column.offset : column.offset + len(column) + 1]
    flat = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data else np.empty(0, np.uint8)
    ends = pa.array((offsets - offsets[0]).astype(np.int32), mask=_list_mask(column))
    return pa.ListArray.from_arrays(ends, pa.array(_UNIT[flat]))


def _list_mask(column: pa.Array) -> np.ndarray | None:
    """Which offsets belong to null rows; the last one to none."""
    if not column.null_count:
        return None
    return np.append(column.is_null().to_numpy(zero_copy_only=False), False)


def unit_bytes(pixels: Column | str) -> Column:
    """Bytes as floats of 0-1: what :func:`min_max` gives for pixel arrays.

    One table look-up per byte, in an Arrow batch function, so that rows can
    travel as bytes, a quarter of what floats take.
    """
    return _unit_bytes(pixels)


def pack_floats(values: Column | str) -> Column:
    """An array as consecutive 4-byte big-endian floats.

    Spark has no float-to-bytes cast, so this is one Arrow batch function.
    """
    column = F.col(values) if isinstance(values, str) else values
    return _pack_big_endian(column.cast("array<float>"))


def unpack_floats(packed: Column | str) -> Column:
    """Inverse of :func:`pack_floats`."""
    return _unpack_big_endian(packed)
