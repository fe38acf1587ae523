"""Sparse vectors held in one row, as ``map<int, double>`` of index to value.

For vectors that already share a row these need no shuffle; for vectors in
different tables, or too large for a row, see :mod:`gridloom.operators.vectors`.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def from_pairs(indices: Column | str, values: Column | str) -> Column:
    """The map of two parallel arrays."""
    return F.map_from_arrays(indices, values)


def from_dense(values: Column | str, *, above: float = 0.0) -> Column:
    """The entries of an array whose magnitude exceeds ``above``."""
    values = (F.col(values) if isinstance(values, str) else values).cast("array<double>")
    pairs = F.transform(values, lambda x, i: F.struct(i.alias("key"), x.alias("value")))
    return F.map_from_entries(F.filter(pairs, lambda p: F.abs(p["value"]) > above))


def to_dense(vector: Column | str, size: Column | int) -> Column:
    """An array of ``size`` values, 0 where there is no entry."""
    vector = F.col(vector) if isinstance(vector, str) else vector
    last = (size if isinstance(size, Column) else F.lit(size)) - 1
    return F.transform(
        F.sequence(F.lit(0), last), lambda i: F.coalesce(vector[i], F.lit(0.0))
    )


def add(a: Column | str, b: Column | str) -> Column:
    """Entry-wise sum over the union of the indices; null is an empty vector."""
    return F.map_zip_with(
        _known(a), _known(b), lambda _, x, y: F.coalesce(x, F.lit(0.0)) + F.coalesce(y, F.lit(0.0))
    )


def multiply(a: Column | str, b: Column | str) -> Column:
    """Entry-wise product over the intersection of the indices."""
    both = F.map_zip_with(_known(a), _known(b), lambda _, x, y: x * y)
    return F.map_filter(both, lambda _, v: v.isNotNull())


def shift(vector: Column | str, offset: Column | int) -> Column:
    """Indices moved up by ``offset``."""
    step = offset if isinstance(offset, Column) else F.lit(offset)
    return F.transform_keys(vector, lambda i, _: (i + step).cast("int"))


def scale(vector: Column | str, factor: float) -> Column:
    """Every entry times a number."""
    return F.transform_values(vector, lambda _, v: v * F.lit(float(factor)))


def concat(vectors: list[Column | str], sizes: list[Column | int]) -> Column:
    """Vectors of the given sizes laid end to end."""
    offset, moved = F.lit(0), []
    for vector, size in zip(vectors, sizes, strict=True):
        moved.append(shift(vector, offset))
        offset = offset + size
    return F.map_concat(*moved)


def indices(vector: Column | str) -> Column:
    """The indices in ascending order."""
    return F.array_sort(F.map_keys(vector))


def _known(vector: Column | str) -> Column:
    empty = F.create_map().cast("map<int,double>")
    return F.coalesce(F.col(vector) if isinstance(vector, str) else vector, empty)
