"""Counts, frequencies, column ranges and change counters."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gridloom.functions.labels import CLASS_NAMES, UNKNOWN_CLASS, class_name
from gridloom.functions.texts import column_name, tokens
from gridloom.operators.combine import CHUNK_SCHEMA, chunk_rows, reduce_chunks
from gridloom.operators.extrema import extremum_moves
from gridloom.operators.index import ordinals
from gridloom.session import materialise
from gridloom.sources.binary import RECORD_LENGTH, _bytes_block, _decode, whole_records

# Records per segment when a file's running extremum is followed in parallel.
SEGMENT_RECORDS = 65536


# --- counts ---------------------------------------------------------------


def class_counts(
    df: DataFrame,
    label: str = "label",
    names: dict[int, str] = CLASS_NAMES,
    default: str = UNKNOWN_CLASS,
) -> DataFrame:
    """``(class_name, n)``: rows per named class.

    Counting by code first keeps the name lookup off the row path.
    """
    by_code = df.groupBy(F.col(label).alias("code")).agg(F.count("*").alias("n"))
    return by_code.groupBy(class_name("code", names, default).alias("class_name")).agg(
        F.sum("n").alias("n")
    )


def row_count(df: DataFrame) -> DataFrame:
    """One row, ``n``."""
    return df.agg(F.count("*").alias("n"))


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """The values of a column, each once, null included."""
    return df.select(column).distinct()


def count_distinct_values(df: DataFrame, column: str) -> DataFrame:
    """One row, ``n``; unlike SQL's ``count(distinct)`` null is a value."""
    return distinct_values(df, column).agg(F.count("*").alias("n"))


def nunique(df: DataFrame, column: str) -> int:
    """The number of distinct values, null counted as one."""
    return distinct_values(df, column).count()


# --- token frequencies ----------------------------------------------------


def token_counts(
    df: DataFrame, text: str = "value", *, skip_first: bool = False
) -> DataFrame:
    """``(token, n)`` over all lines, tokens in lower case; counted in each task
    before the shuffle."""
    written = df.select(F.explode(tokens(text, skip_first=skip_first)).alias("token"))
    return written.groupBy(F.lower("token").alias("token")).agg(F.count("*").alias("n"))


def most_frequent(counts: DataFrame) -> DataFrame:
    """The row with the highest count; of ties the largest token text."""
    return _extreme(counts, F.max)


def least_frequent(counts: DataFrame) -> DataFrame:
    """The row with the lowest count; of ties the smallest token text."""
    return _extreme(counts, F.min)


def _extreme(counts: DataFrame, pick) -> DataFrame:
    best = counts.agg(pick(F.struct("n", "token")).alias("best"))
    return best.where(F.col("best").isNotNull()).select("best.token", "best.n")


def top_tokens(counts: DataFrame, k: int) -> DataFrame:
    """The ``k`` most frequent tokens, kept per task and then merged."""
    return counts.orderBy(F.desc("n"), F.desc("token")).limit(k)


def bottom_tokens(counts: DataFrame, k: int) -> DataFrame:
    """The ``k`` least frequent tokens."""
    return counts.orderBy(F.asc("n"), F.asc("token")).limit(k)


# --- per-column range -----------------------------------------------------


# Columns whose statistics travel together.
STATISTICS_CHUNK = 1024

# Element types whose values a double holds exactly; others are counted by expressions.
_EXACT_IN_DOUBLES = ("tinyint", "smallint", "int", "float", "double")


def column_statistics(df: DataFrame, values: str = "pixels", *, moments: bool = True) -> DataFrame:
    """``(col, n, mean, m2, min, max)`` per position of rows of numbers or bytes.

    Every task reduces its batches to a count, mean, sum of squared deviations,
    minimum and maximum per position; two such sets are merged pairwise, which
    is as exact as going through all rows. A task sends five numbers per
    position. Nulls are left out; where a position has no value, all but ``n``
    are null. NaN is a value, larger than any other. Without ``moments`` mean
    and ``m2`` are 0.
    """

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = _empty_statistics(0)
        for batch in batches:
            if batch.num_rows:
                held = _merged_statistics(held, _batch_statistics(batch.column(0), moments))
        for i, start in enumerate(range(0, held.shape[1], STATISTICS_CHUNK)):
            yield chunk_rows(i, np.ascontiguousarray(held[:, start : start + STATISTICS_CHUNK]).reshape(-1))

    def merge(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return _merged_statistics(a.reshape(5, -1), b.reshape(5, -1)).reshape(-1)

    chunks = reduce_chunks(df.select(values).mapInArrow(partial, CHUNK_SCHEMA), merge)
    width = F.expr("size(sums) div 5")
    rows = chunks.select(
        "chunk", F.posexplode(F.slice("sums", F.lit(1), width)).alias("at", "n"), "sums", width.alias("width")
    )

    def number(k: int) -> Column:
        value = F.get("sums", F.col("at") + k * F.col("width"))
        return F.when(F.col("n") > 0, value)

    return rows.select(
        (F.col("chunk") * STATISTICS_CHUNK + F.col("at")).alias("col"), F.col("n").cast("long").alias("n"),
        *(number(k).alias(name) for k, name in enumerate(("mean", "m2", "min", "max"), 1)),
    )


def _empty_statistics(width: int) -> np.ndarray:
    """Rows n, mean, m2, min, max."""
    held = np.zeros((5, width))
    held[3], held[4] = np.inf, -np.inf
    return held


def _merged_statistics(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Statistics of both parts; the narrower lacks the last positions."""
    width = max(a.shape[1], b.shape[1])
    a, b = (np.hstack([x, _empty_statistics(width - x.shape[1])]) if x.shape[1] < width else x for x in (a, b))
    n = a[0] + b[0]
    share = b[0] / np.maximum(n, 1)
    apart = b[1] - a[1]
    both = (a[0] > 0) & (b[0] > 0)
    mean = np.where(both, a[1] + apart * share, np.where(a[0] > 0, a[1], b[1]))
    m2 = a[2] + b[2] + np.where(both, apart * apart * a[0] * share, 0.0)
    low = np.where(both, np.fmin(a[3], b[3]), np.where(a[0] > 0, a[3], b[3]))
    return np.stack([n, mean, m2, low, np.maximum(a[4], b[4])])


def _batch_statistics(column: pa.Array, moments: bool, rows: int = 256) -> np.ndarray:
    if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type):
        column = column.drop_null()
        flat, offsets = _bytes_block(column)
        lengths, flat, valid = np.diff(offsets), flat[offsets[0] : offsets[-1]], None
    else:
        lengths = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
        values = column.flatten()
        valid = values.is_valid().to_numpy(zero_copy_only=False) if values.null_count else None
        flat = values.fill_null(0).to_numpy(zero_copy_only=False)
    if not len(lengths):
        return _empty_statistics(0)
    width = int(lengths.max())
    if valid is None and (lengths == width).all():
        if not width:
            return _empty_statistics(0)
        return _block_statistics(flat.reshape(-1, width), moments, rows)
    held, starts = _empty_statistics(width), np.concatenate([[0], np.cumsum(lengths)])
    for at in range(0, len(lengths), rows):  # ragged rows or nulls: rows filled up, with a mask
        some = lengths[at : at + rows]
        present = np.arange(width) < some[:, None]
        block = np.zeros(present.shape)
        block[present] = flat[starts[at] : starts[at + len(some)]]
        if valid is not None:
            present[present] = valid[starts[at] : starts[at + len(some)]]
        held = _merged_statistics(held, _masked_statistics(block, present, moments))
    return held


def _masked_statistics(block: np.ndarray, present: np.ndarray, moments: bool) -> np.ndarray:
    n = present.sum(axis=0).astype(np.float64)
    mean = m2 = np.zeros(len(n))
    if moments:
        mean = np.where(present, block, 0.0).sum(axis=0) / np.maximum(n, 1)
        m2 = np.where(present, (block - mean) ** 2, 0.0).sum(axis=0)
    low = np.fmin.reduce(np.where(present, block, np.nan), axis=0)  # NaN only where nothing else is
    return np.stack([n, mean, m2, low, np.where(present, block, -np.inf).max(axis=0)])


def _block_statistics(block: np.ndarray, moments: bool, rows: int) -> np.ndarray:
    """Of a block without gaps, a stretch of rows at a time that stays in cache."""
    held = _empty_statistics(block.shape[1])
    for at in range(0, len(block), rows):
        some = block[at : at + rows]
        n = np.full(block.shape[1], float(len(some)))
        mean = m2 = np.zeros(block.shape[1])
        if moments and some.dtype == np.uint8:  # sums of bytes and their squares are exact
            total = np.add.reduce(some, axis=0, dtype=np.uint32).astype(np.float64)
            wide = some.astype(np.uint16)
            squares = np.add.reduce(wide * wide, axis=0, dtype=np.uint32).astype(np.float64)
            mean, m2 = total / n, squares - total * total / n
        elif moments:
            mean = some.mean(axis=0, dtype=np.float64)
            m2 = ((some - mean) ** 2).sum(axis=0)
        low = np.fmin.reduce(some, axis=0) if some.dtype.kind == "f" else some.min(axis=0)
        held = _merged_statistics(held, np.stack([n, mean, m2, low, some.max(axis=0)]))
    return held


def _element_type(df: DataFrame, values: str) -> str | None:
    """Of the values if a double holds them, ``int`` for bytes, else None."""
    kind = df.schema[values].dataType.simpleString()
    element = "int" if kind == "binary" else kind.removeprefix("array<").removesuffix(">")
    return element if element in _EXACT_IN_DOUBLES else None


def column_range(
    df: DataFrame, values: str = "pixels", *, initial: float | None = None
) -> DataFrame:
    """``(col, name, max, min, n)`` per position of rows of numbers or bytes.

    ``initial`` starts both extrema at a number instead of at the data: with
    0.0 a minimum can never exceed 0. Every task reduces its rows to one row
    per position before the shuffle.
    """
    element = _element_type(df, values)
    if element:
        ranges = column_statistics(df, values, moments=False).select(
            "col", F.col("max").cast(element).alias("max"), F.col("min").cast(element).alias("min"), "n"
        )
    else:
        ranges = (
            df.select(F.posexplode(values).alias("col", "v"))
            .groupBy("col")
            .agg(F.max("v").alias("max"), F.min("v").alias("min"), F.count("v").alias("n"))
        )
    if initial is not None:
        start = F.lit(float(initial))
        ranges = ranges.withColumn("max", F.greatest("max", start)).withColumn(
            "min", F.least("min", start)
        )
    return ranges.select("col", column_name("col").alias("name"), "max", "min", "n")


def column_moments(df: DataFrame, values: str = "pixels") -> DataFrame:
    """``(col, mean, std)`` per position, population deviation."""
    if _element_type(df, values):
        spread = F.sqrt(F.greatest("m2", F.lit(0.0)) / F.nullif("n", F.lit(0).cast("long")))
        return column_statistics(df, values).select("col", "mean", spread.alias("std"))
    return (
        df.select(F.posexplode(values).alias("col", "v"))
        .groupBy("col")
        .agg(F.avg("v").alias("mean"), F.stddev_pop("v").alias("std"))
    )


# --- running extrema ------------------------------------------------------


def change_counts(
    df: DataFrame,
    *,
    file: str = "path",
    rec: str = "rec",
    values: str = "pixels",
    initial: float = 0.0,
    segment: int = SEGMENT_RECORDS,
) -> DataFrame:
    """``(col, max_changed, min_changed)``: how often, reading every file in
    record order, a column's running maximum (minimum) moved, over all files.

    A value not beyond the values before it in its own batch of rows cannot
    move the extremum, so batches are thinned first, and of equal values only
    the first counts. A window over whole files could still be one task's
    work, hence two levels: the extremum before each record segment from the
    segment extrema, then a window inside each segment over the values that
    pass it. The thinned table serves both and is written out once. Minima are
    followed as maxima of the negated values. Values compare as doubles.
    """
    key = df.schema[file].dataType.simpleString()
    thinned = df.select(
        F.col(file).alias("file"),
        F.col(rec).cast("long").alias("rec"),
        F.col(values).alias("v"),
    ).mapInArrow(_thin_batches, f"file {key}, rec long, col int, v double, rising boolean")
    firsts = materialise(
        thinned.groupBy("rising", "file", "col", "v").agg(F.min("rec").alias("rec")), "changes"
    ).withColumn("seg", F.expr(f"rec div {int(segment)}"))
    column_key = ["rising", "file", "col"]

    start = F.when(F.col("rising"), F.lit(float(initial))).otherwise(F.lit(-float(initial)))
    earlier = W.partitionBy(*column_key).orderBy("seg").rowsBetween(W.unboundedPreceding, -1)
    reached = (
        firsts.groupBy(*column_key, "seg")
        .agg(F.max("v").alias("edge"))
        .select(*column_key, "seg", F.greatest(F.max("edge").over(earlier), start).alias("reached"))
    )
    before = W.partitionBy(*column_key, "seg").orderBy("rec").rowsBetween(W.unboundedPreceding, -1)
    # A null file is a file of its own, in the join as in the windows.
    same = F.lit(True)
    for name in (*column_key, "seg"):
        same = same & F.col(f"f.{name}").eqNullSafe(F.col(f"r.{name}"))
    moves = (
        firsts.alias("f").join(reached.alias("r"), same)
        .select("f.*", "r.reached")
        .where(F.col("v") > F.col("reached"))
        .withColumn("running", F.max("v").over(before))
        .where(F.col("running").isNull() | (F.col("v") > F.col("running")))
    )
    up = F.col("rising").cast("int")
    return (
        firsts.select("col", F.lit(0).alias("up"), F.lit(0).alias("down"))
        .unionByName(moves.select("col", up.alias("up"), (1 - up).alias("down")))
        .groupBy("col")
        .agg(F.sum("up").alias("max_changed"), F.sum("down").alias("min_changed"))
    )


def _thin_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(file, rec, col, v, rising)`` of the values beyond all earlier ones of
    their file and column in the same batch, negated where not rising."""
    for batch in batches:
        if not batch.num_rows:
            continue
        arrays = batch.column("v")
        lengths = arrays.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
        flat = arrays.flatten()
        # Rows of one width without nulls form a block; others pass unthinned.
        if flat.null_count == 0 and lengths[0] and (lengths == lengths[0]).all():
            files = batch.column("file").dictionary_encode().indices
            files = files.fill_null(-1).to_numpy(zero_copy_only=False)
            recs = batch.column("rec").to_numpy()
            block = flat.to_numpy().reshape(len(lengths), -1)
            for code in np.unique(files):
                own = np.flatnonzero(files == code)
                own = own[np.argsort(recs[own], kind="stable")]
                for rising in (True, False):
                    edge = block[own[0]].copy()
                    if edge.dtype.kind == "f":
                        edge[np.isnan(edge)] = -np.inf if rising else np.inf
                    first = own[:1].repeat(len(edge))
                    yield _candidates(batch, first, np.arange(len(edge)), edge, rising)
                    for row, col, values in extremum_moves(block, own[1:], edge, rising):
                        yield _candidates(batch, row, col, values, rising)
        else:
            row = np.repeat(np.arange(len(lengths)), lengths)
            col = np.arange(len(row)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
            usable = flat.is_valid()
            if pa.types.is_floating(flat.type):
                usable = pc.and_(usable, pc.invert(pc.fill_null(pc.is_nan(flat), True)))
            kept = usable.to_numpy(zero_copy_only=False)
            values = flat.filter(usable).to_numpy()
            for rising in (True, False):
                yield _candidates(batch, row[kept], col[kept], values, rising)


def _candidates(
    batch: pa.RecordBatch, row: np.ndarray, col: np.ndarray, values: np.ndarray, rising: bool
) -> pa.RecordBatch:
    rows = pa.array(row, pa.int64())
    return pa.RecordBatch.from_arrays(
        [
            batch.column("file").take(rows),
            batch.column("rec").take(rows),
            pa.array(col, pa.int32()),
            pa.array(values.astype(np.float64) * (1.0 if rising else -1.0)),
            pa.array(np.full(len(row), rising)),
        ],
        names=["file", "rec", "col", "v", "rising"],
    )


def file_column_profile(
    files: DataFrame,
    record_length: int = RECORD_LENGTH,
    *,
    signed_shift: bool = False,
    on_partial: str = "error",
) -> DataFrame:
    """``(col, name, max, min, max_changed, min_changed)`` straight from file
    contents, extrema starting at 0.

    A file is one row here, so each task follows the running extrema of its
    files while decoding and sends one row per column to the shuffle; no pixel
    leaves the task. Bytes cannot fall below the starting minimum, so ``min``
    and ``min_changed`` are 0. For files of any size, and for the true minimum,
    see :func:`gridloom.operators.extrema.column_extrema`.
    """

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = record_length - 1
        top = np.zeros(width, np.int64)
        rises = np.zeros(width, np.int64)
        seen = False
        for batch in batches:
            flat, offsets = _bytes_block(batch.column("content"))
            for row, path in enumerate(batch.column("path").to_pylist()):
                content = flat[offsets[row] : offsets[row + 1]]
                block = whole_records(content, path, record_length, on_partial)
                if not len(block):
                    continue
                seen = True
                _, pixels = _decode(block, signed_shift)
                edge = np.zeros(width, np.uint8)
                for _, col, _ in extremum_moves(pixels, np.arange(len(pixels)), edge, True):
                    rises += np.bincount(col, minlength=width)
                top = np.maximum(top, edge)
        if seen:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(width, dtype=np.int32))]
                + [pa.array(a) for a in (top, rises)],
                names=["col", "max", "max_changed"],
            )

    partials = (
        files.where(F.col("content").isNotNull())
        .select("path", "content")
        .mapInArrow(partial, "col int, max long, max_changed long")
    )
    return (
        partials.groupBy("col")
        .agg(
            F.max("max").cast("float").alias("max"),
            F.lit(0.0).cast("float").alias("min"),
            F.sum("max_changed").alias("max_changed"),
            F.lit(0).cast("long").alias("min_changed"),
        )
        .select(
            "col", column_name("col").alias("name"), "max", "min", "max_changed", "min_changed"
        )
    )


# --- ordinals -------------------------------------------------------------


def file_ordinals(files: DataFrame, order_by: Column | str = "path") -> DataFrame:
    """Zero-based ``ordinal`` of each file in path order."""
    return ordinals(files, [order_by], "ordinal")
