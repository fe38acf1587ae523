"""Whole-file scans and fixed-length labelled records."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the binary image format: one label byte and 32 x 32 x 3
# pixel bytes per record, 10,000 records per file.
RECORD_LENGTH = 3073
RECORDS_PER_FILE = 10000

# File sets without a larger file are read whole files at a time, several per
# task; others in record ranges, several tasks per file. The rows are the same.
SMALL_FILE = 8 * 1024 * 1024

# A column value holds no more bytes, so neither does a file read as one row.
LARGEST_ROW = 2**31 - 1

# Within a partition, rows are numbered in these bits.
_ROW_MASK = (1 << 33) - 1

# Bytes of decoded pixels handed to Spark per Arrow batch.
_BATCH_BYTES = 4 * 1024 * 1024

Paths = str | list[str]


def scan_files(
    spark: SparkSession, paths: Paths, *, glob: str | None = None, recursive: bool = False
) -> DataFrame:
    """One row per file: path, modificationTime, length, content.

    Spark reads ``content`` only if a later step uses it. ``glob`` keeps files
    by name, ``recursive`` descends into subfolders.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", recursive)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(paths)


def read_split(
    read: Callable[[Paths], DataFrame], *, train: Paths, test: Paths
) -> DataFrame:
    """Read two file sets with one reader, told apart by a ``split`` column."""
    return (
        read(train)
        .withColumn("split", F.lit("train"))
        .unionByName(read(test).withColumn("split", F.lit("test")))
    )


def _bytes_block(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Flat unsigned bytes of a binary column and its row offsets."""
    if not len(column):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    width = np.int64 if pa.types.is_large_binary(column.type) else np.int32
    _, offsets_buffer, data = column.buffers()
    offsets = np.frombuffer(offsets_buffer, dtype=width)
    offsets = offsets[column.offset : column.offset + len(column) + 1]
    flat = np.frombuffer(data, dtype=np.uint8) if data else np.empty(0, np.uint8)
    return flat, offsets


# Spark types a record's pixels can be decoded to, by name.
PIXEL_FORMS = {"binary": "binary", "array": "array<int>", "none": None}


def _record_schema(form: str) -> str:
    if form not in PIXEL_FORMS:
        raise ValueError(f"pixels is one of {sorted(PIXEL_FORMS)}")
    kind = PIXEL_FORMS[form]
    return "path string, rec long, label int" + (f", pixels {kind}" if kind else "")


def _record_batch(
    path: pa.Array, rec: pa.Array, block: np.ndarray, form: str, signed_shift: bool
) -> pa.RecordBatch:
    labels, pixels = _decode(block, signed_shift and form != "none")
    columns = {"path": path, "rec": rec, "label": pa.array(labels)}
    if form != "none":
        columns["pixels"] = _pixel_column(pixels, form)
    return pa.RecordBatch.from_pydict(columns)


def _pixel_column(pixels: np.ndarray, form: str) -> pa.Array:
    rows, width = pixels.shape
    offsets = np.arange(rows + 1, dtype=np.int32) * np.int32(width)
    if form == "array":
        values = pa.array(pixels.reshape(-1).astype(np.int32))
        return pa.ListArray.from_arrays(pa.array(offsets), values)
    data = pa.py_buffer(np.ascontiguousarray(pixels).tobytes())
    return pa.Array.from_buffers(
        pa.binary(), rows, [None, pa.py_buffer(offsets.tobytes()), data]
    )


def _decode(block: np.ndarray, signed_shift: bool) -> tuple[np.ndarray, np.ndarray]:
    """Labels and pixels of a (records, record_length) byte block."""
    labels = block[:, 0].astype(np.int32)
    pixels = block[:, 1:]
    return labels, pixels ^ np.uint8(128) if signed_shift else pixels


def whole_records(
    content: np.ndarray, path: str, record_length: int, on_partial: str
) -> np.ndarray:
    """View file bytes as (records, record_length), minding trailing bytes."""
    records, trailing = divmod(len(content), record_length)
    if trailing and on_partial == "error":
        raise ValueError(
            f"{path}: {trailing} bytes after {records} records of {record_length}"
        )
    return content[: records * record_length].reshape(records, record_length)


def split_records(
    files: DataFrame,
    record_length: int = RECORD_LENGTH,
    *,
    signed_shift: bool = False,
    on_partial: str = "error",
    pixels: str = "binary",
) -> DataFrame:
    """Split ``(path, content)`` rows into ``(path, rec, label, pixels)``.

    Pixels are unsigned bytes; ``signed_shift=True`` gives what adding 128 to
    the *signed* byte gives (0 -> 128, 200 -> 72). They come as ``binary``, as
    ``array`` of int, or not at all with ``none``: Spark cannot prune what a
    batch function returns, so say here if only labels are wanted. Trailing
    bytes that fill no record raise, or are left out with
    ``on_partial="drop"``.
    """
    if on_partial not in ("error", "drop"):
        raise ValueError("on_partial is 'error' or 'drop'")
    schema = _record_schema(pixels)
    step = max(1, _BATCH_BYTES // (record_length * (4 if pixels == "array" else 1)))

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat, offsets = _bytes_block(batch.column("content"))
            for row, path in enumerate(batch.column("path").to_pylist()):
                block = whole_records(
                    flat[offsets[row] : offsets[row + 1]], path, record_length, on_partial
                )
                for start in range(0, len(block), step):
                    some = block[start : start + step]
                    yield _record_batch(
                        pa.repeat(pa.scalar(path, pa.string()), len(some)),
                        pa.array(np.arange(start, start + len(some), dtype=np.int64)),
                        some,
                        pixels,
                        signed_shift,
                    )

    usable = files.where(F.col("content").isNotNull()).select("path", "content")
    return usable.mapInArrow(decode, schema)


def read_record_ranges(
    spark: SparkSession,
    paths: Paths,
    record_length: int = RECORD_LENGTH,
    *,
    signed_shift: bool = False,
    on_partial: str = "error",
    pixels: str = "binary",
    split_bytes: int | None = None,
) -> DataFrame:
    """The same rows as :func:`split_records`, with files split between tasks.

    Spark's fixed-length input cuts files on record edges into blocks of about
    ``split_bytes``, by default as the file system does, so size is no limit.
    A record's number follows from its block's start and its place in it.
    Unless pixels are wanted as arrays or shifted, no row leaves the JVM.

    Trailing bytes are found from the file lengths when the plan is built:
    they raise, or with ``on_partial="drop"`` the files that have some are read
    whole, without them.
    """
    _record_schema(pixels)
    whole, partial = _by_trailing_bytes(scan_files(spark, paths), paths, record_length, on_partial)
    options = {"signed_shift": signed_shift, "pixels": pixels}
    parts = []
    if whole:
        parts.append(_ranges(spark, whole, record_length, split_bytes=split_bytes, **options))
    if partial:
        parts.append(split_records(scan_files(spark, partial), record_length, on_partial="drop", **options))
    if not parts:
        return spark.createDataFrame([], _record_schema(pixels))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def _by_trailing_bytes(
    files: DataFrame, paths: Paths, record_length: int, on_partial: str
) -> tuple[Paths, list[str]]:
    """What to read in ranges, and the files to read whole for their trailing bytes.

    Reads lengths only. File names come to the driver where some file has
    trailing bytes and they are to be dropped; otherwise ``paths`` stand.
    """
    if on_partial not in ("error", "drop"):
        raise ValueError("on_partial is 'error' or 'drop'")
    trailing = files.where(F.col("length") % record_length != 0).select("path", "length")
    first = trailing.first()
    if first is None:
        return paths, []
    if on_partial == "error":
        records, extra = divmod(first["length"], record_length)
        raise ValueError(f"{first['path']}: {extra} bytes after {records} records of {record_length}")
    partial = trailing.collect()
    too_long = [r["path"] for r in partial if r["length"] > LARGEST_ROW]
    if too_long:
        raise ValueError(f"{too_long[0]}: trailing bytes of a file above {LARGEST_ROW} bytes cannot be dropped")
    whole = files.where(F.col("length") % record_length == 0).select("path").collect()
    return [r["path"] for r in whole], [r["path"] for r in partial]


def _ranges(
    spark: SparkSession,
    paths: Paths,
    record_length: int,
    *,
    signed_shift: bool,
    pixels: str,
    split_bytes: int | None,
) -> DataFrame:
    rows = _fixed_length_rows(spark, paths, record_length, split_bytes).select(
        F.input_file_name().alias("path"),
        (
            F.expr(f"input_file_block_start() div {record_length}")
            + F.monotonically_increasing_id().bitwiseAND(F.lit(_ROW_MASK))
        ).alias("rec"),
        F.col("value").alias("record"),
    )
    if pixels == "array" or (signed_shift and pixels == "binary"):
        return _decoded(rows, record_length, signed_shift, pixels)
    label = F.conv(F.hex(F.substring("record", 1, 1)), 16, 10).cast("int").alias("label")
    own = [F.substring("record", 2, record_length - 1).alias("pixels")] if pixels == "binary" else []
    return rows.select("path", "rec", label, *own)


def _fixed_length_rows(
    spark: SparkSession, paths: Paths, record_length: int, split_bytes: int | None
) -> DataFrame:
    """``value``: the records as bytes, one partition per block of a file."""
    sc = spark.sparkContext
    joined = paths if isinstance(paths, str) else ",".join(paths)
    conf, name = sc._jsc.hadoopConfiguration(), "mapreduce.input.fileinputformat.split.maxsize"
    before = conf.get(name)
    if split_bytes:
        conf.set(name, str(split_bytes))
    try:  # the settings are copied when the input is named
        records = sc._jsc.binaryRecords(joined, record_length).rdd()
    finally:
        if split_bytes:
            conf.set(name, before) if before is not None else conf.unset(name)
    as_bytes = sc._jvm.org.apache.spark.sql.Encoders.BINARY()
    return DataFrame(spark._jsparkSession.createDataset(records, as_bytes).toDF(), spark)


def _decoded(rows: DataFrame, record_length: int, signed_shift: bool, pixels: str) -> DataFrame:
    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            flat, offsets = _bytes_block(batch.column("record"))
            block = flat[offsets[0] : offsets[-1]].reshape(-1, record_length)
            yield _record_batch(
                batch.column("path"), batch.column("rec"), block, pixels, signed_shift
            )

    return rows.mapInArrow(decode, _record_schema(pixels))


def read_records(
    spark: SparkSession,
    paths: Paths,
    record_length: int = RECORD_LENGTH,
    *,
    signed_shift: bool = False,
    on_partial: str = "error",
    pixels: str = "binary",
) -> DataFrame:
    """Labelled records of binary files of any size.

    Looks at the file lengths first (no content is read). Sets of small files
    are read several files per task, sets with a larger one in record ranges,
    see :func:`read_record_ranges`; both treat trailing bytes alike.
    """
    files = scan_files(spark, paths)
    options = {"signed_shift": signed_shift, "on_partial": on_partial, "pixels": pixels}
    if files.where(F.col("length") > SMALL_FILE).select("path").isEmpty():
        return split_records(files, record_length, **options)
    return read_record_ranges(spark, paths, record_length, **options)
