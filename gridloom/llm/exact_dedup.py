"""Exact duplicates by counting quotient filters and byte verification.

A 64-bit fingerprint splits into a block number (the highest bits), a quotient
(the next 16) and a remainder (the rest). Each task builds one filter per block
over its own rows: the occupied quotients with their run lengths, the remainders
sorted inside their runs, a count for each. Only what is occupied is written, so
a filter is in proportion to its fingerprints however many tasks and blocks
there are. Filters of a block merge without loss by sorting the remainders of
all tasks together and adding counts. Fingerprints with a count above one are
the only ones whose texts are compared.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.llm.common import arrow_rows, measured, sorted_groups
from gridloom.session import materialise

QUOTIENT_BITS = 16
BLOCK_ROWS = 65_536  # rows of the table for each block of fingerprints

_FILTERS = pa.schema([("block", pa.int64()), ("quotients", pa.binary()), ("runs", pa.binary()),
                      ("remainders", pa.binary()), ("counts", pa.binary())])
_REPEATED = pa.schema([("fp", pa.int64()), ("n", pa.int64())])
_TEXTS = pa.schema([("fp", pa.int64()), ("sha", pa.string()), ("text", pa.string())])


def _packed(values: np.ndarray, width: int) -> bytes:
    """The lowest ``width`` bytes of each value."""
    return values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def _unpacked(packed: bytes, n: int) -> np.ndarray:
    """Inverse of :func:`_packed`, whose width follows from the number of values."""
    whole = np.zeros((n, 8), np.uint8)
    if n:
        own = np.frombuffer(packed, np.uint8).reshape(n, -1)
        whole[:, :own.shape[1]] = own
    return whole.reshape(-1).view("<u8").astype(np.uint64)


def _width(values: np.ndarray) -> int:
    return max(1, (int(values.max(initial=0)).bit_length() + 7) // 8)


def encode_filter(fingerprints: np.ndarray, counts: np.ndarray, rest_bits: int) -> tuple[bytes, bytes, bytes, bytes]:
    """Occupied quotients, run lengths, remainders and counts of the sorted
    fingerprints of one block, in as few bytes each as they need.

    ``rest_bits``: bits below the block number.
    """
    bits = rest_bits - QUOTIENT_BITS
    quotients = (fingerprints >> np.uint64(bits)) & np.uint64((1 << QUOTIENT_BITS) - 1)
    occupied, runs = np.unique(quotients, return_counts=True)
    remainders = fingerprints & np.uint64((1 << bits) - 1)
    return (_packed(occupied, QUOTIENT_BITS // 8), _packed(runs, _width(runs)), _packed(remainders, (bits + 7) // 8),
            _packed(counts, _width(counts)))


def decode_filter(block: int, quotients: bytes, runs: bytes, remainders: bytes, counts: bytes, rest_bits: int):
    """Fingerprints and counts, ascending; inverse of :func:`encode_filter`."""
    bits = rest_bits - QUOTIENT_BITS
    occupied = _unpacked(quotients, len(quotients) * 8 // QUOTIENT_BITS)
    lengths = _unpacked(runs, len(occupied)).astype(np.int64)
    n = int(lengths.sum())
    high = np.uint64(block) << np.uint64(rest_bits) if rest_bits < 64 else np.uint64(0)
    fingerprints = high | (np.repeat(occupied, lengths) << np.uint64(bits)) | _unpacked(remainders, n)
    return fingerprints, _unpacked(counts, n)


def _add_up(fingerprints: np.ndarray, counts: np.ndarray):
    order = np.argsort(fingerprints, kind="stable")
    fingerprints, counts = fingerprints[order], counts[order]
    first = np.flatnonzero(np.r_[True, fingerprints[1:] != fingerprints[:-1]])
    return fingerprints[first], np.add.reduceat(counts, first)


def _build(rest_bits: int):
    def build(batches):
        seen, counts = np.empty(0, np.uint64), np.empty(0, np.uint64)
        for batch in batches:  # one filter a task; equal rows take one entry
            new = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            if len(new):
                seen, counts = _add_up(np.r_[seen, new], np.r_[counts, np.ones(len(new), np.uint64)])
        if not len(seen):
            return
        blocks = (seen >> np.uint64(rest_bits)) if rest_bits < 64 else np.zeros_like(seen)
        edges = np.r_[np.flatnonzero(np.r_[True, blocks[1:] != blocks[:-1]]), len(seen)]
        for at in range(0, len(edges) - 1, 1024):
            rows = {name: [] for name in _FILTERS.names}
            for a, b in zip(edges[at:at + 1024], edges[at + 1:at + 1025]):
                parts = encode_filter(seen[a:b], counts[a:b], rest_bits)
                for name, value in zip(_FILTERS.names, (int(blocks[a]), *parts)):
                    rows[name].append(value)
            yield arrow_rows(_FILTERS, rows)

    return build


def _merge(rest_bits: int):
    def merge(batches):
        for block, group in sorted_groups(batches, "block"):
            parts = [decode_filter(block, *filter_, rest_bits)
                     for filter_ in zip(*(group[name] for name in _FILTERS.names[1:]))]
            fingerprints, counts = _add_up(np.concatenate([p[0] for p in parts]),
                                           np.concatenate([p[1] for p in parts]))
            often = counts > 1
            yield pa.record_batch([pa.array(fingerprints[often].view(np.int64)),
                                   pa.array(counts[often].astype(np.int64))], schema=_REPEATED)

    return merge


def repeated_fingerprints(slim: DataFrame, fingerprint: str) -> DataFrame:
    """``(fp, n)`` of the fingerprints that occur more than once in the column."""
    blocks = max(0, (slim.count() // BLOCK_ROWS).bit_length())
    rest_bits = 64 - blocks
    filters = slim.select(fingerprint).mapInArrow(
        _build(rest_bits), "block long, quotients binary, runs binary, remainders binary, counts binary"
    )
    return (
        filters.repartition("block").sortWithinPartitions("block")
        .mapInArrow(_merge(rest_bits), "fp long, n long")
    )


def _distinct_texts(batches):
    """Texts with their digests; one that came before in the task is left out."""
    seen: set[bytes] = set()
    for batch in batches:
        rows = {name: [] for name in _TEXTS.names}
        for fp, text in zip(*(c.to_pylist() for c in batch.columns)):
            sha = hashlib.sha256(text.encode())
            if sha.digest() not in seen:
                if len(seen) >= 1_000_000:  # memory only: a text sent twice changes nothing
                    seen.clear()
                seen.add(sha.digest())
                for name, value in zip(_TEXTS.names, (fp, sha.hexdigest(), text)):
                    rows[name].append(value)
        yield arrow_rows(_TEXTS, rows)


def exact_duplicates(docs: DataFrame, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Which row of each group of equal texts stays.

    Result, one row per row of ``docs``: ``key``, ``keep_id`` (largest key among
    the equal texts), ``group_size``, ``kept``, ``text_sha256``. Texts are equal
    when their bytes are, after no change. Null counts as empty text. Of rows
    that repeat both text and largest key exactly one is kept. A null key
    counts as smaller than any other; a group of null keys alone has a null
    ``keep_id`` and keeps one row. Other columns are ignored; an empty table
    gives an empty result.

    Only texts with a repeated fingerprint are looked at again, and one per task
    and text moves. Rows of a hot text are counted in their own task first; the
    final join is one that adaptive execution splits. Long texts are hashed and
    compared whole. Should two texts share a SHA-256 digest the
    query fails rather than merge them.
    """
    content = F.coalesce(F.col(text), F.lit(""))
    slim = materialise(
        docs.select(
            F.col(key).alias("key"),
            F.monotonically_increasing_id().alias("row"),
            F.xxhash64(content).alias("fp"),
            F.sha2(content.cast("binary"), 256).alias("sha"),
        ),
        "exact-dedup",
    )
    repeated = materialise(repeated_fingerprints(slim, "fp"), "repeated")
    verified = (
        docs.select(F.xxhash64(content).alias("fp"), content.alias("text"))
        .join(measured(repeated), "fp", "left_semi")
        .mapInArrow(_distinct_texts, "fp long, sha string, text string")
        .groupBy("fp", "sha")
        .agg(F.min("text").alias("low"), F.max("text").alias("high"))
        .select("fp", "sha", (F.col("low") == F.col("high")).alias("same"))
    )
    groups = (
        slim.join(measured(repeated), "fp", "left_semi")
        .groupBy("fp", "sha")
        .agg(F.count("*").alias("size"), F.max(F.struct("key", "row")).alias("last"))
        .join(verified, ["fp", "sha"])
        .select("fp", "sha", "last", F.when(F.col("same"), F.col("size")).otherwise(
            F.raise_error(F.concat(F.lit("different texts of one digest: "), "sha")).cast("long")).alias("size"))
    )
    alone = F.col("size").isNull()
    return slim.join(groups, ["fp", "sha"], "left").select(
        F.col("key").alias(key),
        F.when(alone, F.col("key")).otherwise(F.col("last.key")).alias("keep_id"),
        F.coalesce("size", F.lit(1).cast("long")).alias("group_size"),
        (alone | (F.col("last.row") == F.col("row"))).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )


def without_exact_duplicates(docs: DataFrame, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row, with all its columns, of each group of equal texts: that with the
    largest key. Of rows that repeat both key and text any one stays."""
    decided = exact_duplicates(docs, key=key, text=text)
    # Names of our own that no column of the table has.
    own_key, sha = (_free_name(docs, name) for name in ("key", "sha"))
    dropped = materialise(
        decided.where(~F.col("kept") & ~F.col(key).eqNullSafe(F.col("keep_id")))
        .select(F.col(key).alias(own_key), F.col("text_sha256").alias(sha)),
        "dropped",
    )
    digest = F.sha2(F.coalesce(F.col(text), F.lit("")).cast("binary"), 256)
    same = F.col(key).eqNullSafe(F.col(own_key)) & (digest == F.col(sha))
    left = docs.join(measured(dropped, 96), same, "left_anti")
    repeated = decided.where(~F.col("kept") & F.col(key).eqNullSafe(F.col("keep_id")))
    if repeated.isEmpty():
        return left
    return left.withColumn(sha, digest).dropDuplicates([key, sha]).select(*docs.columns)


def _free_name(docs: DataFrame, name: str) -> str:
    taken = {c.lower() for c in docs.columns}
    while name in taken:
        name = "_" + name
    return name
