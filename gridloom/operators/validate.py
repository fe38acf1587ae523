"""Checks that report, and checks that stop a job."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.functions.texts import class_count_text
from gridloom.operators.profile import file_ordinals
from gridloom.sources.binary import RECORD_LENGTH, RECORDS_PER_FILE


def file_sizes(
    files: DataFrame, expected_length: int = RECORD_LENGTH * RECORDS_PER_FILE
) -> DataFrame:
    """``(path, status, length)`` with status ``ok`` or ``not ok``.

    Uses the file listing only; no content is read.
    """
    return files.select(
        "path",
        F.when(F.col("length") == expected_length, "ok").otherwise("not ok").alias("status"),
        "length",
    )


def file_size_report(
    files: DataFrame, expected_length: int = RECORD_LENGTH * RECORDS_PER_FILE
) -> DataFrame:
    """:func:`file_sizes` numbered from 0 in path order."""
    return file_ordinals(file_sizes(files, expected_length)).select(
        "ordinal", "path", "status", "length"
    )


def row_shape_faults(
    values: Column | str, label: Column | str, *, width: int, classes: int = 10
) -> Column:
    """Array of what is wrong with a labelled row; empty when nothing is."""
    values = F.col(values) if isinstance(values, str) else values
    label = F.col(label) if isinstance(label, str) else label
    wrong_width = F.coalesce(F.size(values) != width, F.lit(True)) | values.isNull()
    wrong_label = ~F.coalesce(label.between(0, classes - 1), F.lit(False))
    return F.array_compact(
        F.array(F.when(wrong_width, "width"), F.when(wrong_label, "label"))
    )


def row_shape_violations(
    df: DataFrame, values: str, label: str, *, width: int, classes: int = 10
) -> DataFrame:
    """The rows at fault, with their ``faults``."""
    faults = row_shape_faults(values, label, width=width, classes=classes)
    return df.withColumn("faults", faults).where(F.size("faults") > 0)


def require_row_shape(
    df: DataFrame, values: str, label: str, *, width: int, classes: int = 10
) -> DataFrame:
    """The same rows, but evaluating a row at fault stops the job."""
    faults = row_shape_faults(values, label, width=width, classes=classes)
    stop = F.raise_error(F.concat(F.lit("bad row: "), F.array_join(faults, ","))).cast("boolean")
    return df.where(F.when(F.size(faults) > 0, stop).otherwise(F.lit(True)))


def check_class_counts(
    counts: DataFrame, expected: int | dict[str, int], names: list[str] | None = None
) -> DataFrame:
    """``(class_name, actual, expected, ok, report)``.

    With ``expected`` per class, or ``names``, a class without any row is
    reported with 0; a class nothing is expected of has a null expectation.
    """
    spark = counts.sparkSession
    per_class = expected if isinstance(expected, dict) else {n: expected for n in names or []}
    actual = counts.select("class_name", F.col("n").alias("actual"))
    if per_class:
        wanted = spark.range(1).select(
            F.explode(
                F.create_map(*(F.lit(x) for x in chain.from_iterable(per_class.items())))
            ).alias("class_name", "expected")
        )
        joined = wanted.join(actual, "class_name", "full")
    else:
        joined = actual.withColumn("expected", F.lit(expected))
    actual_count = F.coalesce("actual", F.lit(0).cast("long"))
    return joined.select(
        "class_name",
        actual_count.alias("actual"),
        F.col("expected").cast("long").alias("expected"),
        F.coalesce(actual_count == F.col("expected"), F.lit(False)).alias("ok"),
        class_count_text(actual_count).alias("report"),
    )


def operand_mismatches(a: DataFrame, b: DataFrame) -> DataFrame:
    """``(id, size_a, size_b)`` of vector pairs whose sizes differ.

    A side without the vector counts as an empty vector of the right size.
    """
    sizes = (
        a.select("id", F.col("size").alias("size_a"), F.lit(None).cast("int").alias("size_b"))
        .unionByName(
            b.select("id", F.lit(None).cast("int").alias("size_a"), F.col("size").alias("size_b"))
        )
        .groupBy("id")
        .agg(
            F.min("size_a").alias("size_a"), F.max("size_a").alias("max_a"),
            F.min("size_b").alias("size_b"), F.max("size_b").alias("max_b"),
        )
    )
    uneven = (
        (F.col("size_a") != F.col("size_b"))
        | (F.col("size_a") != F.col("max_a"))
        | (F.col("size_b") != F.col("max_b"))
    )
    return sizes.where(uneven).select("id", "size_a", "size_b")


def require_vector_columns(side: DataFrame) -> None:
    """Raise unless a table has the columns of a vector table."""
    missing = {"id", "size", "idx", "value"} - set(side.columns)
    if missing:
        raise TypeError(f"not a vector table, lacks {sorted(missing)}")


def require_same_sizes(a: DataFrame, b: DataFrame) -> None:
    """Raise unless both operands have the vector columns and equal sizes; a job."""
    for side in (a, b):
        require_vector_columns(side)
    if not operand_mismatches(a, b).isEmpty():
        raise ValueError("vectors are not of the same size")
