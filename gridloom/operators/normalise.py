"""Normalising whole tables by their own statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.functions.scaling import min_max, scale, standardise
from gridloom.operators.profile import column_moments, column_range
from gridloom.sources.text import label_and_pixels


def scaled_rows(
    lines: DataFrame, line: str = "value", *, divisor: float = 255.0
) -> DataFrame:
    """``(label, scaled)`` of label-first integer lines, each row on its own.

    Rows stay where they are: nothing is gathered under one key.
    """
    return label_and_pixels(lines, line).select(
        "label", scale("pixels", divisor).alias("scaled")
    )


def _with_statistics(df: DataFrame, stats: DataFrame, names: list[str]) -> DataFrame:
    """Rows with a struct ``__stats`` holding one array per statistic.

    ``stats`` has one row per array position, so the struct is no larger than
    a data row or two. It is a scalar subquery: evaluated once, not joined.
    """
    ordered = F.array_sort(F.collect_list(F.struct("col", *names)))
    arrays = F.struct(
        *(F.col("s").getField(n).cast("array<double>").alias(n) for n in names)
    )
    return df.withColumn("__stats", stats.agg(ordered.alias("s")).select(arrays).scalar())


def min_max_by_column(
    df: DataFrame, values: str, out: str, *, initial: float | None = None
) -> DataFrame:
    """Min-max normalise each array position by the table's own range."""
    rows = _with_statistics(df, column_range(df, values, initial=initial), ["min", "max"])
    normalised = min_max(values, F.col("__stats.min"), F.col("__stats.max"))
    return rows.withColumn(out, normalised).drop("__stats")


def standardise_by_column(df: DataFrame, values: str, out: str) -> DataFrame:
    """Standardise each array position by the table's own mean and spread."""
    rows = _with_statistics(df, column_moments(df, values), ["mean", "std"])
    standardised = standardise(values, F.col("__stats.mean"), F.col("__stats.std"))
    return rows.withColumn(out, standardised).drop("__stats")
