"""Writers. None of them funnels row data through one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def write_csv(
    df: DataFrame, path: str, *, compress: bool = False, mode: str = "error"
) -> None:
    """CSV with a header row, gzip-compressed on request."""
    df.write.mode(mode).csv(
        path, header=True, compression="gzip" if compress else "none"
    )


def write_report(
    df: DataFrame, path: str, order_by: list[str], *, mode: str = "error"
) -> None:
    """Tab-separated key/value lines in key order.

    The sort is range-partitioned and adaptive execution merges its small
    partitions, so a report comes out as one part file while a result too
    large for that is written in parallel, still in order across parts.
    """
    df.orderBy(*order_by).write.mode(mode).csv(path, sep="\t")


def place_by_class(
    df: DataFrame, label: str = "label", *, one_file_per_class: bool = False
) -> DataFrame:
    """Bring the rows of a class together.

    Rows are rebalanced on the label: a small class goes to one task, a class
    beyond the advisory partition size is split over several.
    ``one_file_per_class`` sends each class to a single task whatever its
    size, which is for small outputs only.
    """
    return df.repartition(label) if one_file_per_class else df.hint("rebalance", F.col(label))


def write_by_class(
    df: DataFrame,
    path: str,
    label: str = "label",
    *,
    one_file_per_class: bool = False,
    placed: bool = False,
    rows_per_file: int | None = None,
    mode: str = "error",
) -> None:
    """Parquet with one folder per class, placed by :func:`place_by_class`
    unless the rows are ``placed`` already; files of ``rows_per_file`` rows at
    most."""
    rows = df if placed else place_by_class(df, label, one_file_per_class=one_file_per_class)
    writer = rows.write.mode(mode).partitionBy(label)
    if rows_per_file:
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    writer.parquet(path)


def labelled_line(label: Column | str, values: Column | str) -> Column:
    """``label,v0,v1,...`` as one text."""
    label = F.col(label) if isinstance(label, str) else label
    values = F.col(values) if isinstance(values, str) else values
    return F.concat_ws(",", label.cast("string"), values.cast("array<string>"))


def write_labelled_csv(
    df: DataFrame,
    path: str,
    label: str = "label",
    values: str = "pixels",
    *,
    mode: str = "error",
) -> None:
    """Label-first CSV without header, one record per line."""
    df.select(labelled_line(label, values).alias("value")).write.mode(mode).text(path)
