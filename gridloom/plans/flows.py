"""The jobs users run: profile a file set, find extreme values, normalise,
train and evaluate."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import MultilayerPerceptronClassificationModel
from pyspark.sql import DataFrame, SparkSession

from gridloom.functions.scaling import unit_bytes
from gridloom.operators.evaluate import precision
from gridloom.operators.extrema import column_extrema
from gridloom.operators.profile import (
    class_counts,
    least_frequent,
    most_frequent,
    row_count,
    token_counts,
)
from gridloom.operators.training import fit_perceptron
from gridloom.operators.validate import file_size_report, require_row_shape
from gridloom.session import persist
from gridloom.sinks.files import place_by_class, write_by_class, write_labelled_csv
from gridloom.sources.binary import RECORD_LENGTH, Paths, read_records, scan_files
from gridloom.sources.text import read_labelled_csv, read_lines

# Layer widths and iterations of the two image-set models.
LAYERS_28X28 = [28 * 28, 1024, 10]
ITERATIONS_28X28 = 1000
LAYERS_32X32X3 = [32 * 32 * 3, 1024, 10]
ITERATIONS_32X32X3 = 10

# Normalised records per file of a class folder: some 600 MB of 3,072 floats.
ROWS_PER_FILE = 50_000


def profile_file_sizes(spark: SparkSession, paths: Paths) -> DataFrame:
    """Numbered ``ok`` / ``not ok`` size report of binary image files."""
    return file_size_report(scan_files(spark, paths))


def profile_classes(
    spark: SparkSession, paths: Paths, record_length: int = RECORD_LENGTH
) -> DataFrame:
    """Images per class of binary image files, in class-name order."""
    records = read_records(spark, paths, record_length, pixels="none")
    return class_counts(records).orderBy("class_name")


def profile_columns(
    spark: SparkSession, paths: Paths, record_length: int = RECORD_LENGTH,
    *, signed_shift: bool = False, initial: float | None = 0.0,
) -> DataFrame:
    """Extrema and change counters per pixel column, in column order.

    Files of any size are read by several tasks. Extrema start at ``initial``,
    or at the first record of a file if it is None, which gives the true minimum.
    """
    records = read_records(spark, paths, record_length, signed_shift=signed_shift)
    return column_extrema(records, initial=initial).orderBy("col")


def most_frequent_value(spark: SparkSession, paths: Paths, **options) -> DataFrame:
    """The token that occurs most in text files."""
    return most_frequent(token_counts(read_lines(spark, paths), **options))


def least_frequent_value(spark: SparkSession, paths: Paths, **options) -> DataFrame:
    """The token that occurs least in text files."""
    return least_frequent(token_counts(read_lines(spark, paths), **options))


def normalise_files(
    spark: SparkSession, paths: Paths, out: str, record_length: int = RECORD_LENGTH,
    *, signed_shift: bool = False, rows_per_file: int = ROWS_PER_FILE,
) -> None:
    """Binary image files to Parquet of 0-1 floats, one folder per class.

    Rows move to their class as bytes, one per pixel, and are normalised after.
    """
    records = read_records(spark, paths, record_length, signed_shift=signed_shift)
    placed = place_by_class(records).select("path", "rec", "label", unit_bytes("pixels").alias("pixels"))
    write_by_class(placed, out, placed=True, rows_per_file=rows_per_file)


def convert_to_csv(
    spark: SparkSession,
    paths: Paths,
    out: str,
    record_length: int = RECORD_LENGTH,
    *,
    classes: int = 10,
) -> DataFrame:
    """Binary image files to label-first CSV lines; a label beyond the classes
    stops the job. Returns the line count of what was written, one row."""
    records = read_records(spark, paths, record_length, pixels="array")
    checked = require_row_shape(
        records, "pixels", "label", width=record_length - 1, classes=classes
    )
    write_labelled_csv(checked, out)
    return row_count(read_lines(spark, out))


@dataclass
class Fitted:
    model: MultilayerPerceptronClassificationModel
    predictions: DataFrame
    precision: float


def train_and_evaluate(
    spark: SparkSession,
    train_paths: Paths,
    test_paths: Paths,
    layers: list[int],
    *,
    max_iter: int,
    fraction: float = 1.0,
    block_size: int = 128,
    seed: int = 1234,
) -> Fitted:
    """Fit the perceptron on one labelled CSV and measure it on another."""
    train = persist(read_labelled_csv(spark, train_paths, fraction, seed=seed))
    try:
        model = fit_perceptron(
            train, layers, max_iter=max_iter, block_size=block_size, seed=seed
        )
    finally:
        train.unpersist()
    test = read_labelled_csv(spark, test_paths, fraction, seed=seed)
    predictions = model.transform(test).select("prediction", "label")
    return Fitted(model, predictions, precision(predictions))
