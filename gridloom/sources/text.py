"""CSV, labelled CSV and plain text lines."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from gridloom.functions.scaling import scale

Paths = str | list[str]


def read_csv(
    spark: SparkSession,
    paths: Paths,
    *,
    header: bool = True,
    schema: StructType | str | None = None,
) -> DataFrame:
    """CSV with a header row. Types are inferred unless a schema is given;
    inferring reads the files twice, so give one for large inputs."""
    reader = spark.read.option("header", header)
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    return reader.csv(paths)


def read_lines(spark: SparkSession, paths: Paths) -> DataFrame:
    """One row per text line, in column ``value``."""
    return spark.read.text(paths)


def int_fields(line: Column | str) -> Column:
    """Comma-separated integers of a line as one ``array<int>``."""
    return F.split(line, ",").cast("array<int>")


def csv_fields(line: Column | str) -> Column:
    """Fields of one CSV line as ``array<string>``, quotes taken off.

    Text after a closing quote belongs to its field, and a quote that is never
    closed reaches to the end of the line, so no character is lost.
    """
    line = F.col(line) if isinstance(line, str) else line
    # With a comma put in front, every field is a comma and what follows it.
    found = F.regexp_extract_all(
        F.concat(F.lit(","), line),
        F.lit(r',("[^"]*(?:""[^"]*)*(?:"(?!")[^,]*|\z)|[^,]*)'),
        F.lit(1),
    )
    quoted = r'^"([^"]*(?:""[^"]*)*)(?:"([^,]*))?\z'
    return F.transform(
        found,
        lambda field: F.when(
            field.startswith('"'),
            F.concat(
                F.replace(F.regexp_extract(field, quoted, 1), F.lit('""'), F.lit('"')),
                F.regexp_extract(field, quoted, 2),
            ),
        ).otherwise(field),
    )


def label_and_pixels(lines: DataFrame, line: str = "value") -> DataFrame:
    """``(label int, pixels array<int>)`` from label-first integer lines.

    The row stays one array however many thousand fields it has.
    """
    fields = F.col("fields")
    return lines.select(int_fields(line).alias("fields")).select(
        F.element_at(fields, 1).alias("label"),
        F.slice(fields, F.lit(2), F.size(fields) - 1).alias("pixels"),
    )


def labelled_features(
    lines: DataFrame, line: str = "value", *, divisor: float = 255.0
) -> DataFrame:
    """``(label double, features vector)`` from label-first integer lines."""
    return label_and_pixels(lines, line).select(
        F.col("label").cast("double").alias("label"),
        array_to_vector(scale("pixels", divisor)).alias("features"),
    )


def read_labelled_csv(
    spark: SparkSession,
    paths: Paths,
    fraction: float = 1.0,
    *,
    seed: int = 1234,
    divisor: float = 255.0,
) -> DataFrame:
    """Training table from a label-first CSV without header."""
    lines = read_lines(spark, paths)
    if fraction < 1.0:
        lines = sample_rows(lines, fraction, seed=seed)
    return labelled_features(lines, divisor=divisor)


def concatenate(parts: list[DataFrame]) -> DataFrame:
    """All rows of several equally named tables."""
    whole, *rest = parts
    for part in rest:
        whole = whole.unionByName(part)
    return whole


def sample_rows(
    df: DataFrame, fraction: float, *, seed: int = 1234, key: list[str] | None = None
) -> DataFrame:
    """Bernoulli sample without replacement.

    With ``key`` the draw is a hash of the key and the seed: the same rows
    come out however the table is partitioned, also when a task is retried.
    """
    if key is None:
        return df.sample(False, fraction, seed)
    return df.where(uniform_draw(key, seed) < F.lit(fraction))


def uniform_draw(key: list[str], *salt: int) -> Column:
    """A number in [0, 1) fixed by the key columns and the salt."""
    first32 = F.conv(F.substring(random_order(key, *salt), 1, 8), 16, 10)
    return first32.cast("double") / F.lit(2.0**32)


def random_order(key: list[str], *salt: int) -> Column:
    """A hash of key and salt whose order is a shuffle of the keys."""
    parts = [F.col(name).cast("string") for name in key]
    return F.md5(F.concat_ws(":", *parts, *(F.lit(str(s)) for s in salt)).cast("binary"))
