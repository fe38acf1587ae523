"""The given tables, and image-like tables that Spark derives from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.session import resolve_path
from gridloom.sinks.files import labelled_line

# Derived binary files hold this many records of one label and 64 value bytes.
FILE_RECORDS = 100
FILE_RECORD_LENGTH = 65


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(resolve_path(f"{name}.parquet", sf_dir))


def quantised(values: str = "embedding") -> Column:
    """Values of [-1, 1] as bytes 0-255."""
    return F.transform(
        F.col(values), lambda x: F.floor((x.cast("double") + 1) * 127.5).cast("int")
    )


def image_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(vec_id, label, pixels)``: the embeddings as byte images."""
    return table(spark, sf_dir, "embeddings").select(
        "vec_id", "label", quantised().alias("pixels")
    )


def image_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(vec_id, label, value)``: the byte images as label-first CSV lines."""
    return image_rows(spark, sf_dir).select(
        "vec_id", "label", labelled_line("label", "pixels").alias("value")
    )


def image_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(path, length, content)``, shaped like a scan of binary files.

    A file holds the records of 100 consecutive ids, so the number of files
    grows with the table while a file, and with it a group, stays small.
    """
    byte = lambda n: F.lpad(F.hex(n), 2, "0")
    records = image_rows(spark, sf_dir).select(
        F.format_string("batch_%08d", F.expr(f"vec_id div {FILE_RECORDS}")).alias("path"),
        "vec_id",
        F.concat(
            byte(F.col("label")), F.array_join(F.transform("pixels", byte), "")
        ).alias("record"),
    )
    in_order = F.array_sort(F.collect_list(F.struct("vec_id", "record")))
    files = records.groupBy("path").agg(in_order.alias("records"))
    content = F.unhex(F.array_join(F.col("records.record"), ""))
    return files.select("path", content.alias("content")).select(
        "path", F.octet_length("content").cast("long").alias("length"), "content"
    )


def cells(df: DataFrame, keys: list[str], values: Column | str) -> DataFrame:
    """One row per array element: keys, ``col`` and ``value``."""
    return df.select(*keys, F.posexplode(values).alias("col", "value"))


def rounded(value: Column | str, digits: int = 6) -> Column:
    """Rounded, and never minus zero."""
    return (F.round(value, digits) + F.lit(0.0)).alias(
        value if isinstance(value, str) else "value"
    )


# SQL twins of the derived tables.
CELLS_SQL = """
cells AS (
  SELECT vec_id, label, CAST(generate_subscripts(embedding, 1) - 1 AS INTEGER) AS col,
         CAST(unnest(embedding) AS DOUBLE) AS x
  FROM embeddings
)"""

PIXELS_SQL = f"""{CELLS_SQL},
pixels AS (
  SELECT vec_id, vec_id // {FILE_RECORDS} AS file, vec_id % {FILE_RECORDS} AS rec, label, col,
         CAST(floor((x + 1) * 127.5) AS INTEGER) AS q
  FROM cells
)"""

LINES_SQL = """(SELECT vec_id, label, CAST(label AS VARCHAR) || ',' || array_to_string(
  list_transform(embedding,
    lambda x: CAST(CAST(floor((CAST(x AS DOUBLE) + 1) * 127.5) AS INTEGER) AS VARCHAR)), ',') AS value
  FROM embeddings)"""
