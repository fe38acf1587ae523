"""Jobs over binary files that Spark has written from the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridloom.operators import extrema, profile, validate
from gridloom.plans import flows
from gridloom.plans.profiling_queries import _class_counts_sql
from gridloom.plans.tables import FILE_RECORD_LENGTH, FILE_RECORDS, PIXELS_SQL, cells, image_rows, rounded, table
from gridloom.session import new_work_folder
from gridloom.sources import binary

# A record: the label, 64 values, and the byte that Spark's text writer ends a line with.
WRITTEN_LENGTH = FILE_RECORD_LENGTH + 1

# Bytes per block, so that even small files are split between tasks.
SPLIT_BYTES = 12 * WRITTEN_LENGTH


def written_images(spark, sf_dir):
    """Paths of binary files with the byte images of 100 consecutive ids each.

    The text writer puts bytes out as they are, and a newline after each row,
    which is the last of a record's 65 value bytes.
    """
    folder = new_work_folder(spark, "images")
    byte = lambda n: F.lpad(F.hex(n), 2, "0")
    record = F.unhex(F.concat(byte(F.col("label")), F.array_join(F.transform("pixels", byte), "")))
    rows = image_rows(spark, sf_dir).select(
        F.expr(f"vec_id div {FILE_RECORDS}").alias("file"), "vec_id", record.cast("string").alias("record")
    )
    placed = rows.repartition("file").sortWithinPartitions("file", "vec_id").drop("vec_id")
    placed.write.partitionBy("file").text(folder)
    return f"{folder}/file=*"


def _file(path="path"):
    return F.regexp_extract(path, r"file=(\d+)", 1).cast("long").alias("file")


def _shown(records):
    return records.select(_file(), "rec", "label", F.hex("pixels").alias("pixels"))


def file_records(spark, sf_dir):
    return _shown(binary.read_records(spark, written_images(spark, sf_dir), WRITTEN_LENGTH))


def file_records_in_ranges(spark, sf_dir):
    return _shown(binary.read_record_ranges(
        spark, written_images(spark, sf_dir), WRITTEN_LENGTH, signed_shift=True, split_bytes=SPLIT_BYTES))


def file_class_counts(spark, sf_dir):
    records = binary.read_record_ranges(
        spark, written_images(spark, sf_dir), WRITTEN_LENGTH, pixels="none", split_bytes=SPLIT_BYTES)
    return profile.class_counts(records)


def written_file_sizes(spark, sf_dir):
    listed = binary.scan_files(spark, written_images(spark, sf_dir))
    sizes = validate.file_size_report(listed, FILE_RECORDS * WRITTEN_LENGTH)
    return sizes.select(_file(), "status", "length")


def _records_in_ranges(spark, sf_dir):
    return binary.read_record_ranges(spark, written_images(spark, sf_dir), WRITTEN_LENGTH, split_bytes=SPLIT_BYTES)


def file_change_counts_in_ranges(spark, sf_dir):
    columns = extrema.column_extrema(_records_in_ranges(spark, sf_dir), initial=0.0)
    return columns.select("col", "max_changed", "min_changed")


def file_column_extrema(spark, sf_dir):
    """The data's own minimum, and changes counted from each file's first record."""
    return extrema.column_extrema(_records_in_ranges(spark, sf_dir))


def file_column_moments(spark, sf_dir):
    stats = profile.column_moments(_records_in_ranges(spark, sf_dir))
    return stats.select("col", rounded("mean"), rounded("std"))


def value_change_counts(spark, sf_dir):
    """The counters of a table that is in no file order."""
    rows = table(spark, sf_dir, "embeddings").withColumn("path", F.expr(f"vec_id div {FILE_RECORDS}"))
    found = extrema.column_extrema(
        rows.repartition(7, F.expr("vec_id % 11")), rec="vec_id", values="embedding", initial=0.0)
    return found.select("col", "max", "min", "max_changed", "min_changed")


def normalised_files(spark, sf_dir):
    out = new_work_folder(spark, "normalised")
    flows.normalise_files(spark, written_images(spark, sf_dir), out, WRITTEN_LENGTH, rows_per_file=64)
    back = spark.read.parquet(out)
    return cells(back, ["label"], "pixels").groupBy("label", "col").agg(
        F.count("*").alias("n"), F.round(F.sum(F.col("value").cast("double")), 4).alias("total"))


QUERIES = {
    f.__name__: f
    for f in (
        file_records, file_records_in_ranges, file_class_counts, written_file_sizes, file_change_counts_in_ranges,
        file_column_extrema, file_column_moments, value_change_counts, normalised_files,
    )
}

_WRITTEN_SQL = f"""{PIXELS_SQL},
numbered AS (
  SELECT vec_id, row_number() OVER (PARTITION BY vec_id // {FILE_RECORDS} ORDER BY vec_id) - 1 AS place FROM embeddings
),
written AS (
  SELECT file, place AS rec, label, col, q FROM pixels JOIN numbered USING (vec_id)
  UNION ALL SELECT vec_id // {FILE_RECORDS}, place, label, len(embedding), 10 FROM embeddings JOIN numbered USING (vec_id)
)"""


def _records_sql(value: str) -> str:
    return f"""WITH {_WRITTEN_SQL}
SELECT file, rec, label, string_agg(printf('%02X', {value}), '' ORDER BY col) AS pixels
FROM written GROUP BY file, rec, label"""


def _extrema_sql(source: str, value: str, first: str) -> str:
    """Extrema and changes; ``first`` is where they start, null for the first value."""
    return f"""seen AS (
  SELECT file, col, {value} AS v, greatest({first}, max({value}) OVER earlier) AS top,
         least({first}, min({value}) OVER earlier) AS low
  FROM {source}
  WINDOW earlier AS (PARTITION BY file, col ORDER BY rec ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
),
totals AS (
  SELECT col, CAST(greatest(max(v), {first}) AS FLOAT) AS max, CAST(least(min(v), {first}) AS FLOAT) AS min,
         CAST(count(*) FILTER (v > top) AS BIGINT) AS max_changed,
         CAST(count(*) FILTER (v < low) AS BIGINT) AS min_changed
  FROM seen GROUP BY col
)"""


SQL = {
    "file_records": _records_sql("q"),
    "file_records_in_ranges": _records_sql("xor(q, 128)"),
    "file_class_counts": _class_counts_sql("label", "embeddings"),
    "written_file_sizes": f"""SELECT vec_id // {FILE_RECORDS} AS file,
  CASE WHEN count(*) = {FILE_RECORDS} THEN 'ok' ELSE 'not ok' END AS status,
  count(*) * {WRITTEN_LENGTH} AS length FROM embeddings GROUP BY 1""",
    "file_change_counts_in_ranges": f"""WITH {_WRITTEN_SQL}, {_extrema_sql("written", "q", "0")}
SELECT CAST(col AS INTEGER) AS col, max_changed, min_changed FROM totals""",
    "file_column_extrema": f"""WITH {_WRITTEN_SQL}, {_extrema_sql("written", "q", "NULL")}
SELECT CAST(col AS INTEGER) AS col, printf('Col %04d', col) AS name, max, min, max_changed, min_changed FROM totals""",
    "file_column_moments": f"""WITH {_WRITTEN_SQL}
SELECT CAST(col AS INTEGER) AS col, round(avg(q), 6) + 0.0 AS mean, round(stddev_pop(q), 6) + 0.0 AS std
FROM written GROUP BY col""",
    "value_change_counts": f"""WITH {PIXELS_SQL},
placed AS (SELECT vec_id // {FILE_RECORDS} AS file, vec_id AS rec, col, x FROM cells),
{_extrema_sql("placed", "x", "0.0::DOUBLE")}
SELECT col, max, min, max_changed, min_changed FROM totals""",
    "normalised_files": f"""WITH {_WRITTEN_SQL}
SELECT label, CAST(col AS INTEGER) AS col, count(*) AS n,
       round(sum(CAST(CAST(CAST(q AS DOUBLE) / 255.0 AS FLOAT) AS DOUBLE)), 4) AS total
FROM written GROUP BY label, col""",
}
