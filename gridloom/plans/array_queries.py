"""Record decoding, normalising, packing, batching and file round trips."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from gridloom.functions import scaling
from gridloom.operators import batches, normalise, profile, validate
from gridloom.plans.profiling_queries import DOCUMENT_TOKENS, _class_counts_sql
from gridloom.plans.tables import (
    CELLS_SQL, FILE_RECORD_LENGTH, FILE_RECORDS, LINES_SQL, PIXELS_SQL, cells, image_files, image_lines,
    image_rows, rounded, table,
)
from gridloom.session import new_work_folder
from gridloom.sinks import files as sinks
from gridloom.sources import binary, text


def decoded_records(spark, sf_dir):
    records = binary.split_records(image_files(spark, sf_dir), FILE_RECORD_LENGTH)
    return records.select("path", "rec", "label", F.hex("pixels").alias("pixels"))


def decoded_records_shifted(spark, sf_dir):
    records = binary.split_records(
        image_files(spark, sf_dir), FILE_RECORD_LENGTH, signed_shift=True
    )
    return records.select("path", "rec", "label", F.hex("pixels").alias("pixels"))


def decoded_pixel_arrays(spark, sf_dir):
    records = binary.split_records(image_files(spark, sf_dir), FILE_RECORD_LENGTH, pixels="array")
    return cells(records, ["path", "rec"], "pixels")


def decoded_class_profile(spark, sf_dir):
    return profile.class_counts(
        binary.split_records(image_files(spark, sf_dir), FILE_RECORD_LENGTH)
    )


def derived_file_sizes(spark, sf_dir):
    return validate.file_size_report(
        image_files(spark, sf_dir), FILE_RECORDS * FILE_RECORD_LENGTH
    )


def table_file_sizes(spark, sf_dir):
    listed = binary.scan_files(spark, sf_dir, glob="*.parquet")
    sizes = validate.file_size_report(listed)
    return sizes.withColumn("path", F.element_at(F.split("path", "/"), -1))


def scaled_pixels(spark, sf_dir):
    rows = cells(image_rows(spark, sf_dir), ["vec_id"], scaling.scale("pixels"))
    return rows.select("vec_id", "col", rounded("value"))


def scaled_line_values(spark, sf_dir):
    scaled = normalise.scaled_rows(image_lines(spark, sf_dir))
    by_value = cells(scaled, ["label"], "scaled").select("label", "col", rounded("value"))
    return by_value.groupBy("label", "col", "value").agg(F.count("*").alias("n"))


def min_max_pixels(spark, sf_dir):
    rows = cells(image_rows(spark, sf_dir), ["vec_id"], scaling.min_max("pixels", 10, 200))
    return rows.select("vec_id", "col", rounded("value"))


def min_max_by_column(spark, sf_dir):
    rows = normalise.min_max_by_column(table(spark, sf_dir, "embeddings"), "embedding", "z")
    return cells(rows, ["vec_id"], "z").select("vec_id", "col", rounded("value"))


def standardised_pixels(spark, sf_dir):
    values = scaling.standardise(scaling.scale("pixels"))
    rows = cells(image_rows(spark, sf_dir), ["vec_id"], values)
    return rows.select("vec_id", "col", rounded("value"))


def standardised_by_column(spark, sf_dir):
    rows = normalise.standardise_by_column(table(spark, sf_dir, "embeddings"), "embedding", "z")
    return cells(rows, ["vec_id"], "z").select("vec_id", "col", rounded("value", 5))


def flattened_grids(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings").select(
        "vec_id",
        F.transform(
            F.sequence(F.lit(0), F.lit(7)), lambda r: F.slice("embedding", r * 8 + 1, F.lit(8))
        ).alias("grid"),
    )
    flat = cells(rows, ["vec_id"], scaling.flatten_grid("grid"))
    return flat.select("vec_id", "col", F.col("value").cast("double").alias("value"))


def packed_floats(spark, sf_dir):
    return table(spark, sf_dir, "embeddings").select(
        "vec_id", F.hex(scaling.pack_floats("embedding")).alias("packed")
    )


def unpacked_floats(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings").select(
        "vec_id", scaling.unpack_floats(scaling.pack_floats("embedding")).alias("v")
    )
    return cells(rows, ["vec_id"], "v").select(
        "vec_id", "col", F.col("value").cast("double").alias("value")
    )


def argmax_positions(spark, sf_dir):
    return table(spark, sf_dir, "embeddings").select(
        "vec_id", scaling.row_argmax("embedding").alias("position")
    )


def csv_line_fields(spark, sf_dir):
    quote = F.concat(F.lit('"'), F.regexp_replace("p_name", "o", 'o,""'), F.lit('"'))
    line = F.concat_ws(",", F.col("p_partkey").cast("string"), quote, F.lit(""), "p_type")
    lines = table(spark, sf_dir, "part").select("p_partkey", line.alias("line"))
    fields = lines.select("p_partkey", F.posexplode(text.csv_fields("line")).alias("pos", "field"))
    return fields


def sampled_documents(spark, sf_dir):
    rows = text.sample_rows(table(spark, sf_dir, "documents"), 0.3, seed=7, key=["doc_id"])
    return rows.select("doc_id", "lang")


def shuffled_batches(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    return batches.exact_batches(orders, ["o_orderkey"], 64, seed=1, epoch=2)


def hashed_batches(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey")
    return batches.hashed_batches(orders, ["o_orderkey"], 100, seed=1, epoch=2)


def concatenated_names(spark, sf_dir):
    parts = [
        table(spark, sf_dir, name).select(
            F.col(f"{p}_name").alias("name"), F.col(f"{p}_nationkey").alias("nation")
        )
        for name, p in (("customer", "c"), ("supplier", "s"))
    ]
    return text.concatenate(parts)


# --- round trips through files ---------------------------------------------


def csv_round_trip(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").withColumn(
        "l_shipdate", F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss")
    )
    folder = new_work_folder(spark, "csv")
    sinks.write_csv(lines, folder, compress=True)
    return text.read_csv(spark, folder, schema=lines.schema)


def inferred_csv_round_trip(spark, sf_dir):
    folder = new_work_folder(spark, "csv")
    sinks.write_csv(table(spark, sf_dir, "part"), folder)
    return text.read_csv(spark, folder)


def report_lines(spark, sf_dir):
    folder = new_work_folder(spark, "report")
    counts = profile.class_counts(table(spark, sf_dir, "embeddings"))
    sinks.write_report(counts.select("class_name", "n"), folder, ["class_name"])
    return text.read_lines(spark, folder)


def class_folders(spark, sf_dir):
    folder = new_work_folder(spark, "classes")
    images = image_rows(spark, sf_dir).select(
        "vec_id", "label", scaling.min_max("pixels").cast("array<float>").alias("pixels")
    )
    sinks.write_by_class(images, folder)
    back = spark.read.parquet(folder)
    return cells(back, ["label"], "pixels").groupBy("label", "col").agg(
        F.count("*").alias("n"), (F.round(F.sum(F.col("value").cast("double")), 4)).alias("total")
    )


def labelled_csv_features(spark, sf_dir):
    folder = new_work_folder(spark, "labelled")
    sinks.write_labelled_csv(image_rows(spark, sf_dir), folder)
    rows = text.read_labelled_csv(spark, folder).select(
        "label", vector_to_array("features").alias("v")
    )
    by_value = cells(rows, ["label"], "v").select("label", "col", rounded("value"))
    return by_value.groupBy("label", "col", "value").agg(F.count("*").alias("n"))


def tokens_of_text_files(spark, sf_dir):
    folder = new_work_folder(spark, "text")
    table(spark, sf_dir, "documents").select("text").write.text(folder)
    return profile.token_counts(text.read_lines(spark, folder))


def file_set_bytes(spark, sf_dir):
    folders = {name: new_work_folder(spark, name) for name in ("train", "test")}
    lines = image_lines(spark, sf_dir).withColumn(
        "split", F.when(F.col("label") >= 8, "test").otherwise("train")
    )
    for name, folder in folders.items():
        lines.where(F.col("split") == name).select("value").write.text(folder)
    listed = binary.read_split(lambda p: binary.scan_files(spark, p), **folders)
    return listed.groupBy("split").agg(F.sum("length").alias("bytes"))


QUERIES = {
    f.__name__: f
    for f in (
        decoded_records, decoded_records_shifted, decoded_pixel_arrays, decoded_class_profile,
        derived_file_sizes, table_file_sizes, scaled_pixels, scaled_line_values, min_max_pixels,
        min_max_by_column, standardised_pixels, standardised_by_column, flattened_grids,
        packed_floats, unpacked_floats, argmax_positions, csv_line_fields, sampled_documents,
        shuffled_batches, hashed_batches, concatenated_names, csv_round_trip,
        inferred_csv_round_trip, report_lines, class_folders, labelled_csv_features,
        tokens_of_text_files, file_set_bytes,
    )
}


def _records_sql(value: str) -> str:
    return f"""WITH {PIXELS_SQL}
SELECT printf('batch_%08d', file) AS path, rec, label,
       string_agg(printf('%02X', {value}), '' ORDER BY col) AS pixels
FROM pixels GROUP BY file, rec, label"""


def _cells_sql(value: str, digits: int = 6) -> str:
    return f"""WITH {PIXELS_SQL}
SELECT vec_id, col, round({value}, {digits}) + 0.0 AS value FROM pixels"""


def _shuffle_hash_sql(key: str, *salt: int) -> str:
    return "md5(" + f" || ':' || ".join([f"CAST({key} AS VARCHAR)"] + [f"'{s}'" for s in salt]) + ")"


_LABEL_COLUMN_COUNTS = f"""WITH {PIXELS_SQL}
SELECT {{label}} AS label, col, round(CAST(q AS DOUBLE) / 255.0, 6) + 0.0 AS value, count(*) AS n
FROM pixels GROUP BY 1, 2, 3"""

SQL = {
    "decoded_records": _records_sql("q"),
    "decoded_records_shifted": _records_sql("xor(q, 128)"),
    "decoded_pixel_arrays": f"""WITH {PIXELS_SQL}
SELECT printf('batch_%08d', file) AS path, rec, col, q AS value FROM pixels""",
    "decoded_class_profile": _class_counts_sql("label", "embeddings"),
    "derived_file_sizes": f"""
WITH sizes AS (
  SELECT vec_id // {FILE_RECORDS} AS file, count(*) * {FILE_RECORD_LENGTH} AS length
  FROM embeddings GROUP BY 1
)
SELECT row_number() OVER (ORDER BY file) - 1 AS ordinal, printf('batch_%08d', file) AS path,
       CASE WHEN length = {FILE_RECORDS * FILE_RECORD_LENGTH} THEN 'ok' ELSE 'not ok' END AS status,
       length
FROM sizes""",
    "scaled_pixels": _cells_sql("CAST(q AS DOUBLE) / 255.0"),
    "scaled_line_values": _LABEL_COLUMN_COUNTS.format(label="label"),
    "min_max_pixels": _cells_sql("(CAST(q AS DOUBLE) - 10.0) / 190.0"),
    "min_max_by_column": f"""WITH {CELLS_SQL},
stats AS (SELECT col, min(x) AS lo, max(x) AS hi FROM cells GROUP BY col)
SELECT vec_id, col,
       round(CASE WHEN hi = lo THEN 0.0 ELSE (x - lo) / (hi - lo) END, 6) + 0.0 AS value
FROM cells JOIN stats USING (col)""",
    "standardised_pixels": _cells_sql("(CAST(q AS DOUBLE) / 255.0 - 0.1307) / 0.3081"),
    "standardised_by_column": f"""WITH {CELLS_SQL},
stats AS (SELECT col, avg(x) AS mu, stddev_pop(x) AS sigma FROM cells GROUP BY col)
SELECT vec_id, col, round(CASE WHEN sigma = 0 THEN 0.0 ELSE (x - mu) / sigma END, 5) + 0.0 AS value
FROM cells JOIN stats USING (col)""",
    "flattened_grids": f"WITH {CELLS_SQL} SELECT vec_id, col, x AS value FROM cells",
    "packed_floats": f"""WITH {CELLS_SQL},
parts AS (
  SELECT vec_id, col, x, abs(x) AS a, CAST(floor(log2(abs(x))) AS INTEGER) AS guess FROM cells
),
fields AS (
  SELECT vec_id, col, x, a,
         CASE WHEN a >= pow(2.0, guess + 1) THEN guess + 1
              WHEN a < pow(2.0, guess) THEN guess - 1 ELSE guess END AS e
  FROM parts
),
bits AS (
  SELECT vec_id, col,
    CASE WHEN x = 0 THEN 0 ELSE
      CASE WHEN x < 0 THEN 2147483648 ELSE 0 END
      + (CAST(e AS BIGINT) + 127) * 8388608
      + CAST((a / pow(2.0, e) - 1.0) * 8388608 AS BIGINT) END AS b
  FROM fields
)
SELECT vec_id, string_agg(printf('%08X', b), '' ORDER BY col) AS packed FROM bits GROUP BY vec_id""",
    "unpacked_floats": f"WITH {CELLS_SQL} SELECT vec_id, col, x AS value FROM cells",
    "argmax_positions": """SELECT vec_id,
  CAST(list_position(embedding, list_max(embedding)) - 1 AS INTEGER) AS position FROM embeddings""",
    "csv_line_fields": """
SELECT p_partkey, CAST(pos AS INTEGER) AS pos, field FROM (
  SELECT p_partkey, 0 AS pos, CAST(p_partkey AS VARCHAR) AS field FROM part
  UNION ALL SELECT p_partkey, 1, replace(p_name, 'o', 'o,"') FROM part
  UNION ALL SELECT p_partkey, 2, '' FROM part
  UNION ALL SELECT p_partkey, 3, p_type FROM part)""",
    "sampled_documents": f"""SELECT doc_id, lang FROM documents
WHERE CAST('0x' || substr({_shuffle_hash_sql("doc_id", 7)}, 1, 8) AS BIGINT) / 4294967296.0 < 0.3""",
    "shuffled_batches": f"""
WITH placed AS (
  SELECT o_orderkey, o_orderpriority,
         row_number() OVER (ORDER BY {_shuffle_hash_sql("o_orderkey", 1, 2)}, o_orderkey) - 1 AS position
  FROM orders
)
SELECT o_orderkey, o_orderpriority, position, position // 64 AS batch FROM placed""",
    "hashed_batches": f"""SELECT o_orderkey,
  CAST('0x' || substr({_shuffle_hash_sql("o_orderkey", 1, 2)}, 1, 15) AS BIGINT) % 100 AS batch
FROM orders""",
    "concatenated_names": """SELECT c_name AS name, c_nationkey AS nation FROM customer
UNION ALL SELECT s_name, s_nationkey FROM supplier""",
    "csv_round_trip": "SELECT * REPLACE (strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS l_shipdate) "
    "FROM lineitem",
    "inferred_csv_round_trip": "SELECT * REPLACE (CAST(p_partkey AS INTEGER) AS p_partkey) FROM part",
    "report_lines": f"""SELECT class_name || chr(9) || CAST(n AS VARCHAR) AS value
FROM ({_class_counts_sql("label", "embeddings")})""",
    "class_folders": f"""WITH {PIXELS_SQL}
SELECT label, col, count(*) AS n,
       round(sum(CAST(CAST(CAST(q AS DOUBLE) / 255.0 AS FLOAT) AS DOUBLE)), 4) AS total
FROM pixels GROUP BY label, col""",
    "labelled_csv_features": _LABEL_COLUMN_COUNTS.format(label="CAST(label AS DOUBLE)"),
    "tokens_of_text_files": DOCUMENT_TOKENS,
    "file_set_bytes": f"""SELECT CASE WHEN label >= 8 THEN 'test' ELSE 'train' END AS split,
  CAST(sum(strlen(value) + 1) AS BIGINT) AS bytes FROM {LINES_SQL} GROUP BY 1""",
}
