"""Counts, frequencies, ranges, checks."""

from __future__ import annotations

from collections import Counter

from pyspark.sql import functions as F

from gridloom.functions.labels import class_name
from gridloom.functions.texts import (
    class_count_text, column_name, elapsed_text, join_tabs, split_tabs,
)
from gridloom.operators import profile, validate
from gridloom.operators.combine import aggregate_by_key
from gridloom.plans.tables import (
    CELLS_SQL, FILE_RECORD_LENGTH, FILE_RECORDS, LINES_SQL, PIXELS_SQL, image_files, image_lines,
    image_rows, rounded, table,
)
from gridloom.sources.text import concatenate

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

CLASS_CASE = """CASE {label}
  WHEN 0 THEN 'airplane' WHEN 1 THEN 'automobile' WHEN 2 THEN 'bird' WHEN 3 THEN 'cat'
  WHEN 4 THEN 'deer' WHEN 5 THEN 'dog' WHEN 6 THEN 'frog' WHEN 7 THEN 'horse'
  WHEN 8 THEN 'ship' WHEN 9 THEN 'truck' ELSE 'error' END"""

TOKENS_SQL = r"regexp_extract_all({text}, '[\p{{L}}\p{{N}}_'']+')"

EXPECTED_PER_CLASS = 50


def class_profile(spark, sf_dir):
    counts = profile.class_counts(table(spark, sf_dir, "embeddings"))
    return counts.orderBy("class_name")


def class_profile_of_unknown_codes(spark, sf_dir):
    codes = table(spark, sf_dir, "lineitem").select((F.col("l_linenumber") * 2).alias("label"))
    return profile.class_counts(codes)


def class_names_per_line(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", class_name(F.col("l_linenumber") * 2 - 3).alias("class_name")
    )


def class_count_check(spark, sf_dir):
    counts = profile.class_counts(table(spark, sf_dir, "embeddings"))
    expected = {name: EXPECTED_PER_CLASS for name in ("airplane", "bird", "truck", "unicorn")}
    return validate.check_class_counts(counts, expected)


def class_count_texts(spark, sf_dir):
    counts = profile.class_counts(table(spark, sf_dir, "embeddings"))
    return counts.select("class_name", class_count_text("n").alias("report"))


def table_row_counts(spark, sf_dir):
    return concatenate(
        [
            profile.row_count(table(spark, sf_dir, name)).select(F.lit(name).alias("table_name"), "n")
            for name in TABLES
        ]
    )


def distinct_counts(spark, sf_dir):
    columns = [
        ("orders", "o_custkey"), ("orders", "o_orderpriority"), ("lineitem", "l_partkey"),
        ("events", "user_id"), ("events", "props"), ("documents", "text"), ("documents", "lang"),
    ]
    return concatenate(
        [
            profile.count_distinct_values(table(spark, sf_dir, t), c).select(
                F.lit(c).alias("column_name"), "n"
            )
            for t, c in columns
        ]
    )


def distinct_counts_with_null(spark, sf_dir):
    scores = table(spark, sf_dir, "documents").join(
        table(spark, sf_dir, "labels"), "doc_id", "left"
    )
    return profile.count_distinct_values(scores, "quality")


def distinct_event_types(spark, sf_dir):
    return profile.distinct_values(table(spark, sf_dir, "events"), "event_type")


def document_token_counts(spark, sf_dir):
    return profile.token_counts(table(spark, sf_dir, "documents"), "text")


def page_token_counts(spark, sf_dir):
    return profile.token_counts(table(spark, sf_dir, "pages"), "html")


def conversation_token_counts(spark, sf_dir):
    return profile.token_counts(table(spark, sf_dir, "conversations"), "text")


def most_frequent_token(spark, sf_dir):
    return profile.most_frequent(document_token_counts(spark, sf_dir))


def least_frequent_token(spark, sf_dir):
    return profile.least_frequent(document_token_counts(spark, sf_dir))


def top_tokens(spark, sf_dir):
    return profile.top_tokens(document_token_counts(spark, sf_dir), 25)


def bottom_tokens(spark, sf_dir):
    return profile.bottom_tokens(document_token_counts(spark, sf_dir), 25)


def pixel_value_counts(spark, sf_dir):
    return profile.token_counts(image_lines(spark, sf_dir))


def pixel_value_counts_without_label(spark, sf_dir):
    return profile.token_counts(image_lines(spark, sf_dir), skip_first=True)


def most_frequent_pixel_value(spark, sf_dir):
    return profile.most_frequent(pixel_value_counts(spark, sf_dir))


def least_frequent_pixel_value(spark, sf_dir):
    return profile.least_frequent(pixel_value_counts(spark, sf_dir))


def column_range(spark, sf_dir):
    return profile.column_range(table(spark, sf_dir, "embeddings"), "embedding").select(
        "col", "name", F.col("max").cast("double").alias("max"),
        F.col("min").cast("double").alias("min"), "n",
    )


def column_range_from_zero(spark, sf_dir):
    return profile.column_range(
        table(spark, sf_dir, "embeddings"), "embedding", initial=0.0
    ).select("col", "name", F.col("max").cast("double").alias("max"),
             F.col("min").cast("double").alias("min"))


def column_moments(spark, sf_dir):
    return profile.column_moments(table(spark, sf_dir, "embeddings"), "embedding").select(
        "col", rounded("mean"), rounded("std")
    )


def running_change_counts(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings").withColumn(
        "path", F.expr(f"vec_id div {FILE_RECORDS}")
    )
    return profile.change_counts(rows, rec="vec_id", values="embedding")


def pixel_change_counts(spark, sf_dir):
    rows = image_rows(spark, sf_dir).withColumn("path", F.expr(f"vec_id div {FILE_RECORDS}"))
    return profile.change_counts(rows, rec="vec_id", segment=16)


def file_column_profile(spark, sf_dir):
    return profile.file_column_profile(image_files(spark, sf_dir), FILE_RECORD_LENGTH)


def file_column_profile_shifted(spark, sf_dir):
    return profile.file_column_profile(
        image_files(spark, sf_dir), FILE_RECORD_LENGTH, signed_shift=True
    )


def column_report_texts(spark, sf_dir):
    columns = file_column_profile(spark, sf_dir)
    return columns.select("name", join_tabs("max", "min", "max_changed", "min_changed").alias("line"))


def column_report_parsed(spark, sf_dir):
    top, low, rises, falls = split_tabs(F.col("line"), ["float", "float", "int", "int"])
    return column_report_texts(spark, sf_dir).select(
        "name", top.cast("double").alias("max"), low.cast("double").alias("min"),
        rises.alias("max_changed"), falls.alias("min_changed"),
    )


def padded_column_names(spark, sf_dir):
    return table(spark, sf_dir, "part").select(
        "p_partkey", column_name(F.col("p_partkey").cast("int")).alias("name")
    )


def elapsed_texts(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        "event_id", elapsed_text(F.col("value") * 10).alias("elapsed")
    )


def row_shape_violations(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings").select(
        "vec_id", (F.col("label") * 2 - 1).alias("label"),
        F.concat("embedding", F.array_repeat(F.lit(0).cast("float"), F.greatest(F.lit(0), 4 - F.col("label")).cast("int")))
        .alias("values"),
    )
    bad = validate.row_shape_violations(rows, "values", "label", width=64)
    return bad.select("vec_id", "label", F.array_join("faults", ",").alias("faults"))


def highest_prices(spark, sf_dir):
    """Per priority the three highest distinct prices and how many orders have each."""

    def best(counts):
        return [{"price": p, "n": counts[p]} for p in sorted(counts, reverse=True)[:3]]

    def create(columns):
        return best(Counter(columns["o_totalprice"].drop_null().to_pylist()))

    def merge(a, b):
        counts = Counter()
        for entry in (*a, *b):
            counts[entry["price"]] += entry["n"]
        return best(counts)

    kept = "array<struct<price:double,n:long>>"
    rows = aggregate_by_key(
        table(spark, sf_dir, "orders"), ["o_orderpriority"], ["o_totalprice"],
        create=create, merge=merge, state=kept, result=kept,
    )
    placed = rows.select("o_orderpriority", F.posexplode("result").alias("place", "entry"))
    return placed.select("o_orderpriority", (F.col("place") + 1).alias("rank"), "entry.price", "entry.n")


QUERIES = {
    f.__name__: f
    for f in (
        highest_prices, class_profile, class_profile_of_unknown_codes, class_names_per_line, class_count_check,
        class_count_texts, table_row_counts, distinct_counts, distinct_counts_with_null,
        distinct_event_types, document_token_counts, page_token_counts,
        conversation_token_counts, most_frequent_token, least_frequent_token, top_tokens,
        bottom_tokens, pixel_value_counts, pixel_value_counts_without_label,
        most_frequent_pixel_value, least_frequent_pixel_value, column_range,
        column_range_from_zero, column_moments, running_change_counts, pixel_change_counts,
        file_column_profile, file_column_profile_shifted, column_report_texts,
        column_report_parsed, padded_column_names, elapsed_texts, row_shape_violations,
    )
}


def _class_counts_sql(label: str, source: str) -> str:
    return (
        f"SELECT {CLASS_CASE.format(label=label)} AS class_name, count(*) AS n "
        f"FROM {source} GROUP BY 1"
    )


def _token_counts_sql(source: str, text: str, first: int = 1) -> str:
    found = TOKENS_SQL.format(text=text)
    found = found if first == 1 else f"({found})[{first}:]"
    return f"""SELECT token, count(*) AS n
FROM (SELECT lower(unnest({found})) AS token FROM {source}) GROUP BY token"""


def _ends_sql(counts: str, way: str, k: int) -> str:
    return f"SELECT token, n FROM ({counts}) ORDER BY n {way}, token {way} LIMIT {k}"


DOCUMENT_TOKENS = _token_counts_sql("documents", "text")
PIXEL_TOKENS = _token_counts_sql(LINES_SQL, "value")


def _changes_sql(value: str, with_cells: str, shape: str) -> str:
    """The running extremum spelled out: a window over all earlier rows."""
    return f"""WITH {with_cells},
seen AS (
  SELECT file, col, v,
         greatest(0, coalesce(max(v) OVER earlier, 0)) AS top,
         least(0, coalesce(min(v) OVER earlier, 0)) AS low
  FROM (SELECT file, rec, col, {value} AS v FROM pixels_or_cells)
  WINDOW earlier AS (PARTITION BY file, col ORDER BY rec
                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
),
totals AS (
  SELECT col, greatest(max(v), 0) AS max, least(min(v), 0) AS min,
         CAST(sum(CASE WHEN v > top THEN 1 ELSE 0 END) AS BIGINT) AS max_changed,
         CAST(sum(CASE WHEN v < low THEN 1 ELSE 0 END) AS BIGINT) AS min_changed
  FROM seen GROUP BY col
)
SELECT {shape} FROM totals"""


_FILE_CELLS = f"""{CELLS_SQL},
pixels_or_cells AS (SELECT vec_id // {FILE_RECORDS} AS file, vec_id AS rec, col, x FROM cells)"""
_FILE_PIXELS = f"""{PIXELS_SQL},
pixels_or_cells AS (SELECT file, rec, col, q FROM pixels)"""
_PROFILE_SHAPE = """col, printf('Col %04d', col) AS name, CAST(max AS FLOAT) AS max,
  CAST(min AS FLOAT) AS min, max_changed, min_changed"""
_REPORT_SHAPE = r"""printf('Col %04d', col) AS name,
  CAST(CAST(max AS FLOAT) AS VARCHAR) || chr(9) || CAST(CAST(min AS FLOAT) AS VARCHAR) || chr(9)
  || CAST(max_changed AS VARCHAR) || chr(9) || CAST(min_changed AS VARCHAR) AS line"""
_PARSED_SHAPE = """printf('Col %04d', col) AS name, CAST(max AS DOUBLE) AS max,
  CAST(min AS DOUBLE) AS min, CAST(max_changed AS INTEGER) AS max_changed,
  CAST(min_changed AS INTEGER) AS min_changed"""


def _union_counts(pairs: list[tuple[str, str]], template: str) -> str:
    return "\nUNION ALL ".join(template.format(a=a, b=b) for a, b in pairs)


SQL = {
    "highest_prices": """SELECT o_orderpriority, CAST(dense_rank() OVER w AS INTEGER) AS rank, o_totalprice AS price, count(*) AS n
FROM orders WHERE o_totalprice IS NOT NULL GROUP BY o_orderpriority, o_totalprice
WINDOW w AS (PARTITION BY o_orderpriority ORDER BY o_totalprice DESC) QUALIFY dense_rank() OVER w <= 3""",
    "class_profile": _class_counts_sql("label", "embeddings") + " ORDER BY 1",
    "class_profile_of_unknown_codes": _class_counts_sql(
        "label", "(SELECT l_linenumber * 2 AS label FROM lineitem)"
    ),
    "class_names_per_line": "SELECT l_orderkey, l_linenumber, "
    + CLASS_CASE.format(label="l_linenumber * 2 - 3") + " AS class_name FROM lineitem",
    "class_count_check": f"""
WITH counts AS ({_class_counts_sql("label", "embeddings")}),
wanted AS (SELECT unnest(['airplane', 'bird', 'truck', 'unicorn']) AS class_name,
           CAST({EXPECTED_PER_CLASS} AS BIGINT) AS expected)
SELECT class_name, coalesce(n, 0) AS actual, expected,
       coalesce(coalesce(n, 0) = expected, false) AS ok,
       'Actual num images: ' || CAST(coalesce(n, 0) AS VARCHAR)
       || '    Correct num images: 5000 (training set), 1000 (test set)' AS report
FROM counts FULL JOIN wanted USING (class_name)""",
    "class_count_texts": f"""SELECT class_name, 'Actual num images: ' || CAST(n AS VARCHAR)
  || '    Correct num images: 5000 (training set), 1000 (test set)' AS report
FROM ({_class_counts_sql("label", "embeddings")})""",
    "table_row_counts": _union_counts(
        [(t, t) for t in TABLES], "SELECT '{a}' AS table_name, count(*) AS n FROM {b}"
    ),
    "distinct_counts": _union_counts(
        [("o_custkey", "orders"), ("o_orderpriority", "orders"), ("l_partkey", "lineitem"),
         ("user_id", "events"), ("props", "events"), ("text", "documents"),
         ("lang", "documents")],
        "SELECT '{a}' AS column_name, count(*) AS n FROM (SELECT DISTINCT {a} FROM {b})",
    ),
    "distinct_counts_with_null": "SELECT count(*) AS n FROM (SELECT DISTINCT quality "
    "FROM documents LEFT JOIN labels USING (doc_id))",
    "distinct_event_types": "SELECT DISTINCT event_type FROM events",
    "document_token_counts": DOCUMENT_TOKENS,
    "page_token_counts": _token_counts_sql("pages", "html"),
    "conversation_token_counts": _token_counts_sql("conversations", "text"),
    "most_frequent_token": _ends_sql(DOCUMENT_TOKENS, "DESC", 1),
    "least_frequent_token": _ends_sql(DOCUMENT_TOKENS, "ASC", 1),
    "top_tokens": _ends_sql(DOCUMENT_TOKENS, "DESC", 25),
    "bottom_tokens": _ends_sql(DOCUMENT_TOKENS, "ASC", 25),
    "pixel_value_counts": PIXEL_TOKENS,
    "pixel_value_counts_without_label": _token_counts_sql(LINES_SQL, "value", first=2),
    "most_frequent_pixel_value": _ends_sql(PIXEL_TOKENS, "DESC", 1),
    "least_frequent_pixel_value": _ends_sql(PIXEL_TOKENS, "ASC", 1),
    "column_range": f"""WITH {CELLS_SQL}
SELECT col, printf('Col %04d', col) AS name, max(x) AS max, min(x) AS min, count(*) AS n
FROM cells GROUP BY col""",
    "column_range_from_zero": f"""WITH {CELLS_SQL}
SELECT col, printf('Col %04d', col) AS name, greatest(max(x), 0.0::DOUBLE) AS max,
       least(min(x), 0.0::DOUBLE) AS min
FROM cells GROUP BY col""",
    "column_moments": f"""WITH {CELLS_SQL}
SELECT col, round(avg(x), 6) + 0.0 AS mean, round(stddev_pop(x), 6) + 0.0 AS std
FROM cells GROUP BY col""",
    "running_change_counts": _changes_sql("x", _FILE_CELLS, "col, max_changed, min_changed"),
    "pixel_change_counts": _changes_sql("q", _FILE_PIXELS, "col, max_changed, min_changed"),
    "file_column_profile": _changes_sql("q", _FILE_PIXELS, _PROFILE_SHAPE),
    "file_column_profile_shifted": _changes_sql("xor(q, 128)", _FILE_PIXELS, _PROFILE_SHAPE),
    "column_report_texts": _changes_sql("q", _FILE_PIXELS, _REPORT_SHAPE),
    "column_report_parsed": _changes_sql("q", _FILE_PIXELS, _PARSED_SHAPE),
    "padded_column_names": "SELECT p_partkey, printf('Col %04d', p_partkey) AS name FROM part",
    "elapsed_texts": """SELECT event_id,
  printf('%dm %ds', CAST(floor(s / 60) AS BIGINT), CAST(floor(s - floor(s / 60) * 60) AS BIGINT))
  AS elapsed
FROM (SELECT event_id, value * 10 AS s FROM events)""",
    "row_shape_violations": """SELECT vec_id, label, CASE WHEN w AND b THEN 'width,label'
  WHEN w THEN 'width' ELSE 'label' END AS faults
FROM (SELECT vec_id, label * 2 - 1 AS label,
        len(embedding) + greatest(0, 4 - label) <> 64 AS w,
        label * 2 - 1 NOT BETWEEN 0 AND 9 AS b FROM embeddings)
WHERE w OR b""",
}
