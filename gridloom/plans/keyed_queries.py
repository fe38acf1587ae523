"""Index maps and sparse vectors as tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridloom.functions import sparse
from gridloom.functions.texts import empty_vector_text
from gridloom.operators import index, validate, vectors
from gridloom.plans.tables import CELLS_SQL, rounded, table

THRESHOLD = 0.1


def priority_index(spark, sf_dir):
    return index.index_map(table(spark, sf_dir, "orders"), "o_orderpriority", "idx")


def customer_index(spark, sf_dir):
    return index.index_map(
        table(spark, sf_dir, "orders"), "o_custkey", "idx", kind="long", count_name="n"
    )


def source_index(spark, sf_dir):
    return index.index_map(table(spark, sf_dir, "documents"), "source", "idx")


def indexed_orders(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    return index.zip_index(orders, "o_orderpriority", "idx")


def indexed_events_by_shuffle(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "user_id")
    return index.zip_index(events, "user_id", "idx", broadcast_bytes=0)


def indexed_scores_with_null(spark, sf_dir):
    scores = table(spark, sf_dir, "documents").join(
        table(spark, sf_dir, "labels"), "doc_id", "left"
    )
    return index.zip_index(scores.select("doc_id", "quality"), "quality", "idx", how="left")


# --- vectors: entries beyond the threshold, each vector with the one before it ---


def _vectors(spark, sf_dir, *, headers=False):
    return vectors.from_arrays(
        table(spark, sf_dir, "embeddings"), "vec_id", "embedding",
        above=THRESHOLD, headers=headers,
    )


def _pairs(spark, sf_dir, *, headers=False):
    own = _vectors(spark, sf_dir, headers=headers)
    return own, own.withColumn("id", F.col("id") + 1)


def sparse_entries(spark, sf_dir):
    return _vectors(spark, sf_dir, headers=True)


def sparse_sum(spark, sf_dir):
    return vectors.add(*_pairs(spark, sf_dir)).select("id", "size", "idx", rounded("value"))


def sparse_product(spark, sf_dir):
    product = vectors.multiply(*_pairs(spark, sf_dir, headers=True))
    return product.select("id", "size", "idx", rounded("value"))


def sparse_shifted(spark, sf_dir):
    return vectors.shift(_vectors(spark, sf_dir), 10, 100)


def sparse_scaled(spark, sf_dir):
    return vectors.scale_by(_vectors(spark, sf_dir), -2.5).select(
        "id", "size", "idx", rounded("value")
    )


def sparse_concatenation(spark, sf_dir):
    return vectors.concat(list(_pairs(spark, sf_dir, headers=True)), sizes=[64, 64])


def sparse_concatenation_by_id(spark, sf_dir):
    return vectors.concat(list(_pairs(spark, sf_dir, headers=True)))


def vector_offsets(spark, sf_dir):
    parts = table(spark, sf_dir, "embeddings").select(
        F.expr("vec_id div 4").alias("id"), F.expr("vec_id % 4").cast("int").alias("part"),
        (F.col("label") + 10).alias("size"),
    )
    return vectors.offsets_by_id(parts)


def vector_rows(spark, sf_dir):
    rows = vectors.to_rows(vectors.add(*_pairs(spark, sf_dir)))
    return rows.select(
        "id", "size", F.array_join(F.col("indices").cast("array<string>"), ",").alias("indices"),
        F.size("values").alias("entries"),
    )


def vector_texts(spark, sf_dir):
    """Texts of vectors that keep entries above 0.4 only, some of them empty."""
    sparse = vectors.from_arrays(
        table(spark, sf_dir, "embeddings"), "vec_id", "embedding", above=0.4, headers=True
    )
    return vectors.vector_text(vectors.to_rows(sparse))


def empty_vector_texts(spark, sf_dir):
    return table(spark, sf_dir, "part").select(
        "p_partkey", empty_vector_text("p_size").alias("text")
    )


def index_union(spark, sf_dir):
    return vectors.index_union(*_pairs(spark, sf_dir))


def index_intersection(spark, sf_dir):
    return vectors.index_intersection(*_pairs(spark, sf_dir))


# --- the same with both vectors in one row ------------------------------------


def _vector_rows(spark, sf_dir):
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("id"), sparse.from_dense("embedding", above=THRESHOLD).alias("a")
    )


def _paired_rows(spark, sf_dir):
    own = _vector_rows(spark, sf_dir)
    return own.join(own.select(F.col("id") + 1, F.col("a")).toDF("id", "b"), "id")


def _entries(df, vector):
    return df.select("id", F.explode(vector).alias("idx", "value")).select(
        "id", "idx", rounded("value")
    )


def row_sparse_sum(spark, sf_dir):
    return _entries(_paired_rows(spark, sf_dir), sparse.add("a", "b"))


def row_sparse_product(spark, sf_dir):
    return _entries(_paired_rows(spark, sf_dir), sparse.multiply("a", "b"))


def row_sparse_concatenation(spark, sf_dir):
    return _entries(_paired_rows(spark, sf_dir), sparse.concat(["a", "b"], [64, 64]))


def row_sparse_scaled(spark, sf_dir):
    return _entries(_vector_rows(spark, sf_dir), sparse.scale("a", 3.0))


def row_dense_values(spark, sf_dir):
    rows = _vector_rows(spark, sf_dir)
    return rows.select("id", F.posexplode(sparse.to_dense("a", 64)).alias("idx", "value")).select(
        "id", "idx", rounded("value")
    )


def operand_mismatches(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings")
    a = vectors.from_arrays(rows, "vec_id", "embedding")
    more = F.array_repeat(F.lit(1).cast("float"), F.col("label").cast("int"))
    longer = rows.withColumn("embedding", F.concat("embedding", more))
    return validate.operand_mismatches(a, vectors.from_arrays(longer, "vec_id", "embedding"))


QUERIES = {
    f.__name__: f
    for f in (
        priority_index, customer_index, source_index, indexed_orders, indexed_events_by_shuffle,
        indexed_scores_with_null, sparse_entries, sparse_sum, sparse_product, sparse_shifted,
        sparse_scaled, sparse_concatenation, sparse_concatenation_by_id, vector_offsets,
        vector_rows, vector_texts, empty_vector_texts, index_union, index_intersection,
        operand_mismatches, row_sparse_sum, row_sparse_product, row_sparse_concatenation,
        row_sparse_scaled, row_dense_values,
    )
}


def _index_sql(source: str, key: str, kind: str = "INTEGER", more: str = "") -> str:
    return f"""SELECT {key}, CAST(row_number() OVER (ORDER BY {key}) - 1 AS {kind}) AS idx{more}
FROM {source} WHERE {key} IS NOT NULL GROUP BY {key}"""


_SCORES = "(SELECT doc_id, quality FROM documents LEFT JOIN labels USING (doc_id))"

_PAIRS = f"""{CELLS_SQL},
a AS (
  SELECT vec_id AS id, 64 AS size, col AS idx, x AS value FROM cells WHERE abs(x) > {THRESHOLD}
),
b AS (SELECT id + 1 AS id, size, idx, value FROM a),
own AS (SELECT vec_id AS id FROM embeddings),
before AS (SELECT vec_id + 1 AS id FROM embeddings),
both_ids AS (SELECT id FROM own JOIN before USING (id))"""

_CONCATENATION = f"""WITH {_PAIRS}
SELECT id, 128 AS size, idx, value FROM a
UNION ALL SELECT id, 128, idx + 64, value FROM b
UNION ALL SELECT id, 128, NULL, NULL FROM own FULL JOIN before USING (id)"""

_CONCATENATION_BY_ID = f"""WITH {_PAIRS},
ids AS (
  SELECT id, own.id IS NOT NULL AND before.id IS NOT NULL AS paired
  FROM own FULL JOIN before USING (id)
)
SELECT id, CASE WHEN paired THEN 128 ELSE 64 END AS size, idx, value FROM a JOIN ids USING (id)
UNION ALL SELECT id, CASE WHEN paired THEN 128 ELSE 64 END,
  CASE WHEN paired THEN idx + 64 ELSE idx END, value FROM b JOIN ids USING (id)
UNION ALL SELECT id, CASE WHEN paired THEN 128 ELSE 64 END, NULL, NULL FROM ids"""

_SUMMED = f"""WITH {_PAIRS},
summed AS (
  SELECT id, 64 AS size, idx, sum(value) AS value
  FROM (SELECT * FROM a UNION ALL SELECT * FROM b) GROUP BY id, idx
)"""

SQL = {
    "priority_index": _index_sql("orders", "o_orderpriority"),
    "customer_index": _index_sql("orders", "o_custkey", "BIGINT", ", count(*) AS n"),
    "source_index": _index_sql("documents", "source"),
    "indexed_orders": f"""SELECT o_orderkey, o_orderpriority, idx
FROM orders JOIN ({_index_sql("orders", "o_orderpriority")}) USING (o_orderpriority)""",
    "indexed_events_by_shuffle": f"""SELECT event_id, user_id, idx
FROM events JOIN ({_index_sql("events", "user_id")}) USING (user_id)""",
    "indexed_scores_with_null": f"""SELECT doc_id, s.quality, idx
FROM {_SCORES} s LEFT JOIN ({_index_sql(_SCORES, "quality")}) i ON s.quality = i.quality""",
    "sparse_entries": f"""WITH {CELLS_SQL}
SELECT vec_id AS id, 64 AS size, col AS idx, x AS value FROM cells WHERE abs(x) > {THRESHOLD}
UNION ALL SELECT vec_id, 64, NULL, NULL FROM embeddings""",
    "sparse_sum": f"{_SUMMED} SELECT id, size, idx, round(value, 6) + 0.0 AS value FROM summed",
    "sparse_product": f"""WITH {_PAIRS}
SELECT a.id, a.size, a.idx, round(a.value * b.value, 6) + 0.0 AS value
FROM a JOIN b ON a.id = b.id AND a.idx = b.idx
UNION ALL SELECT id, 64, NULL, NULL FROM both_ids""",
    "sparse_shifted": f"WITH {_PAIRS} SELECT id, 100 AS size, idx + 10 AS idx, value FROM a",
    "sparse_scaled": f"WITH {_PAIRS} SELECT id, size, idx, round(value * -2.5, 6) + 0.0 AS value FROM a",
    "sparse_concatenation": _CONCATENATION,
    "sparse_concatenation_by_id": _CONCATENATION_BY_ID,
    "row_sparse_sum": f"""{_SUMMED} SELECT s.id, idx, round(value, 6) + 0.0 AS value
FROM summed s JOIN both_ids USING (id)""",
    "row_sparse_product": f"""WITH {_PAIRS}
SELECT a.id, a.idx, round(a.value * b.value, 6) + 0.0 AS value
FROM a JOIN b ON a.id = b.id AND a.idx = b.idx""",
    "row_sparse_concatenation": f"""WITH {_PAIRS}
SELECT id, idx, round(value, 6) + 0.0 AS value FROM a JOIN both_ids USING (id)
UNION ALL SELECT id, idx + 64, round(value, 6) + 0.0 FROM b JOIN both_ids USING (id)""",
    "row_sparse_scaled": f"""WITH {_PAIRS}
SELECT id, idx, round(value * 3.0, 6) + 0.0 AS value FROM a""",
    "row_dense_values": f"""WITH {CELLS_SQL}
SELECT vec_id AS id, col AS idx,
       round(CASE WHEN abs(x) > {THRESHOLD} THEN x ELSE 0.0 END, 6) + 0.0 AS value
FROM cells""",
    "vector_offsets": """
WITH parts AS (
  SELECT vec_id // 4 AS id, CAST(vec_id % 4 AS INTEGER) AS part, label + 10 AS size FROM embeddings
)
SELECT id, part,
  CAST(coalesce(sum(size) OVER (PARTITION BY id ORDER BY part
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS INTEGER) AS start,
  CAST(sum(size) OVER (PARTITION BY id) AS INTEGER) AS total
FROM parts""",
    "vector_rows": f"""{_SUMMED}
SELECT id, 64 AS size, string_agg(CAST(idx AS VARCHAR), ',' ORDER BY idx) AS indices,
       CAST(count(*) AS INTEGER) AS entries
FROM summed GROUP BY id""",
    "vector_texts": f"""WITH {CELLS_SQL}
SELECT vec_id AS id, '(64,['
  || coalesce(string_agg(CAST(col AS VARCHAR), ',' ORDER BY col) FILTER (WHERE abs(x) > 0.4), '') || '],['
  || coalesce(string_agg(CAST(x AS VARCHAR), ',' ORDER BY col) FILTER (WHERE abs(x) > 0.4), '') || '])' AS text
FROM cells GROUP BY vec_id""",
    "empty_vector_texts": "SELECT p_partkey, '(' || CAST(p_size AS VARCHAR) || ',[],[])' AS text FROM part",
    "index_union": f"WITH {_PAIRS} SELECT id, idx FROM a UNION SELECT id, idx FROM b",
    "index_intersection": f"WITH {_PAIRS} SELECT id, idx FROM a INTERSECT SELECT id, idx FROM b",
    "operand_mismatches": """SELECT vec_id AS id, CAST(len(embedding) AS INTEGER) AS size_a,
  CAST(len(embedding) + label AS INTEGER) AS size_b
FROM embeddings WHERE label > 0""",
}
