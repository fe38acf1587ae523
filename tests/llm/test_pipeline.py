"""Pipeline stages on odd tables: nulls, empty and long texts, ties, repeated rows, none at all."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from gridloom.llm import quality, toxicity

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
SF_DIR = "/root/testdata/sf0.001"
LONG = " ".join(f"word{i % 9000}" for i in range(30_000))
ROWS = [
    (1, "Same text here for all of them", "en", "s", 1), (2, "Same text here for all of them", None, None, None),
    (2, "Same text here for all of them", None, None, None), (3, "", "en", "s", 0), (4, None, None, None, None),
    (None, None, None, None, None), (None, "only null key", "de", "s", 3), (6, LONG, "en", "s", 2),
    (7, LONG + " more", "en", "s", 2), (8, " \t\n ", "es", "s", 4),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ROWS, DOCS)


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stages_take_odd_tables(spark, odd, name, stage):
    left = stage(spark, odd, SF_DIR)
    rows = left.collect()
    if name == "packing":
        assert {r["doc_id"] for r in rows} <= {r[0] for r in ROWS}
        assert {1, 2, 3, 4, 6, 7, 8} <= {r["doc_id"] for r in rows}
    else:
        assert left.columns == odd.columns and {tuple(r) for r in rows} <= set(ROWS)
    assert stage(spark, odd.limit(0), SF_DIR).count() == 0


def test_stages_keep_columns_of_any_name(spark, odd):
    wide = odd
    for extra in ("score", "label", "predicted", "threshold", "key", "fp", "sha", "__key", "__sha", "component_id", "grp", "kept"):
        wide = wide.withColumn(extra, F.lit("x"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        left = stage(spark, wide, SF_DIR)
        assert left.columns == wide.columns, name
        assert left.where("score <> 'x'").count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, wide, SF_DIR).count() > 0


def test_near_copies_and_copies_go(spark, odd):
    stages = dict(corpus_pipeline.STAGES)
    once = stages["exact dedup"](spark, odd, SF_DIR)
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in once.collect()) == [
        (False, 2), (False, 4), (False, 6), (False, 7), (False, 8), (True, 0)]
    apart = stages["n-gram jaccard join"](spark, once, SF_DIR)
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in apart.collect()) == [
        (False, 2), (False, 4), (False, 6), (False, 8), (True, 0)]


@pytest.mark.parametrize("stage, label, scored", [
    (quality.good_only, "quality", quality.quality_scores), (toxicity.without_toxic, "toxic", toxicity.toxicity_scores)])
def test_filters_decide_as_their_scores_do(spark, stage, label, scored):
    """Rows that go are those below the cut, or at the threshold of their language; nothing else."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    scores = {r["doc_id"]: r for r in scored(docs, labels).collect()}
    kept = {r["doc_id"] for r in stage(docs, labels).collect()}
    if label == "quality":
        assert kept == {i for i, r in scores.items() if r["score"] >= quality.CUT}
    else:
        assert kept == {i for i, r in scores.items() if r["score"] < r["threshold"]}
    none = labels.limit(0)
    assert stage(docs, none).count() == docs.count()  # no labels: nothing is held against anyone
