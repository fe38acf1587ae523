"""Every registered query against its SQL twin on the smallest tables, and the
shapes no query plan may have."""

import oracle
import pytest

import __spark_entry__ as entry

SF_DIR = "/root/testdata/sf0.001"
SQL = entry.oracle_sql()
FORBIDDEN = ["CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython"]


@pytest.fixture(scope="module")
def duck():
    return oracle.connect(SF_DIR)


@pytest.mark.parametrize("name", list(entry.queries()))
def test_query(spark, duck, name):
    frame = entry.queries()[name](spark, SF_DIR)
    check_plan(frame)
    if name in SQL:
        assert oracle.compare(frame, duck, SQL[name]) is None
    else:
        assert frame.count() > 0


def check_plan(frame):
    """No cross join, no row-at-a-time function, and no window without
    partitions but the one over the partition sizes of a table."""
    plan = shown(frame)
    for node in FORBIDDEN:
        assert node not in plan
    for line in plan.splitlines():
        if "Window [" in line and line.count("], [") < 2:
            assert "], [__part#" in line


def shown(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_every_sql_has_a_query():
    assert set(SQL) <= set(entry.queries())


def test_entry(spark):
    rows = entry.entry(spark).collect()
    assert [r["class_name"] for r in rows] == sorted(r["class_name"] for r in rows)
    assert sum(r["n"] for r in rows) == spark.read.parquet(f"{SF_DIR}/embeddings.parquet").count()


def test_scans_read_only_the_columns_a_query_uses(spark):
    queries = entry.queries()
    assert "ReadSchema: struct<label:int>" in shown(queries["class_profile"](spark, SF_DIR))
    assert "ReadSchema: struct<text:string>" in shown(queries["document_token_counts"](spark, SF_DIR))
    assert "ReadSchema: struct<l_linenumber:int>" in shown(
        queries["class_profile_of_unknown_codes"](spark, SF_DIR)
    )
    assert "ReadSchema: struct<embedding:array<float>>" in shown(
        queries["column_range"](spark, SF_DIR)
    )


def test_top_k_is_kept_per_task(spark):
    assert "TakeOrderedAndProject(limit=25" in shown(entry.queries()["top_tokens"](spark, SF_DIR))


def test_counts_are_combined_before_the_shuffle(spark):
    plan = shown(entry.queries()["document_token_counts"](spark, SF_DIR))
    assert plan.index("functions=[count(1)]") < plan.index("Exchange hashpartitioning")
    assert plan.index("Exchange hashpartitioning") < plan.index("functions=[partial_count(1)]")
