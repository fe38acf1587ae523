import random

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gridloom.operators import index, vectors
from gridloom.operators.validate import operand_mismatches, require_same_sizes

VECTOR = "id int, size int, idx int, value double"


def table(spark, vecs, *, headers=True):
    """Vectors given as {id: (size, {idx: value})}."""
    rows = [(i, size, k, v) for i, (size, entries) in vecs.items() for k, v in entries.items()]
    if headers:
        rows += [(i, size, None, None) for i, (size, _) in vecs.items()]
    return spark.createDataFrame(rows, VECTOR)


def as_dict(df):
    out = {}
    for r in df.collect():
        entries = out.setdefault(r["id"], (r["size"], {}))[1]
        if r["idx"] is not None:
            assert r["idx"] not in entries
            entries[r["idx"]] = r["value"]
    return out


def test_index_map(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,), ("b",), ("é",)], "k string").repartition(4)
    indices = index.index_map(df, "k")
    assert indices.dtypes == [("k", "string"), ("index", "int")]
    assert {r["k"]: r["index"] for r in indices.collect()} == {"a": 0, "b": 1, "é": 2}


def test_index_map_over_many_partitions(spark):
    keys = list(range(0, 50000, 7))
    random.Random(1).shuffle(keys)
    df = spark.createDataFrame([(k,) for k in keys], "k long").repartition(16)
    got = {r["k"]: r["i"] for r in index.index_map(df, "k", "i", kind="long").collect()}
    assert got == {k: i for i, k in enumerate(sorted(keys))}


def test_index_map_of_one_key_and_of_none(spark):
    one = spark.createDataFrame([(4,), (4,)], "k int")
    assert [tuple(r) for r in index.index_map(one, "k").collect()] == [(4, 0)]
    assert index.index_map(one.where("k > 9"), "k").count() == 0


@pytest.mark.parametrize("how", ["inner", "left"])
def test_zip_index_by_broadcast_and_by_shuffle(spark, how, monkeypatch):
    monkeypatch.setattr(index, "HOT_SHARE", 0.01)
    rows = [(i, None if i % 11 == 0 else ("hot" if i % 3 else f"k{i % 200:03d}")) for i in range(3000)]
    df = spark.createDataFrame(rows, "i int, k string").repartition(6)
    small = index.zip_index(df, "k", "n", how=how)
    shuffled = index.zip_index(df, "k", "n", how=how, broadcast_bytes=0)
    assert small.columns == shuffled.columns == ["i", "k", "n"]
    a, b = sorted(map(str, small.collect())), sorted(map(str, shuffled.collect()))
    assert a == b
    assert len(a) == (3000 if how == "left" else sum(k is not None for _, k in rows))
    plan = shuffled._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "LeftAnti" in plan
    monkeypatch.setattr(index, "BROADCAST_BYTES", 1)
    plain = index.zip_index(df, "k", "n", how=how, broadcast_bytes=0)
    assert sorted(map(str, plain.collect())) == a
    assert "LeftAnti" not in plain._jdf.queryExecution().executedPlan().toString()


def test_ordinals_follow_the_order(spark):
    df = spark.range(2000).withColumn("k", F.xxhash64("id"))
    rows = index.ordinals(df, [F.desc("k")]).orderBy("ordinal").collect()
    assert [r["ordinal"] for r in rows] == list(range(2000))
    assert [r["k"] for r in rows] == sorted((r["k"] for r in rows), reverse=True)


CASES = [
    ({0: 1.0, 3: 2.0}, {1: 5.0}),
    ({0: 1.0, 3: 2.0}, {0: -1.0, 3: 4.0}),
    ({}, {2: 1.5}),
    ({}, {}),
    ({1: 0.0}, {1: 7.0, 2: 0.0}),
]


def test_add_and_multiply(spark):
    a = table(spark, {i: (4, x) for i, (x, _) in enumerate(CASES)})
    b = table(spark, {i: (4, y) for i, (_, y) in enumerate(CASES)})
    total = {
        i: (4, {k: x.get(k, 0) + y.get(k, 0) for k in x.keys() | y.keys()})
        for i, (x, y) in enumerate(CASES)
    }
    product = {i: (4, {k: x[k] * y[k] for k in x.keys() & y.keys()}) for i, (x, y) in enumerate(CASES)}
    assert as_dict(vectors.add(a, b)) == as_dict(vectors.add(b, a)) == total
    assert as_dict(vectors.multiply(a, b)) == as_dict(vectors.multiply(b, a)) == product


def test_a_missing_side_is_an_empty_vector(spark):
    a = table(spark, {1: (4, {0: 1.0})})
    none = table(spark, {2: (4, {})}).where("id < 0")
    assert as_dict(vectors.add(a, none)) == {1: (4, {0: 1.0})}
    assert as_dict(vectors.multiply(a, none)) == {}


def test_sizes_must_agree(spark):
    a, b = table(spark, {1: (4, {0: 1.0})}), table(spark, {1: (5, {2: 1.0})})
    assert [tuple(r) for r in operand_mismatches(a, b).collect()] == [(1, 4, 5)]
    with pytest.raises(ValueError):
        require_same_sizes(a, b)
    other = table(spark, {2: (7, {0: 3.0})})
    for op in (vectors.add, vectors.multiply):
        with pytest.raises(Exception, match="not of the same size: 1"):
            op(a.unionByName(other), b.unionByName(other)).collect()
        assert op(a.unionByName(other), b.unionByName(other), strict=False).count() >= 1
        with pytest.raises(TypeError):
            op(a, spark.range(3))


def test_sizes_are_compared_inside_the_one_aggregation(spark):
    a, b = table(spark, {1: (4, {0: 1.0})}), table(spark, {1: (5, {2: 1.0})})
    group = "sizes-are-lazy"
    spark.sparkContext.setJobGroup(group, group)
    try:
        results = [op(a, b) for op in (vectors.add, vectors.multiply)]
        assert not spark.sparkContext.statusTracker().getJobIdsForGroup(group)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    for result in results:
        plan = result._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 1 and plan.count("Expand") == 1
        assert "partial_min(size" in plan and plan.count("Scan ExistingRDD") == plan.count("Union") * 2


def test_concat_of_many_ids_joins_hot_ones_in_place(spark, monkeypatch):
    rng = np.random.default_rng(11)
    wide = {0: (9000, {int(i): float(i) for i in range(9000)})}  # an id with most entries
    few = [{i: (int(rng.integers(1, 5)), {0: float(i)}) for i in rng.choice(200, 120, replace=False).tolist()} for _ in range(3)]
    parts = [table(spark, {**own, **(wide if k == 1 else {})}).repartition(6) for k, own in enumerate(few)]
    plain = as_dict(vectors.concat(parts))
    monkeypatch.setattr(vectors, "BROADCAST_BYTES", 0)
    monkeypatch.setattr(vectors, "HOT_SHARE", 0.05)
    joined = vectors.concat(parts)
    assert as_dict(joined) == plain
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "LeftAnti" in plan and "SortMergeJoin" in plan and "Window" not in plan


def test_concat_with_constant_and_looked_up_sizes(spark):
    parts = [
        table(spark, {1: (2, {0: 1.0}), 2: (2, {})}),
        table(spark, {1: (3, {2: 5.0}), 2: (3, {0: 6.0})}),
        table(spark, {1: (1, {0: 9.0}), 2: (1, {})}),
    ]
    whole = {1: (6, {0: 1.0, 4: 5.0, 5: 9.0}), 2: (6, {2: 6.0})}
    constant = vectors.concat(parts, sizes=[2, 3, 1])
    # Only the headers are shuffled, to keep one per vector.
    plan = constant._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert "isnull(idx" in plan
    assert as_dict(constant) == whole
    assert as_dict(vectors.concat(parts)) == whole
    for result in (constant, vectors.concat(parts)):
        assert result.where("idx is null").count() == 2


def test_concat_with_sizes_differing_by_id(spark):
    parts = [
        table(spark, {1: (2, {1: 1.0}), 2: (5, {4: 2.0})}),
        table(spark, {1: (3, {0: 3.0}), 2: (1, {0: 4.0})}),
    ]
    assert as_dict(vectors.concat(parts)) == {1: (5, {1: 1.0, 2: 3.0}), 2: (6, {4: 2.0, 5: 4.0})}


def test_shift_scale_and_offsets(spark):
    v = table(spark, {1: (4, {0: 1.0, 3: 2.0}), 2: (4, {})})
    assert as_dict(vectors.shift(v, 2, 9)) == {1: (9, {2: 1.0, 5: 2.0}), 2: (9, {})}
    assert as_dict(vectors.scale_by(v, -3.0)) == {1: (4, {0: -3.0, 3: -6.0}), 2: (4, {})}
    assert vectors.part_offsets([2, 3, 1]) == [0, 2, 5]


def test_index_sets(spark):
    a, b = table(spark, {1: (9, {0: 1.0, 2: 1.0})}), table(spark, {1: (9, {2: 1.0, 5: 1.0})})
    assert {r["idx"] for r in vectors.index_union(a, b).collect()} == {0, 2, 5}
    assert {r["idx"] for r in vectors.index_intersection(a, b).collect()} == {2}


def test_rows_are_sorted_and_keep_empty_vectors(spark):
    v = table(spark, {1: (9, {5: 1.0, 0: 2.0}), 2: (9, {})})
    rows = {r["id"]: (r["indices"], r["values"]) for r in vectors.to_rows(v).collect()}
    assert rows == {1: ([0, 5], [2.0, 1.0]), 2: ([], [])}
    said = {r["id"]: r["text"] for r in vectors.vector_text(vectors.to_rows(v)).collect()}
    assert said == {1: "(9,[0,5],[2.0,1.0])", 2: "(9,[],[])"}


def test_from_arrays(spark):
    df = spark.createDataFrame([(1, [0.0, 0.5, -0.7]), (2, [0.0, 0.0, 0.0])], "k int, v array<float>")
    entries = vectors.from_arrays(df, "k", "v", above=0.6, headers=True)
    got = as_dict(entries)
    assert got[1][1].keys() == {2} and got[2] == (3, {})


entries = st.dictionaries(st.integers(0, 5), st.integers(-3, 3).map(float), max_size=6)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(entries, entries), min_size=1, max_size=6))
def test_vector_algebra_properties(spark, pairs):
    a = table(spark, {i: (6, x) for i, (x, _) in enumerate(pairs)})
    b = table(spark, {i: (6, y) for i, (_, y) in enumerate(pairs)})
    assert as_dict(vectors.add(a, b, strict=False)) == as_dict(vectors.add(b, a, strict=False))
    assert as_dict(vectors.multiply(a, b, strict=False)) == as_dict(
        vectors.multiply(b, a, strict=False)
    )
    joined = as_dict(vectors.concat([a, b]))
    assert joined == as_dict(vectors.concat([a, b], sizes=[6, 6]))
    for i, (x, y) in enumerate(pairs):
        assert joined[i] == (12, {**x, **{k + 6: v for k, v in y.items()}})
