import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridloom.functions import scaling, sparse
from gridloom.operators import batches, normalise


def one(spark, values, column, kind="int"):
    return spark.createDataFrame([(values,)], f"v array<{kind}>").select(column.alias("x")).first()["x"]


def test_scaling(spark):
    assert one(spark, [0, 51, 255], scaling.scale("v")) == [0.0, 0.2, 1.0]
    assert one(spark, [0, 51, None], scaling.min_max("v")) == [0.0, 0.2, None]
    assert one(spark, [3, 5], scaling.min_max("v", 5, 5)) == [0.0, 0.0]
    got = one(spark, [0, 255], scaling.standardise(scaling.scale("v")))
    assert got == pytest.approx([-0.1307 / 0.3081, (1 - 0.1307) / 0.3081])


def test_scaling_by_position(spark):
    low, high = F.array(F.lit(0.0), F.lit(10.0)), F.array(F.lit(2.0), F.lit(10.0))
    assert one(spark, [1, 10], scaling.min_max("v", low, high)) == [0.5, 0.0]


def test_min_max_by_column_with_a_constant_column(spark):
    df = spark.createDataFrame([([1.0, 5.0],), ([3.0, 5.0],), ([2.0, 5.0],)], "v array<double>")
    rows = sorted(r["z"] for r in normalise.min_max_by_column(df, "v", "z").collect())
    assert rows == [[0.0, 0.0], [0.5, 0.0], [1.0, 0.0]]
    from_zero = normalise.min_max_by_column(df, "v", "z", initial=0.0).collect()
    assert sorted(r["z"][1] for r in from_zero) == [1.0, 1.0, 1.0]


def test_standardise_by_column(spark):
    data = np.random.default_rng(2).normal(3, 2, (40, 4))
    df = spark.createDataFrame([(row.tolist(),) for row in data], "v array<double>")
    got = np.array([r["z"] for r in normalise.standardise_by_column(df, "v", "z").collect()])
    assert np.allclose(got.mean(axis=0), 0) and np.allclose(got.std(axis=0), 1)


def test_scaled_rows_keep_the_label(spark):
    df = spark.createDataFrame([("7,0,255",)], "value string")
    assert tuple(normalise.scaled_rows(df).first()) == (7, [0.0, 1.0])


def test_packed_floats(spark):
    rows = [([0.5, -2.0],), ([],), (None,), ([1.0],)]
    df = spark.createDataFrame(rows, "v array<float>").coalesce(1)
    packed = df.select("v", scaling.pack_floats("v").alias("p"))
    for r in packed.collect():
        expected = None if r["v"] is None else struct.pack(f">{len(r['v'])}f", *r["v"])
        assert (None if r["p"] is None else bytes(r["p"])) == expected
    back = packed.select("v", scaling.unpack_floats("p").alias("u")).collect()
    assert all(r["v"] == r["u"] for r in back)


def test_argmax_takes_the_first_of_ties(spark):
    assert one(spark, [1, 7, 7, 3], scaling.row_argmax("v")) == 1


def test_flatten(spark):
    grid = F.array(F.array(F.lit(1), F.lit(2)), F.array(F.lit(3), F.lit(4)))
    assert spark.range(1).select(scaling.flatten_grid(grid).alias("x")).first()["x"] == [1, 2, 3, 4]


def test_exact_batches(spark):
    df = spark.range(1000).repartition(7)
    placed = batches.exact_batches(df, ["id"], 64, seed=1, epoch=1)
    rows = placed.collect()
    assert sorted(r["id"] for r in rows) == list(range(1000))
    assert sorted(r["position"] for r in rows) == list(range(1000))
    sizes = sorted(r["count"] for r in placed.groupBy("batch").count().collect())
    assert sizes == [1000 - 15 * 64] + [64] * 15
    again = batches.exact_batches(df.repartition(3), ["id"], 64, seed=1, epoch=1)
    assert {(r["id"], r["batch"]) for r in again.collect()} == {(r["id"], r["batch"]) for r in rows}
    other = batches.exact_batches(df, ["id"], 64, seed=1, epoch=2)
    assert {(r["id"], r["batch"]) for r in other.collect()} != {(r["id"], r["batch"]) for r in rows}


def test_batches_of_rows_sharing_a_key(spark):
    df = spark.range(300).select("id", F.lit("same").alias("text"))
    placed = batches.exact_batches(df, ["text"], 50)
    assert sorted(r["count"] for r in placed.groupBy("batch").count().collect()) == [50] * 6
    assert placed.select("id").distinct().count() == 300


def test_hashed_batches_need_no_shuffle(spark):
    placed = batches.hashed_batches(spark.range(1000), ["id"], 8)
    assert "Exchange" not in placed._jdf.queryExecution().executedPlan().toString()
    assert {r["batch"] for r in placed.select("batch").distinct().collect()} == set(range(8))


def test_sparse_maps_in_one_row(spark):
    df = spark.createDataFrame(
        [({0: 1.0, 3: 2.0}, {3: 4.0, 1: 0.0}), ({}, {2: 1.0}), (None, {5: 1.0})],
        "a map<int,double>, b map<int,double>",
    )
    rows = df.select(
        sparse.add("a", "b").alias("sum"), sparse.multiply("a", "b").alias("product"),
        sparse.concat(["a", "b"], [4, 6]).alias("both"), sparse.indices("b").alias("indices"),
        sparse.to_dense("a", 4).alias("dense"), sparse.shift("b", 2).alias("shifted"),
    ).collect()
    assert rows[0]["sum"] == {0: 1.0, 3: 6.0, 1: 0.0}
    assert rows[0]["product"] == {3: 8.0}
    assert rows[0]["both"] == {0: 1.0, 3: 2.0, 7: 4.0, 5: 0.0}
    assert rows[0]["indices"] == [1, 3]
    assert rows[0]["dense"] == [1.0, 0.0, 0.0, 2.0]
    assert rows[0]["shifted"] == {5: 4.0, 3: 0.0}
    assert rows[1]["sum"] == {2: 1.0} and rows[1]["product"] == {}
    assert rows[2]["sum"] == {5: 1.0} and rows[2]["product"] == {}


def test_sparse_from_dense_and_pairs(spark):
    df = spark.createDataFrame([([0.0, -0.5, 0.2],)], "v array<float>")
    assert df.select(sparse.from_dense("v", above=0.3).alias("m")).first()["m"] == {1: -0.5}
    pairs = spark.createDataFrame([([4, 1], [1.0, 2.0])], "i array<int>, v array<double>")
    assert pairs.select(sparse.from_pairs("i", "v").alias("m")).first()["m"] == {4: 1.0, 1: 2.0}
