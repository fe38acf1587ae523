import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gridloom.functions import texts
from gridloom.operators import profile, validate
from gridloom.sources import binary


def follow(files, initial=0.0):
    """Change counts by a loop: {col: [ups, downs]}."""
    out = {}
    for rows in files.values():
        tops, lows = {}, {}
        for _, values in sorted(rows, key=lambda r: r[0]):
            for col, v in enumerate(values or []):
                if v is None:
                    continue
                moved = out.setdefault(col, [0, 0])
                if v > tops.get(col, initial):
                    tops[col] = v
                    moved[0] += 1
                if v < lows.get(col, initial):
                    lows[col] = v
                    moved[1] += 1
    return out


def counted(df, **options):
    return {
        r["col"]: [r["max_changed"], r["min_changed"]]
        for r in profile.change_counts(df, **options).collect()
    }


@pytest.mark.parametrize("segment", [1, 7, 65536])
@pytest.mark.parametrize("kind", ["int", "double"])
def test_change_counts_match_a_loop(spark, kind, segment):
    rng = np.random.default_rng(segment)
    files = {}
    for f in ("a", "b", "c"):
        values = rng.integers(-20, 20, (60, 5)) if kind == "int" else rng.normal(size=(60, 5))
        files[f] = list(enumerate(values.tolist()))
    rows = [(f, i, v) for f, records in files.items() for i, v in records]
    df = spark.createDataFrame(rows, f"path string, rec int, pixels array<{kind}>").repartition(5)
    assert counted(df, segment=segment) == follow(files)


def test_change_counts_of_ragged_rows_with_nulls(spark):
    files = {"a": [(0, [1, None, 3]), (1, [2, 5]), (2, None), (3, []), (4, [9, -1, None])]}
    rows = [("a", i, v) for i, v in files["a"]]
    df = spark.createDataFrame(rows, "path string, rec int, pixels array<int>").coalesce(1)
    assert counted(df) == follow(files)


@pytest.mark.parametrize("width", [2, 3])
def test_change_counts_skip_nan(spark, width):
    nan = float("nan")
    values = [[nan, 1.0], [2.0, nan], [1.0, 3.0], [nan, nan], [4.0, -1.0]]
    rows = [("a", i, v + [5.0] * (width - 2 if i else 0)) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "path string, rec int, pixels array<double>").coalesce(1)
    assert counted(df) == follow({"a": [(i, v) for _, i, v in rows]})


def test_change_counts_of_long_files_in_mixed_batches(spark):
    rng = np.random.default_rng(5)
    files = {f: list(enumerate(rng.normal(size=(900, 3)).cumsum(axis=0).tolist())) for f in "ab"}
    rows = [(f, i, v) for f, records in files.items() for i, v in records]
    rng.shuffle(rows)
    rows = [(f, int(i), v) for f, i, v in rows]
    df = spark.createDataFrame(rows, "path string, rec int, pixels array<double>").coalesce(1)
    assert counted(df) == follow(files)


def test_change_counts_start_elsewhere(spark):
    files = {"a": list(enumerate([[5], [11], [12], [3]]))}
    rows = [("a", i, v) for i, v in files["a"]]
    df = spark.createDataFrame(rows, "path string, rec int, pixels array<int>")
    assert counted(df, initial=10.0) == follow(files, 10.0)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.integers(-5, 5), min_size=2, max_size=2), min_size=1, max_size=40))
def test_change_counts_property(spark, values):
    files = {"f": list(enumerate(values))}
    rows = [("f", i, v) for i, v in files["f"]]
    df = spark.createDataFrame(rows, "path string, rec int, pixels array<int>").repartition(3)
    assert counted(df, segment=4) == follow(files)


@pytest.mark.parametrize("shift", [False, True])
def test_file_profile_matches_a_loop_and_the_general_form(spark, tmp_path, shift):
    rng = np.random.default_rng(8)
    blocks = [rng.integers(0, 256, (40, 7), dtype=np.uint8) for _ in range(4)]
    for i, block in enumerate(blocks):
        block.tofile(tmp_path / f"{i}.bin")
    seen = [(b[:, 1:] ^ 128) if shift else b[:, 1:] for b in blocks]
    expected = follow({i: list(enumerate(b.tolist())) for i, b in enumerate(seen)})
    top = np.max([b.max(axis=0) for b in seen], axis=0)
    files = binary.scan_files(spark, str(tmp_path))
    rows = profile.file_column_profile(files, 7, signed_shift=shift).orderBy("col").collect()
    assert [r["max"] for r in rows] == top.tolist()
    assert {r["min"] for r in rows} == {0.0}
    assert {r["col"]: [r["max_changed"], r["min_changed"]] for r in rows} == expected
    assert rows[3]["name"] == "Col 0003"
    records = binary.split_records(files, 7, pixels="array", signed_shift=shift)
    assert counted(records) == expected


def test_column_range_with_and_without_start(spark):
    df = spark.createDataFrame(
        [([5, -9, 0],), ([7, -3, 0],)], "pixels array<int>"
    )
    plain = [(r["max"], r["min"]) for r in profile.column_range(df).orderBy("col").collect()]
    assert plain == [(7, 5), (-3, -9), (0, 0)]
    zero = profile.column_range(df, initial=0.0).orderBy("col").collect()
    assert [(r["max"], r["min"]) for r in zero] == [(7.0, 0.0), (0.0, -9.0), (0.0, 0.0)]


def test_column_range_of_ragged_rows(spark):
    df = spark.createDataFrame([([1, 2],), ([3],), (None,)], "pixels array<int>")
    assert [(r["col"], r["max"], r["n"]) for r in profile.column_range(df).orderBy("col").collect()] == [
        (0, 3, 2), (1, 2, 1),
    ]


TEXTS = ["Don't stop, DON'T", "Été à la mer", "9 9 10 10", "", "a_b-c 数字 ٣ ½", "x" * 50000 + " tail"]


def test_tokens_match_python_regex(spark):
    df = spark.createDataFrame([(t,) for t in TEXTS], "value string")
    expected = Counter(w.lower() for t in TEXTS for w in re.findall(r"[\w']+", t))
    got = {r["token"]: r["n"] for r in profile.token_counts(df).collect()}
    assert got == dict(expected)


def test_ties_fall_to_the_larger_or_smaller_text(spark):
    df = spark.createDataFrame([("9 9 10 10 8",)], "value string")
    counts = profile.token_counts(df)
    assert tuple(profile.most_frequent(counts).first()) == ("9", 2)
    tied = profile.token_counts(spark.createDataFrame([("9 10",)], "value string"))
    assert tuple(profile.least_frequent(tied).first()) == ("10", 1)
    assert [tuple(r) for r in profile.top_tokens(counts, 2).collect()] == [("9", 2), ("10", 2)]


def test_extremes_of_nothing(spark):
    counts = profile.token_counts(spark.createDataFrame([("",)], "value string"))
    assert profile.most_frequent(counts).count() == 0


def test_skip_first_leaves_out_the_label(spark):
    df = spark.createDataFrame([("7,1,1,2",), ("7,2",), ("",)], "value string")
    got = {r["token"]: r["n"] for r in profile.token_counts(df, skip_first=True).collect()}
    assert got == {"1": 2, "2": 2}


def test_distinct_count_takes_null_as_a_value(spark):
    df = spark.createDataFrame([(1,), (1,), (None,), (2,)], "x int")
    assert profile.nunique(df, "x") == 3
    assert profile.count_distinct_values(df, "x").first()["n"] == 3
    assert {r.x for r in profile.distinct_values(df, "x").collect()} == {1, 2, None}


def test_class_count_check(spark):
    counts = spark.createDataFrame([("cat", 5), ("dog", 4), ("error", 1)], "class_name string, n long")
    rows = {
        r["class_name"]: (r["actual"], r["expected"], r["ok"])
        for r in validate.check_class_counts(counts, 5, ["cat", "dog", "ship"]).collect()
    }
    assert rows == {
        "cat": (5, 5, True), "dog": (4, 5, False), "ship": (0, 5, False), "error": (1, None, False),
    }
    all_five = validate.check_class_counts(counts, 5).where("ok").collect()
    assert [r["class_name"] for r in all_five] == ["cat"]


def test_file_sizes(spark, tmp_path):
    (tmp_path / "b.bin").write_bytes(bytes(11))
    (tmp_path / "a.bin").write_bytes(bytes(10))
    files = binary.scan_files(spark, str(tmp_path))
    rows = validate.file_size_report(files, 10).orderBy("ordinal").collect()
    assert [(r["ordinal"], r["path"][-5:], r["status"], r["length"]) for r in rows] == [
        (0, "a.bin", "ok", 10), (1, "b.bin", "not ok", 11),
    ]


def test_row_shape(spark):
    df = spark.createDataFrame(
        [([1, 2], 0), ([1], 9), ([1, 2], 10), (None, None)], "v array<int>, label int"
    )
    bad = validate.row_shape_violations(df, "v", "label", width=2)
    assert sorted((r["label"] or -1, r["faults"]) for r in bad.collect()) == [
        (-1, ["width", "label"]), (9, ["width"]), (10, ["label"]),
    ]
    good = df.where("label = 0")
    assert validate.require_row_shape(good, "v", "label", width=2).count() == 1
    with pytest.raises(Exception, match="bad row: label"):
        validate.require_row_shape(df.where("label = 10"), "v", "label", width=2).collect()


def test_report_texts(spark):
    row = spark.range(1).select(
        texts.elapsed_text(F.lit(125.9)).alias("elapsed"),
        texts.empty_vector_text(F.lit(7)).alias("empty"),
        texts.column_name(F.lit(7)).alias("name"),
        texts.class_count_text(F.lit(12)).alias("report"),
        texts.training_text(
            F.lit(1), F.lit(640), F.lit(6400), F.lit(10.0), F.lit(0.1234567)
        ).alias("log"),
    ).first()
    assert row["elapsed"] == "2m 5s"
    assert row["empty"] == "(7,[],[])"
    assert row["name"] == "Col 0007"
    assert row["report"].startswith("Actual num images: 12    Correct")
    assert row["log"] == "Train Epoch: 1 [640/6400 (10%)]\tLoss: 0.123457"


def test_shape_faults_are_made_without_cutting_vectors(spark, monkeypatch):
    from gridloom.plans import profiling_queries

    seen = []
    check = validate.row_shape_violations
    monkeypatch.setattr(validate, "row_shape_violations", lambda df, *a, **b: seen.append(df) or check(df, *a, **b))
    faulty = profiling_queries.row_shape_violations(spark, "/root/testdata/sf0.001")
    vectors = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").select("vec_id", "embedding")
    whole = seen[0].join(vectors, "vec_id").where(F.slice("values", 1, F.size("embedding")) == F.col("embedding"))
    assert whole.count() == vectors.count()
    assert not faulty.where("faults LIKE '%width%'").isEmpty()
