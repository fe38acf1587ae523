"""Files read in ranges, and what is computed from their parts."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gridloom.operators import extrema, gradient, networks, profile
from gridloom.operators.combine import aggregate_by_key
from gridloom.sources import binary

WIDTH = 12


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    path, rng = tmp_path_factory.mktemp("ranges"), np.random.default_rng(4)
    for i, n in enumerate((3000, 1, 0, 777)):
        block = rng.integers(0, 256, (n, WIDTH + 1)).astype(np.uint8)
        block[:, 0] %= 10
        block.tofile(path / f"b{i}.bin")
    return path


def shown(df):
    return df._jdf.queryExecution().toString()


def hexed(df):
    return df.withColumn("pixels", F.hex("pixels"))


@pytest.mark.parametrize("split_bytes", [None, 1, 1000, 20_000])
@pytest.mark.parametrize("shift", [False, True])
def test_ranges_give_the_rows_of_whole_files(spark, folder, split_bytes, shift):
    whole = hexed(binary.split_records(binary.scan_files(spark, str(folder)), WIDTH + 1, signed_shift=shift))
    if split_bytes == 1:  # one record per block
        whole = whole.where(F.col("path").endswith("b3.bin"))
    paths = str(folder / "b3.bin") if split_bytes == 1 else str(folder)
    ranges = binary.read_record_ranges(spark, paths, WIDTH + 1, signed_shift=shift, split_bytes=split_bytes)
    other = hexed(ranges)
    assert other.count() == whole.count() == (777 if split_bytes == 1 else 3778)
    assert whole.exceptAll(other).isEmpty() and other.exceptAll(whole).isEmpty()
    if split_bytes == 1000:
        assert ranges.rdd.getNumPartitions() > 40
    if not shift:  # no row leaves the JVM
        assert "Python" not in shown(ranges) and "InArrow" not in shown(ranges)


@pytest.mark.parametrize("small_file", [1 << 23, 1000])
def test_both_ways_of_reading_treat_trailing_bytes_alike(spark, tmp_path, monkeypatch, small_file):
    monkeypatch.setattr(binary, "SMALL_FILE", small_file)
    rng = np.random.default_rng(5)
    contents = {f"f{i}.bin": rng.integers(0, 256, n).astype(np.uint8).tobytes() for i, n in enumerate((13 * 200, 13 * 300 + 5, 4))}
    for name, content in contents.items():
        (tmp_path / name).write_bytes(content)
    for pixels in ("binary", "array", "none"):
        rows = binary.read_records(spark, str(tmp_path), 13, on_partial="drop", pixels=pixels).collect()
        assert len(rows) == 500
        for r in rows:
            own = contents[r["path"].rsplit("/", 1)[1]][r["rec"] * 13 : (r["rec"] + 1) * 13]
            assert r["label"] == own[0]
            assert pixels == "none" or bytes(r["pixels"]) == own[1:]
    with pytest.raises(Exception, match="5 bytes after 300 records|4 bytes after 0 records"):
        binary.read_records(spark, str(tmp_path), 13).count()
    with pytest.raises(ValueError):
        binary.read_record_ranges(spark, str(tmp_path), 13, on_partial="skip")
    used = shown(binary.read_records(spark, str(tmp_path / "f0.bin"), 13))
    assert ("SerializeFromObject" in used) == (small_file == 1000)


def test_only_partial_files(spark, tmp_path):
    (tmp_path / "a.bin").write_bytes(bytes(30))
    assert binary.read_record_ranges(spark, str(tmp_path), 13, on_partial="drop").count() == 2


# --- extrema -------------------------------------------------------------------


def follow(files, initial):
    """``{col: (max, min, ups, downs)}`` by a loop over every file."""
    out = {}
    for block in files:
        for col in range(block.shape[1]):
            values = block[:, col].tolist()
            top = low = values[0] if initial is None else initial
            ups = downs = 0
            for v in values:
                if v > top:
                    top, ups = v, ups + 1
                if v < low:
                    low, downs = v, downs + 1
            held = out.get(col, (top, low, 0, 0))
            out[col] = (max(held[0], top), min(held[1], low), held[2] + ups, held[3] + downs)
    return out


def found(columns):
    return {r["col"]: (r["max"], r["min"], r["max_changed"], r["min_changed"]) for r in columns.collect()}


@pytest.mark.parametrize("initial", [None, 0.0, 100.0])
@pytest.mark.parametrize("split_bytes", [None, 13 * 7, 5000])
def test_extrema_are_equal_for_every_split(spark, folder, monkeypatch, initial, split_bytes):
    monkeypatch.setattr(extrema, "SPAN_RECORDS", 50)  # stretches are joined in two rounds
    blocks = [np.fromfile(folder / f"b{i}.bin", np.uint8).reshape(-1, WIDTH + 1)[:, 1:] for i in (0, 1, 3)]
    records = binary.read_record_ranges(spark, str(folder), WIDTH + 1, split_bytes=split_bytes)
    assert found(extrema.column_extrema(records, initial=initial)) == follow(blocks, initial)


def test_extrema_of_tables_in_any_order(spark):
    rng = np.random.default_rng(6)
    files = [rng.normal(size=(n, 4)).round(1).astype(np.float32).cumsum(axis=0, dtype=np.float32).round(1) for n in (60, 1, 33)]
    rows = [(None if f == 1 else f, i, v.tolist()) for f, block in enumerate(files) for i, v in enumerate(block)]
    order = rng.permutation(len(rows))
    df = spark.createDataFrame([rows[i] for i in order], "path int, rec int, pixels array<float>").repartition(5)
    wanted = follow(files, 0.0)
    got = found(extrema.column_extrema(df, initial=0.0))
    assert {c: (v[2], v[3]) for c, v in got.items()} == {c: (v[2], v[3]) for c, v in wanted.items()}
    assert all(np.allclose(got[c][:2], wanted[c][:2]) for c in wanted)
    counts = {r["col"]: (r["max_changed"], r["min_changed"]) for r in profile.change_counts(df).collect()}
    assert counts == {c: v[2:] for c, v in got.items()}
    for bad in ([(0, 0, [1.0]), (0, 1, None)], [(0, 0, [1.0]), (0, 1, [1.0, 2.0])], [(0, 0, [1.0, None])]):
        with pytest.raises(Exception, match="null|widths"):
            extrema.column_extrema(spark.createDataFrame(bad, df.schema).coalesce(1)).collect()
    assert extrema.column_extrema(df.limit(0)).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 9), min_size=1, max_size=6), min_size=1, max_size=6))
def test_staircases_of_parts_make_the_staircase_of_the_whole(parts):
    def stairs(values):
        out = []
        for v in values:
            if not out or v > out[-1]:
                out.append(v)
        return out

    joined = []
    for part in parts:
        joined += [v for v in stairs(part) if not joined or v > joined[-1]]
    assert joined == stairs([v for part in parts for v in part])


# --- statistics ------------------------------------------------------------------


def test_statistics_of_files(spark, folder):
    records = binary.read_record_ranges(spark, str(folder), WIDTH + 1, split_bytes=4000)
    block = np.concatenate([np.fromfile(folder / f"b{i}.bin", np.uint8).reshape(-1, WIDTH + 1)[:, 1:] for i in (0, 1, 3)])
    rows = sorted(map(tuple, profile.column_statistics(records).collect()))
    assert [r[:2] for r in rows] == [(c, len(block)) for c in range(WIDTH)]
    assert np.allclose([r[2] for r in rows], block.mean(axis=0))
    assert np.allclose([r[3] / len(block) for r in rows], block.var(axis=0))
    assert [r[4:] for r in rows] == list(zip(block.min(axis=0), block.max(axis=0)))
    plan = shown(profile.column_moments(records))
    assert "Generate posexplode(slice" in plan and plan.count("Generate") <= 3 * plan.count("posexplode(slice")


def test_statistics_of_ragged_rows(spark, monkeypatch):
    monkeypatch.setattr(profile, "STATISTICS_CHUNK", 2)
    nan = float("nan")
    rows = [([1.0, 2.0, nan],), ([3.0],), (None,), ([],), ([5.0, None, 4.0, None],), ([nan, 7.0],)] * 3
    df = spark.createDataFrame(rows, "pixels array<double>").repartition(4)
    got = {r["col"]: r for r in profile.column_range(df).collect()}
    plain = df.select(F.posexplode("pixels").alias("col", "v")).groupBy("col").agg(
        F.max("v").alias("max"), F.min("v").alias("min"), F.count("v").alias("n"))
    for r in plain.collect():
        assert repr((r["max"], r["min"], r["n"])) == repr(tuple(got[r["col"]][k] for k in ("max", "min", "n")))
    assert len(got) == 4
    means = {r["col"]: (r["mean"], r["std"]) for r in profile.column_moments(df).collect()}
    assert means[1] == pytest.approx((4.5, 2.5)) and means[3] == (None, None) and np.isnan(means[0][0])


def test_moments_far_from_zero(spark):
    values = 1e9 + np.random.default_rng(7).normal(size=(500, 3))
    df = spark.createDataFrame([(v.tolist(),) for v in values], "pixels array<double>").repartition(7)
    got = sorted((r["col"], r["std"]) for r in profile.column_moments(df).collect())
    assert np.allclose([s for _, s in got], values.std(axis=0), rtol=1e-6)


def test_statistics_of_types_beyond_doubles(spark):
    df = spark.createDataFrame([([2**53 + 1, 1],), ([2**53, 2],)], "pixels array<long>")
    got = {r["col"]: (r["max"], r["min"]) for r in profile.column_range(df).collect()}
    assert got == {0: (2**53 + 1, 2**53), 1: (2, 1)}


# --- aggregates of one's own -----------------------------------------------------


def spread(df, **options):
    """Widest gap between neighbouring values, from sets that are merged."""
    return aggregate_by_key(
        df, ["k", "l"], ["v"],
        create=lambda columns: sorted(set(columns["v"].drop_null().to_pylist())),
        merge=lambda a, b: sorted({*a, *b}),
        finish=lambda held: max((b - a for a, b in zip(held, held[1:])), default=None),
        state="array<long>", result="long", **options)


@pytest.mark.parametrize("salts, held_keys", [(1, 100_000), (4, 100_000), (4, 2)])
def test_an_aggregate_of_ones_own(spark, salts, held_keys):
    rng = np.random.default_rng(8)
    rows = [(0 if rng.random() < 0.6 else int(rng.integers(1, 9)), rng.choice(["a", None]), int(v)) for v in rng.integers(0, 5000, 2000)]
    rows += [(None, "a", 5), (None, "a", 9), (99, "a", None)]
    df = spark.createDataFrame(rows, "k int, l string, v long").repartition(6)
    wanted = {}
    for k, name, v in rows:
        wanted.setdefault((k, name), set()).update([] if v is None else [v])
    got = {(r["k"], r["l"]): r["result"] for r in spread(df, salts=salts, held_keys=held_keys).collect()}
    gap = lambda held: max((b - a for a, b in zip(held, held[1:])), default=None)
    assert got == {key: gap(sorted(held)) for key, held in wanted.items()}
    assert spread(df.limit(0)).count() == 0


def test_states_are_combined_before_the_shuffle(spark):
    df = spark.createDataFrame([(1, None, 1)] * 1000, "k int, l string, v long").repartition(5)
    first = spread(df)._jdf.queryExecution().optimizedPlan().toString()
    assert first.count("MapInArrow") == 3 and first.count("RepartitionByExpression [k") == 2


# --- gradients -------------------------------------------------------------------


def test_a_gradient_keeps_the_partitions_of_its_data(spark):
    df = spark.range(400).select(F.array(*(F.rand(i) for i in range(3))).alias("features"), (F.col("id") % 4).cast("int").alias("label"))
    df = df.repartition(37).cache()
    model, grad = networks.softmax_model(3, 4), networks.softmax_gradient()
    seen = spark.sparkContext.accumulator(0)

    def counting(batch, params):
        seen.add(1)
        return grad(batch, params)

    many = gradient.loss_and_gradient(df, model, counting)
    assert seen.value == 37
    few = gradient.loss_and_gradient(df, model, grad, tasks=2)
    assert many[0] == pytest.approx(few[0]) and np.allclose(many[1]["w"], few[1]["w"]) and many[2] == few[2] == 400
    df.unpersist()
