import gzip

import numpy as np
import pytest
from pyspark import StorageLevel
from pyspark.sql import functions as F

from gridloom import session
from gridloom.operators.profile import class_counts
from gridloom.plans import flows
from gridloom.sinks import files
from gridloom.sources.binary import read_records


@pytest.fixture
def image_dir(tmp_path):
    folder = tmp_path / "images"
    folder.mkdir()
    rng = np.random.default_rng(9)
    for i in range(3):
        block = rng.integers(0, 256, (30, 13), dtype=np.uint8)
        block[:, 0] = np.arange(30) % 10
        block.tofile(folder / f"{i}.bin")
    return str(folder)


def test_csv_with_gzip(spark, tmp_path):
    out = str(tmp_path / "out")
    files.write_csv(spark.range(3).coalesce(1), out, compress=True)
    (part,) = (tmp_path / "out").glob("*.csv.gz")
    assert gzip.open(part, "rt").read().split() == ["id", "0", "1", "2"]
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        files.write_csv(spark.range(3), out)


def test_report_is_one_sorted_file(spark, tmp_path):
    df = spark.createDataFrame([(f"k{i:02d}", i) for i in range(40)], "k string, v int").repartition(6)
    files.write_report(df, str(tmp_path / "out"), ["k"])
    (part,) = (tmp_path / "out").glob("part-*")
    assert part.read_text().splitlines() == [f"k{i:02d}\t{i}" for i in range(40)]


@pytest.mark.parametrize("single", [False, True])
def test_one_folder_per_class(spark, tmp_path, image_dir, single):
    records = read_records(spark, image_dir, 13)
    out = tmp_path / "classes"
    files.write_by_class(records, str(out), one_file_per_class=single)
    folders = sorted(p.name for p in out.iterdir() if p.is_dir())
    assert folders == [f"label={i}" for i in range(10)]
    assert all(len(list((out / f).glob("*.parquet"))) == 1 for f in folders)
    one = spark.read.parquet(str(out)).where("label = 3")
    assert "PartitionFilters: [isnotnull(label" in one._jdf.queryExecution().executedPlan().toString()
    assert one.count() == 9


def test_binary_to_csv_to_features(spark, tmp_path, image_dir):
    out = str(tmp_path / "csv")
    assert flows.convert_to_csv(spark, image_dir, out, 13).first()["n"] == 90
    with pytest.raises(Exception, match="bad row: label"):
        flows.convert_to_csv(spark, image_dir, f"{out}-strict", 13, classes=5)
    lines = [line for p in (tmp_path / "csv").glob("part-*") for line in p.read_text().splitlines()]
    assert len(lines) == 90 and all(len(line.split(",")) == 13 for line in lines)
    from gridloom.sources.text import label_and_pixels, read_lines

    back = label_and_pixels(read_lines(spark, out))
    original = read_records(spark, image_dir, 13, pixels="array").select("label", "pixels")
    assert back.exceptAll(original).isEmpty() and original.exceptAll(back).isEmpty()


def test_normalise_files(spark, tmp_path, image_dir):
    out = str(tmp_path / "normal")
    flows.normalise_files(spark, image_dir, out, 13, signed_shift=True)
    shifted = read_records(spark, image_dir, 13, pixels="array", signed_shift=True)
    both = spark.read.parquet(out).withColumnRenamed("pixels", "z").join(shifted, ["path", "rec"])
    worst = both.select(
        F.array_max(F.zip_with("z", "pixels", lambda z, p: F.abs(z - p / 255.0))).alias("d")
    ).agg(F.max("d"), F.count("*")).first()
    assert worst[0] < 1e-6 and worst[1] == 90


def test_profiles_of_files(spark, tmp_path, image_dir):
    sizes = flows.profile_file_sizes(spark, image_dir).collect()
    assert [r["status"] for r in sizes] == ["not ok"] * 3
    classes = flows.profile_classes(spark, image_dir, 13).collect()
    assert [r["n"] for r in classes] == [9] * 10
    columns = flows.profile_columns(spark, image_dir, 13).collect()
    assert [r["col"] for r in columns] == list(range(12))


def test_values_of_text_files(spark, tmp_path):
    (tmp_path / "a.csv").write_text("1,5,5\n1,5,7\n")
    assert tuple(flows.most_frequent_value(spark, str(tmp_path)).first()) == ("5", 3)
    assert tuple(flows.least_frequent_value(spark, str(tmp_path)).first()) == ("7", 1)
    without_label = flows.least_frequent_value(spark, str(tmp_path), skip_first=True)
    assert tuple(without_label.first()) == ("7", 1)


def test_paths(spark):
    assert session.resolve_path("a/b.csv", "hdfs://host/user/me/") == "hdfs://host/user/me/a/b.csv"
    assert session.resolve_path("/a/b.csv", "hdfs://host") == "/a/b.csv"
    assert session.resolve_path("s3://x/y", "hdfs://host") == "s3://x/y"
    assert session.resolve_path("a") == "a"


def test_persist(spark):
    df = session.persist(spark.range(5), eager=True)
    assert df.storageLevel == StorageLevel.MEMORY_AND_DISK_2
    df.unpersist()


def test_session_factory_reuses_the_session(spark):
    assert session.start_session(verbose_logging="ERROR") is not None
    assert session.elapsed_since(0.0).endswith("s")


def test_work_folder(spark, tmp_path):
    folder = session.new_work_folder(spark, "x")
    assert folder.startswith(spark.conf.get("spark.checkpoint.dir"))
    table = session.materialise(spark.range(4), "x", folder=folder)
    assert table.count() == 4
    session.remove_work_folder(spark, folder)
    with pytest.raises(Exception):
        spark.read.parquet(folder)
    for other in (str(tmp_path), f"{folder}/../../elsewhere"):
        with pytest.raises(ValueError):
            session.remove_work_folder(spark, other)


def test_class_counts_are_combined_before_the_shuffle(spark, image_dir):
    plan = class_counts(read_records(spark, image_dir, 13))._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan
