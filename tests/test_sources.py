import csv
import io
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridloom.functions.labels import class_name
from gridloom.operators.profile import class_counts
from gridloom.sources import binary, text


def write_records(path, labels, pixels):
    block = np.column_stack([np.asarray(labels, np.uint8), np.asarray(pixels, np.uint8)])
    block.tofile(path)
    return block


def test_decode_is_the_inverse_of_encode(spark, tmp_path):
    rng = np.random.default_rng(3)
    for i in range(3):
        write_records(tmp_path / f"b{i}.bin", rng.integers(0, 10, 50), rng.integers(0, 256, (50, 12)))
    files = {p.name: p.read_bytes() for p in tmp_path.iterdir()}
    rows = binary.read_records(spark, str(tmp_path), 13).collect()
    assert len(rows) == 150
    back = {name: {} for name in files}
    for r in rows:
        back[r["path"].rsplit("/", 1)[1]][r["rec"]] = bytes([r["label"]]) + bytes(r["pixels"])
    for name, content in files.items():
        assert b"".join(back[name][i] for i in range(50)) == content


def test_unsigned_and_shifted_pixels(spark, tmp_path):
    write_records(tmp_path / "a.bin", [1], [[0, 127, 128, 255]])
    plain = binary.read_records(spark, str(tmp_path), 5, pixels="array").first()
    shifted = binary.read_records(spark, str(tmp_path), 5, pixels="array", signed_shift=True).first()
    assert plain["pixels"] == [0, 127, 128, 255]
    assert shifted["pixels"] == [128, 255, 0, 127]


def test_labels_outside_the_classes_become_error(spark, tmp_path):
    write_records(tmp_path / "a.bin", [0, 9, 10, 255], np.zeros((4, 4)))
    records = binary.read_records(spark, str(tmp_path), 5)
    names = [r[0] for r in records.orderBy("rec").select(class_name("label")).collect()]
    assert names == ["airplane", "truck", "error", "error"]
    counts = {r["class_name"]: r["n"] for r in class_counts(records).collect()}
    assert counts == {"airplane": 1, "truck": 1, "error": 2}


def test_trailing_bytes(spark, tmp_path):
    (tmp_path / "short.bin").write_bytes(bytes(14))
    with pytest.raises(Exception, match="4 bytes after 2 records"):
        binary.read_records(spark, str(tmp_path), 5).count()
    assert binary.read_records(spark, str(tmp_path), 5, on_partial="drop").count() == 2
    with pytest.raises(ValueError):
        binary.split_records(binary.scan_files(spark, str(tmp_path)), 5, on_partial="skip")


def test_empty_file(spark, tmp_path):
    (tmp_path / "empty.bin").write_bytes(b"")
    write_records(tmp_path / "one.bin", [3], [[1, 2, 3, 4]])
    assert binary.read_records(spark, str(tmp_path), 5).count() == 1


def test_size_scan_reads_no_content(spark, tmp_path):
    (tmp_path / "a.bin").write_bytes(bytes(10))
    plan = binary.scan_files(spark, str(tmp_path)).select("path", "length")
    shown = plan._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<path:string,length:bigint>" in shown


def test_scan_options(spark, tmp_path):
    (tmp_path / "deep").mkdir()
    for name in ("a.bin", "b.txt", "deep/c.bin"):
        (tmp_path / name).write_bytes(bytes(3))
    assert binary.scan_files(spark, str(tmp_path)).count() == 2
    found = binary.scan_files(spark, str(tmp_path), glob="*.bin", recursive=True)
    assert sorted(r["path"][-5:] for r in found.select("path").collect()) == ["a.bin", "c.bin"]


def test_train_and_test_sets(spark, tmp_path):
    for name, n in (("train", 3), ("test", 1)):
        (tmp_path / name).mkdir()
        write_records(tmp_path / name / "a.bin", [0] * n, np.zeros((n, 4)))
    both = binary.read_split(
        lambda p: binary.read_records(spark, p, 5),
        train=str(tmp_path / "train"), test=str(tmp_path / "test"),
    )
    assert {r["split"]: r["count"] for r in both.groupBy("split").count().collect()} == {
        "train": 3, "test": 1,
    }


def test_labelled_csv(spark, tmp_path):
    (tmp_path / "a.csv").write_text("3,0,255,51\n7,102,153,204\n")
    rows = text.read_labelled_csv(spark, str(tmp_path)).orderBy("label").collect()
    assert [r["label"] for r in rows] == [3.0, 7.0]
    assert rows[0]["features"].toArray().tolist() == [0.0, 1.0, 0.2]
    bad = tmp_path / "bad.csv"
    bad.write_text("3,x\n")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        text.read_labelled_csv(spark, str(bad)).collect()


def test_labelled_csv_fraction(spark, tmp_path):
    (tmp_path / "a.csv").write_text("".join(f"{i % 10},1,2\n" for i in range(2000)))
    half = text.read_labelled_csv(spark, str(tmp_path), 0.5)
    assert 800 < half.count() < 1200
    assert text.read_labelled_csv(spark, str(tmp_path)).count() == 2000


def test_header_csv_types(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,score,name\n1,2.5,x\n2,3.5,y\n")
    df = text.read_csv(spark, str(tmp_path))
    assert df.dtypes == [("id", "int"), ("score", "double"), ("name", "string")]
    assert text.read_csv(spark, str(tmp_path), schema="a string, b string, c string").count() == 2


def test_csv_fields_match_the_csv_module(spark):
    draw = random.Random(5)
    rows = [["", "a"], ["a"], ["x,y", 'he said "hi"', ""], ['""', ",", "end"]]
    rows += [
        ["".join(draw.choice('ab,"é ') for _ in range(draw.randint(0, 6))) for _ in range(draw.randint(1, 5))]
        for _ in range(200)
    ]
    lines = []
    for row in rows:
        out = io.StringIO()
        csv.writer(out, lineterminator="").writerow(row)
        lines.append(out.getvalue())
    df = spark.createDataFrame(list(enumerate(lines)), "i int, line string")
    got = {r["i"]: r["f"] for r in df.select("i", text.csv_fields("line").alias("f")).collect()}
    for i, line in enumerate(lines):
        assert got[i] == (next(csv.reader([line])) or [""])


def test_keyed_sample_does_not_depend_on_partitions(spark):
    df = spark.range(5000)
    a = text.sample_rows(df.repartition(3), 0.2, seed=9, key=["id"])
    b = text.sample_rows(df.repartition(17), 0.2, seed=9, key=["id"])
    assert {r.id for r in a.collect()} == {r.id for r in b.collect()}
    assert 850 < a.count() < 1150
    other = text.sample_rows(df, 0.2, seed=10, key=["id"])
    assert {r.id for r in other.collect()} != {r.id for r in a.collect()}


def test_concatenate_matches_columns_by_name(spark):
    a = spark.createDataFrame([(1, "x")], "n int, s string")
    b = spark.createDataFrame([("y", 2)], "s string, n int")
    assert sorted(map(tuple, text.concatenate([a, b]).collect())) == [(1, "x"), (2, "y")]
