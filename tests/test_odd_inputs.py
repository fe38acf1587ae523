"""Inputs that used to give wrong answers without an error."""

import csv

import numpy as np
import pyarrow as pa
import pytest

from gridloom.operators import gradient, networks, profile
from gridloom.sources.text import csv_fields

LINES = ['"abc"def,x', '"abc,def', 'a,"b ""c"" d",e', "", "a,,b,", '"a""b', '"",""', 'x"y,z', '"a"b"c,d']


def test_csv_fields_lose_no_text(spark):
    frame = spark.createDataFrame([(line,) for line in LINES], "line string")
    got = {r["line"]: r["f"] for r in frame.select("line", csv_fields("line").alias("f")).collect()}
    for line in LINES:
        assert got[line] == (next(csv.reader([line]), None) or [""]), line


@pytest.mark.parametrize("rows", [[[1.0, 2.0, 3.0], [4.0]], [[1.0, 2.0], None], [[1.0, None], [1.0, 2.0]]])
def test_uneven_or_null_rows_raise(rows):
    with pytest.raises(ValueError):
        gradient._column_values(pa.array(rows))


def test_labels_outside_the_classes_raise():
    for label in (-1, 3):
        with pytest.raises(ValueError):
            networks._loss_and_error(np.zeros((1, 3)), np.array([label]))


def test_changes_of_a_null_file_count(spark):
    rows = [(None, 0, [1.0]), (None, 1, [3.0]), ("f", 0, [1.0]), ("f", 1, [3.0])]
    frame = spark.createDataFrame(rows, "path string, rec long, pixels array<double>")
    for path in (None, "f"):
        own = frame.where(frame["path"].eqNullSafe(path))
        got = profile.change_counts(own).collect()
        assert [r["max_changed"] for r in got] == [2]
