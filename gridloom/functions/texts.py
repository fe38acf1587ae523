"""Tokens and report texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What counts as a token (letters, digits and underscore of any
# script, and the apostrophe) and the texts of the reports.
TOKEN_PATTERN = r"[\p{L}\p{N}_']+"
COLUMN_FORMAT = "Col %04d"
ELAPSED_FORMAT = "%dm %ds"
EMPTY_VECTOR_FORMAT = "(%d,[],[])"
TRAINING_FORMAT = "Train Epoch: %d [%d/%d (%.0f%%)]\tLoss: %.6f"
SCORE_FORMAT = "Test set: Average loss: %.4f, Accuracy: %d/%d (%.0f%%)"
CLASS_COUNT_FORMAT = (
    "Actual num images: %d    Correct num images: 5000 (training set), 1000 (test set)"
)


def tokens(text: Column | str, *, skip_first: bool = False) -> Column:
    """All tokens of a text as they are written; ``skip_first`` leaves out a
    leading label."""
    text = F.col(text) if isinstance(text, str) else text
    found = F.regexp_extract_all(text, F.lit(TOKEN_PATTERN), F.lit(0))
    if skip_first:
        found = F.slice(found, F.lit(2), F.greatest(F.size(found) - 1, F.lit(0)))
    return found


def column_name(position: Column | str) -> Column:
    """``Col 0007`` for position 7, so that text order is numeric order."""
    return F.format_string(COLUMN_FORMAT, position)


def elapsed_text(seconds: Column | str) -> Column:
    """``2m 5s`` for 125.9 seconds."""
    seconds = F.col(seconds) if isinstance(seconds, str) else seconds
    minutes = F.floor(seconds / 60).cast("long")
    return F.format_string(
        ELAPSED_FORMAT, minutes, F.floor(seconds - minutes * 60).cast("long")
    )


def empty_vector_text(size: Column | str) -> Column:
    """Text of a vector of the given size without entries."""
    return F.format_string(EMPTY_VECTOR_FORMAT, size)


def class_count_text(count: Column | str) -> Column:
    """Counted and expected images of a class in one line."""
    return F.format_string(CLASS_COUNT_FORMAT, count)


def training_text(
    epoch: Column | str, seen: Column | str, total: Column | str,
    percent: Column | str, loss: Column | str,
) -> Column:
    """One log line of a training run."""
    return F.format_string(TRAINING_FORMAT, epoch, seen, total, percent, loss)


def score_text(
    loss: Column | str, correct: Column | str, total: Column | str, accuracy: Column | str
) -> Column:
    """One line with the result of an evaluation."""
    return F.format_string(SCORE_FORMAT, loss, correct, total, accuracy)


def join_tabs(*values: Column | str) -> Column:
    """Values as one tab-separated text."""
    return F.concat_ws("\t", *(_as_text(v) for v in values))


def split_tabs(text: Column | str, types: list[str]) -> list[Column]:
    """Typed columns out of one tab-separated text."""
    parts = F.split(text, "\t")
    return [F.get(parts, F.lit(i)).cast(kind) for i, kind in enumerate(types)]


def _as_text(value: Column | str) -> Column:
    return (F.col(value) if isinstance(value, str) else value).cast("string")
