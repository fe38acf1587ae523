"""Class codes and names."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

# The ten image classes by code, and the name of any other code.
CLASS_NAMES = {
    0: "airplane",
    1: "automobile",
    2: "bird",
    3: "cat",
    4: "deer",
    5: "dog",
    6: "frog",
    7: "horse",
    8: "ship",
    9: "truck",
}
UNKNOWN_CLASS = "error"


def class_name(
    label: Column | str,
    names: dict[int, str] = CLASS_NAMES,
    default: str = UNKNOWN_CLASS,
) -> Column:
    """Name of a class code; unknown and null codes get ``default``."""
    label = F.col(label) if isinstance(label, str) else label
    table = F.create_map(*(F.lit(x) for x in chain.from_iterable(names.items())))
    return F.coalesce(F.element_at(table, label.cast("int")), F.lit(default))
