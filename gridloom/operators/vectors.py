"""Sparse vectors as tables ``(id, size, idx, value)``, one row per entry.

A row with a null ``idx`` is a vector's header: it carries no entry and says
that the vector exists, which an empty vector could not show otherwise. All
operators keep headers. Explicit zeros are entries like any other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.functions.texts import empty_vector_text
from gridloom.operators.index import BROADCAST_BYTES, ENTRY_BYTES, HOT_SHARE, join_around_hot_keys
from gridloom.operators.validate import require_vector_columns
from gridloom.session import materialise
from gridloom.sources.text import concatenate


def from_arrays(
    df: DataFrame, id_column: str, values: str, *, above: float = 0.0, headers: bool = False
) -> DataFrame:
    """Entries of dense arrays whose magnitude exceeds ``above``."""
    rows = df.select(
        F.col(id_column).alias("id"), F.size(values).alias("size"), F.col(values).alias("v")
    )
    entries = rows.select("id", "size", F.posexplode("v").alias("idx", "value")).select(
        "id", "size", "idx", F.col("value").cast("double").alias("value")
    )
    entries = entries.where(F.abs("value") > above)
    return with_headers(entries, rows.select("id", "size")) if headers else entries


def with_headers(entries: DataFrame, vectors: DataFrame) -> DataFrame:
    """Entries plus one header row per ``(id, size)`` row of ``vectors``."""
    return entries.unionByName(
        vectors.select(
            "id", "size",
            F.lit(None).cast("int").alias("idx"), F.lit(None).cast("double").alias("value"),
        )
    )


def add(a: DataFrame, b: DataFrame, *, strict: bool = True) -> DataFrame:
    """Entry-wise sum over the union of the indices.

    One aggregation over both tables, summed in each task first; a vector on
    one side only is added to an empty one. With ``strict`` vectors of
    different sizes stop the job that evaluates the result.
    """
    return _by_entry(a, b, strict).select(
        "id", "size", "idx", F.coalesce(F.col("x") + F.col("y"), "x", "y").alias("value")
    )


def multiply(a: DataFrame, b: DataFrame, *, strict: bool = True) -> DataFrame:
    """Entry-wise product over the intersection of the indices.

    An aggregation like :func:`add`, by vector and index, so a vector with many
    entries spreads.
    """
    both = _by_entry(a, b, strict).where((F.col("in_a") > 0) & (F.col("in_b") > 0))
    return both.select("id", "size", "idx", (F.col("x") * F.col("y")).alias("value"))


def _by_entry(a: DataFrame, b: DataFrame, strict: bool) -> DataFrame:
    """``(id, size, idx, x, y, in_a, in_b)``: values of either side per entry.

    Where sizes are looked after, every task also sends one row per vector with
    the least and largest size it met; a vector whose two differ raises where
    the others are let through. That happens inside the one aggregation: the
    tables are read once and no job runs before the result is asked for.
    """
    for side in (a, b):
        require_vector_columns(side)
    columns = ("id", "size", "idx", "value")
    both = a.select(*columns, F.lit(True).alias("left")).unionByName(b.select(*columns, F.lit(False).alias("left")))
    on_left = F.col("left")
    measures = [
        F.max("size").alias("size"), F.min("size").alias("least"),
        F.sum(F.when(on_left, F.col("value"))).alias("x"), F.sum(F.when(~on_left, F.col("value"))).alias("y"),
        F.count_if(on_left).alias("in_a"), F.count_if(~on_left).alias("in_b"),
    ]
    if not strict:
        return both.groupBy("id", "idx").agg(*measures).drop("least")
    rows = both.groupingSets([["id", "idx"], ["id"]], "id", "idx").agg(*measures, F.grouping_id().alias("level"))
    differ = F.concat(F.lit("vectors are not of the same size: "), F.col("id").cast("string"))
    fits = F.when(F.col("level") == 0, F.lit(True)).when(
        F.col("least") != F.col("size"), F.raise_error(differ).cast("boolean")
    ).otherwise(F.lit(False))
    return rows.where(fits).drop("least", "level")


def shift(v: DataFrame, offset: int, size: int) -> DataFrame:
    """Indices moved up by ``offset`` in vectors of the new ``size``."""
    return v.select(
        "id", F.lit(size).alias("size"), (F.col("idx") + offset).alias("idx"), "value"
    )


def scale_by(v: DataFrame, factor: float) -> DataFrame:
    """Every entry times a number."""
    return v.withColumn("value", F.col("value") * factor)


def part_offsets(sizes: list[int]) -> list[int]:
    """Where each part starts when parts of these sizes follow each other."""
    return [sum(sizes[:i]) for i in range(len(sizes))]


def concat(parts: list[DataFrame], sizes: list[int] | None = None) -> DataFrame:
    """Vectors of equal id laid end to end.

    With ``sizes`` (one per part) the offsets are constants and no entry is
    shuffled. Without, a part's size is looked up for each id, so sizes may
    differ between ids; an id absent from a part has size 0 there. The starts
    of all parts are one row per id, written out when the plan is built. Few
    ids are broadcast; of many, entries of hot ids are joined in place and the
    others shuffled once.
    """
    if sizes is not None:
        total = sum(sizes)
        return _one_header(
            concatenate(
                [shift(p, off, total) for p, off in zip(parts, part_offsets(sizes), strict=True)]
            )
        )
    tagged = concatenate(
        [p.select("id", "size", "idx", "value").withColumn("part", F.lit(i)) for i, p in enumerate(parts)]
    )
    placed = materialise(_placed_ids(tagged, len(parts)), "offsets")
    size = placed.agg(F.count("*").alias("ids"), F.coalesce(F.sum("rows"), F.lit(0)).alias("rows")).first()
    unique = placed.drop("rows")
    if size["ids"] * (ENTRY_BYTES + 4 * len(parts)) <= BROADCAST_BYTES:
        moved = tagged.drop("size").join(F.broadcast(unique), "id")
    else:
        hot = placed.where(F.col("rows") > F.lit(HOT_SHARE * size["rows"])).drop("rows")
        moved = join_around_hot_keys(tagged.drop("size"), unique, hot, "id")
    # A vector's header stays where its first part has one.
    kept = F.col("idx").isNotNull() | (F.col("part") == F.col("header"))
    return moved.where(kept).select(
        "id", F.element_at("starts", -1).alias("size"),
        (F.col("idx") + F.get("starts", F.col("part"))).alias("idx"), "value",
    )


def _one_header(v: DataFrame) -> DataFrame:
    """The entries, and each header once."""
    headers = v.where(F.col("idx").isNull()).distinct()
    return v.where(F.col("idx").isNotNull()).unionByName(headers)


def _placed_ids(tagged: DataFrame, parts: int) -> DataFrame:
    """``(id, starts, header, rows)``: one row per id, with the start of each part
    and the total size in one array, the first part that has a header, and the
    number of rows. Only ids, sizes and indices are read, and each task sends
    one row per id."""
    sizes = tagged.groupBy("id").agg(
        *(F.max(F.when(F.col("part") == i, F.col("size"))).alias(f"size{i}") for i in range(parts)),
        F.min(F.when(F.col("idx").isNull(), F.col("part"))).alias("header"),
        F.count("*").alias("rows"),
    )
    starts, at = [F.lit(0)], F.lit(0)
    for i in range(parts):
        at = at + F.coalesce(F.col(f"size{i}"), F.lit(0))
        starts.append(at)
    return sizes.select("id", F.array(*starts).cast("array<int>").alias("starts"), "header", "rows")


def offsets_by_id(tagged: DataFrame) -> DataFrame:
    """``(id, part, start, total)``: running sum of the part sizes per id.

    For parts that are rows of a table. The parts of an id are gathered in one
    array, so a task holds one number per part of an id.
    """
    sizes = tagged.groupBy("id", "part").agg(F.max("size").alias("size"))
    rows = sizes.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("part", "size"))).alias("parts"))
    held = F.aggregate(
        "parts",
        F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<part:int,start:int>>").alias("starts")),
        lambda acc, p: F.struct(
            (acc["at"] + p["size"]).alias("at"),
            F.concat(acc["starts"], F.array(F.struct(p["part"].cast("int").alias("part"), acc["at"].cast("int").alias("start"))))
            .alias("starts"),
        ),
    )
    placed = rows.select("id", held.alias("held"))
    return placed.select("id", F.col("held.at").cast("int").alias("total"), F.inline("held.starts")).select(
        "id", "part", "start", "total"
    )


def index_union(a: DataFrame, b: DataFrame) -> DataFrame:
    """``(id, idx)`` of indices in either vector."""
    return _indices(a).unionByName(_indices(b)).distinct()


def index_intersection(a: DataFrame, b: DataFrame) -> DataFrame:
    """``(id, idx)`` of indices in both vectors."""
    return _indices(a).join(_indices(b), ["id", "idx"], "left_semi").distinct()


def _indices(v: DataFrame) -> DataFrame:
    return v.where(F.col("idx").isNotNull()).select("id", "idx")


def to_rows(v: DataFrame) -> DataFrame:
    """One row per vector: ``(id, size, indices, values)``, indices ascending.

    A vector is gathered into one row here, as a vector column needs it; its
    entries number at most ``size``.
    """
    entry = F.when(F.col("idx").isNotNull(), F.struct("idx", "value"))
    rows = v.groupBy("id").agg(
        F.max("size").alias("size"), F.array_sort(F.collect_list(entry)).alias("entries")
    )
    return rows.select(
        "id", "size",
        F.col("entries.idx").alias("indices"), F.col("entries.value").alias("values"),
    )


def vector_text(rows: DataFrame) -> DataFrame:
    """``(id, text)``: ``(size,[indices],[values])`` of each vector row."""
    filled = F.format_string(
        "(%d,[%s],[%s])",
        "size",
        F.array_join(F.col("indices").cast("array<string>"), ","),
        F.array_join(F.col("values").cast("array<string>"), ","),
    )
    return rows.select(
        "id",
        F.when(F.size("indices") == 0, empty_vector_text("size")).otherwise(filled).alias("text"),
    )
