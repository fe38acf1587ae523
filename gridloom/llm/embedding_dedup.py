"""Near-duplicate vectors by Euclidean p-stable hashing and exact cosines.

A vector scaled to length one falls, in each of several tables, into the bucket
of its quantised random projections: ``floor((a . v + b) / width)`` for each of
``k`` Gaussian directions ``a``. A cosine of at least ``t`` is a distance of at
most ``sqrt(2 - 2t)``, for which the chance to share a bucket is known, so the
number of tables follows from the recall wanted. Pairs within a bucket are
checked by their cosine in double precision.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.llm.common import Forest, arrow_rows, connected_components, sorted_groups
from gridloom.session import materialise

WIDTH = 2.0
RECALL = 0.995  # of pairs that lie exactly at the threshold; closer ones are found more often
BUCKET_ROWS = 200  # expected strangers in a bucket, from which the number of directions follows
BLOCK = 512  # vectors of a bucket compared at once
GRID = float(1 << 20)  # projections are taken on this grid, where sums are exact in any order

_KEYS = pa.schema([("rep", pa.int64()), ("n", pa.int64()), ("vector", pa.binary()),
                   ("tab", pa.int32()), ("bucket", pa.int64())])
_FOUND = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("links", pa.int64())])


def collision(distance: float, width: float) -> float:
    """Chance that one quantised projection agrees for two points so far apart."""
    r = width / distance
    tail = 0.5 * math.erfc(r / math.sqrt(2))
    return 1 - 2 * tail - 2 / (math.sqrt(2 * math.pi) * r) * (1 - math.exp(-r * r / 2))


def table_plan(rows: int, threshold: float, recall: float) -> tuple[int, int]:
    """Directions per table and tables, by the laws of the hash and the row count."""
    strangers = collision(math.sqrt(2), WIDTH)
    k = max(4, math.ceil(math.log(max(rows, 1) / BUCKET_ROWS, 1 / strangers))) if rows > BUCKET_ROWS else 4
    near = collision(math.sqrt(2 - 2 * threshold), WIDTH) ** k
    return k, max(1, math.ceil(math.log(1 - recall) / math.log(1 - near)))


class Hash:
    def __init__(self, dims: int, k: int, tables: int, seed: int):
        rng = np.random.default_rng([seed, dims])
        self.k, self.tables = k, tables
        self.directions = np.rint(rng.standard_normal((dims, tables * k)) * 256)
        self.shifts = np.rint(rng.random(tables * k) * WIDTH * 256 * GRID)
        self.mix = rng.integers(1, 1 << 62, tables * k, dtype=np.int64) | 1

    def buckets(self, vectors: np.ndarray) -> np.ndarray:
        """Bucket of each vector in each table; the same wherever it is computed."""
        unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
        cells = np.floor((np.rint(unit * GRID) @ self.directions + self.shifts) / (WIDTH * 256 * GRID))
        mixed = cells.astype(np.int64) * self.mix
        return mixed.reshape(len(vectors), self.tables, self.k).sum(axis=2)


def _decode(vectors: list[bytes]) -> np.ndarray:
    """Scaled by their largest component, so that no length over- or underflows."""
    found = np.frombuffer(b"".join(vectors), "<f8").reshape(len(vectors), -1)
    return found / np.abs(found).max(axis=1, keepdims=True)


def _hash_rows(k: int, tables: int, seed: int):
    def hash_rows(batches):
        hashes: dict[int, Hash] = {}
        for batch in batches:
            reps, ns, vectors = (c.to_pylist() for c in batch.columns)
            by_size: dict[int, list[int]] = {}
            packed = [np.array(v, "<f8").tobytes() for v in vectors]
            for i, v in enumerate(packed):
                by_size.setdefault(len(v) // 8, []).append(i)
            for dims, own in by_size.items():
                if dims not in hashes:
                    hashes[dims] = Hash(dims, k, tables, seed)
                for at in range(0, len(own), 1024):
                    some = own[at:at + 1024]
                    found = hashes[dims].buckets(_decode([packed[i] for i in some]))
                    # The table and the number of components are part of a bucket's name.
                    found = found * 64 + np.arange(tables) % 64 + dims * 1_000_003
                    rows = {"rep": [], "n": [], "vector": [], "tab": [], "bucket": []}
                    for i, names in zip(some, found.tolist()):
                        rows["rep"] += [reps[i]] * tables
                        rows["n"] += [ns[i]] * tables
                        rows["vector"] += [packed[i]] * tables
                        rows["tab"] += range(tables)
                        rows["bucket"] += names
                    yield arrow_rows(_KEYS, rows)

    return hash_rows


def _compare(threshold: float, k: int, tables: int, seed: int):
    def compare(batches):
        hashes: dict[int, Hash] = {}
        rows = {name: [] for name in _FOUND.names}
        for _, group in sorted_groups(batches, "place"):
            sizes = {}
            for i, v in enumerate(group["vector"]):
                sizes.setdefault((group["tab"][i], len(v)), []).append(i)
            for (tab, size), own in sizes.items():
                dims = size // 8
                if dims not in hashes:
                    hashes[dims] = Hash(dims, k, tables, seed)
                _compare_block(threshold, hashes[dims], tab, [{c: group[c][i] for c in group} for i in own], rows)
            if len(rows["a"]) > 20_000:
                yield arrow_rows(_FOUND, rows)
                rows = {name: [] for name in _FOUND.names}
        yield arrow_rows(_FOUND, rows)

    return compare


def _compare_block(threshold: float, hash_: Hash, tab: int, members: list[dict], rows: dict) -> None:
    vectors = _decode([m["vector"] for m in members])
    sides = np.array([m["side"] for m in members])
    reps, ns = np.array([m["rep"] for m in members]), np.array([m["n"] for m in members], np.int64)
    left = np.flatnonzero(sides != 1)
    right = np.flatnonzero(sides != 0)
    names = hash_.buckets(vectors)
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    near = unit[left] @ unit[right].T >= threshold
    i, j = np.nonzero(near & ((sides[left] == 0)[:, None] | (left[:, None] < right[None, :])))
    i, j = left[i], right[j]
    # A pair counts in the first table in which it shares a bucket.
    first = (names[i, tab] == names[j, tab]) & ~(names[i, :tab] == names[j, :tab]).any(axis=1)
    i, j = i[first], j[first]
    if not len(i):
        return
    links = np.bincount(i, ns[j], len(members)) + np.bincount(j, ns[i], len(members))
    order = np.argsort(reps, kind="stable")
    place = np.empty_like(order)
    place[order] = np.arange(len(order))
    forest = Forest(len(members))
    for x, y in zip(place[i].tolist(), place[j].tolist()):
        forest.join(x, y)
    for at in np.flatnonzero(links):
        rows["a"].append(int(reps[at]))
        rows["b"].append(int(reps[order[forest.root(int(place[at]))]]))
        rows["links"].append(int(links[at]))


def near_duplicate_vectors(
    vectors: DataFrame,
    *,
    key: str = "vec_id",
    vector: str = "embedding",
    threshold: float = 0.9,
    recall: float = RECALL,
    seed: int = 7,
) -> DataFrame:
    """Links, and the component, of every row.

    Result per row: ``key``, ``n_links`` (other rows whose cosine is at least
    ``threshold``), ``component_id`` (smallest key reachable by links, its own
    included), ``kept`` (whether that is its own). No pair below the threshold
    is linked; of pairs exactly at it the share ``recall`` is found.

    A row whose vector is null, empty, zero or holds a null or non-finite
    component links with nothing, nor do vectors of different sizes or rows with a
    null key; a null key keeps its null component and is kept. Rows that repeat
    a vector are linked with one another; rows that repeat a key as well count
    as rows, and are kept or not together. Other columns are ignored; an empty
    table gives none.

    Equal vectors become one row with a count first, by an aggregate that
    combines within tasks, so copies never meet in pairs. Buckets beyond
    ``BLOCK`` rows are cut into blocks, and pairs of blocks are compared in
    tasks of their own: nothing is capped, no pair is written out, and a task
    returns one row per vector with the sum of its links.
    """
    values = F.transform(F.col(vector), lambda x: x.cast("double"))
    fine = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    usable = F.coalesce(
        F.col("key").isNotNull() & F.forall("vector", fine) & F.exists("vector", lambda x: x != 0), F.lit(False)
    )
    rows = vectors.select(F.col(key).cast("long").alias("key"), values.alias("vector")).select(
        "key", F.when(usable, F.col("vector")).alias("vector")
    )
    classes = materialise(
        rows.where("vector IS NOT NULL").groupBy("vector").agg(F.min("key").alias("rep"), F.count("*").alias("n")),
        "vector-classes",
    )
    k, tables = table_plan(classes.count(), threshold, recall)
    keys = classes.select("rep", "n", "vector").mapInArrow(
        _hash_rows(k, tables, seed), "rep long, n long, vector binary, tab int, bucket long"
    )
    sizes = materialise(
        keys.groupBy("tab", "bucket").agg(F.count("*").alias("rows")).where("rows > 1"), "vector-buckets"
    )
    blocks = F.ceil(F.col("rows") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("rep", F.lit(seed)), F.col("blocks")).cast("int")
    pairs = F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1),
        lambda other: F.struct(
            F.least(F.col("block"), other).alias("x"), F.greatest(F.col("block"), other).alias("y"),
            F.when(other == F.col("block"), -1).when(F.col("block") < other, 0).otherwise(1).alias("side"),
        ),
    )
    found = materialise(
        keys.join(sizes, ["tab", "bucket"])
        .withColumn("blocks", blocks).withColumn("block", own)
        .withColumn("pair", F.explode(pairs))
        .select(
            F.xxhash64("tab", "bucket", "pair.x", "pair.y").alias("place"),
            "tab", "rep", "n", "vector", F.col("pair.side").alias("side"),
        )
        .repartition("place").sortWithinPartitions("place")
        .mapInArrow(_compare(threshold, k, tables, seed), "a long, b long, links long"),
        "vector-links",
    )
    links = found.groupBy("a").agg(F.sum("links").alias("links"))
    components = connected_components(found, "a", "b")
    known = (
        classes.join(links, classes["rep"] == links["a"], "left")
        .join(components, classes["rep"] == components["node"], "left")
        .select("vector", "n", "rep", "links", "component")
    )
    component = F.coalesce("component", "rep", "key")
    return rows.join(known, "vector", "left").select(
        F.col("key").alias(key),
        F.coalesce(F.col("n") - 1 + F.coalesce("links", F.lit(0)), F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        component.eqNullSafe(F.col("key")).alias("kept"),
    )
