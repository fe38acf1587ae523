"""Exact Jaccard self-join of word shingles over a token-group matrix.

Similar documents are put into groups by a minimum hash of their shingles,
large groups cut into blocks. A group stands for its members by the union of
their tokens. Rows of the matrix are the tokens by which two documents that
link must meet (the rarest ones of each, prefix filtering), columns are groups;
where two groups of unconnected documents meet, the overlap of each query with
the other group's whole union bounds what any member can share with it, and
only groups that pass are opened and their members compared. To keep the cells
of a token in proportion to its groups, every token first names one hub among
them, and groups are compared with the hubs they share most with until no hub
connects anything more; only groups still apart then meet each other.

Nothing asks for pairs of copies: equal sets are one row, and groups that are
known to hang together need not be compared, as only components are reported.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.llm.common import (
    BATCH_BYTES,
    Forest,
    arrow_rows,
    connected_components,
    giving_back,
    measured,
    slices,
    sorted_groups,
    texts_of,
)
from gridloom.session import materialise

WORDS = 5
BLOCK = 256  # members of a group
BLOCK_SHINGLES = 1 << 20  # of all members of a group, about ten bytes of text each
PROBING_ROUNDS = 1  # at most; what they leave unconnected is compared afterwards
HELD_TOKENS = 1 << 18  # of results that a task has not handed on
CACHED_WORDS = 200_000
MATRIX_BYTES = 8 << 20  # of tokens by sets, that are multiplied at a time
COUNTER_BITS = 22  # hashed counters of frequent shingles in a task; they order tokens and decide nothing

_FACTOR = np.uint64(0x9E3779B97F4A7C15)
# One minimum hash each. Two sets that link differ in all of them once in 25 times at most; the matrix finds those.
_SEEDS = tuple(np.uint64(s) for s in (0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))
MINIMA = [f"g{i}" for i in range(1, len(_SEEDS) + 1)]
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))

_SLIM = pa.schema([("key", pa.int64()), ("n", pa.int64()), ("fp", pa.string()), *((g, pa.int64()) for g in MINIMA),
                   ("bucket", pa.int64()), ("count", pa.int64())])
_TOKENS = pa.schema([("grp", pa.int64()), ("root", pa.int64()), ("lo", pa.int64()), ("hi", pa.int64()),
                     ("tokens", pa.list_(pa.int64())), ("rests", pa.list_(pa.int32())), ("a", pa.int64()), ("b", pa.int64())])
_PREFIX = pa.schema([("key", pa.int64()), ("fp", pa.string()), ("tokens", pa.list_(pa.int64())),
                     ("rests", pa.list_(pa.int32()))])
_EDGES = pa.schema([("a", pa.int64()), ("b", pa.int64())])


class Shingles:
    """Sets of hashed shingles of texts; words that came before are not hashed again."""

    def __init__(self, words: int):
        self.words, self.cache = words, {}

    def of(self, text: str) -> np.ndarray:
        """Sorted distinct 64-bit hashes of the shingles; those of a text with
        fewer words are the hash of all of them, and of none without words."""
        found = text.encode().translate(_LOWER).split()
        if not found:
            return np.empty(0, np.uint64)
        cache = self.cache
        if len(cache) > CACHED_WORDS:
            cache.clear()
        hashes = list(map(cache.get, found))
        if None in hashes:
            for i, known in enumerate(hashes):
                if known is None:
                    hashes[i] = cache[found[i]] = xxhash.xxh3_64_intdigest(found[i])
        h = np.array(hashes, np.uint64)
        width = min(self.words, len(h))
        mixed = np.full(len(h) - width + 1, width, np.uint64)
        for i in range(width):
            mixed = mixed * _FACTOR + h[i:len(h) - width + 1 + i]
        mixed ^= mixed >> np.uint64(29)
        mixed *= _SEEDS[0]
        return np.unique(mixed ^ (mixed >> np.uint64(32)))


def set_digest(tokens: np.ndarray) -> str:
    return hashlib.blake2b(tokens.tobytes(), digest_size=16).hexdigest()


def needed(size: int, percent: int) -> int:
    """Least overlap with any set that links with one of this size."""
    return -(-percent * size // 100)


def prefix(tokens: np.ndarray, counters: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """The rarest tokens of a set, and how many tokens it has from each of them on.

    In one order of all tokens, the first of the at least ``t`` shared ones lies
    among the first ``n - t + 1`` of either set. From there on either set has at
    least as many tokens as the two share.
    """
    n = len(tokens)
    counts = counters[(tokens >> np.uint64(64 - COUNTER_BITS)).astype(np.int64)]
    order = np.argsort(counts, kind="stable")  # ties by hash: the tokens are sorted
    found = tokens[order[:n - needed(n, percent) + 1]]
    return found, n - np.arange(len(found), dtype=np.int32)


def dense_counters(frequent: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    counters = np.zeros(1 << COUNTER_BITS, np.uint32)
    counters[frequent[0]] = np.minimum(frequent[1], (1 << 32) - 1)  # the same in every task, as an order must be
    return counters


def overlaps(some: list[np.ndarray], others: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of every set of one list with each of another; the sets are sorted."""
    universe, place = np.unique(np.concatenate(others), return_inverse=True)
    edges = np.cumsum([0, *map(len, others)])
    counts = np.zeros((len(some), len(others)), np.int64)
    step = max(1, MATRIX_BYTES // (4 * max(1, len(some) + len(others))))  # tokens at a time, in bounded memory
    borders = np.r_[0:len(universe):step, len(universe)]
    spots = []
    for own in some:
        at = np.minimum(np.searchsorted(universe, own), max(0, len(universe) - 1))
        spots.append(at[universe[at] == own] if len(universe) else at[:0])
    sides = [(spots, [np.searchsorted(at, borders) for at in spots])]
    spots = [place[a:b] for a, b in zip(edges, edges[1:])]
    sides.append((spots, [np.searchsorted(at, borders) for at in spots]))
    for n, (low, high) in enumerate(zip(borders, borders[1:])):
        left, right = (np.zeros((len(own), high - low), np.float32) for own, _ in sides)
        for matrix, (own, cuts) in zip((left, right), sides):
            for row, at, cut in zip(matrix, own, cuts):
                row[at[cut[n]:cut[n + 1]] - low] = 1
        counts += (left @ right.T).astype(np.int64)
    return counts


def linked(some: list[np.ndarray], others: list[np.ndarray], percent: int) -> np.ndarray:
    """Where 100 times the intersection is at least ``percent`` times the union."""
    shared = overlaps(some, others)
    sizes = np.array([len(s) for s in some])[:, None] + np.array([len(s) for s in others])[None, :]
    return (100 * shared >= percent * (sizes - shared)) & (shared > 0)


def _describe(words: int):
    def describe(batches):
        shingles, counters = Shingles(words), np.zeros(1 << COUNTER_BITS, np.uint32)
        for batch in slices(batches):
            rows = {name: [] for name in _SLIM.names}
            rows["key"] = batch.column(0).to_pylist()
            for text in texts_of(batch.column(1)):
                tokens = shingles.of(text)
                rows["n"].append(len(tokens))
                np.add.at(counters, (tokens >> np.uint64(64 - COUNTER_BITS)).astype(np.int64), np.uint32(1))
                rows["fp"].append(set_digest(tokens) if len(tokens) else None)
                for name, seed in zip(MINIMA, _SEEDS):
                    low = ((tokens ^ (tokens >> np.uint64(31))) * seed).min() if len(tokens) else None
                    rows[name].append(None if low is None else int(low.view(np.int64)))
            rows["bucket"] = rows["count"] = [None] * len(rows["key"])
            yield arrow_rows(_SLIM, rows)
        often = np.flatnonzero(counters > 2 + 2 * counters.mean())
        none = [None] * len(often)
        yield arrow_rows(_SLIM, {**dict.fromkeys(_SLIM.names, none), "bucket": often,
                                 "count": counters[often].astype(np.int64)})

    return giving_back(describe)


def _prefixes(words: int, frequent: tuple[np.ndarray, np.ndarray], percent: int):
    def prefixes(batches):
        shingles, counters = Shingles(words), dense_counters(frequent)
        for batch in slices(batches):
            rows = {name: [] for name in _PREFIX.names}
            rows["key"] = batch.column(0).to_pylist()
            for text in texts_of(batch.column(1)):
                tokens = shingles.of(text)
                rows["fp"].append(set_digest(tokens) if len(tokens) else None)
                found, rests = prefix(tokens, counters, percent) if len(tokens) else (None, None)
                rows["tokens"].append(None if found is None else found.view(np.int64))
                rows["rests"].append(rests)
            yield arrow_rows(_PREFIX, rows)

    return giving_back(prefixes)


def _inside_groups(words: int, frequent: tuple[np.ndarray, np.ndarray], percent: int):
    """Links inside each group, and the group's token union for each part of it
    that hangs together. Rows with ``member`` false only link."""

    def inside(batches):
        shingles, counters = Shingles(words), dense_counters(frequent)
        rows, held = {name: [] for name in _TOKENS.names}, 0
        for grp, group in sorted_groups(batches, "grp"):
            order = sorted(range(len(group["rep"])), key=lambda i: group["rep"][i])
            reps = [group["rep"][i] for i in order]
            sets = [shingles.of(group["text"][i] or "") for i in order]
            forest = Forest(len(reps))
            for i, j in np.argwhere(linked(sets, sets, percent)).tolist():
                forest.join(i, j)
            for i in range(1, len(reps)):
                if reps[i] == reps[i - 1]:  # a key that occurs again
                    forest.join(i, i - 1)
            parts: dict[int, list[int]] = {}
            for i, at in enumerate(order):
                root = forest.root(i)
                if root != i:
                    _edge(rows, reps[i], reps[root])
                if group["member"][at]:
                    parts.setdefault(root, []).append(i)
            for root, own in parts.items():
                sizes = [len(sets[i]) for i in own]
                found, rests = (np.concatenate(c) for c in zip(*(prefix(sets[i], counters, percent) for i in own)))
                union, place = np.unique(found, return_inverse=True)
                most = np.zeros(len(union), np.int32)
                np.maximum.at(most, place, rests)
                for name, value in zip(_TOKENS.names, (grp, reps[root], min(sizes), max(sizes),
                                                       union.view(np.int64), most, None, None)):
                    rows[name].append(value)
                held += len(union)
            if len(rows["grp"]) > 500 or held > HELD_TOKENS:
                yield arrow_rows(_TOKENS, rows)
                rows, held = {name: [] for name in _TOKENS.names}, 0
        yield arrow_rows(_TOKENS, rows)

    return giving_back(inside)


def _edge(rows: dict[str, list], a: int, b: int) -> None:
    for name in rows:
        rows[name].append({"a": a, "b": b}.get(name))


def _open_groups(words: int, percent: int):
    """Compare the askers of each place with its group, if the bound lets it be opened."""

    def open_groups(batches):
        shingles = Shingles(words)
        rows = {name: [] for name in _EDGES.names}
        for _, group in sorted_groups(batches, "place"):
            order = sorted(range(len(group["rep"])), key=lambda i: group["rep"][i])
            reps = [group["rep"][i] for i in order]
            sets = [shingles.of(group["text"][i] or "") for i in order]
            sides = [group["side"][i] for i in order]
            members = [i for i, side in enumerate(sides) if side == 1]
            if not members:
                continue
            union = np.unique(np.concatenate([sets[i] for i in members]))
            asking = []
            for i, side in enumerate(sides):
                at = np.minimum(np.searchsorted(union, sets[i]), max(0, len(union) - 1))
                enough = len(union) and 100 * int((union[at] == sets[i]).sum()) >= percent * len(sets[i])
                if side == 0 and enough:  # else no member can share enough
                    asking.append(i)
            forest = Forest(len(reps))
            if asking:
                found = linked([sets[i] for i in asking], [sets[j] for j in members], percent)
                for i, j in np.argwhere(found).tolist():
                    forest.join(asking[i], members[j])
            for i in range(len(reps)):
                if forest.root(i) != i:
                    _edge(rows, reps[i], reps[forest.root(i)])
            if len(rows["a"]) > 10_000:
                yield arrow_rows(_EDGES, rows)
                rows = {name: [] for name in _EDGES.names}
        yield arrow_rows(_EDGES, rows)

    return giving_back(open_groups)


def _visits(reps: DataFrame, by: str, *, members: bool) -> DataFrame:
    """``(grp, rep, member)`` of the groups with several rows.

    Every block of a large group is also visited by two rows of the whole
    group, through which its blocks become connected early on.
    """
    mixed = F.struct(F.xxhash64("rep", F.lit(1)).alias("h"), "rep")
    groups = (
        reps.groupBy(by)
        .agg(F.count("*").alias("rows"), F.sum("n").alias("shingles"),
             F.min(mixed)["rep"].alias("low"), F.max(mixed)["rep"].alias("high"))
        .where("rows > 1")
        .withColumn("blocks", F.ceil(F.greatest(F.col("rows") / BLOCK, F.col("shingles") / BLOCK_SHINGLES)).cast("int"))
    )
    block = F.pmod(F.xxhash64("rep", F.lit(2)), F.col("blocks")).cast("int")
    name = lambda block: F.xxhash64(F.lit(by), F.col(by), block)
    own = reps.join(groups.select(by, "blocks"), by).select(
        name(block).alias("grp"), "rep", F.lit(members).alias("member")
    )
    hubs = (
        groups.where("blocks > 1")
        .select(by, "blocks", F.explode(F.array("low", "high")).alias("rep"),)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .where(F.col("other") != block)
        .select(name(F.col("other")).alias("grp"), "rep", F.lit(False).alias("member"))
    )
    return own.unionByName(hubs)


def _places(pairs: DataFrame, members: DataFrame) -> DataFrame:
    """``(place, side, rep)``: who is compared where, for pairs of groups.

    The larger group of a pair is opened (side 1) for the members of the smaller
    one (side 0). It is opened once for all that ask for it, or once for every
    ``BLOCK`` of them, so rows are in proportion to the pairs.
    """
    sizes = members.groupBy("grp").agg(F.count("*").alias("size"))
    sides = (
        pairs.join(sizes.select(F.col("grp").alias("one"), F.col("size").alias("s1")), "one")
        .join(sizes.select(F.col("grp").alias("other"), F.col("size").alias("s2")), "other")
    )
    first = F.col("s1") > F.col("s2")
    asked = sides.select(
        F.when(first, F.col("one")).otherwise(F.col("other")).alias("home"),
        F.when(first, F.col("other")).otherwise(F.col("one")).alias("grp"), F.least("s1", "s2").alias("size"),
    )
    loads = asked.groupBy("home").agg(F.ceil(F.sum("size") / BLOCK).cast("int").alias("parts"))
    part = F.pmod(F.xxhash64("grp", F.lit(3)), F.col("parts")).cast("int")
    asking = asked.join(loads, "home").select(F.xxhash64("home", part).alias("place"), "grp", F.lit(0).alias("side"))
    homes = loads.select(F.col("home").alias("grp"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    opened = homes.select(F.xxhash64("grp", "part").alias("place"), "grp", F.lit(1).alias("side"))
    return asking.unionByName(opened).join(members, "grp").select("place", "side", "rep")


def _placed(postings: DataFrame, components: DataFrame) -> DataFrame:
    """Postings with the component that their part of a group belongs to."""
    return postings.join(measured(components), F.col("root") == F.col("node"), "left").select(
        "grp", F.coalesce("component", "root").alias("comp"), "lo", "hi", "token", "rest"
    )


def _may_link(x, y, percent: int):
    """Whether a set of one group can link with one of another whose first shared
    token this is: neither is too small for the other, and from the token on both
    have as many tokens as a link needs in common. ``x`` and ``y`` give columns by name."""
    long = lambda side, name: side(name).cast("long")
    return (
        (long(x, "hi") * 100 >= long(y, "lo") * percent)
        & (long(y, "hi") * 100 >= long(x, "lo") * percent)
        & (F.least(long(x, "rest"), long(y, "rest")) * (100 + percent) >= (long(x, "lo") + long(y, "lo")) * percent)
    )


def _pair(one, other):
    return F.least(one, other).alias("one"), F.greatest(one, other).alias("other")


def _closest_hubs(placed: DataFrame, percent: int, tried: DataFrame | None) -> DataFrame:
    """``(one, other)``: for every component the group and the hub that share most.

    A token's hub is its group of the smallest component. One row per posting is
    made, however many groups share a token.
    """
    hubs = (
        placed.groupBy("token")
        .agg(F.min(F.struct("comp", "grp", "lo", "hi", "rest")).alias("hub"), F.max("comp").alias("top"))
        .where("hub.comp < top").drop("top")
    )
    probes = (
        placed.join(hubs, "token")
        .where((F.col("comp") != F.col("hub.comp")) & (F.col("grp") != F.col("hub.grp")))
        .where(_may_link(F.col, lambda name: F.col(f"hub.{name}"), percent))
        .groupBy("comp", "grp", F.col("hub.grp").alias("to"))
        .agg(F.count("*").alias("shared"))
        .select("comp", "shared", *_pair("grp", "to"))
    )
    best = F.max(F.struct("shared", "one", "other")).alias("best")
    return _untried(probes, tried).groupBy("comp").agg(best).select("best.one", "best.other").distinct()


def _untried(pairs: DataFrame, tried: DataFrame | None) -> DataFrame:
    return pairs if tried is None else pairs.join(measured(tried), ["one", "other"], "left_anti")


def _meetings(placed: DataFrame, percent: int) -> DataFrame:
    """``(one, other)``: groups of different components that may hold a link."""
    x, y = placed.alias("x"), placed.alias("y")
    return (
        x.join(y, (F.col("x.token") == F.col("y.token")) & (F.col("x.comp") < F.col("y.comp"))
               & _may_link(lambda name: F.col(f"x.{name}"), lambda name: F.col(f"y.{name}"), percent))
        .where("x.grp <> y.grp")
        .select(*_pair(F.col("x.grp"), F.col("y.grp"))).distinct()
    )


def shingle_components(
    docs: DataFrame,
    *,
    key: str = "doc_id",
    text: str = "text",
    words: int = WORDS,
    percent: int = 80,
) -> DataFrame:
    """Set size and component of every row.

    Words are runs of anything but the space and control white space of ASCII,
    with A-Z in lower case; a set holds the distinct runs of ``words`` of them,
    or the whole sequence where there are fewer. Two rows link when 100 times
    the intersection is at least ``percent`` times the union. Result: ``key``,
    ``n_shingles``, ``component_id`` (smallest key reachable, its own included).

    Null, empty and blank texts have no shingles and link with nothing; their
    component is their key. Equal sets always link. Rows that share a key are
    one node. A row with a null key takes the component of its equals, or null.
    Other columns are ignored; an empty table gives none. The join is exact
    but for collisions of 64-bit hashes: every pair that could link is either
    compared or already connected.
    """
    source = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    described = materialise(
        source.mapInArrow(
            _describe(words),
            f"key long, n long, fp string, {', '.join(f'{g} long' for g in MINIMA)}, bucket long, count long",
        ),
        "shingles", batch_bytes=BATCH_BYTES,
    )
    slim = described.where("bucket IS NULL").select("key", "n", "fp", *MINIMA)
    counted = described.where("bucket IS NOT NULL").groupBy("bucket").agg(F.sum("count").alias("n"))
    found = counted.toArrow()  # at most one row for each of the fixed counters
    frequent = (found["bucket"].to_numpy().astype(np.int32), found["n"].to_numpy())

    reps = materialise(
        slim.where("fp IS NOT NULL AND key IS NOT NULL").groupBy("fp")
        .agg(F.min("key").alias("rep"), F.min("n").alias("n"), *(F.min(g).alias(g) for g in MINIMA)),
        "shingle-sets",
    )
    first, *others = MINIMA
    visits = _visits(reps, first, members=True)
    for by in others:
        visits = visits.unionByName(_visits(reps, by, members=False))
    visits = materialise(visits, "shingle-groups")
    inside = materialise(
        source.join(measured(visits), F.col("key") == F.col("rep"))
        .select("grp", "rep", "member", "text")
        .repartition("grp").sortWithinPartitions("grp")
        .mapInArrow(
            _inside_groups(words, frequent, percent),
            "grp long, root long, lo long, hi long, tokens array<long>, rests array<int>, a long, b long",
        ),
        "shingle-links", batch_bytes=BATCH_BYTES,
    )
    edges = inside.where("a IS NOT NULL").select("a", "b")
    components = materialise(connected_components(edges, "a", "b"), "shingle-components")

    grouped = visits.where("member").select("grp", "rep")
    alone = reps.join(grouped.select("rep"), "rep", "left_anti").select("rep", "fp", "n")
    single = (
        source.mapInArrow(_prefixes(words, frequent, percent), "key long, fp string, tokens array<long>, rests array<int>")
        .withColumnRenamed("fp", "fp2")
        .join(alone, (F.col("key") == F.col("rep")) & (F.col("fp") == F.col("fp2")))
        .select(F.col("rep").alias("grp"), F.col("rep").alias("root"), F.col("n").alias("lo"),
                F.col("n").alias("hi"), "tokens", "rests")
    )
    columns = materialise(
        single.unionByName(inside.where("grp IS NOT NULL AND a IS NULL").select("grp", "root", "lo", "hi", "tokens", "rests")),
        "shingle-columns", batch_bytes=BATCH_BYTES,
    )
    # Most tokens occur in one group only: they are counted, task by task first, and not moved again.
    common = materialise(
        columns.select(F.explode("tokens").alias("token")).groupBy("token").agg(F.count("*").alias("n"))
        .where("n > 1").select("token"),
        "shingle-tokens",
    )
    postings = materialise(
        columns.select("grp", "root", F.col("lo").cast("int").alias("lo"), F.col("hi").cast("int").alias("hi"),
                       F.inline(F.arrays_zip(F.col("tokens").alias("token"), F.col("rests").alias("rest"))))
        .join(measured(common, 16), "token"),
        "shingle-postings",
    )
    members = grouped.unionByName(alone.select(F.col("rep").alias("grp"), "rep"))

    def opened(pairs: DataFrame) -> DataFrame:
        rows = materialise(_places(pairs, members), "shingle-opened")
        return materialise(
            source.join(measured(rows, 24), F.col("key") == F.col("rep"))
            .select("place", "side", "rep", "text")
            .repartition("place").sortWithinPartitions("place")
            .mapInArrow(_open_groups(words, percent), "a long, b long"),
            "shingle-more-links", batch_bytes=BATCH_BYTES,
        )

    links = components.select(F.col("node").alias("a"), F.col("component").alias("b"))
    tried = None
    for _ in range(PROBING_ROUNDS):
        closest = materialise(_closest_hubs(_placed(postings, components), percent, tried), "shingle-closest")
        found = opened(closest)
        if found.isEmpty():
            tried = closest if tried is None else tried.unionByName(closest)
            break
        tried = closest if tried is None else tried.unionByName(closest)
        links = links.unionByName(found)
        components = materialise(connected_components(links, "a", "b"), "shingle-components")
    last = _untried(_meetings(_placed(postings, components), percent), tried)
    final = connected_components(links.unionByName(opened(last)), "a", "b")
    known = reps.join(final, F.col("rep") == F.col("node"), "left").select(
        "fp", F.coalesce("component", "rep").alias("component")
    )
    return slim.join(known, "fp", "left").select(
        F.col("key").alias(key), F.col("n").alias("n_shingles"),
        F.coalesce("component", "key").alias("component_id"),
    )


def without_near_duplicates(docs: DataFrame, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows, with all their columns, that have the smallest key of their component."""
    decided = shingle_components(docs, key=key, text=text)
    dropped = materialise(
        decided.where(F.col("component_id") < F.col(key)).select(F.col(key)).distinct(), "dropped"
    )
    return docs.join(measured(dropped), key, "left_anti").select(*docs.columns)
