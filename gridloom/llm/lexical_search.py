"""Ranked lexical search for many items at once.

Items share terms, often several of them. Sets of terms that items have in
common are mined first and become nodes of a graph: a leaf adds up the terms
that exactly the same items hold, an inner node adds two nodes that occur
together in several items. Every task evaluates each node once for a block of
documents, and an item's scores are the sum of its few nodes. Scores are 64-bit
integers, so the order of the additions does not matter.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gridloom.session import materialise

# Items searched in one pass over the documents: at most so many, and so many
# terms of all items together unless a single item has more.
BLOCK_ITEMS = 1024
BLOCK_TERMS = 200_000
# Items with more groups of terms than this are not mined for pairs.
MINED_GROUPS = 2_000
BLOCK_BYTES = 1 << 20  # of a text, taken apart at a time
NODE_BYTES = 32 << 20  # accumulators held by a task
SALTS = 64  # groups that the tasks' candidates of an item are ranked in first
KEPT_FACTOR = 4  # candidates held per item, as a multiple of k, before they are pruned

# Bytes that end a term become spaces, A-Z become a-z; bytes of characters
# beyond ASCII stay, so whole characters do.
_TERM_BYTES = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256)).lower()


def term_frequencies(text: bytes) -> Counter:
    """Occurrences of every term of a UTF-8 text."""
    found: Counter = Counter()
    spaced, start = text.translate(_TERM_BYTES), 0
    while start < len(spaced):
        end = spaced.find(b" ", start + BLOCK_BYTES)
        end = len(spaced) if end < 0 else end
        found.update(spaced[start:end].split())
        start = end
    return found


# --- sharing between items ---------------------------------------------------


@dataclass
class SharingGraph:
    """How items are put together from terms.

    Nodes below ``leaves`` add up the terms with that entry in ``leaf_of``; the
    others add the two nodes of their row in ``pairs``. ``depth`` counts from 1
    for pairs of leaves. ``parts``: the nodes of each item.
    """

    leaves: int
    leaf_of: np.ndarray
    pairs: np.ndarray
    depth: np.ndarray
    parts: list[list[int]]

    @property
    def nodes(self) -> int:
        return self.leaves + len(self.pairs)

    def additions(self) -> int:
        return len(self.pairs) + sum(max(0, len(p) - 1) for p in self.parts)


def sharing_graph(items: list[set[int]], terms: int) -> SharingGraph:
    """Mine the term sets that items share.

    Terms held by the same items fall together. Then the pair of nodes that
    most items hold is replaced by a new node in all of them, as long as a pair
    is in two items at least. Pairs of very long items are not counted, for
    their number; such items are sums of more nodes, and as exact.
    """
    holders: dict[int, list[int]] = defaultdict(list)
    for i, own in enumerate(items):
        for t in own:
            holders[t].append(i)
    leaf_of, leaf_by_holders = np.zeros(terms, np.int64), {}
    parts: list[set[int]] = [set() for _ in items]
    for t in range(terms):
        held = holders.get(t, [])
        leaf = leaf_by_holders.setdefault(tuple(held), len(leaf_by_holders))
        leaf_of[t] = leaf
        for i in held:
            parts[i].add(leaf)
    leaves, pairs, depth = len(leaf_by_holders), [], [0] * len(leaf_by_holders)

    mined = [i for i, p in enumerate(parts) if len(p) <= MINED_GROUPS]
    shared = Counter(n for i in mined for n in parts[i])
    items_of: dict[tuple[int, int], set[int]] = defaultdict(set)
    for i in mined:
        own = sorted(n for n in parts[i] if shared[n] > 1)
        for k, a in enumerate(own):
            for b in own[k + 1:]:
                items_of[a, b].add(i)
    heap = [(-len(held), pair) for pair, held in items_of.items() if len(held) > 1]
    heapq.heapify(heap)
    while heap:
        count, (a, b) = heapq.heappop(heap)
        held = items_of.get((a, b), set())
        if len(held) < 2:
            continue
        if len(held) != -count:
            heapq.heappush(heap, (-len(held), (a, b)))
            continue
        node = leaves + len(pairs)
        pairs.append((a, b))
        depth.append(1 + max(depth[a], depth[b]))
        del items_of[a, b]
        beside: dict[int, set[int]] = defaultdict(set)
        for i in held:
            parts[i] -= {a, b}
            for other in parts[i]:
                for gone in (a, b):
                    items_of.get((min(gone, other), max(gone, other)), set()).discard(i)
                beside[other].add(i)
            parts[i].add(node)
        for other, both in beside.items():
            if len(both) > 1:
                items_of[other, node] = both
                heapq.heappush(heap, (-len(both), (other, node)))
    return SharingGraph(leaves, leaf_of, np.array(pairs, np.int64).reshape(-1, 2), np.array(depth, np.int64),
                        [sorted(p) for p in parts])


class Accumulators:
    """Scores of blocks of documents for all items of a graph."""

    def __init__(self, graph: SharingGraph):
        self.graph = graph
        inner = graph.depth[graph.leaves:]
        self.levels = [np.flatnonzero(inner == d) for d in range(1, int(inner.max(initial=0)) + 1)]
        self.parts = np.array([n for p in graph.parts for n in p], np.int64)
        sizes = [len(p) for p in graph.parts]
        self.full = np.flatnonzero(sizes)  # items with a term at all
        self.starts = (np.cumsum([0, *sizes])[:-1])[self.full]
        self.width = max(1, min(1024, NODE_BYTES // (8 * max(1, graph.nodes + len(self.parts)))))

    def scores(self, document: np.ndarray, term: np.ndarray, value: np.ndarray, n: int) -> np.ndarray:
        """``(items with terms, n)`` sums of ``value`` over the postings."""
        graph = self.graph
        held = np.zeros((graph.nodes, n), np.int64)
        np.add.at(held.reshape(-1), graph.leaf_of[term] * n + document, value)
        for level in self.levels:
            a, b = graph.pairs[level].T
            held[graph.leaves + level] = held[a] + held[b]
        return np.add.reduceat(held[self.parts], self.starts, axis=0)


# --- in tasks ------------------------------------------------------------------

POSTINGS = "doc_id long, n long, terms array<int>, tfs array<long>"


def _postings(numbers: dict[bytes, int]):
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("terms", pa.list_(pa.int32())),
                        ("tfs", pa.list_(pa.int64()))])

    def postings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, terms, tfs = [], [], []
            for text in batch.column(1).to_pylist():
                found = term_frequencies(text or b"")
                own = found.keys() & numbers.keys()
                n.append(found.total())
                terms.append([numbers[t] for t in own])
                tfs.append([found[t] for t in own])
            yield pa.record_batch([batch.column(0), pa.array(n, pa.int64()), pa.array(terms, schema.field(2).type),
                                   pa.array(tfs, schema.field(3).type)], schema=schema)

    return postings


class _Best:
    """The k best documents per item so far: higher scores, then smaller ids, nulls last."""

    def __init__(self, items: int, k: int):
        self.k, self.bar = k, np.zeros(items, np.int64)
        self.most = KEPT_FACTOR * k * max(1, items)
        empty = np.zeros(0, np.int64)
        self.rows, self.fresh = (empty, empty, empty, np.zeros(0, bool)), []

    def add(self, scores: np.ndarray, ids: np.ndarray, null: np.ndarray) -> None:
        item, at = np.nonzero((scores > 0) & (scores >= self.bar[:, None]))
        self.fresh.append((item, scores[item, at], ids[at], null[at]))
        if len(self.rows[0]) + sum(len(f[0]) for f in self.fresh) > self.most:
            self.prune()

    def prune(self) -> tuple[np.ndarray, ...]:
        item, score, doc, null = (np.concatenate(c) for c in zip(self.rows, *self.fresh))
        order = np.lexsort((doc, null, -score, item))
        placed = item[order]
        rank = np.arange(len(placed)) - np.searchsorted(placed, placed)
        kept, last = order[rank < self.k], order[rank == self.k - 1]
        self.rows, self.fresh = (item[kept], score[kept], doc[kept], null[kept]), []
        self.bar[item[last]] = score[last]
        return self.rows


def _ranked(graph: SharingGraph, weights: np.ndarray, documents: int, length: int, k: int):
    """Each task's k best documents per item."""

    def rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = Accumulators(graph)
        best = _Best(len(sums.full), k)
        for batch in batches:
            ids = batch.column(0)
            null = ids.is_null().to_numpy(zero_copy_only=False)
            ids = ids.fill_null(0).to_numpy()
            n = batch.column(1).to_numpy()
            # A document's m is 100 - 50 + (50 n N) div L, in Python's integers where 64 bits might not do.
            safe = 50 * int(n.max(initial=0)) * documents < 2**63
            share = (50 * n * documents) // length if safe else np.array([50 * int(x) * documents // length for x in n])
            m = 50 + share
            for start in range(0, len(n), sums.width):
                some = batch.slice(start, sums.width)
                lists = some.column(2)
                document = np.repeat(np.arange(len(some)), lists.value_lengths().to_numpy())
                term = lists.flatten().to_numpy()
                tf = some.column(3).flatten().to_numpy()
                value = weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 20 * m[start:][document]))
                stop = start + len(some)
                best.add(sums.scores(document, term, value, len(some)), ids[start:stop], null[start:stop])
        item, score, doc, null = best.prune()
        if len(item):
            yield pa.RecordBatch.from_arrays(
                [pa.array(sums.full[item].astype(np.int32)), pa.array(doc, mask=null), pa.array(score)],
                names=["item", "doc_id", "score"])

    return rank


# --- the search ------------------------------------------------------------------


def _blocks(rows: Iterator, block_items: int, block_terms: int) -> Iterator[list[tuple]]:
    """Items and their terms, in blocks that fit the driver and every task."""
    block, held = [], 0
    for key, text in rows:
        terms = set(term_frequencies(text))
        if block and (len(block) >= block_items or held + len(terms) > block_terms):
            yield block
            block, held = [], 0
        block.append((key, terms))
        held += len(terms)
    if block:
        yield block


def ranked_search(
    docs: DataFrame,
    items: DataFrame,
    *,
    k: int = 50,
    doc_key: str = "doc_id",
    item_key: str = "item_id",
    text: str = "text",
    block_items: int = BLOCK_ITEMS,
    block_terms: int = BLOCK_TERMS,
) -> DataFrame:
    """``(item, rank, document, score)``: each item's ``k`` best documents.

    Terms are runs of letters and digits of ASCII and of all characters beyond,
    A-Z in lower case. A term's weight is ``floor(1000 ln((2N+2)/(2 df+1)))``
    over the N documents with terms; a document of n terms scores, over the
    item's terms, ``weight * ((1e9 tf) div (1000 tf + 20 m))`` with
    ``m = 50 + (50 n N) div L``, L being all terms. Documents without a positive
    score are left out. Equal scores go by document key, nulls last.

    Items are a stated set: they are read in blocks of bounded size, one pass
    over the documents each. A pass writes, per document, the frequencies of
    the block's terms to the shared folder; weights come from their counts,
    and tasks then keep their own ``k`` best per item, which are ranked in two
    steps so that no item's candidates pile up in one task. These passes run
    when the plan is built.

    Null and empty texts have no terms and are not documents for N; items
    without terms, or without a document of positive score, have no rows. Rows
    with one item key, the null key too, make one item with all their terms.
    Repeated documents count and rank each. Extra columns are ignored, long
    texts are taken whole, an empty table on either side gives no rows.
    """
    spark = docs.sparkSession
    texts = F.concat_ws(" ", F.sort_array(F.collect_list(F.coalesce(text, F.lit("")))))
    queries = items.groupBy(F.col(item_key).alias("key")).agg(F.encode(texts, "UTF-8").alias("text"))
    source = docs.select(F.col(doc_key).cast("long").alias("doc_id"), F.encode(text, "UTF-8").alias("text"))
    kind = items.schema[item_key].dataType.simpleString()
    result = spark.createDataFrame([], f"`{item_key}` {kind}, rank int, `{doc_key}` long, score long")
    for block in _blocks(((r["key"], bytes(r["text"])) for r in queries.toLocalIterator()), block_items, block_terms):
        numbers = {t: i for i, t in enumerate(sorted(set().union(*(terms for _, terms in block))))}
        if not numbers:
            continue
        postings = materialise(source.mapInArrow(_postings(numbers), POSTINGS).where("n > 0"), "postings")
        size = postings.agg(F.count("*"), F.sum("n")).first()
        if not size[0]:
            break
        weights = np.zeros(len(numbers), np.int64)
        # One row per term of the block at most, whatever the corpus.
        for term, df in postings.select(F.explode("terms").alias("term")).groupBy("term").count().toLocalIterator():
            weights[term] = math.floor(1000 * math.log((2 * size[0] + 2) / (2 * df + 1)))
        graph = sharing_graph([{numbers[t] for t in terms} for _, terms in block], len(numbers))
        partial = postings.mapInArrow(_ranked(graph, weights, size[0], size[1], k), "item int, doc_id long, score long")
        order = [F.desc("score"), F.asc_nulls_last("doc_id")]
        few = (
            partial.withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(SALTS)))
            .withColumn("place", F.row_number().over(W.partitionBy("item", "salt").orderBy(*order)))
            .where(F.col("place") <= k)
        )
        ranked = few.withColumn("rank", F.row_number().over(W.partitionBy("item").orderBy(*order))).where(F.col("rank") <= k)
        keys = spark.createDataFrame([(i, key) for i, (key, _) in enumerate(block)], f"item int, key {kind}")
        result = result.unionByName(ranked.join(F.broadcast(keys), "item").select(
            F.col("key").alias(item_key), "rank", F.col("doc_id").alias(doc_key), "score"))
    return result
