"""Ranked search against a plain evaluation of its definition."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from gridloom.llm import lexical_search, queries

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_terms(text):
    return TERM.findall((text or "").translate(UPPER))


def plain_search(docs, items, k):
    """``(item, rank, document, score)`` by going through all pairs."""
    held = [(i, Counter(plain_terms(t))) for i, t in docs]
    held = [(i, c) for i, c in held if c]
    n_docs, length = len(held), sum(c.total() for _, c in held)
    df = Counter(t for _, c in held for t in c)
    rows, wanted = [], {}
    for key, text in items:
        wanted.setdefault(key, set()).update(plain_terms(text))
    for key, terms in wanted.items():
        found = []
        for i, c in held:
            m = 50 + 50 * c.total() * n_docs // length
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                        * (1_000_000_000 * c[t] // (1000 * c[t] + 20 * m)) for t in terms if c[t])
            if score > 0:
                found.append((-score, i is None, i or 0, i))
        rows += [(key, rank, f[3], -f[0]) for rank, f in enumerate(sorted(found)[:k], 1)]
    return rows


def by(row):
    return tuple((v is None, v or 0) for v in row)


def same(frame, wanted):
    assert sorted(map(tuple, frame.collect()), key=by) == sorted(wanted, key=by)


def test_terms(monkeypatch):
    text = "A_b É-é x\x00y Ünïcode 12,5 \x7f\x80ab" + " word" * 50
    wanted = Counter(t.encode() for t in plain_terms(text))
    assert lexical_search.term_frequencies(text.encode()) == wanted
    monkeypatch.setattr(lexical_search, "BLOCK_BYTES", 7)
    assert lexical_search.term_frequencies(text.encode()) == wanted


@pytest.mark.parametrize("mined", [2_000, 3])
def test_the_graph_adds_up_what_the_items_hold(monkeypatch, mined):
    monkeypatch.setattr(lexical_search, "MINED_GROUPS", mined)
    rng = random.Random(7)
    topics = [rng.sample(range(120), 9) for _ in range(6)]
    items = [set(rng.sample(range(120), rng.randint(0, 8))).union(*rng.sample(topics, rng.randint(0, 2))) for _ in range(40)]
    items += [set(), items[3], items[3]]
    graph = lexical_search.sharing_graph(items, 120)
    sums = lexical_search.Accumulators(graph)
    doc, term = (np.array(c) for c in zip(*[(d, t) for d in range(30) for t in rng.sample(range(120), 25)]))
    value = np.array([rng.randrange(1, 10**10) for _ in doc])
    got = sums.scores(doc, term, value, 30)
    assert [i for i, own in enumerate(items) if own] == sums.full.tolist()
    for row, i in zip(got, sums.full):
        wanted = np.zeros(30, np.int64)
        for d, t, v in zip(doc, term, value):
            wanted[d] += v if t in items[i] else 0
        assert (row == wanted).all()
    plain = sum(max(0, len(own) - 1) for own in items)
    assert graph.additions() < plain
    if mined > 3:
        assert graph.nodes > graph.leaves and graph.additions() < 0.75 * plain


def test_the_best_of_many_blocks():
    rng = np.random.default_rng(1)
    best = lexical_search._Best(3, 5)
    scores, ids = rng.integers(0, 40, (3, 4000)), rng.permutation(4000)
    for start in range(0, 4000, 100):
        some = slice(start, start + 100)
        best.add(scores[:, some], ids[some], np.zeros(100, bool))
    item, score, doc, _ = best.prune()
    for i in range(3):
        wanted = sorted((-s, d) for s, d in zip(scores[i], ids))[:5]
        assert [(-s, d) for s, d in zip(score[item == i], doc[item == i])] == wanted


def test_edge_cases_and_blocks(spark):
    rng = random.Random(8)
    words = [a + b for a in "bcdfgklmé" for b in ("a", "o", "rem", "Lis")]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    docs = [(i, text(rng.randint(1, 40))) for i in range(300)]
    docs += [(500, None), (501, ""), (502, " ,;"), (None, docs[0][1]), (None, None), (7, docs[7][1]), (7, docs[7][1]),
             (600, text(40_000)), (601, docs[0][1]), (602, docs[0][1])]
    items = [(i, text(rng.randint(1, 12))) for i in range(20)] + [
        (30, None), (31, ""), (32, "unheard of"), (None, "ba bo"), (3, "gLis"), (33, docs[0][1]), (34, docs[0][1])]
    docs_frame = spark.createDataFrame([(*d, "en", "s", 1) for d in docs], DOCS).repartition(5)
    items_frame = spark.createDataFrame(items, "item_id long, text string")
    for extra in ("item", "term", "n", "score", "rank", "salt", "key"):
        docs_frame = docs_frame.withColumn(extra, docs_frame.n_chars)
        items_frame = items_frame.withColumn(extra, items_frame.item_id)
    wanted = plain_search(docs, items, 9)
    got = lexical_search.ranked_search(docs_frame, items_frame, k=9)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    same(got, wanted)
    same(lexical_search.ranked_search(docs_frame, items_frame, k=9, block_items=4, block_terms=30), wanted)
    assert lexical_search.ranked_search(docs_frame.limit(0), items_frame).count() == 0
    assert lexical_search.ranked_search(docs_frame, items_frame.limit(0)).count() == 0


def test_query(spark):
    sf_dir = "/root/testdata/sf0.01"
    docs = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()]
    same(queries.QUERIES["op12_lexical_search"](spark, sf_dir), plain_search(docs, items, 50))
