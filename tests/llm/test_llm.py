"""The training-data operators against brute force, libraries and hand-made cases."""

import base64
import collections
import hashlib
import os
import random
import re
import subprocess
import sys
import tracemalloc
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from gridloom import session
from gridloom.llm import (
    bpe,
    common,
    embedding_dedup,
    exact_dedup,
    extraction,
    learning,
    ngram_join,
    packing,
    quality,
    queries,
    sharding,
    toxicity,
    warc,
)
from gridloom.llm.common import connected_components

SF_DIR = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
LONG = " ".join(f"word{i % 9000}" for i in range(60_000))

# Nulls in every column, empty and long texts, ties, rows that repeat entirely.
ROWS = [
    (1, "Same text here for all of them", "en", "s", 1), (2, "Same text here for all of them", None, None, None),
    (2, "Same text here for all of them", None, None, None), (3, "", "en", "s", 0), (4, None, None, None, None),
    (None, None, None, None, None), (None, "only null key", "de", "s", 3), (5, "a", "fr", "s", 1),
    (6, LONG, "en", "s", 2), (7, LONG + " more", "en", "s", 2), (8, " \t\n ", "es", "s", 4),
    (9, "<|endoftext|> é 你好 \x1c x  ý 's", "en", "s", 5),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, DOCS)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def clashing(docs):
    """Extra columns named as results and helpers are."""
    from pyspark.sql import functions as F

    names = ["key", "size", "fp", "sha", "row", "part", "n", "ids", "component", "node", "score", "kept", "shard",
             "grp", "rep", "label", "place", "bucket", "keep_id", "payload", "predicted", "threshold"]
    return docs.select("*", *[F.lit("x").alias(n) for n in names])


def text_of(row):
    return row[1] or ""


def test_exact_duplicates(spark, docs, none, clashing):
    got = sorted(map(tuple, exact_dedup.exact_duplicates(docs).collect()), key=str)
    assert sorted(map(tuple, exact_dedup.exact_duplicates(clashing).collect()), key=str) == got
    groups = defaultdict(list)
    for row in ROWS:
        groups[text_of(row)].append(row[0])
    assert len(got) == len(ROWS)
    for key, keep, size, _, sha in got:
        text = next(t for t in groups if hashlib.sha256(t.encode()).hexdigest() == sha)
        known = [k for k in groups[text] if k is not None]
        assert (keep, size) == (max(known, default=None), len(groups[text])) and (key in groups[text])
    assert sum(r[3] for r in got) == len(groups)  # one of each, also of rows that repeat the largest key
    assert exact_dedup.exact_duplicates(none).count() == 0
    left = exact_dedup.without_exact_duplicates(docs)
    assert left.columns == docs.columns and sorted(r["text"] or "" for r in left.collect()) == sorted(groups)


def test_filters_merge_without_loss():
    rng = np.random.default_rng(1)
    for bits in (64, 60):
        values = np.unique(rng.integers(0, 1 << 60, 500, dtype=np.uint64))
        counts = rng.integers(1, 9, len(values)).astype(np.uint64)
        parts = exact_dedup.encode_filter(values, counts, bits)
        back = exact_dedup.decode_filter(0, *parts, bits)
        assert (back[0] == values).all() and (back[1] == counts).all()


def test_byte_bpe_equals_the_library():
    own, library = bpe.BytePairCoder(open(BYTE_BPE).read()), Tokenizer.from_file(BYTE_BPE)
    library.no_padding(), library.no_truncation()
    rng = random.Random(3)
    letters = [*"abcdeAB 's't \n\n\t  0123...!?é ñüß你😀\x1c\x85\xa0 ́", "<|endoftext|>", "'ll", " the", "====", "\r\n"]
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 40))) for _ in range(4000)]
    for text in [*texts, "=" * 3000, "ab" * 3000, " " * 400 + "x", LONG[:20_000]]:
        ids = own.encode(text)
        wanted = library.encode(text, add_special_tokens=False).ids
        assert ids.tolist() == wanted
        assert own.decode(ids) == library.decode(wanted, skip_special_tokens=False)


def test_bpe_tables(docs, none, clashing):
    library = Tokenizer.from_file(BYTE_BPE)
    library.no_padding(), library.no_truncation()
    got = sorted(map(tuple, bpe.round_trip_digests(clashing, BYTE_BPE).collect()), key=str)
    wanted = []
    for row in ROWS:
        ids = library.encode(text_of(row), add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        wanted.append((row[0], len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                       hashlib.sha256(decoded.encode()).hexdigest()))
    assert got == sorted(wanted, key=str)
    assert bpe.round_trip_digests(none, BYTE_BPE).count() == 0
    back = {r["doc_id"]: r["text"] for r in bpe.decode(bpe.encode(docs, BYTE_BPE), BYTE_BPE).collect()}
    assert back[6] == LONG and back[4] == "" and back[9] == ROWS[-1][1]


def check_packing(rows, pieces):
    library = Tokenizer.from_file(WORD_BPE)
    library.no_padding(), library.no_truncation()
    wanted = sorted((r[0] is None, r[0] or 0, len(library.encode(text_of(r), add_special_tokens=False).ids) + 1) for r in rows)
    sequences, by_doc = defaultdict(list), defaultdict(list)
    for p in pieces:
        sequences[p["sequence_id"]].append((p["offset"], p["length"]))
        by_doc[p["doc_id"]].append(p)
    for own in sequences.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at and length > 0
            at += length
        assert at <= 4096
    assert sorted(sequences) == list(range(len(sequences)))
    assert sum(p["length"] for p in pieces) == sum(w[2] for w in wanted)
    total = sum(sum(n for _, n in own) for own in sequences.values())
    room = sum(t if t & (t - 1) == 0 else 4096 for t in (sum(n for _, n in own) for own in sequences.values()))
    assert total >= 0.99 * room
    for row in rows:
        if sum(r[0] == row[0] for r in rows) == 1:
            ids = [*library.encode(text_of(row), add_special_tokens=False).ids, 2]
            at = 0
            for p in sorted(by_doc[row[0]], key=lambda p: p["start"]):
                own = np.array(ids[p["start"]:p["start"] + p["length"]], "<u4").tobytes()
                assert p["start"] == at and zlib.crc32(own) == p["ids_crc32"] and p["doc_tokens"] == len(ids)
                at += p["length"]
            assert at == len(ids)


def test_packing(spark, clashing, none):
    check_packing(ROWS, packing.packed_pieces(clashing, WORD_BPE).collect())
    table = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    check_packing([tuple(r) for r in table.collect()], packing.packed_pieces(table, WORD_BPE, with_ids=False).collect())
    assert packing.packed_pieces(none, WORD_BPE).count() == 0


def test_filters_are_in_proportion_to_their_fingerprints():
    """Bytes per fingerprint of 16 tasks, from half a million to eight million rows."""
    rng, bytes_each = np.random.default_rng(3), []
    for n in (1 << 19, 1 << 21, 1 << 23):
        rest_bits = 64 - (n // exact_dedup.BLOCK_ROWS).bit_length()
        own = np.sort(rng.integers(0, 2**64 - 1, n // 16, dtype=np.uint64))  # one of the tasks
        blocks = own >> np.uint64(rest_bits)
        edges = np.r_[np.flatnonzero(np.r_[True, blocks[1:] != blocks[:-1]]), len(own)]
        size = sum(len(part) for x, y in zip(edges, edges[1:])
                   for part in exact_dedup.encode_filter(own[x:y], np.ones(y - x, np.uint64), rest_bits))
        bytes_each.append(size / len(own))
    assert max(bytes_each) < 11


def test_names_of_columns_do_not_matter_when_copies_go(spark):
    rows = [(1, "a", 5, 6, 7), (2, "a", 5, 6, 7), (2, "a", 5, 6, 8), (3, None, 1, 1, 1), (4, "", 1, 1, 1), (None, "b", 0, 0, 0)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, __key int, sha int, __sha int")
    frame = frame.withColumn("key", frame.sha).withColumn("_key", frame.sha).withColumn("__rank", frame.sha)
    left = exact_dedup.without_exact_duplicates(frame)
    assert left.columns == frame.columns
    assert sorted((r["doc_id"] or 0, r["text"]) for r in left.collect()) == [(0, "b"), (2, "a"), (4, "")]
    near = ngram_join.without_near_duplicates(frame)
    assert near.columns == frame.columns
    assert sorted({(r["doc_id"] or 0, r["text"]) for r in near.collect()}, key=str) == [(0, "b"), (1, "a"), (3, None), (4, "")]


def test_packing_layouts():
    rng = random.Random(5)
    for _ in range(100):
        capacity = rng.choice([8, 64, 256])
        histogram = {rng.randint(1, capacity): rng.randint(1, 40) for _ in range(rng.randint(1, 20))}
        layout = packing.Layout(packing.pack_histogram(histogram, capacity), capacity, rng.choice([0, 2, 8]))
        sequences = defaultdict(list)
        for length, count in histogram.items():
            for rank in range(count):
                at = 0
                for start, take, sequence, offset in layout.find(length, rank):
                    assert start == at
                    at += take
                    sequences[sequence].append((offset, take))
                assert at == length
        assert sorted(sequences) == list(range(layout.sequences))
        for own in sequences.values():
            ends = [o + n for o, n in sorted(own)]
            assert [o for o, _ in sorted(own)] == [0, *ends[:-1]] and ends[-1] <= capacity


def jump(key: int, shards: int) -> int:
    key, b, j = key % 2**64, -1, 0
    while j < shards:
        b = j
        key = (key * 2862933555777941757 + 1) % 2**64
        j = int((b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return b


def test_sharding(clashing, none):
    got = sharding.shard_table(clashing).collect()
    assert len(got) == len(ROWS)
    slots = defaultdict(list)
    for r in got:
        key = r["doc_id"] or 0
        assert (r["shard"], r["grown_shard"], r["law"]) == (jump(key, 24), jump(key, 25), "key")
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    crcs = sorted((r["size"], r["text_crc32"]) for r in got)
    assert crcs == sorted((len(text_of(r).encode()) + 8, zlib.crc32(text_of(r).encode())) for r in ROWS)
    assert sharding.shard_table(none).count() == 0


def test_jump_moves_rows_only_into_the_new_shard(spark):
    keys = [0, 1, -1, 2**63 - 1, -(2**63), *range(10**6, 10**6 + 2000)]
    frame = spark.createDataFrame([(k,) for k in keys], "k long")
    for n in (1, 2, 24):
        for r in frame.select("k", sharding.jump_shards(frame["k"], n).alias("s")).collect():
            assert (r["s"]["shard"], r["s"]["grown"]) == (jump(r["k"], n), jump(r["k"], n + 1))
            assert r["s"]["grown"] in (r["s"]["shard"], n)


def shingles(text, words=5):
    found = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
    return {tuple(found[i:i + words]) for i in range(max(1, len(found) - words + 1))} if found else set()


def brute_components(rows):
    sets = [shingles(text_of(r)) for r in rows]
    parent = {r[0]: r[0] for r in rows}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            shared = len(a & sets[j])
            if shared and 100 * shared >= 80 * len(a | sets[j]):
                x, y = root(rows[i][0]), root(rows[j][0])
                parent[max(x, y)] = min(x, y)
    return {r[0]: (len(s), root(r[0])) for r, s in zip(rows, sets)}


def test_shingle_join(spark, none, clashing):
    rng = random.Random(9)
    base = [f"w{rng.randint(0, 400)}" for _ in range(120)]
    rows = [r for r in ROWS if r[0] is not None]
    for i in range(700):  # more near copies than a block holds, some of copies of copies
        own = list(base)
        for _ in range(rng.randint(0, 3)):
            own[rng.randrange(len(own))] = f"x{rng.randint(0, 50)}"
        rows.append((100 + i, " ".join(own), "en", "s", 1))
    shared = " ".join(f"p{i}" for i in range(60))
    rows += [(2000 + i, shared + " " + " ".join(f"u{i}_{j}" for j in range(rng.randint(0, 60))), "en", "s", 1)
             for i in range(300)]
    wanted = brute_components(rows)
    got = ngram_join.shingle_components(spark.createDataFrame(rows, DOCS)).collect()
    assert len(got) == len(rows)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == wanted
    assert ngram_join.shingle_components(none).count() == 0
    again = ngram_join.shingle_components(clashing).collect()
    assert {r["doc_id"]: r["component_id"] for r in again if r["doc_id"] is not None}[2] == 1
    left = ngram_join.without_near_duplicates(clashing)
    assert left.columns == clashing.columns


def test_shingle_join_on_a_table(spark):
    table = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.shingle_components(table).collect()}
    assert got == brute_components([tuple(r) for r in table.collect()])


def test_vectors(spark):
    rng = np.random.default_rng(2)
    centre = rng.standard_normal(16)
    vectors = [rng.standard_normal(16) for _ in range(60)]
    vectors += [centre + 0.25 * rng.standard_normal(16) for _ in range(600)] + [centre] * 40
    rows = [(i, [float(x) for x in v], "x") for i, v in enumerate(vectors)]
    n = len(rows)
    odd = [None, [], [0.0] * 16, [None] + [1.0] * 15, [float("nan")] * 16, [float("inf")] * 16, [1e300] * 16, [1e-300] * 16]
    rows += [(n + i, v, "x") for i, v in enumerate(odd)] + [(None, [1.0] * 16, "x"), (n + 20, [1.0, 2.0], "x")]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, component long".replace("component long", "n string"))
    got = {r["vec_id"]: r for r in embedding_dedup.near_duplicate_vectors(frame).collect()}
    unit = np.array(vectors) / np.linalg.norm(vectors, axis=1, keepdims=True)
    near = unit @ unit.T >= 0.9
    np.fill_diagonal(near, False)
    found = sum(got[i]["n_links"] for i in range(n))
    assert found <= near.sum() and found >= 0.97 * near.sum()
    assert all(got[i]["n_links"] <= near[i].sum() for i in range(n))
    assert all(got[i]["component_id"] == 60 for i in range(660, 700)) or got[660]["component_id"] <= 660
    for i in [*range(n, n + 6), n + 20]:
        assert (got[i]["n_links"], got[i]["component_id"], got[i]["kept"]) == (0, i, True)
    assert got[n + 6]["n_links"] == got[n + 7]["n_links"] == 1 and got[n + 7]["component_id"] == n + 6
    assert got[None]["n_links"] == 0 and got[None]["component_id"] is None
    assert embedding_dedup.near_duplicate_vectors(frame.limit(0)).count() == 0


def test_components(spark):
    chain = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 100), (7, 3)], "a long, b long")
    got = {r["node"]: r["component"] for r in connected_components(chain, "a", "b").collect()}
    assert got == {i: 0 for i in range(61)}
    assert connected_components(chain.limit(0), "a", "b").count() == 0


def test_warc(spark, tmp_path):
    pages = [(1, "http://a/1", "x" * 5000), (2, "http://a/2", "x" * 5000), (3, None, None), (4, "http://a/\r\nb é", ""),
             (5, "u", "\r\n\r\nWARC/1.1\r\n\r\n" * 300), (6, "u", "é你\r\n" * 4000), (7, "u", "tail\r\n"),
             (7, "u", "tail\r\n"), (8, "u", "\r\n\r\n\r"), (None, "u", "no id"), (9, "u", "WARC/1.0\r\nContent-Length: 5\r\n\r\n")]
    frame = spark.createDataFrame([(*p, "x") for p in pages], "page_id long, url string, html string, chunk string")
    folder = str(tmp_path / "archives")
    got = warc.archived_pages(frame, folder=folder, chunk_bytes=1000).collect()
    assert len(got) == len(pages)
    keeper = {}
    for i, _, html in pages:
        keeper[html or ""] = max(keeper.get(html or "", -1), -1 if i is None else i)
    for r in got:
        payload = next((h or "") for i, _, h in pages if i == r["page_id"]).encode()
        assert r["payload_bytes"] == len(payload)
        assert r["payload_digest"] == base64.b32encode(hashlib.sha1(payload).digest()).decode()
        last = keeper[payload.decode()]
        first = r["page_id"] is None or r["page_id"] == last
        assert (r["record_type"], r["refers_to"]) == (("response", None) if first else ("revisit", last))
    chunks = [r for r in warc.read_archives(spark, folder).collect() if r["page_id"] == "6"]
    assert b"".join(r["data"] for r in sorted(chunks, key=lambda r: r["chunk"])) == ("é你\r\n" * 4000).encode()
    assert max(len(r["data"]) for r in chunks) <= 1000 and chunks[0]["url"] == b"u"
    assert warc.archived_pages(frame.limit(0)).count() == 0


PAGE = """<!DOCTYPE html><html><head><title>no</title><style>p{}</style></head><body><header>Site</header>
<nav><ul><li>menu</ul></nav><div id="cookie-notice">We use</div><script>var t="</p><p>no";</script>
<article><header><h1 class="post-header">Head&amp;line</h1></header><p>A &lt;b&gt;&nbsp;c<br>d <i>x</i>y<p>next
 line<ul><li>one<li>two</ul><form>no<input></form><!-- no --><section class="comments"><p>me too</p></section>
<aside>no</aside><div class="adSlot">no</div></article><div>after</div><footer>&copy; no"""


def test_extraction_of_a_page():
    assert extraction.Page(PAGE).text() == "Head&line\n\nA <b> c d xy\n\nnext line\n\none\n\ntwo"
    assert extraction.Page("").text() == extraction.Page("<nav>x</nav><p").text() == ""
    assert extraction.Page("plain &amp text").text() == "plain & text"
    assert extraction.Page("<p>" * 5000 + "deep").text() == "deep"


def test_extraction_keeps_article_blocks_by_their_names():
    kept = ["<section id='discussion'><p>a</p></section>", "<h2 id='related-work' class='notice'>a</h2>", "<p id='social-history'>a</p>",
            "<div class='notice-of-decision'>a</div>", "<h3 id=alert>a</h3>", "<div data-id='share'>a</div>",
            "<div id='menu-of-the-day'>a</div>", "<p class='skip-logic lead'>a</p>"]
    dropped = ["<div class='share-buttons'>a</div>", "<div class='related'>a</div>", "<div id='comments'>a</div>",
               "<div class='x relatedPosts'>a</div>", "<section class='newsletter-signup'>a</section>", "<p class='ad-300'>a</p>",
               "<div class='my-navbar-2'>a</div>"]
    for block in kept:
        assert extraction.Page(f"<article>{block}<p>end</p></article>").text() == "a\n\nend", block
    for block in dropped:
        assert extraction.Page(f"<article>{block}<p>end</p></article>").text() == "end", block
    assert extraction.Page("<div class='notice-of-decision'>a</div><p>end</p>").text() == "end"  # outside as it was


def test_extraction_takes_time_in_proportion():
    import time

    def seconds(page):
        started = time.perf_counter()
        extraction.Page(page, subtrees=True)
        return time.perf_counter() - started

    shapes = [lambda n: "<div>" * n + "</b>" * n, lambda n: "<div><b>" * n + "text", lambda n: "<b>" * n + "<p>x" * n,
              lambda n: "<div>" * n + "x" * 20 * n + "</div>" * n]
    for shape in shapes:
        seconds(shape(1000))
        assert seconds(shape(40_000)) < 16 * max(0.05, seconds(shape(5000))), shape(1)


def test_pages_are_not_shuffled(spark):
    pages = spark.createDataFrame([(i, f"http://a.example/{i}", f"<p>page {i}</p>") for i in range(20)], "page_id long, url string, html string")
    plan = extraction.main_texts(pages)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_extraction_learns_templates(spark):
    words = lambda i: f"<p>text of page {i} that differs</p>"
    pages = [(i, f"http://h.example/{i}", f"<body><div>Welcome to h</div><div>{words(i)}</div></body>", "x") for i in range(30)]
    pages += [(100 + i, f"http://c.example/{i}", "<body><div>same page</div></body>", "x") for i in range(9)]  # copies
    pages += [(200, None, None, "x"), (201, "no url", "<p>alone</p>", "x"), (None, "http://h.example/", "", "x")]
    frame = spark.createDataFrame(pages, "page_id long, url string, html string, host string")
    got = {r["page_id"]: r for r in extraction.main_texts(frame).collect()}
    assert len(got) == len(pages)
    assert all(got[i]["text"] == f"text of page {i} that differs" for i in range(30))
    assert all(got[100 + i]["text"] == "same page" for i in range(9))
    assert (got[200]["text"], got[201]["text"], got[None]["text"]) == ("", "alone", "")
    assert got[201]["n_chars"] == 5 and got[201]["url"] == "no url"
    assert extraction.main_texts(frame.limit(0)).count() == 0


def test_extraction_deletes_what_recurs_inside_articles(spark):
    box = '<div class="box"><p>Read this first</p></div>'
    page = lambda i: (f"<article><h2>Method</h2><p>story {i} of its own</p><ul><li>yes</li><li>item {i}</li></ul>"  # noqa: E731
                      f"{box}<p>end of {i} <b>Note</b></p></article><div>outside</div>")
    pages = [(i, f"http://a.example/{i}", page(i)) for i in range(12)]
    pages += [(100, "http://a.example/box", f"<main>{box}</main><div>outside</div>")]  # nothing is left, also not from outside
    pages += [(200 + i, f"http://{i}.example/", page(i)) for i in range(3)]  # seen once on its host
    got = {r["page_id"]: r["text"] for r in extraction.main_texts(
        spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    for i in range(12):
        assert got[i] == f"Method\n\nstory {i} of its own\n\nyes\n\nitem {i}\n\nend of {i} Note"
    assert got[100] == "" and all("Read this first" in got[200 + i] for i in range(3))


def test_extraction_keeps_near_copies_and_shared_passages(spark):
    story = [f"paragraph {k} of the one story that was copied" for k in range(4)]
    near = lambda i: "".join(f"<p>{t}</p>" for t in [*story, f"changed {i}"])
    quote = "<p>a passage that several stories quote</p>"
    own = lambda i: f"<p>page {i} says something of its own</p>{quote if i % 5 == 0 else ''}"
    site = "<div>Site notice</div>"
    pages = [(i, f"http://small.example/{i}", f"<body>{site}<div>{near(i)}</div></body>") for i in range(3)]
    pages += [(i, f"http://small.example/{i}", f"<body>{site}<div>{own(i)}</div></body>") for i in range(5, 25)]
    pages += [(100 + i, f"http://tiny.example/{i}", f"<body><div>{near(i)}</div></body>") for i in range(3)]
    got = {r["page_id"]: r["text"] for r in extraction.main_texts(
        spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    for i in range(3):
        assert got[i] == got[100 + i] == "\n\n".join([*story, f"changed {i}"])
    for i in range(5, 25):
        assert got[i].split("\n\n") == [f"page {i} says something of its own",
                                        *(["a passage that several stories quote"] if i % 5 == 0 else [])]


def rows_of(kind, n, seed):
    rng = random.Random(seed)
    words = [f"{a}{b}{c}" for a in "bdfgk" for b in "aeiou" for c in ("rem", "lis", "ton", "va")]
    for i in range(n):
        own = [rng.choice(words) for _ in range(rng.randint(20, 120))]
        yes = i % 2
        if kind == "toxic" and yes:
            for _ in range(3):
                own[rng.randrange(len(own))] = "scoundrel" + rng.choice(["", "s", "ly"])
        text = ". ".join(" ".join(own[k:k + 6]) for k in range(0, len(own), 6)) + "."
        if kind == "quality" and not yes:
            text = " ".join(w + rng.choice(["%%%", "$$$"]) for w in own)
        yield text, yes, "en"


@pytest.mark.parametrize("kind, module", [("toxic", toxicity), ("quality", quality)])
def test_classifiers_learn(kind, module):
    model = module.train(list(rows_of(kind, 900, 1)))
    held = list(rows_of(kind, 300, 2))
    scores = module._Scorer(model).scores([h[0] for h in held])
    right = (scores >= module.CUT) == np.array([h[1] for h in held])
    assert right.mean() > 0.97
    one = module._Scorer(model).scores([held[0][0]])[0]
    assert abs(one - scores[0]) < 1e-4  # whatever stands beside it
    far = held[1][0] if kind == "toxic" else held[0][0]
    calm = held[0][0] if kind == "toxic" else held[1][0]
    long = " ".join([calm] * 300 + [far])
    assert module.CUT <= module._Scorer(model).scores([long])[0] or kind == "quality"


def test_quality_of_a_long_text_does_not_depend_on_the_pieces(monkeypatch):
    model = quality.train(list(rows_of("quality", 200, 1)), epochs=1)
    text = " ".join(t for t, _, _ in rows_of("quality", 60, 4))
    whole = quality._Scorer(model).scores([text])[0]
    monkeypatch.setattr(quality, "SCORED_BYTES", 1024)
    assert abs(quality._Scorer(model).scores([text])[0] - whole) < 1e-5


@pytest.mark.parametrize("query, folds, held, cut, label", [
    (toxicity.toxicity_scores, 4, 2, 0.3, "toxic"), (quality.quality_scores, 3, 1, 0.5, "quality")])
def test_classifier_queries(spark, docs, none, clashing, query, folds, held, cut, label):
    base = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    got = query(base, labels).collect()
    assert len(got) == base.count()
    known = {r["doc_id"]: r[label] for r in labels.collect()}
    for r in got:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % folds == held)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= cut)
    judged = [(r["predicted"], known[r["doc_id"]]) for r in got if r["held_out"] and r["doc_id"] in known]
    assert sum(p == y for p, y in judged) / len(judged) > 0.85
    assert query(none, labels).count() == 0
    few = query(clashing, labels.limit(0)).collect()  # no labels: nothing is held against anyone
    assert len(few) == len(ROWS) and all(r["predicted"] == (label == "quality") for r in few)


def test_labels_of_the_held_out_fold_are_not_read(spark):
    docs = spark.createDataFrame([(i, f"text {i}", "en") for i in range(40)], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)] + [(None, 1)], "doc_id long, toxic int")
    rows = learning.training_rows(docs, labels, "toxic", folds=4, held=2)
    assert {r[0] for r in rows} == {f"text {i}" for i in range(40) if zlib.crc32(str(i).encode()) % 4 != 2}


def test_the_sample_is_full_whatever_labels_lack_documents(spark):
    docs = [(i, "long " * 100 if i % 2 else f"text {i}", "en") for i in range(40)] + [(4, f"copy {i}", "en") for i in range(50)]
    docs = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, i // 2 % 2) for i in range(4000)], "doc_id long, toxic int")  # most have no document
    rows = learning.training_rows(docs, labels, "toxic", folds=4, held=2, per_class=5, most_bytes=100)
    assert sorted(r[1] for r in rows) == [0] * 5 + [1] * 5
    every = learning.training_rows(docs, labels, "toxic", folds=4, held=2, most_bytes=100)
    keys = [i for i in range(0, 40, 2) if zlib.crc32(str(i).encode()) % 4 != 2]
    assert sorted(r[0] for r in every) == sorted("copy 0" if i == 4 else f"text {i}" for i in keys)


@pytest.fixture(scope="module")
def duck():
    import oracle

    return oracle.connect(SF_DIR)


@pytest.mark.parametrize("name", list(queries.SQL))
def test_sql(spark, duck, name):
    import oracle

    assert oracle.compare(queries.QUERIES[name](spark, SF_DIR), duck, queries.SQL[name]) is None


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert len(names) == 5
    sizes = [docs.count()]
    for name, stage in corpus_pipeline.STAGES:
        before = {r["doc_id"]: r["text"] for r in docs.collect()}
        docs = corpus_pipeline.materialise(stage(spark, docs, SF_DIR), "test-stage")
        if name == names[-1]:
            assert {r["doc_id"] for r in docs.collect()} == set(before)
            continue
        after = {r["doc_id"]: r["text"] for r in docs.collect()}
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        if name == "exact dedup":
            last = {}
            for i, text in before.items():
                last[text] = max(i, last.get(text, i))
            assert set(after) == set(last.values())
        elif name == "n-gram jaccard join":
            wanted = brute_components([(i, t) for i, t in before.items()])
            assert set(after) == {i for i, (_, c) in wanted.items() if i == c}
        else:
            assert set(after) < set(before) and len(after) > 0.6 * len(before)
        sizes.append(len(after))
    assert corpus_pipeline.ORACLE_SQL is None


def test_table_plan():
    k, tables = embedding_dedup.table_plan(10**9, 0.9, 0.995)
    assert k > 10 and tables > 20
    assert 0.8 < embedding_dedup.collision(0.447, 2.0) < 0.85


def test_packing_words_are_encoded_as_by_the_tokenizer(monkeypatch):
    """Plain words go to the bare model and all ids to one array; caches of a few words turn over."""
    vocabulary = public_tokenizers.path("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(vocabulary)
    rng = random.Random(3)
    letters = "aeEÉéñÑßøŸžĳĲſİıŉ日s't0_" + "".join(map(chr, range(0xc0, 0x17f)))
    texts = ["", "  ", "a\x1cb c", "​ x", "éte é.", "don't THE'RE.", "ﬁ ... !!! $$ .,;", "İstanbul. Σας ΣΑΣ,"]
    for _ in range(300):
        texts.append(" ".join("".join(rng.choice(letters[:24] if rng.random() < 0.5 else letters)
                                      for _ in range(rng.randint(1, 9)))
                              + rng.choice(["", "", ".", "%%%", ",.", "#|"]) for _ in range(40)))
    monkeypatch.setattr(packing, "CACHED_WORDS", 2000)
    words = packing._Words(bpe._read(vocabulary))
    assert all(isinstance(cache, packing._Pieces) for cache in words.caches)  # one array, no object for each word
    for _ in range(2):
        for at in range(0, len(texts), 50):
            some = texts[at:at + 50]
            assert [np.frombuffer(ids, "<u4").tolist() for ids in words.encode(some)] == [
                tokenizer.encode(text, add_special_tokens=False).ids for text in some]


def test_tasks_hold_few_rows_as_objects(monkeypatch):
    """One large batch of texts comes back in parts, described, grouped and tokenised as before."""
    monkeypatch.setattr(common, "SLICE_ROWS", 7)
    texts = [" ".join(f"w{i % 50 + j}" for j in range(20)) for i in range(100)]
    batch = pa.record_batch({"key": pa.array(range(100), pa.int64()), "text": pa.array(texts)})
    described = list(ngram_join._describe(5)(iter([batch])))
    assert [len(b) for b in described[:-1]] == [7] * 14 + [2]
    assert [k for b in described[:-1] for k in b.column("key").to_pylist()] == list(range(100))
    wanted = collections.Counter(int(t) >> 42 for text in texts for t in ngram_join.Shingles(5).of(text))
    often = dict(zip(described[-1].column("bucket").to_pylist(), described[-1].column("count").to_pylist()))
    assert often == {k: n for k, n in wanted.items() if n > 2 + 2 * sum(wanted.values()) / (1 << ngram_join.COUNTER_BITS)}
    prefixes = list(ngram_join._prefixes(5, (np.empty(0, int), np.empty(0, int)), 80)(iter([batch])))
    assert max(map(len, prefixes)) == 7 and sum(map(len, prefixes)) == 100
    groups = pa.record_batch({"grp": pa.array([i // 30 for i in range(100)], pa.int64()), "text": pa.array(texts)})
    assert [(k, g["text"]) for k, g in common.sorted_groups(iter([groups, groups.slice(90)]), "grp")] == [
        (0, texts[:30]), (1, texts[30:60]), (2, texts[60:90]), (3, texts[90:] * 2)]


def test_packing_looks_up_a_piece_once_for_many_texts():
    """Repeats of a word cost no lookup, and the older cache is asked, not walked through."""
    asked = []

    class Places(dict):
        def get(self, word, *default):
            asked.append(word)
            return super().get(word, *default)

        def __iter__(self):
            raise AssertionError("walks through a cache")

    tokenizer = Tokenizer.from_file(WORD_BPE)
    words = packing._Words(bpe._read(WORD_BPE))
    words.caches[:] = packing._Pieces(), packing._Pieces()
    assert words.encode(["zyx old"])
    words.caches[:] = packing._Pieces(), words.caches[0]
    for cache in words.caches:
        cache.places = Places(dict.items(cache.places))
    texts = ["The cat, the CAT.  Zyx | don't " * 300] * 3
    wanted = tokenizer.encode(texts[0], add_special_tokens=False).ids
    assert [np.frombuffer(ids, "<u4").tolist() for ids in words.encode(texts)] == [wanted] * 3
    assert max(collections.Counter(asked).values()) <= 2  # once in each cache
    assert len(asked) <= 2 * len({"", "the", "cat", "zyx", "|", "don't", ",", "."})


def test_packing_splits_texts_where_the_tokenizer_does(monkeypatch):
    monkeypatch.setattr(packing, "GATHERED_WORDS", 5)
    tokenizer = Tokenizer.from_file(WORD_BPE)
    spaces = [chr(c) for c in range(0x110000) if chr(c).isspace()] + list("᠎​‍⁠﻿\x00\x7f")
    texts = [f"{c}One{c}{c}two, {c} three{c}" for c in spaces]
    texts += ["", " ", "a<|endoftext|>b <|startoftext|>", "x " * 50, "\U0001f600́ é 日本.", chr(0x17f) + "t"]
    words = packing._Words(bpe._read(WORD_BPE))
    wanted = [tokenizer.encode(text, add_special_tokens=False).ids for text in texts]
    for column in (texts, pa.array(texts, pa.string()), pa.array(["cut", *texts], pa.large_string()).slice(1)):
        assert [np.frombuffer(ids, "<u4").tolist() for ids in words.encode(column)] == wanted
    assert words.encode([]) == []


def test_packing_parts_are_bounded_by_rows_and_bytes(monkeypatch):
    monkeypatch.setattr(packing, "PART_BYTES", 10)
    monkeypatch.setattr(packing, "PART_ROWS", 4)
    texts = ["abc", None, "defg", "hij", "k" * 25, None, None, None, None, "", "l" * 11, "m"]
    batch = pa.record_batch({"key": pa.array(range(len(texts)), pa.int64()), "text": pa.array(texts)})
    parts = list(packing._parts(iter([batch.slice(0, 0), batch, batch.slice(3, 2)])))
    assert [part.column(1).to_pylist() for part in parts] == [
        ["abc", None, "defg", "hij"], ["k" * 25], [None, None, None, None], [""], ["l" * 11], ["m"], ["hij"], ["k" * 25]]
    assert [k for part in parts for k in part.column(0).to_pylist()] == [*range(len(texts)), 3, 4]


_WORKER = """
import re, sys, threading, time
import numpy as np, pandas, pyarrow as pa
import public_tokenizers
from gridloom.llm import common, packing

def held():
    return sum(map(int, re.findall(r"Pss_(?:Anon|Shmem):\\s+(\\d+)", open("/proc/self/smaps_rollup").read()))) // 1024

class Context:
    get = classmethod(lambda cls: cls)
    partitionId = staticmethod(lambda: 0)

packing.TaskContext = Context
spec = packing._read(public_tokenizers.path("word_bpe_49k.json"))
packing._Words(spec)
common.give_back()
start, most, going = held(), 0, True

def watch():
    global most
    while going:
        most = max(most, held())
        time.sleep(0.01)

def batches():  # 16 of 2 MB, of 25,000 words each that no other has
    rng = np.random.default_rng(3)
    letters = np.frombuffer(b"abcdefghijklmnopqrstuvwxyz", np.uint8)
    for n in range(16):
        words = [bytes(w).decode() for w in letters[rng.integers(0, 26, (25_000, 9))]]
        texts = [" ".join(words[i] for i in rng.integers(0, 25_000, 200)) for _ in range(1000)]
        yield pa.record_batch({"key": pa.array(range(1000), pa.int64()), "text": pa.array(texts, pa.string())})

given = list(batches())
common.give_back()
start, watcher = held(), threading.Thread(target=watch)
watcher.start()
rows = sum(b.num_rows for b in packing._tokenise(spec, 4096, 2)(iter(given)))
going = False
watcher.join()
print(rows, most - start, held() - start)
"""


def test_packing_tasks_hold_little_memory():
    run = subprocess.run([sys.executable, "-c", _WORKER], capture_output=True, text=True, timeout=300,
                         cwd=os.path.dirname(corpus_pipeline.__file__))
    rows, most, after = map(int, run.stdout.split())
    assert rows == 16_000 and most < 120 and after < 80, (rows, most, after)


def test_overlaps_are_multiplied_in_small_parts(monkeypatch):
    rng = np.random.default_rng(8)
    some, others = ([np.unique(rng.integers(0, 30_000, n)).astype(np.uint64) for n in rng.integers(0, 600, 200)]
                    for _ in range(2))
    wanted = [[len(np.intersect1d(a, b)) for b in others] for a in some]
    tracemalloc.start()
    try:
        found = ngram_join.overlaps(some, others)
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert found.tolist() == wanted and most < 24 << 20
    monkeypatch.setattr(ngram_join, "MATRIX_BYTES", 4 * 400 * 7)
    assert ngram_join.overlaps(some, others).tolist() == wanted
    assert ngram_join.overlaps([np.empty(0, np.uint64)], [np.empty(0, np.uint64)] * 2).tolist() == [[0, 0]]


def test_tables_are_sent_to_tasks_in_small_batches(spark):
    before = spark.conf.get(session.BATCH_SETTING)
    sizes = lambda batches: (pa.record_batch({"n": [b.num_rows]}) for b in batches)
    rows = spark.range(4000, numPartitions=1).select(F.repeat(F.lit("a"), 1000).alias("text"))
    assert max(r["n"] for r in session.materialise(rows.mapInArrow(sizes, "n long"), "sizes").collect()) == 4000
    small = session.materialise(rows.mapInArrow(sizes, "n long"), "sizes", batch_bytes=1 << 18).collect()
    assert sum(r["n"] for r in small) == 4000 and max(r["n"] for r in small) < 500
    assert spark.conf.get(session.BATCH_SETTING) == before


def test_tasks_give_back_when_they_begin_and_end(monkeypatch):
    seen = []
    monkeypatch.setattr(common, "give_back", lambda: seen.append("back"))
    task = common.giving_back(lambda batches: (seen.append(b) or b for b in batches))
    assert list(task(iter("ab"))) == ["a", "b"] and seen == ["back", "a", "b", "back"]


def test_quality_scores_few_bytes_at_a_time():
    scorer, texts = quality._Scorer(quality.train([])), [f"{i} words and marks, " * 250 for i in range(400)]
    wanted = [scorer.scores([text])[0] for text in texts[::40]]
    tracemalloc.start()
    try:
        found = scorer.scores(texts)
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert np.allclose(found[::40], wanted, atol=1e-6) and most < 60 << 20
