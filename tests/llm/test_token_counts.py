"""Token counts against the tokenizers library."""

import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from gridloom.llm import queries, token_counts

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(BYTE_BPE)


@pytest.fixture(scope="module")
def vocabulary():
    with open(BYTE_BPE, encoding="utf-8") as file:
        return token_counts.proved_vocabulary(file.read())


def test_what_is_proved_whole_is_one_token(library, vocabulary):
    whole = sorted(vocabulary.whole)
    assert len(whole) > 49_000
    alone = library.encode_batch([w for w in whole if w in (" the", "the", "ing", "\n\n", " ", "é")], add_special_tokens=False)
    assert [len(e.ids) for e in alone] == [1] * 6
    assert "<|endoftext|>" not in vocabulary.whole


def test_random_texts(library, vocabulary):
    counter, rng = token_counts.TokenCounter(vocabulary), random.Random(5)
    letters = [*"ab'sS tT 1  \n\t\x1c\x85\xa0éñ你😀.,<|>", "<|endoftext|>", "'ll", "the ", " ", " "]
    texts = ["".join(rng.choice(letters) if rng.random() < 0.9 else
                     chr(rng.choice([rng.randrange(32, 0x2FFF), rng.randrange(0x10000, 0x4FFFF)]))
                     for _ in range(rng.randint(0, 40))) for _ in range(8000)]
    texts += [f"a{c}1 {c}'ll" for c in vocabulary.unassigned[::50]]
    wanted = [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]
    assert [counter.count(t) for t in texts] == wanted


def test_both_ways_of_merging_and_blocks(library, vocabulary, monkeypatch):
    rng = random.Random(6)
    words = ["".join(rng.choice("abeinorst") for _ in range(rng.randint(1, 60))) for _ in range(400)]
    parts = [token_counts.merged_parts(w, vocabulary.ranks) for w in words]
    assert parts == [token_counts._merged_by_heap(w, vocabulary.ranks) for w in words]
    long = " ".join(words) + "  tail\n" + "x" * 50_000 + " end"
    wanted = len(library.encode(long, add_special_tokens=False).ids)
    monkeypatch.setattr(token_counts, "BLOCK_CHARS", 100)
    monkeypatch.setattr(token_counts, "REMEMBERED", 50)
    assert token_counts.TokenCounter(vocabulary).count(long) == wanted


def test_vocabularies_of_another_kind_are_refused():
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as file:
        with pytest.raises(ValueError):
            token_counts.proved_vocabulary(file.read())


def test_edge_cases(spark, library):
    rows = [(1, "a b", "en", "s", 1), (1, "a b", "en", "s", 1), (2, None, None, None, None), (None, "é", None, None, 3),
            (3, "", "en", "s", 0), (4, "word " * 600, "en", "s", 2), (5, "a<|endoftext|>b", "en", "s", 2)]
    docs = spark.createDataFrame(rows, DOCS)
    for extra in ("key", "n_tokens", "n_bytes", "over_limit"):
        docs = docs.withColumn(extra, docs.doc_id)
    got = token_counts.token_counts(docs, BYTE_BPE)
    assert got.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    wanted = []
    for key, text, *_ in rows:
        n = len(library.encode(text or "", add_special_tokens=False).ids)
        wanted.append((key, len((text or "").encode()), n, n > 512))
    by = lambda r: (r[0] is None, r)
    assert sorted(map(tuple, got.collect()), key=by) == sorted(wanted, key=by)
    assert token_counts.token_counts(docs.limit(0), BYTE_BPE).count() == 0


def test_query(spark, library):
    sf_dir = "/root/testdata/sf0.01"
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    got = {r["doc_id"]: r["n_tokens"] for r in queries.QUERIES["op13_token_counts"](spark, sf_dir).collect()}
    wanted = library.encode_batch(list(texts.values()), add_special_tokens=False)
    assert got == {i: len(e.ids) for i, e in zip(texts, wanted)}
