"""Token counts by a whole-token shortcut.

Most pre-tokens of a text are vocabulary strings that the merges put together
to exactly one token. Which strings are that is proved once per vocabulary, by
running the merges on every one of them. Tasks then count such pre-tokens by
looking them up and run the merges only on the rest. No ids are made.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers.pre_tokenizers import ByteLevel

from gridloom.llm.bpe import PATTERN, byte_letters
from gridloom.llm.common import arrow_rows, texts_of

BLOCK_CHARS = 1 << 20  # a text is worked on in blocks of about this length
REMEMBERED = 300_000  # chunks whose count is kept; forgotten ones are counted again
REMEMBERED_CHARS = 64
SCANNED_LETTERS = 64  # longer pre-tokens are merged with a heap

_NEVER = 1 << 30

# White space next to a space; elsewhere every space starts a pre-token.
_IRREGULAR = re.compile(r" \s|\s ")
# A space that starts a pre-token wherever it stands.
_BORDER = re.compile(r"(?<=[!-~]) (?=[!-~])")

_proved: dict[str, Vocabulary] = {}


def merged_parts(letters: str, ranks: dict[tuple[str, str], int]) -> list[str]:
    """What the merges make of one pre-token given as byte letters.

    The pair of lowest rank goes first, of equal ones the leftmost.
    """
    if len(letters) > SCANNED_LETTERS:
        return _merged_by_heap(letters, ranks)
    parts, rank_of = list(letters), ranks.get
    open_pairs = [rank_of(pair, _NEVER) for pair in zip(letters, letters[1:])]
    while open_pairs and (least := min(open_pairs)) != _NEVER:
        i = open_pairs.index(least)
        parts[i] += parts.pop(i + 1)
        del open_pairs[i]
        if i < len(open_pairs):
            open_pairs[i] = rank_of((parts[i], parts[i + 1]), _NEVER)
        if i:
            open_pairs[i - 1] = rank_of((parts[i - 1], parts[i]), _NEVER)
    return parts


def _merged_by_heap(letters: str, ranks: dict[tuple[str, str], int]) -> list[str]:
    """The same by a heap of pairs over a linked list: n log n, also for a
    pre-token of a million bytes."""
    parts: list[str | None] = list(letters)
    n = len(parts)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(rank, i) for i in range(n - 1) if (rank := ranks.get((parts[i], parts[i + 1]))) is not None]
    heapq.heapify(heap)
    while heap:
        rank, i = heapq.heappop(heap)
        j = after[i] if parts[i] is not None else n
        if j >= n or ranks.get((parts[i], parts[j])) != rank:
            continue  # one of the two has become part of another token
        parts[i] += parts[j]
        parts[j] = None
        k = after[i] = after[j]
        if k < n:
            before[k] = i
            if (rank := ranks.get((parts[i], parts[k]))) is not None:
                heapq.heappush(heap, (rank, i))
        h = before[i]
        if h >= 0 and (rank := ranks.get((parts[h], parts[i]))) is not None:
            heapq.heappush(heap, (rank, h))
    return [p for p in parts if p is not None]


@dataclass
class Vocabulary:
    """What tasks need of a vocabulary file; its size is that of the file."""

    whole: frozenset[str]  # pre-tokens proved to be one token
    ranks: dict[tuple[str, str], int]
    special: tuple[str, ...]
    unassigned: str  # characters that only newer tables than the library's call letters or numbers


def unassigned_characters() -> str:
    """Characters that the pattern's classes take for letters or numbers and the
    tokenizers library, whose Unicode tables are older, for neither.

    Only characters that Python's own, still older tables lack can be such; the
    library is asked about each of them.
    """
    split = ByteLevel(add_prefix_space=False, use_regex=True).pre_tokenize_str
    named = regex.compile(r"[\p{L}\p{N}]")
    new = (chr(i) for i in range(0x80, 0x110000) if unicodedata.category(chr(i)) == "Cn")
    # "%" joins neither letters nor numbers, so it stays apart from either.
    return "".join(c for c in new if named.match(c) and len(split("%" + c)) == 1)


def proved_vocabulary(specification: str) -> Vocabulary:
    """Read a byte-level BPE of the tokenizers library (its JSON text) and prove
    which of its strings encode alone as one token."""
    spec = json.loads(specification)
    model = spec["model"]
    pre = spec["pre_tokenizer"] or {}
    plain = (model["type"] == "BPE" and not spec["normalizer"] and not model.get("end_of_word_suffix")
             and not model.get("continuing_subword_prefix") and not model.get("ignore_merges")
             and pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space"))
    if not plain:
        raise ValueError("not a byte-level BPE without normaliser and prefix")
    odd = [a["content"] for a in spec["added_tokens"] if a["single_word"] or a["lstrip"] or a["rstrip"] or a["normalized"]]
    if odd:
        raise ValueError(f"added tokens that take more than their own text: {odd}")
    pairs = (m if isinstance(m, list) else m.split(" ") for m in model["merges"])
    ranks = {(a, b): i for i, (a, b) in enumerate(pairs)}
    letters = byte_letters()
    whole = set()
    for token in model["vocab"]:
        if all(c in letters for c in token) and merged_parts(token, ranks) == [token]:
            try:
                whole.add(bytes(letters[c] for c in token).decode())
            except UnicodeDecodeError:
                pass  # a part of a character is no pre-token
    return Vocabulary(frozenset(whole), ranks, tuple(a["content"] for a in spec["added_tokens"]),
                      unassigned_characters())


class TokenCounter:
    """Counts tokens of whole texts with one proved vocabulary."""

    def __init__(self, vocabulary: Vocabulary):
        self.whole, self.ranks = vocabulary.whole, vocabulary.ranks
        special = sorted(vocabulary.special, key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, special))) if special else None
        self.pattern = regex.compile(PATTERN)
        # The same pattern with those characters among the others.
        other = "[" + regex.escape(vocabulary.unassigned) + "]"
        self.unassigned = frozenset(vocabulary.unassigned)
        self.beyond = re.compile(f"[{min(self.unassigned, default=chr(0x10FFFF))}-{chr(0x10FFFF)}]")
        exact = PATTERN.replace(r" ?\p{L}+", rf" ?[\p{{L}}--{other}]+").replace(r" ?\p{N}+", rf" ?[\p{{N}}--{other}]+")
        exact = exact.replace(r"[^\p{White_Space}\p{L}\p{N}]", rf"[{other}||[^\p{{White_Space}}\p{{L}}\p{{N}}]]")
        self.exact = regex.compile(exact, regex.V1) if vocabulary.unassigned else self.pattern
        self.letter_of = {b: c for c, b in byte_letters().items()}
        self.known: dict[str, int] = dict.fromkeys(self.whole, 1)

    def _remember(self, stretch: str, n: int) -> int:
        if len(stretch) <= REMEMBERED_CHARS:
            if len(self.known) >= REMEMBERED + len(self.whole):
                self.known = dict.fromkeys(self.whole, 1)
            self.known[stretch] = n
        return n

    def _merged(self, piece: str) -> int:
        letters = "".join(map(self.letter_of.__getitem__, piece.encode()))
        return self._remember(piece, len(merged_parts(letters, self.ranks)))

    def _chunk(self, chunk: str, pattern: regex.Pattern) -> int:
        """Tokens of a stretch that starts and ends with a pre-token."""
        pieces = pattern.findall(chunk)
        if pieces == [chunk]:
            return self._merged(chunk)
        known = self.known.get
        n = sum(self._merged(p) if (one := known(p)) is None else one for p in pieces)
        return self._remember(chunk, n)

    def _block(self, block: str) -> int:
        pattern = self.pattern
        if not block.isascii() and self.beyond.search(block) and not self.unassigned.isdisjoint(block):
            pattern = self.exact
        if _IRREGULAR.search(block):
            chunks = pattern.findall(block)
        else:
            first, *words = block.split(" ")
            chunks = [" " + w for w in words]
            if first:
                chunks.append(first)
        counts = list(map(self.known.get, chunks))
        if None in counts:
            counts = [self._chunk(c, pattern) if n is None else n for c, n in zip(chunks, counts)]
        return sum(counts)

    def _blocks(self, text: str) -> Iterator[str]:
        start = 0
        while len(text) - start > BLOCK_CHARS:
            border = _BORDER.search(text, start + BLOCK_CHARS)
            if border is None:
                break
            yield text[start:border.start()]
            start = border.start()
        yield text[start:]

    def count(self, text: str) -> int:
        """Tokens of a text; the string of a special token is one token."""
        if not text:
            return 0
        found = len(self.special.findall(text)) if self.special else 0
        parts = self.special.split(text) if found else [text]
        return found + sum(self._block(b) for part in parts if part for b in self._blocks(part))


_RESULT = pa.schema([("key", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64())])


def token_counts(
    docs: DataFrame, vocabulary: str, *, limit: int = 512, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``(key, n_bytes, n_tokens, over_limit)`` of every whole text.

    ``vocabulary``: path of a byte-level BPE file of the tokenizers library,
    read and proved on the driver; its content, about 3 MB whatever the corpus,
    is broadcast. Null counts as empty text, with 0 bytes and tokens. Repeated
    rows and null keys give a row each, long texts are counted whole in blocks,
    other columns are ignored whatever their names, an empty table gives none.
    Narrow: nothing is shuffled and no job runs before the action.
    """
    if vocabulary not in _proved:
        with open(vocabulary, encoding="utf-8") as file:  # on the driver
            _proved[vocabulary] = proved_vocabulary(file.read())
    shared = docs.sparkSession.sparkContext.broadcast(_proved[vocabulary])

    def count(batches):
        counter = TokenCounter(shared.value)
        for batch in batches:
            yield arrow_rows(_RESULT, {
                "key": batch.column(0).to_pylist(),
                "n_bytes": batch.column(1).to_pylist(),
                "n_tokens": [counter.count(t) for t in texts_of(batch.column(2))],
            })

    rows = docs.select(
        F.col(key).cast("long").alias("key"),
        F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes"),
        F.col(text).alias("text"),
    )
    counted = rows.mapInArrow(count, "key long, n_bytes long, n_tokens long")
    return counted.select(F.col("key").alias(key), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
