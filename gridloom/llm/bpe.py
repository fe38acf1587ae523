"""Byte-level BPE by backtracking over longest matches, and decoding by offsets.

A piece of text is covered with the longest tokens an Aho-Corasick automaton
finds. A token may follow another only if merging could not have joined bytes
across their border first, which a pair table answers. Where no token fits, the
last one is taken back and replaced by its next shorter prefix. Every position
is given up at most once, so a piece takes time linear in its length, and the
result is the one the merges give.
"""

from __future__ import annotations

import hashlib
import json
import math
import re
from array import array

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from gridloom.llm.common import arrow_rows, texts_of

# The published pattern of the byte-level pre-tokenizer (fixed value).
PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
    r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
)
CACHED_PIECES = 500_000  # twice as many at most; forgotten pieces are encoded again
CACHED_CHARS = 64
ENDINGS = ".,;:!?%&*$#"  # what often follows a word; any set gives the same ids

_DOUBLE_SPACE = re.compile(r" \s|\s ")

_coders: dict[str, BytePairCoder] = {}


def byte_letters() -> dict[str, int]:
    """Letter to byte: printable bytes stand for themselves, others follow from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


class BytePairCoder:
    """Encoder and decoder of one vocabulary file of the tokenizers library.

    ``specification``: its JSON text. Needs a byte-level BPE without normaliser
    whose ids rise in merge order.
    """

    def __init__(self, specification: str):
        spec = json.loads(specification)
        model, letters = spec["model"], byte_letters()
        if model["type"] != "BPE" or spec["normalizer"] or model.get("end_of_word_suffix"):
            raise ValueError("not a byte-level BPE without normaliser")
        content = {text: bytes(letters[c] for c in text) for text in model["vocab"]}
        ids = model["vocab"]
        added = {a["content"]: a["id"] for a in spec["added_tokens"]}
        size = max([*ids.values(), *added.values()]) + 1
        tokens: list[bytes] = [b""] * size
        for text, i in ids.items():
            tokens[i] = content[text]
        for text, i in added.items():
            tokens[i] = text.encode()
        self.added = added
        self.split_added = regex.compile("(" + "|".join(map(regex.escape, added)) + ")") if added else None
        self.pattern = regex.compile(PATTERN)
        self.left, self.right, self.merged = [-1] * size, [-1] * size, {}
        last = -1
        for merge in model["merges"]:
            a, b = merge if isinstance(merge, list) else merge.split(" ")
            whole = ids[a + b]
            if whole <= last:
                raise ValueError("ids must rise in merge order")
            last = whole
            self.left[whole], self.right[whole] = ids[a], ids[b]
            self.merged[ids[a], ids[b]] = whole
        by_bytes = {content[text]: i for text, i in ids.items()}
        self.lengths = [len(t) for t in tokens]
        self.shorter = [-1] * size  # the longest token that is a proper prefix
        self.automaton = ahocorasick.Automaton()
        for token, i in by_bytes.items():
            self.automaton.add_word(token.decode("latin-1"), i)
            self.shorter[i] = next((by_bytes[token[:n]] for n in range(len(token) - 1, 0, -1)
                                    if token[:n] in by_bytes), -1)
        self.automaton.make_automaton()
        self.offsets = np.cumsum([0, *self.lengths])
        self.buffer = np.frombuffer(b"".join(tokens), np.uint8)
        self.fits: dict[tuple[int, int], bool] = {}
        self.cache: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.decimals = [str(i) for i in range(size)]

    def compatible(self, a: int, b: int) -> bool:
        """Whether the merges leave a border between the bytes of two tokens.

        Goes back in time from the two whole tokens: undo the younger one and
        ask each time whether the two parts at the border would have merged
        before that step. Equal steps happen from left to right.
        """
        x, y, before, answer = a, b, math.inf, None
        while answer is None:
            rank = self.merged.get((x, y))
            if rank is not None and rank < before:
                answer = False
            elif x > y:
                before, x = x, self.right[x]
                answer = True if x < 0 else None
            else:
                before, y = y + 1, self.left[y]
                answer = True if y < 0 else None
        if len(self.fits) > 1_000_000:
            self.fits.clear()
        self.fits[a, b] = answer
        return answer

    def encode_piece(self, piece: bytes) -> list[int]:
        """Ids of one pre-token."""
        n, longest = len(piece), [-1] * len(piece)
        lengths, shorter, fits = self.lengths, self.shorter, self.fits
        for end, token in self.automaton.iter(piece.decode("latin-1")):
            longest[end + 1 - lengths[token]] = token  # ends rise, so the longest stays
        if n and longest[0] >= 0 and lengths[longest[0]] == n:
            return [longest[0]]
        open_at, taken, at = bytearray(b"\x01" * (n + 1)), [], 0
        token = longest[0] if n else -1
        while at < n:
            while token >= 0:
                if open_at[at + lengths[token]]:
                    if not taken:
                        break
                    fit = fits.get((taken[-1], token))
                    if self.compatible(taken[-1], token) if fit is None else fit:
                        break
                token = shorter[token]
            if token >= 0:
                taken.append(token)
                at += lengths[token]
                token = longest[at] if at < n else -1
            else:
                if not taken:
                    raise ValueError("the vocabulary lacks a byte of the text")
                open_at[at] = 0  # no way leads on from here
                token = taken.pop()
                at -= lengths[token]
                token = shorter[token]
        return taken

    def _remember(self, chunk: str, ids: bytes) -> bytes:
        if len(chunk) <= CACHED_CHARS:
            if len(self.cache) >= CACHED_PIECES:
                self.cache, self.older = {}, self.cache
            self.cache[chunk] = ids
        return ids

    def _piece(self, piece: str) -> bytes:
        known = self.cache.get(piece)
        if known is None:
            known = self.older.get(piece)
            if known is None:
                known = array("I", self.encode_piece(piece.encode())).tobytes()
            self._remember(piece, known)
        return known

    def _encoded(self, chunk: str) -> bytes:
        """Ids of a chunk that is not among the recent ones."""
        word = chunk[1:] if chunk[0] == " " else chunk
        if word.isalpha():
            return self._piece(chunk)
        core = chunk.rstrip(ENDINGS)
        if core and (core[1:] if core[0] == " " else core).isalpha():
            return self._piece(core) + self._piece(chunk[len(core):])
        return b"".join([self._piece(piece) for piece in self.pattern.findall(chunk)])

    def _chunks(self, text: str) -> list[str]:
        """The text cut before single spaces between visible characters, where a
        pre-token always starts; kept whole where white space is not that plain."""
        if _DOUBLE_SPACE.search(text):
            return self.pattern.findall(text)
        first, *words = text.split(" ")
        chunks = [" " + w for w in words]
        return [first, *chunks] if first else chunks

    def encode(self, text: str) -> np.ndarray:
        """Ids of a whole text."""
        parts = self.split_added.split(text) if self.split_added and any(a in text for a in self.added) else [text]
        ids: list[bytes] = []
        for part in parts:
            if part in self.added:
                ids.append(array("I", [self.added[part]]).tobytes())
            elif part:
                chunks = self._chunks(part)
                found = list(map(self.cache.get, chunks))
                if None in found:
                    found = [self._encoded(c) if known is None else known for c, known in zip(chunks, found)]
                ids += found
        return np.frombuffer(b"".join(ids), "<u4")

    def decimal(self, ids: np.ndarray) -> str:
        return ",".join(map(self.decimals.__getitem__, ids.tolist()))

    def decode_bytes(self, ids: np.ndarray) -> bytes:
        """Bytes of a sequence of ids, copied from one buffer by offsets."""
        out = []
        for at in range(0, len(ids), 1 << 20):
            some = ids[at:at + (1 << 20)]
            starts = self.offsets[some]
            lengths = self.offsets[some + 1] - starts
            ends = np.cumsum(lengths)
            places = np.arange(ends[-1]) + np.repeat(starts - ends + lengths, lengths)
            out.append(self.buffer[places].tobytes())
        return b"".join(out)

    def decode(self, ids: np.ndarray) -> str:
        return self.decode_bytes(ids).decode("utf-8", "replace")


def coder(specification: str) -> BytePairCoder:
    """One coder per vocabulary and Python worker."""
    if specification not in _coders:
        _coders.clear()
        _coders[specification] = BytePairCoder(specification)
    return _coders[specification]


_RESULT = pa.schema([("key", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()),
                     ("decoded_sha256", pa.string())])


def _digests(specification: str):
    def digests(batches):
        own = coder(specification)
        for batch in batches:
            rows = {name: [] for name in _RESULT.names}
            rows["key"] = batch.column(0).to_pylist()
            for text in texts_of(batch.column(1)):
                ids = own.encode(text)
                rows["n_tokens"].append(len(ids))
                rows["ids_sha256"].append(hashlib.sha256(own.decimal(ids).encode()).hexdigest())
                rows["decoded_sha256"].append(hashlib.sha256(own.decode(ids).encode()).hexdigest())
            yield arrow_rows(_RESULT, rows)

    return digests


def _ids(specification: str):
    schema = pa.schema([("key", pa.int64()), ("ids", pa.list_(pa.int32()))])

    def encode(batches):
        own = coder(specification)
        for batch in batches:
            ids = [own.encode(text).astype(np.int32) for text in texts_of(batch.column(1))]
            yield arrow_rows(schema, {"key": batch.column(0).to_pylist(), "ids": ids})

    return encode


def _texts(specification: str):
    schema = pa.schema([("key", pa.int64()), ("text", pa.string())])

    def decode(batches):
        own = coder(specification)
        for batch in batches:
            texts = [own.decode(np.array(ids or [], np.int64)) for ids in batch.column(1).to_pylist()]
            yield arrow_rows(schema, {"key": batch.column(0).to_pylist(), "text": texts})

    return decode


def _read(path: str) -> str:
    with open(path, encoding="utf-8") as file:  # on the driver; tasks get its content
        return file.read()


def encode(docs: DataFrame, vocabulary: str, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, ids)`` of every text; null is empty. ``vocabulary``: path of the file."""
    return docs.select(key, text).mapInArrow(_ids(_read(vocabulary)), f"`{key}` long, ids array<int>")


def decode(rows: DataFrame, vocabulary: str, *, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """``(key, text)`` of every list of ids; null is empty."""
    return rows.select(key, ids).mapInArrow(_texts(_read(vocabulary)), f"`{key}` long, text string")


def round_trip_digests(
    docs: DataFrame, vocabulary: str, *, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Encode and decode every whole text, and report digests of both.

    Result per row: ``key``, ``n_tokens``, ``ids_sha256`` (decimal ids joined
    by commas), ``decoded_sha256``. Null counts as empty text, which has no
    token. Strings of special tokens become their ids. Repeated rows and null
    keys give a row each; other columns are ignored; an empty table gives none.
    Narrow: rows are never shuffled.
    """
    return docs.select(key, text).mapInArrow(
        _digests(_read(vocabulary)),
        f"`{key}` long, n_tokens long, ids_sha256 string, decoded_sha256 string",
    )
