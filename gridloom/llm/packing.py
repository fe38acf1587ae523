"""Packing token sequences by shortest-pack-first over the length histogram.

Only the histogram of at most ``capacity`` lengths is packed: lengths go from
the longest down, each to the shortest open packing pattern that has room, and
the count of that pattern is split or renewed. The number of patterns depends
on the capacity, not on the table. Documents then find their place by their
rank among the pieces of their length.
"""

from __future__ import annotations

import codecs
import heapq
import json
import os
import zlib
from collections import Counter
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.taskcontext import TaskContext
from tokenizers import Tokenizer, models, pre_tokenizers

from gridloom.llm.bpe import _read
from gridloom.llm.common import BATCH_BYTES, arrow_rows, give_back, giving_back, slices
from gridloom.session import materialise

CAPACITY = 4096
END_ID = 2
SLACK = 32  # a pattern with more padding than this is cut at sequence borders instead
CACHED_WORDS = 200_000  # pieces of words, twice as many at most; forgotten ones are encoded again
PART_BYTES, PART_ROWS = BATCH_BYTES, 4096  # of texts that are split into words at once
GATHERED_WORDS = 1 << 17  # whose ids are put together at once
BROADCAST_ROWS = 1_000_000  # 24 bytes each; beyond, a join that shuffles

# Characters that Arrow takes as white space and the tokenizer does not.
_ODD_SPACE = "[\x1c-\x1f]"

# Letters that lower-casing and composing leave one letter each.
_LETTERS = "[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0132-\u017e]+"
_RUN = regex.compile(_LETTERS)
MARKS = ".,;:!?%&*$#|"

_tokenizers: dict[str, tuple] = {}

_TOKENS = pa.schema([
    ("key", pa.int64()), ("ids", pa.binary()), ("n", pa.int64()), ("part", pa.int64()),
    ("full_rank", pa.int64()), ("rest", pa.int64()), ("rest_rank", pa.int64()),
])
_PIECES = pa.schema([
    ("key", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
    ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()), ("ids", pa.binary()),
])


def pack_histogram(histogram: dict[int, int], capacity: int) -> list[tuple[list[int], int]]:
    """``(lengths in order, how many sequences)`` patterns that hold every piece once."""
    open_by_space: dict[int, list] = {}
    spaces: list[int] = []  # a heap of negative spaces, with stale entries
    done: list[tuple[tuple, int]] = []

    def put(pattern: tuple, space: int, count: int) -> None:
        if space == 0:
            done.append((pattern, count))
            return
        if not open_by_space.get(space):
            heapq.heappush(spaces, -space)
        open_by_space.setdefault(space, []).append((pattern, count))

    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            while spaces and not open_by_space.get(-spaces[0]):
                heapq.heappop(spaces)
            if not spaces or -spaces[0] < length:
                fit = capacity // length
                for times, count in ((fit, left // fit), (left % fit, 1)):
                    if times and count:
                        put((None, length, times), capacity - times * length, count)
                left = 0
            else:
                space = -spaces[0]
                pattern, count = open_by_space[space].pop()
                used = min(count, left)
                left -= used
                if count > used:
                    put(pattern, space, count - used)
                put((pattern, length, 1), space - length, used)
    rest = [(p, n) for kept in open_by_space.values() for p, n in kept]
    patterns = []
    for node, count in done + rest:
        lengths = []
        while node is not None:
            lengths += [node[1]] * node[2]
            node = node[0]
        patterns.append((lengths[::-1], count))
    return patterns


class Layout:
    """Where the piece of a given length and rank goes.

    Patterns that leave up to ``slack`` ids of padding stay as they are. The
    pieces of others follow one another in a stream that is cut at the
    capacity, and the stream's last sequence at powers of two, which need no
    padding.
    """

    def __init__(self, patterns: list[tuple[list[int], int]], capacity: int, slack: int):
        following: Counter = Counter()
        slots: dict[int, list] = {}  # first rank, then sequence and offset, or -1 and place in the stream
        sequences, stream, loose = 0, 0, Counter()
        for lengths, count in patterns:
            if capacity - sum(lengths) > slack:
                for length in lengths:
                    loose[length] += count
                continue
            at = 0
            for length in lengths:
                slots.setdefault(length, []).append((following[length], sequences, at))
                following[length] += count
                at += length
            sequences += count
        for length, count in sorted(loose.items(), reverse=True):
            slots.setdefault(length, []).append((following[length], -1, stream))
            stream += length * count
        self.slots, self.capacity, self.first_loose = slots, capacity, sequences
        self.starts = {length: np.array([s[0] for s in own]) for length, own in slots.items()}
        self.whole = stream // capacity * capacity
        tail = stream - self.whole
        parts = [1 << bit for bit in range(tail.bit_length() - 1, -1, -1) if tail >> bit & 1]
        self.tail = self.whole + np.cumsum([0, *parts])
        self.sequences = sequences + stream // capacity + len(parts)

    def find(self, length: int, rank: int) -> list[tuple[int, int, int, int]]:
        """``(start inside the piece, length, sequence, offset)`` of its parts."""
        first, sequence, at = self.slots[length][int(np.searchsorted(self.starts[length], rank, "right")) - 1]
        if sequence >= 0:
            return [(0, length, sequence + rank - first, at)]
        found, inside, at = [], 0, at + (rank - first) * length
        while inside < length:
            if at < self.whole:
                number, offset = divmod(at, self.capacity)
                room = self.capacity - offset
            else:
                i = int(np.searchsorted(self.tail, at, "right")) - 1
                number, offset = self.whole // self.capacity + i, at - int(self.tail[i])
                room = int(self.tail[i + 1]) - at
            take = min(room, length - inside)
            found.append((inside, take, self.first_loose + number, offset))
            inside, at = inside + take, at + take
        return found


def _rows_of(starts: np.ndarray, ids: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of the given rows one after another, and how many each has; row i is ``ids[starts[i]:starts[i + 1]]``."""
    first = starts[which]
    lengths = starts[which + 1] - first
    ends = np.cumsum(lengths)
    return ids[np.repeat(first - ends + lengths, lengths) + np.arange(lengths.sum())], lengths


def _strings(column: pa.Array) -> list[str]:
    """As ``to_pylist``, which makes an object of Arrow for each value besides."""
    return column.to_numpy(zero_copy_only=False).tolist()


class _Pieces:
    """Ids of pieces of words one after another in one array, and where those of each begin."""

    def __init__(self):
        self.places: dict[str, int] = {}
        self.starts, self.ids = np.zeros(1, np.int64), np.empty(1024, "<u4")

    def add(self, new: list[str], ids: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Places of new pieces, whose ids are given one after another."""
        first = len(self.places)
        last, end = first + len(new), int(self.starts[first])
        while last >= len(self.starts):
            self.starts = np.concatenate([self.starts, np.zeros_like(self.starts)])
        while end + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.empty_like(self.ids)])
        self.starts[first + 1:last + 1], self.ids[end:end + len(ids)] = end + np.cumsum(lengths), ids
        self.places.update(zip(new, range(first, last)))
        return np.arange(first, last)

    def find(self, pieces: list[str]) -> np.ndarray:
        """Places of pieces, -1 for those that are not here."""
        return np.fromiter(map(self.places.get, pieces, repeat(-1)), np.int64, len(pieces))


class _Words:
    """Ids of texts by the tokenizer, which is asked once for a piece of a word.

    What stands between white space is independent in this tokenizer. So are a
    run of letters and the run of marks after it, each of which is one piece;
    the last id of a piece is an end-of-word one, which tells the pieces of
    many words encoded at once apart. Runs of plain letters are lower-cased and
    spelt in the tokenizer's letters for bytes here, so that its model gets them
    without the steps before it. Other words are pieces as they stand.

    Arrow splits many texts into words and finds the different ones, so only
    their different pieces become Python objects.
    """

    def __init__(self, specification: str):
        if specification not in _tokenizers:
            _tokenizers.clear()
            os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
            tokenizer = Tokenizer.from_str(specification)
            tokenizer.no_padding()
            tokenizer.no_truncation()
            ends = np.zeros(tokenizer.get_vocab_size(), bool)
            ends[[i for token, i in tokenizer.get_vocab().items() if token.endswith("</w>")]] = True
            model = {name: value for name, value in json.loads(specification)["model"].items()
                     if name != "type" and value is not None}
            model["merges"] = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
            # For words that are normalised and spelt already; it is asked once for each, so its own cache has no use.
            bare = Tokenizer(models.BPE(**model, cache_capacity=0))
            bare.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
            spelling = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
            spelt = [chr(n) for n in range(256)]
            for c in filter(_RUN.fullmatch, map(chr, range(128, 0x180))):
                for byte, letter in zip(c.encode(), spelling.pre_tokenize_str(c)[0][0]):
                    spelt[byte] = letter
            spelt = "".join(spelt)
            _tokenizers[specification] = (tokenizer, bare, spelt, ends, [_Pieces(), _Pieces()])
        self.tokenizer, self.bare, self.spelt, self.ends, self.caches = _tokenizers[specification]

    def _many(self, pieces: list[str]) -> tuple[list[np.ndarray], list[int]]:
        """Ids of pieces that are runs of plain small letters each, in parts, and how many each piece has."""
        found: list[np.ndarray] = []
        lengths: list[int] = []
        for at in range(0, len(pieces), 128):
            some = pieces[at:at + 128]
            spelt = codecs.charmap_decode(" ".join(some).encode(), "strict", self.spelt)[0]
            ids = np.array(self.bare.encode_batch_fast([spelt], add_special_tokens=False)[0].ids, "<u4")
            borders = np.flatnonzero(self.ends[ids]) + 1
            if len(borders) != len(some):  # not pieces after all
                own = [self._one(piece) for piece in some]
                found += own
                lengths += map(len, own)
            else:
                found.append(ids)
                lengths += np.diff(borders, prepend=0).tolist()
        return found, lengths

    def _one(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4")

    def encode(self, texts: pa.Array | list[str]) -> list[bytes]:
        """Ids of each text as unsigned 32-bit values."""
        texts = (texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())).cast(pa.large_string())
        odd = pc.match_substring_regex(texts, _ODD_SPACE)
        alone = {i: self._one(texts[i].as_py()).tobytes() for i in np.flatnonzero(odd).tolist()}
        split = pc.utf8_split_whitespace(pc.if_else(odd, "", texts) if alone else texts)
        counts = pc.list_value_length(split).to_numpy()
        coded = split.flatten().dictionary_encode()
        every, (starts, ids) = coded.indices.to_numpy(), self._words(coded.dictionary)
        borders = np.cumsum(np.r_[0, starts[every + 1] - starts[every]])[np.cumsum(np.r_[0, counts])].tolist()
        parts = [_rows_of(starts, ids, every[at:at + GATHERED_WORDS])[0] for at in range(0, len(every), GATHERED_WORDS)]
        ids = np.concatenate([ids[:0], *parts])
        return [alone[i] if i in alone else ids[a:b].tobytes() for i, (a, b) in enumerate(zip(borders, borders[1:]))]

    def _words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Where the ids of each of different words start, and all their ids."""
        cores = pc.ascii_rtrim(words, characters=MARKS)
        plain = pc.match_substring_regex(cores, f"^{_LETTERS}$")
        marks = np.where(plain, pc.binary_length(words).to_numpy() - pc.binary_length(cores).to_numpy(), 0)
        marked = np.flatnonzero(marks)
        tails = [word[-n:] for word, n in zip(_strings(words.take(pa.array(marked))), marks[marked].tolist())]
        pieces = pa.concat_arrays([pc.if_else(plain, pc.utf8_lower(cores), words), pa.array(tails, words.type)])
        coded = pieces.dictionary_encode()
        places = self._places(_strings(coded.dictionary))[coded.indices.to_numpy()]
        ends = np.cumsum(1 + (marks > 0))
        order = np.empty(len(places), np.int64)
        order[ends[marked] - 1] = places[len(words):]
        order[ends - 1 - (marks > 0)] = places[:len(words)]
        ids, lengths = _rows_of(self.caches[0].starts, self.caches[0].ids, order)
        return np.cumsum(np.r_[0, lengths])[np.r_[0, ends]], ids

    def _places(self, pieces: list[str]) -> np.ndarray:
        """Places in the younger cache of different pieces, which are put there if need be."""
        if len(self.caches[0].places) > CACHED_WORDS:
            self.caches[:] = _Pieces(), self.caches[0]
        cache, older = self.caches
        places = cache.find(pieces)
        missing = np.flatnonzero(places < 0)
        before = older.find([pieces[i] for i in missing.tolist()])
        known, missing = missing[before >= 0], missing[before < 0]
        places[known] = cache.add([pieces[i] for i in known.tolist()],
                                  *_rows_of(older.starts, older.ids, before[before >= 0]))
        new = [pieces[i] for i in missing.tolist()]
        letters = np.fromiter(((p.isascii() and p.isalpha()) or bool(_RUN.fullmatch(p)) for p in new), bool, len(new))
        for some, encode in ((missing[letters], self._many), (missing[~letters], self._singly)):
            own = [pieces[i] for i in some.tolist()]
            found, lengths = encode(own)
            places[some] = cache.add(own, np.concatenate([cache.ids[:0], *found]), np.array(lengths, np.int64))
        return places

    def _singly(self, pieces: list[str]) -> tuple[list[np.ndarray], list[int]]:
        found = [self._one(piece) for piece in pieces]
        return found, list(map(len, found))


def _parts(batches):
    """The batches in parts of few rows and bytes of text, or of one row, without a copy."""
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(), dtype=np.int64)
        at = 0
        while at < len(ends):
            before = int(ends[at - 1]) if at else 0
            stop = max(at + 1, min(at + PART_ROWS, int(np.searchsorted(ends, before + PART_BYTES, "right"))))
            yield batch.slice(at, stop - at)
            at = stop


def _tokenise(specification: str, capacity: int, end_id: int):
    end = np.array([end_id], "<u4").tobytes()

    def tokenise(batches):
        words, ranks, part = _Words(specification), Counter(), TaskContext.get().partitionId()
        for batch in _parts(batches):
            rows = {name: [] for name in _TOKENS.names}
            rows["key"] = batch.column(0).to_pylist()
            for ids in words.encode(pc.fill_null(batch.column(1), "")):
                n = len(ids) // 4 + 1
                full, rest = divmod(n, capacity)
                for name, value in (("ids", _narrow(ids + end)), ("n", n), ("part", part),
                                    ("full_rank", ranks[capacity]), ("rest", rest),
                                    ("rest_rank", ranks[rest] if rest else 0)):
                    rows[name].append(value)
                ranks[capacity] += full
                if rest:
                    ranks[rest] += 1
            yield arrow_rows(_TOKENS, rows)
            give_back()  # what splitting takes is many times the text

    return giving_back(tokenise)


def _narrow(ids: bytes) -> bytes:
    """A width byte and the ids, in 16 bits where all fit."""
    wide = np.frombuffer(ids, "<u4")
    return b"\x02" + wide.astype("<u2").tobytes() if wide.max() < 1 << 16 else b"\x04" + ids


def _wide(stored: bytes) -> np.ndarray:
    return np.frombuffer(stored, "<u2" if stored[0] == 2 else "<u4", offset=1).astype("<u4")


def _place(layout: Layout, capacity: int, with_ids: bool):
    def place(batches):
        for batch in slices(batches):
            rows = {name: [] for name in _PIECES.names}
            columns = {name: batch.column(name).to_pylist() for name in batch.schema.names}
            for i, stored in enumerate(columns["ids"]):
                ids, n, rest = _wide(stored), columns["n"][i], columns["rest"][i]
                pieces = [(j * capacity, capacity, columns["full_base"][i] + columns["full_rank"][i] + j)
                          for j in range(n // capacity)]
                if rest:
                    pieces.append((n - rest, rest, columns["rest_base"][i] + columns["rest_rank"][i]))
                for start, length, rank in pieces:
                    for inside, take, sequence, offset in layout.find(length, rank):
                        own = ids[start + inside:start + inside + take].tobytes()
                        for name, value in zip(_PIECES.names, (
                            columns["key"][i], start + inside, take, zlib.crc32(own), n, sequence, offset,
                            own if with_ids else None,
                        )):
                            rows[name].append(value)
            yield arrow_rows(_PIECES, rows)

    return giving_back(place)


def packed_pieces(
    docs: DataFrame,
    vocabulary: str,
    *,
    key: str = "doc_id",
    text: str = "text",
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    slack: int = SLACK,
    with_ids: bool = True,
) -> DataFrame:
    """Tokenise every whole text and pack the ids into sequences.

    Result per piece: ``key``, ``start``, ``length``, ``ids_crc32``,
    ``doc_tokens``, ``sequence_id``, ``offset`` and, ``with_ids``, the piece's
    ids as unsigned 32-bit values. Documents longer than ``capacity`` are cut
    into full sequences and a rest. Null counts as empty text, whose only id is
    ``end_id``. Repeated rows and null keys are documents of their own; other
    columns are ignored; an empty table gives no piece. Patterns that would leave
    over ``slack`` ids of padding are dissolved; see :class:`Layout`.

    Token ids are written once to the shared folder with ranks counted per
    task; ranks become global by adding up the counts of earlier tasks, one row
    for each length and task. Ids are shuffled only if there are more than
    ``BROADCAST_ROWS`` such rows. A length that a third of all documents share
    is counted in every task by itself.
    """
    spec = _read(vocabulary)
    tokens = materialise(
        docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text")).mapInArrow(
            _tokenise(spec, capacity, end_id),
            "key long, ids binary, n long, part long, full_rank long, rest long, rest_rank long",
        ),
        "packing-tokens", batch_bytes=BATCH_BYTES,
    )
    counts = materialise(
        tokens.where("rest > 0").groupBy(F.col("rest").alias("len"), "part").agg(F.count("*").alias("n"))
        .unionByName(
            tokens.groupBy("part").agg(F.sum(F.expr(f"n div {capacity}")).alias("n"))
            .where("n > 0").select(F.lit(capacity).cast("long").alias("len"), "part", "n")
        ),
        "packing-counts",
    )
    histogram = {r["len"]: r["n"] for r in counts.groupBy("len").agg(F.sum("n").alias("n")).collect()}
    layout = Layout(pack_histogram(histogram, capacity), capacity, slack)  # at most `capacity` lengths
    earlier = W.partitionBy("len").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    bases = counts.select("len", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    small = counts.count() <= BROADCAST_ROWS
    hint = F.broadcast if small else (lambda df: df)
    placed = (
        tokens.join(hint(bases.select(F.col("len").alias("rest"), "part", F.col("base").alias("rest_base"))),
                    ["rest", "part"], "left")
        .join(hint(bases.where(F.col("len") == capacity).select("part", F.col("base").alias("full_base"))),
              "part", "left")
        .na.fill(0, ["rest_base", "full_base"])
        .select("key", "ids", "n", "rest", "full_rank", "rest_rank", "full_base", "rest_base")
    )
    pieces = placed.mapInArrow(
        _place(layout, capacity, with_ids),
        "key long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
        "offset long, ids binary",
    ).withColumnRenamed("key", key)
    return pieces if with_ids else pieces.drop("ids")
