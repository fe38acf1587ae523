"""Damage to conversations, and their cheapest repair by an auction for shortest paths.

A conversation's rows and the role that came last span a lattice: node
``(row, state)``, arcs for the edits, integer costs. An auction finds a
shortest path through it: every node has a price that never exceeds what the
way to the end costs, a path grows along an arc whose cost the prices pay in
full, and where no such arc leaves its last node, that node's price rises and
the path is cut back. Origins are taken from the last row to the first, so a
path ends as soon as it meets a node whose price has converged. Arcs that
converged prices pay in full lie on the shortest paths; following the one with
the least letter gives the least audit.

Conversations are cut into segments of bounded size. Auctions per segment give
the cost from each state at its start to each state at its end; these small
matrices are combined from the end of a conversation to its start, and give the
prices at the borders, after which segments are traced apart from each other.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.operators.index import ordinals

SEGMENT_ROWS = 4096

# Fixed values of the contract: how rows are damaged, and what edits cost.
DROP, BLANK, CUT, REPEAT, RENAME = range(5)
DAMAGE_MODULUS = 20
KEEP_COST, REROLE_COST, DELETE_COST, INSERT_COST, TRUNCATED_COST = 0, 3, 4, 3, 3
WHITE_SPACE = " \t\n\x0b\x0c\r"

# States: nothing written yet, after a system row, after a user's, after an
# assistant's. A repair ends in the first or the last.
NOTHING, SYSTEM, USER, ASSISTANT = STATES = range(4)
TURN_AFTER = (USER, USER, ASSISTANT, USER)  # the role whose turn it is
NAMES = {USER: "user", ASSISTANT: "assistant"}
FAR = 1 << 60
# Every state that can go on at all does so at this much more than any other at most.
SPREAD = 8 * max(REROLE_COST + TRUNCATED_COST, DELETE_COST, INSERT_COST)
REMEMBERED_ROWS = 32  # shorter segments recur; their prices and audits are kept

# What the lattice needs of a row, as one letter: its role's initial, in upper
# case if truncated; "x" for another role, "X" if truncated, "-" if it must go.
GOES = "-"


def _arcs(code: str | None, state: int) -> list[tuple[str, int, bool, int]]:
    """``(letter, cost, to the next row, state)`` out of a node, by letter.

    ``code`` None: after the last row, where only insertions are possible.
    """
    arcs = []
    turn = TURN_AFTER[state]
    if code is not None:
        arcs.append(("D", DELETE_COST, True, state))
    arcs.append(("I", INSERT_COST, False, turn))
    if code is not None and code != GOES:
        extra = TRUNCATED_COST if code.isupper() else 0
        role = {"s": SYSTEM, "u": USER, "a": ASSISTANT}.get(code.lower())
        if role == turn or (role == SYSTEM and state == NOTHING):
            arcs.append(("K", KEEP_COST + extra, True, role))
        arcs.append(("R", REROLE_COST + extra, True, turn))
    return arcs


ARCS = {code: [_arcs(code, s) for s in STATES] for code in [None, *"suaxSUAX", GOES]}


def auction_layer(code: str | None, later: tuple[int, ...], ends: tuple[int, ...] | None = None) -> tuple[int, ...]:
    """Prices of the nodes before a row, given the converged ones after it.

    ``ends``: instead of a row, what it costs to stop in each state.
    """
    arcs, stops = ARCS[code], later if ends is None else ends
    price = [min(stops)] * 4  # pays for no arc more than it costs, as costs are not negative
    highest = max(p for p in stops if p < FAR) + SPREAD  # prices beyond only bid each other up
    converged = [False] * 4
    for origin in STATES:
        path = [origin]
        while path and not converged[origin]:
            node = path[-1]
            best, ahead = (FAR, None) if ends is None else (ends[node], None)
            for _, cost, next_row, state in arcs[node]:
                paid = cost + (later[state] if next_row else price[state])
                if paid < best:
                    best, ahead = paid, (None if next_row else state)
            if best > highest:
                best, ahead = FAR, None
            if price[node] < best:  # no arc is paid in full: the price rises, the path is cut back
                price[node] = best
                if node != origin:
                    path.pop()
            elif ahead is None or converged[ahead]:  # it reaches a converged price
                for on_path in path:
                    converged[on_path] = True
            else:
                path.append(ahead)
    return tuple(price)


def auction_prices(codes: str, ends: tuple[int, ...]) -> list[tuple[int, ...]]:
    """Converged prices before each row of a segment, and at its end."""
    prices = [ends]
    for code in reversed(codes):
        prices.append(auction_layer(code, prices[-1]))
    prices.reverse()
    return prices


# What is left to do after the last row costs its insertions.
FINAL = auction_layer(None, (FAR,) * 4, (0, FAR, FAR, 0))


def segment_costs(codes: str) -> list[int]:
    """Cost from each state before a segment to each one after it, flat ``[after][before]``."""
    return [c for end in STATES for c in auction_prices(codes, tuple(0 if s == end else FAR for s in STATES))[0]]


def through(costs: list[int], ends: tuple[int, ...]) -> tuple[int, ...]:
    """Prices before a segment from those after it; ``costs`` flat, ``[after][before]``."""
    return tuple(min(FAR, *(costs[4 * after + before] + ends[after] for after in STATES)) for before in STATES)


def traces(codes: str, ends: tuple[int, ...]) -> tuple[tuple[str, ...], tuple[int, ...]]:
    """The least audit through a segment from each state before it, and where it ends."""
    prices = auction_prices(codes, ends)
    audits, reached = [], []
    for state in STATES:
        letters = []
        for row, code in enumerate(codes):
            moved = False
            while not moved:
                for letter, cost, moved, target in ARCS[code][state]:  # by letter: the first paid in full
                    if prices[row][state] == cost + prices[row + moved][target]:
                        break
                letters.append(letter)
                state = target
        audits.append("".join(letters))
        reached.append(state)
    return tuple(audits), tuple(reached)


@lru_cache(maxsize=50_000)
def _short_costs(codes: str) -> list[int]:
    return segment_costs(codes)


@lru_cache(maxsize=50_000)
def _short_traces(codes: str, ends: tuple[int, ...]) -> tuple[tuple[str, ...], tuple[int, ...]]:
    return traces(codes, ends)


def last_insertions(state: int) -> str:
    """The audit after the last row."""
    return "I" * (FINAL[state] // INSERT_COST)


# --- rows -------------------------------------------------------------------------


def damaged(rows: DataFrame, conversation: str, turn: str, role: str, text: str) -> DataFrame:
    """``(conv, turn, role, text, gone)``: the rows after damage, dropped ones marked.

    Nulls of role and text become one space; the key and the turn do so where
    they are written as text. A repeated row comes twice.
    """
    written = F.concat(F.coalesce(F.col(conversation).cast("string"), F.lit(" ")), F.lit(":"),
                       F.coalesce(F.col(turn).cast("string"), F.lit(" ")))
    read = rows.select(
        F.col(conversation).alias("conv"),
        F.col(turn).cast("long").alias("turn"),
        F.coalesce(F.col(role).cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col(text).cast("string"), F.lit(" ")).alias("text"),
        F.pmod(F.crc32(written.cast("binary")), F.lit(DAMAGE_MODULUS)).alias("damage"),
    )
    harm = F.col("damage")
    return read.select(
        "conv", "turn",
        F.when(harm == RENAME, F.lit("user")).otherwise(F.col("role")).alias("role"),
        F.when(harm == BLANK, F.lit("")).when(harm == CUT, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        (harm == DROP).alias("gone"),
        F.explode(F.when(harm == REPEAT, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy"),
    ).drop("copy")


def _facts(rows: DataFrame) -> DataFrame:
    """What ordering and repair need of a row instead of its text."""
    ending = F.substring(F.rtrim("text", F.lit(WHITE_SPACE)), -1, 1)
    initial = F.substring("role", 1, 1)
    return rows.select(
        "conv", "turn", "role", F.sha2(F.col("text").cast("binary"), 256).alias("digest"), "gone",
        F.when(initial.isin("s", "u", "a"), initial).otherwise(F.lit("x")).alias("initial"),
        (ending == "").alias("blank"), (~ending.isin(".", "!", "?")).alias("truncated"),
    )


# A row's fault as a letter beside its initial.
FAULTS = {"blank": "b", "duplicate": "d", "truncated": "t"}
SEGMENTS = "conv {kind}, seg long, codes string, costs array<long>, first string, last string, illegal long, " \
    "blank long, duplicate long, truncated long, least long, most long, distinct long"


def _legal(before: str, after: str) -> bool:
    """Whether two initials may stand together; x stands for other ones, which never may."""
    return before + after in ("su", "ua", "au")


def _segments(schema: pa.Schema):
    """Rows of a segment, gathered, to what its conversation needs of it."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pydict()
            made = {name: [] for name in schema.names if name not in rows}
            for letters in rows["letters"]:
                initials, faults = letters[::2], letters[1::2]
                codes = "".join(GOES if f in "bd" else i.upper() if f == "t" else i for i, f in zip(initials, faults))
                costs = _short_costs(codes) if len(codes) <= REMEMBERED_ROWS else segment_costs(codes)
                made["codes"].append(codes)
                made["costs"].append(costs)
                made["first"].append(initials[:1] or None)
                made["last"].append(initials[-1:] or None)
                made["illegal"].append(sum(not _legal(*pair) for pair in zip(initials, initials[1:])))
                for fault, letter in FAULTS.items():
                    made[fault].append(faults.count(letter))
            columns = [pa.array(made[f.name], f.type) if f.name in made else batch.column(f.name) for f in schema]
            yield pa.record_batch(columns, schema=schema)

    return gather


def _borders(schema: pa.Schema):
    """Segments of a conversation, last one first, with the prices after each."""

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, prices = object(), FINAL
        for batch in batches:
            after = []
            for key, costs in zip(batch.column("conv").to_pylist(), batch.column("costs").to_pylist()):
                if key != conv:
                    conv, prices = key, FINAL
                after.append(prices)
                prices = through(costs, prices)
            columns = [batch.column(f.name) if f.name != "ends" else pa.array(after, f.type) for f in schema]
            yield pa.record_batch(columns, schema=schema)

    return walk


def _traced(schema: pa.Schema):
    """The audits of every segment."""

    def trace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(_short_traces if len(codes) <= REMEMBERED_ROWS else traces)(codes, tuple(ends)) for codes, ends in
                     zip(batch.column("codes").to_pylist(), batch.column("ends").to_pylist())]
            made = {"audits": [list(a) for a, _ in found], "reached": [list(r) for _, r in found]}
            columns = [pa.array(made[f.name], f.type) if f.name in made else batch.column(f.name) for f in schema]
            yield pa.record_batch(columns, schema=schema)

    return trace


class _Repair:
    """One conversation in the stream: its segments come first, then its rows."""

    def __init__(self, key):
        self.key, self.state, self.audit = key, NOTHING, []
        self.counts = dict.fromkeys(("illegal", "blank", "duplicate", "truncated", "distinct"), 0)
        self.cost = self.least = self.most = self.last = self.last_turn = None
        self.digest, self.written, self.letters = hashlib.sha256(), False, None

    def segment(self, row: dict) -> None:
        if self.cost is None:
            self.cost = through(row["costs"], tuple(row["ends"]))[NOTHING]
        for name in self.counts:
            self.counts[name] += row[name]
        if row["first"] is not None:
            if self.last is not None:
                self.counts["illegal"] += not _legal(self.last, row["first"])
            self.last = row["last"]
        if row["least"] is not None:
            if self.most is None:
                self.least = row["least"]
            elif self.most == row["least"]:
                self.counts["distinct"] -= 1  # a turn that goes on across the border
            self.most = row["most"]
        self.audit.append(row["audits"][self.state])
        self.state = row["reached"][self.state]

    def _write(self, role: str, text: str) -> None:
        self.digest.update((("\n" if self.written else "") + role + ":" + text).encode())
        self.written = True

    def _edits(self) -> Iterator[str]:
        for piece in self.audit:
            yield from piece

    def row(self, role: str, text: str) -> None:
        if self.letters is None:
            self.letters, self.state = self._edits(), NOTHING
        for letter in self.letters:
            if letter == "D":
                return
            turn = TURN_AFTER[self.state]
            if letter == "I":
                self._write(NAMES[turn], "")
            elif letter == "K":
                turn = SYSTEM if role[:1] == "s" else turn
                self._write(role, text)
            else:
                self._write(NAMES[turn], text)
            self.state = turn
            if letter != "I":
                return

    def result(self) -> dict:
        tail = last_insertions(self.state)
        for _ in tail:
            turn = TURN_AFTER[self.state]
            self._write(NAMES[turn], "")
            self.state = turn
        counts = dict(self.counts)
        distinct = counts.pop("distinct")
        gaps = self.most - self.least + 1 - distinct if self.most is not None else 0
        return {"conv": self.key, "gaps": gaps, **counts, "cost": self.cost, "audit": "".join([*self.audit, tail]),
                "repaired_sha256": self.digest.hexdigest()}


RESULT = "conv {kind}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, " \
    "repaired_sha256 string"


def _repaired(schema: pa.Schema):
    """One row per conversation from segments and rows in order."""

    def repair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current: _Repair | None = None
        for batch in batches:
            done = []
            for row in batch.to_pylist():
                if current is None or current.key != row["conv"]:
                    if current is not None:
                        done.append(current.result())
                    current = _Repair(row["conv"])
                if row["segment"] is not None:
                    current.segment(row["segment"])
                else:
                    current.row(row["role"], row["text"])
            if done:
                yield pa.RecordBatch.from_pylist(done, schema=schema)
        if current is not None:
            yield pa.RecordBatch.from_pylist([current.result()], schema=schema)

    return repair


def _arrow(frame: DataFrame, ddl: str) -> pa.Schema:
    empty = frame.sparkSession.createDataFrame([], ddl)
    return empty.toArrow().schema


def repaired_conversations(
    rows: DataFrame,
    *,
    conversation: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    segment_rows: int = SEGMENT_ROWS,
) -> DataFrame:
    """``(conversation, gaps, blank, duplicate, truncated, illegal, cost, audit,
    repaired_sha256)``: every conversation damaged, examined and repaired.

    Rows are ordered by turn, nulls first; equal turns go by role, then by the
    SHA-256 of the text, so that equal rows stand together. Null roles and
    texts count as one space, which makes a row blank and no turn. A null
    conversation is one. Repeated rows are duplicates. A conversation without
    rows after damage has zeros, an empty audit and the hash of nothing. Other
    columns are ignored whatever their names; an empty table gives no rows.

    Ordering, counting and auctions see no text. They run on segments of at
    most ``segment_rows`` rows, so a conversation of any size is spread over
    tasks; one task sees its segments, a few numbers and a letter per row each.
    Texts are shuffled once. SHA-256 takes its bytes in order, so one task
    reads a conversation's texts, but as a stream that holds none of them.
    The ordering runs when the plan is built and writes to the shared folder.
    """
    kind = rows.schema[conversation].dataType.simpleString()
    texts = damaged(rows, conversation, turn, role, text)
    facts = ordinals(_facts(texts), [F.asc_nulls_first("conv"), F.asc_nulls_first("turn"), "role", "digest"], "g")
    firsts = (
        facts.where(~F.col("gone"))
        .groupBy("conv", "role", "digest").agg(F.min("g").alias("g"))
        .select("g", F.lit(True).alias("first"))
    )
    marked = facts.drop("role", "digest").join(firsts, "g", "left").withColumn("duplicate", F.col("first").isNull())
    fault = F.when(F.col("blank"), "b").when(F.col("duplicate"), "d").when(F.col("truncated"), "t").otherwise(".")
    here = ~F.col("gone")
    letters = F.sort_array(F.collect_list(F.when(here, F.struct("g", F.concat("initial", fault).alias("letters")))))
    turns = F.when(here, F.col("turn"))
    gathered = marked.groupBy("conv", F.expr(f"g div {int(segment_rows)}").alias("seg")).agg(
        F.array_join(letters["letters"], "").alias("letters"),
        F.min(turns).alias("least"), F.max(turns).alias("most"),
        F.size(F.collect_set(turns)).cast("long").alias("distinct"),
    )
    ddl = SEGMENTS.format(kind=kind)
    segments = gathered.mapInArrow(_segments(_arrow(rows, ddl)), ddl)
    ddl += ", ends array<long>"
    bordered = segments.repartition("conv").sortWithinPartitions("conv", F.desc("seg"))
    bordered = bordered.mapInArrow(_borders(_arrow(rows, ddl)), ddl)
    ddl += ", audits array<string>, reached array<int>"
    traced = bordered.repartition("conv", "seg").mapInArrow(_traced(_arrow(rows, ddl)), ddl).drop("codes")
    names = [c for c in traced.columns if c not in ("conv", "seg")]
    no_text = F.lit(None).cast("string")
    pieces = traced.select("conv", F.lit(0).alias("part"), F.col("seg").alias("at"), no_text.alias("role"), no_text.alias("digest"),
                           no_text.alias("text"), F.struct(*names).alias("segment"))
    kept = texts.where(~F.col("gone")).select(
        "conv", F.lit(1).alias("part"), F.col("turn").alias("at"), "role",
        F.sha2(F.col("text").cast("binary"), 256).alias("digest"), "text",
        F.lit(None).cast(pieces.schema["segment"].dataType).alias("segment"))
    stream = pieces.unionByName(kept).repartition("conv").sortWithinPartitions(
        "conv", "part", F.asc_nulls_first("at"), "role", "digest")
    ddl = RESULT.format(kind=kind)
    result = stream.select("conv", "segment", "role", "text").mapInArrow(_repaired(_arrow(rows, ddl)), ddl)
    return result.withColumnRenamed("conv", conversation)
