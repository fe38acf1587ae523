"""Damage and repair of conversations against plain evaluations of the contract."""

import hashlib
import itertools
import random
import re
import zlib

import pytest

from gridloom.llm import conversations, queries

ROWS = "conv_id long, turn long, role string, text string"
WHITE = " \t\n\x0b\x0c\r"
RIGHT = re.compile(r"(s?(ua)+)?")


def plain_damage(rows):
    """Rows of one conversation after damage, in order."""
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if v is None else v for v in (role, text))
        name = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        harm = zlib.crc32(name.encode()) % 20
        if harm == 0:
            continue
        text = "" if harm == 1 else re.sub("[.!?]", "", text) if harm == 2 else text
        out += [(turn, "user" if harm == 4 else role, text)] * (2 if harm == 3 else 1)
    return sorted(out, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.sha256(r[2].encode()).hexdigest()))


def plain_faults(rows):
    faults = []
    for i, (_, role, text) in enumerate(rows):
        bare = text.strip(WHITE)
        seen = any((role, text) == r[1:] for r in rows[:i])
        faults.append("blank" if not bare else "duplicate" if seen else "truncated" if bare[-1] not in ".!?" else None)
    return faults


def plain_repair(rows, faults):
    """Cheapest cost, least audit and repaired lines, by all best ways to every state."""
    def step(role, before):  # state after a role's initial, or None
        return {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("a", "u"): "u", ("u", "a"): "a"}.get((before, role[:1]))

    def inserted(ways):
        for _ in range(2):
            for state, (cost, audit, lines) in list(ways.items()):
                for role in ("user", "assistant"):
                    to = step(role, state)
                    if to:
                        new = (cost + 3, audit + "I", lines + [role + ":"])
                        ways[to] = min(ways.get(to, new), new)
        return ways

    ways = {"": (0, "", [])}
    for (_, role, text), fault in zip(rows, faults):
        after = {}
        for state, (cost, audit, lines) in inserted(ways).items():
            extra = 3 if fault == "truncated" else 0
            moves = [(state, 4, "D", [])]
            if fault not in ("blank", "duplicate"):
                moves.append((step(role, state), extra, "K", [f"{role}:{text}"]))
                moves += [(step(r, state), 3 + extra, "R", [f"{r}:{text}"]) for r in ("user", "assistant")]
            for to, more, letter, line in moves:
                if to is not None:
                    new = (cost + more, audit + letter, lines + line)
                    after[to] = min(after.get(to, new), new)
        ways = after
    return min(way for state, way in inserted(ways).items() if state in ("", "a"))


def plain_result(conv, rows):
    rows = plain_damage(rows)
    faults = plain_faults(rows)
    turns = {r[0] for r in rows if r[0] is not None}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    cost, audit, lines = plain_repair(rows, faults)
    kinds = [faults.count(k) for k in ("blank", "duplicate", "truncated")]
    return (conv, gaps, *kinds, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def plain_results(rows):
    by = {}
    for row in rows:
        by.setdefault(row[0], []).append(row)
    return [plain_result(conv, own) for conv, own in by.items()]


def same(frame, wanted):
    key = lambda r: (r[0] is None, r[0] or 0)
    for got, want in zip(sorted(map(tuple, frame.collect()), key=key), sorted(wanted, key=key), strict=True):
        assert got == want


def brute_audits(codes):
    """Cheapest edits in full, by trying all strings of letters up to a length."""
    best = None
    for length in range(2 * len(codes) + 3):
        for letters in itertools.product("DIKR", repeat=length):
            if sum(x != "I" for x in letters) != len(codes):
                continue
            initials, cost, rows = "", 0, iter(codes)
            for x in letters:
                turn = "a" if initials[-1:] == "u" else "u"
                code = "" if x == "I" else next(rows)
                if x == "I":
                    initials, cost = initials + turn, cost + 3
                elif x == "D":
                    cost += 4
                elif code == "-":
                    cost += 10**6
                else:
                    initials += code.lower() if x == "K" else turn
                    cost += (3 if code.isupper() else 0) + (3 if x == "R" else 0)
            if cost < 10**6 and RIGHT.fullmatch(initials):
                best = min(best or (cost, letters), (cost, letters))
    return best[0], "".join(best[1])


def audit_of(codes, ends=conversations.FINAL):
    audits, reached = conversations.traces(codes, ends)
    return conversations.auction_prices(codes, ends)[0][0], audits[0] + conversations.last_insertions(reached[0])


def test_the_auction_finds_the_least_of_the_cheapest():
    assert conversations.FINAL == (0, 6, 3, 0)
    for codes in ["", *"suaxSUAX-", "su", "ua", "au", "uu", "s-", "xX", "aa", "Ua", "suU", "ss", "u-a"]:
        assert audit_of(codes) == brute_audits(codes), codes


def test_layers_have_the_prices_of_relaxation():
    rng = random.Random(9)
    for _ in range(3000):
        code = rng.choice("suaxSUAX-")
        later = tuple(rng.choice([conversations.FAR, *range(12)]) for _ in range(4))
        if min(later) == conversations.FAR:
            continue
        price = [conversations.FAR] * 4
        for _ in range(6):
            for s in range(4):
                for _, cost, moved, to in conversations.ARCS[code][s]:
                    price[s] = min(price[s], cost + (later if moved else price)[to])
        assert conversations.auction_layer(code, later) == tuple(price), (code, later)


def test_segments_make_the_whole():
    rng = random.Random(10)
    for _ in range(200):
        codes = "".join(rng.choice("uaauuasxSUAX--") for _ in range(rng.randint(0, 40)))
        cuts = sorted(rng.randint(0, len(codes)) for _ in range(3))
        parts = [codes[a:b] for a, b in zip([0, *cuts], [*cuts, len(codes)])]
        ends = [conversations.FINAL]
        for part in reversed(parts):
            ends.append(conversations.through(conversations.segment_costs(part), ends[-1]))
        ends.reverse()
        state, audit = 0, ""
        for part, end in zip(parts, ends[1:]):
            audits, reached = conversations.traces(part, end)
            audit, state = audit + audits[state], reached[state]
        assert (ends[0][0], audit + conversations.last_insertions(state)) == audit_of(codes)


def random_rows(seed, convs):
    rng = random.Random(seed)
    texts = ["Hello there.", "Yes!", "cut off", " \t\x0b\n", "", None, "é?\x0c", "end. ", "a. b! c?", "  .  "]
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", None, "User", "server"]
    rows = []
    for conv in convs:
        for turn in range(rng.randint(1, 14)):
            rows.append((conv, None if rng.random() < 0.05 else turn * rng.choice([1, 1, 1, 2]), rng.choice(roles), rng.choice(texts)))
    return rows


@pytest.mark.parametrize("segment_rows", [4096, 3, 1])
def test_whole_jobs_with_segments_of_any_size(spark, segment_rows):
    rows = random_rows(11, [None, *range(300)])
    rows += [(1000, None, None, None)] * 3 + [(1001, t, "user" if t % 2 else "assistant", "same.") for t in range(120)]
    rows += [(1002, 5, "user", "Long. " * 100_000), (1002, 5, "user", "Long. " * 100_000)]
    frame = spark.createDataFrame(rows, ROWS).repartition(4)
    for extra in ("conv", "g", "seg", "code", "gone", "at", "part", "segment", "cost", "first", "digest"):
        frame = frame.withColumn(extra, frame.turn)
    got = conversations.repaired_conversations(frame, segment_rows=segment_rows)
    assert got.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    same(got, plain_results(rows))


def test_nothing_left_and_nothing_given(spark):
    turn = next(t for t in range(100) if zlib.crc32(f"7:{t}".encode()) % 20 == 0)
    frame = spark.createDataFrame([(7, turn, "user", "gone.")], ROWS)
    none = hashlib.sha256(b"").hexdigest()
    assert [tuple(r) for r in conversations.repaired_conversations(frame).collect()] == [(7, 0, 0, 0, 0, 0, 0, "", none)]
    assert conversations.repaired_conversations(frame.limit(0)).count() == 0


def test_query(spark):
    sf_dir = "/root/testdata/sf0.1"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    same(queries.QUERIES["op11_conversation_repair"](spark, sf_dir), plain_results(rows))
