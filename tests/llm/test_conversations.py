from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter
from itertools import product

import numpy as np
import pytest

from mailtax.llm import conversations as cv
from tests.llm.conftest import SF_DIR

STEP = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (3, "u"): 2, (2, "a"): 3}


def plain_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return out


def plain_faults(rows):
    seen, out = set(), []
    for role, text in rows:
        last = re.findall(r"[^\x20\x09-\x0D]", text)[-1:]
        out.append("blank" if not last else "duplicate" if (role, text) in seen else "" if last[0] in ".!?" else "truncated")
        seen.add((role, text))
    return out


def plain_repair(rows, faults):
    """(cost, audit, lines): every state with its cheapest edits, row by row, all strings spelled out."""
    def inserted(states):
        for _ in range(4):
            for state, (cost, audit, lines) in list(states.items()):
                for initial, role in (("u", "user"), ("a", "assistant")):
                    if (state, initial) in STEP:
                        new = (cost + 5, audit + "I", lines + [f"{role}:"])
                        to = STEP[state, initial]
                        if to not in states or new < states[to]:
                            states[to] = new
        return states

    states = inserted({0: (0, "", [])})
    for (role, text), fault in zip(rows, faults):
        after = {}

        def offer(to, found):
            if to not in after or found < after[to]:
                after[to] = found

        for state, (cost, audit, lines) in states.items():
            offer(state, (cost + 2, audit + "D", lines))
            if fault not in ("blank", "duplicate"):
                more = 5 if fault == "truncated" else 0
                if (state, role[:1]) in STEP:
                    offer(STEP[state, role[:1]], (cost + more, audit + "K", lines + [f"{role}:{text}"]))
                for initial, new in (("u", "user"), ("a", "assistant")):
                    if (state, initial) in STEP:
                        offer(STEP[state, initial], (cost + 1 + more, audit + "R", lines + [f"{new}:{text}"]))
        states = inserted(after)
    return min(states[s] for s in (0, 3) if s in states)


def plain_result(rows):
    ids, after = {r[0] for r in rows}, plain_damage(rows)
    out = []
    for conv in ids:
        own = [r for r in after if r[0] == conv]
        own.sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2], hashlib.sha256(r[3].encode()).hexdigest()))
        pairs = [(r[2], r[3]) for r in own]
        turns = {r[1] for r in own if r[1] is not None}
        faults = plain_faults(pairs)
        n = Counter(faults)
        cost, audit, lines = plain_repair(pairs, faults)
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(pairs, pairs[1:]))
        out.append((
            conv, max(turns) - min(turns) + 1 - len(turns) if turns else 0, n["blank"], n["duplicate"], n["truncated"], illegal, cost, audit,
            hashlib.sha256("\n".join(lines).encode()).hexdigest(),
        ))
    return sorted(out, key=str)


KINDS = "conv_id long, turn long, role string, text string"


def random_rows(rng, conversations, longest):
    rows = []
    for conv in range(conversations):
        turn = 0
        for _ in range(rng.randint(1, longest)):
            turn += rng.choice((0, 1, 1, 1, 1, 3))
            role = rng.choice(("user", "assistant", "user", "assistant", "system", "tool", "", None))
            text = rng.choice(("Yes.", "No!", "What?  ", " \t\n", "", "so", "and then,", None, f"row {rng.random()}.", f"{rng.random()}"))
            rows.append((conv, rng.choice((turn, turn, turn, None)), role, text))
    return rows


@pytest.mark.parametrize("chunk, fan, rules", [(256, 256, 64), (3, 2, 64), (2, 3, 2)])
def test_against_brute_force(spark, rng, monkeypatch, chunk, fan, rules):
    monkeypatch.setattr(cv, "CHUNK", chunk)
    monkeypatch.setattr(cv, "FAN", fan)
    monkeypatch.setattr(cv, "RULES", rules)
    rows = random_rows(rng, 60, 8) + [(100, i, ("user", "assistant")[i % 2], f"{i}.") for i in range(70)]
    rows += [(None, 1, "user", "a."), (None, 2, "assistant", "b."), (101, None, "user", "c.")]
    got = cv.repaired_conversations(spark.createDataFrame(rows, KINDS).repartition(3))
    assert got.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert sorted(map(tuple, got.collect()), key=str) == plain_result(rows)


def test_given_conversations(spark):
    table = spark.read.parquet(f"{SF_DIR}/conversations.parquet")
    rows = [(r.conv_id, r.turn, r.role, r.text) for r in table.collect()]
    got = sorted(map(tuple, cv.repaired_conversations(table).collect()), key=str)
    assert got == plain_result(rows) and len({r[7] for r in got}) > 5


def test_repaired_rows_follow_the_grammar(spark, rng):
    rows = random_rows(rng, 30, 10)
    summary, out = cv.repair(spark.createDataFrame(rows, KINDS))
    by = {}
    for r in sorted(out.collect(), key=lambda r: (r.conv_id, r.place, r.part)):
        by.setdefault(r.conv_id, []).append(r)
    for r in summary.collect():
        own = by.get(r.conv_id, [])
        assert re.fullmatch("(s?(ua)+)?", "".join(x.role[0] for x in own))
        assert [x.edit for x in own] == [e for e in r.audit if e != "D"]
        assert all(x.text == "" for x in own if x.edit == "I")


def test_every_short_sequence_and_split(rng):
    """Matrix products in any bracketing, by rules or not, spell the same edits as the plain search."""
    faults = ["", "blank", "duplicate", "truncated"]
    grammar = cv.Grammar([("e", "i"), ("i", "e"), (chr(cv.RULE_0), chr(cv.RULE_0)), ("h", "l")])
    flat = cv.Grammar([])
    codes = list(product(range(16), repeat=3)) + [tuple(rng.choice((4, 8, 4, 8, rng.randrange(16))) for _ in range(rng.randint(4, 40))) for _ in range(400)]
    sequences = ["".join(chr(97 + c) for c in x) for x in codes]
    for g in (grammar, flat):
        m = g.fold(sequences)[0]
        whole = (m[:, :4] + np.array([5 * len(cv.CLOSING[s]) for s in range(4)])) * 4 + m[:, 16:20]
        end = whole.argmin(axis=1)
        spelled = g.edits(sequences, np.zeros(len(end), np.int64), end)
        for x, cost, s, e in zip(codes, (whole.min(axis=1) // 4).tolist(), spelled, end.tolist()):
            rows = [(("system", "user", "assistant", "tool")[c // 4], str(i)) for i, c in enumerate(x)]
            want = plain_repair(rows, [faults[c % 4] for c in x])
            assert (cost, cv.audit(s + cv.CLOSING[e])) == want[:2], x


def test_grammar_compresses_and_keeps(spark):
    sequences = spark.createDataFrame([("eieieiei" * 4, 5), ("eiei", 100), ("p", 7)], "seq string, n long")
    rules = cv.repair_grammar(sequences)
    grammar = cv.Grammar(rules)
    assert [len(s) for s in grammar.compress(["eieieiei" * 4, "eiei", "p"])] == [1, 1, 1]
    assert cv.repair_grammar(sequences.limit(0)) == []


def test_long_conversation_and_long_text(spark):
    rows = [(1, i, ("user", "assistant")[i % 2], f"{i}.") for i in range(70_000)] + [(2, 0, "user", "x" * 2_000_000)]
    got = {r.conv_id: r for r in cv.repaired_conversations(spark.createDataFrame(rows, KINDS)).collect()}
    want = {r[0]: r for r in [plain_summary(rows)]}
    assert (got[1].audit, got[1].cost, got[1].repaired_sha256) == want[1][1:]
    assert got[2].conv_id == 2


def plain_summary(rows):
    own = [(r[2], r[3]) for r in plain_damage([r for r in rows if r[0] == 1])]
    faults = plain_faults(own)
    cost, audit, lines = chunked_repair(own, faults)
    return 1, audit, cost, hashlib.sha256("\n".join(lines).encode()).hexdigest()


def chunked_repair(rows, faults):
    """As ``plain_repair``, for long conversations: costs to go from the end, then the least letter that keeps the cost."""
    n = len(rows)
    far = 10**9
    insert = {s: {t: 5 * len(a) for (f, t), a in {(0, 2): "u", (0, 3): "ua", (1, 2): "u", (1, 3): "ua", (2, 3): "a", (3, 2): "u"}.items() if f == s} | {s: 0} for s in range(4)}

    def options(i, state):
        (role, _), fault = rows[i], faults[i]
        yield "D", 2, state, None
        if fault not in ("blank", "duplicate"):
            more = 5 if fault == "truncated" else 0
            if (state, role[:1]) in STEP:
                yield "K", more, STEP[state, role[:1]], role
            for initial, new in (("u", "user"), ("a", "assistant")):
                if (state, initial) in STEP:
                    yield "R", 1 + more, STEP[state, initial], new

    close = {s: min((c + (0 if t in (0, 3) else far)) for t, c in insert[s].items()) for s in range(4)}
    togo = [None] * n + [close]
    for i in range(n - 1, -1, -1):
        direct = {s: min(c + togo[i + 1][t] for _, c, t, _ in options(i, s)) for s in range(4)}
        togo[i] = {s: min(c + direct[t] for t, c in insert[s].items()) for s in range(4)}
    state, audit, lines, cost = 0, [], [], togo[0][0]
    left = cost
    i = 0
    while i < n or left:
        ways = []
        if i < n:
            ways += [(letter, c, t, i + 1, new and f"{new}:{rows[i][1]}") for letter, c, t, new in options(i, state) if c + togo[i + 1][t] == left]
        for initial, role in (("u", "user"), ("a", "assistant")):
            if (state, initial) in STEP and 5 + togo[i][STEP[state, initial]] == left:
                ways.append(("I", 5, STEP[state, initial], i, f"{role}:"))
        letter, c, state, i, line = min(ways, key=lambda w: w[0])
        audit.append(letter)
        lines += [line] if line else []
        left -= c
    return cost, "".join(audit), lines


def test_odd_rows(spark):
    wide = "conv_id long, turn long, role string, text string, place long, c string, symbol string"
    rows = [(1, 0, "user", "Hi."), (1, 0, "user", "Hi."), (1, 0, "user", "Hi."), (2, None, None, None), (2, None, None, None), (3, 5, "", "x" * 100_000)]
    df = spark.createDataFrame([(*r, 1, "x", "y") for r in rows], wide)
    got = sorted(map(tuple, cv.repaired_conversations(df).collect()), key=str)
    assert got == plain_result(rows)
    assert cv.repaired_conversations(df.limit(0)).isEmpty()
    summary, out = cv.repair(df.limit(0))
    assert summary.isEmpty() and out.isEmpty()
