"""Repair of conversation structure by a grammar-compressed dynamic program.

Each row of a conversation is a symbol: the initial of its role and its first fault. Edits turn the rows into a sequence of roles
``(s?(ua)+)?``; an edit depends on the rows before it only through one of four states (nothing yet, after system, after user,
after assistant). So a run of rows is a 4 x 4 min-plus transfer matrix: the least cost from state to state, and, as equal costs
go to the least audit, the order of the audits that start in one state. Audits of a run from one state end in different states,
have as many row edits and end in one, so none is a prefix of another and the order of two joined runs follows from the orders
of the parts. An entry keeps the state between its parts; that is its rope, and audits are only spelled along the chosen ropes.

Conversations are cut into chunks of bounded length. Re-Pair over the different chunks, counted by Spark, gives a grammar of bounded
size: every round turns the most frequent pairs of symbols into rules. Each rule's matrix is made once, bottom-up, from those of its
two parts, and shared by all conversations; a chunk is the product of few matrices. Products of chunks are folded in levels of
bounded groups and the chosen states handed down again, so a conversation may have any length.
"""

from __future__ import annotations

import hashlib
import re
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mailtax.functions.numbering import number_within
from mailtax.functions.staging import cut
from mailtax.llm.common import Batches

CHUNK = 256  # rows of a chunk
FAN = 256  # chunks, or groups of them, that are folded at once
ROUNDS, RULES = 8, 64  # of the grammar: rounds, and new rules a round
BLANKS = " \t\n\x0b\x0c\r"
RULE_0 = 0x4E00  # code point of the first rule; rows are letters from a on
# Costs of the edits, and what an undeleted truncated row adds.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
NEXT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (3, "u"): 2, (2, "a"): 3}  # states by state and role
INSERTS = {(0, 2): "u", (0, 3): "ua", (1, 2): "u", (1, 3): "ua", (2, 3): "a", (3, 2): "u"}
CLOSING = {0: "", 1: "ua", 2: "a", 3: ""}
ROLES = "sua?"
NONE, BLANK, DUPLICATE, TRUNC = range(4)
FAR = 1 << 50
WIDTH = 38  # 16 costs, 16 orders, 4 counts (blank, duplicate, truncated, illegal), first and last role
KEY = ["c0", "c"]


def damaged(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``conv_id, turn, role, text`` with faults put in by crc32 of ``conv_id:turn`` modulo 20: 0 drops a row, 1 empties its text,
    2 removes ``.!?``, 3 repeats it, 4 makes its role user. Null roles, texts and parts of the key are one space."""
    spaced = {c: F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in (conv, turn, role, text)}
    kind = F.pmod(F.crc32(F.concat(spaced[conv], F.lit(":"), spaced[turn]).cast("binary")), F.lit(20))
    rows = df.select(F.col(conv).alias("conv_id"), F.col(turn).alias("turn"), spaced[role].alias("role"), spaced[text].alias("text"), kind.alias("kind"))
    return rows.where("kind <> 0").select(
        "conv_id", "turn",
        F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    ).drop("copy")


# --- matrices ---------------------------------------------------------------------------------------------------------


def row_matrix(code: int) -> tuple[np.ndarray, dict[tuple[int, int], str]]:
    """The packed matrix of a row (4 x role + fault), and how each entry is spelled: inserted initials, then K, U or A
    (rerole), or D."""
    role, fault = ROLES[code // 4], code % 4
    best: dict[tuple[int, int], tuple[int, str, str]] = {}
    for state in range(4):
        for middle in range(4):
            if state != middle and (state, middle) not in INSERTS:
                continue
            added = INSERTS.get((state, middle), "")
            ways = [(DELETE, "D", middle)]
            if fault not in (BLANK, DUPLICATE):
                more = TRUNCATED if fault == TRUNC else 0
                ways += [(more, "K", NEXT[middle, role])] if (middle, role) in NEXT else []
                ways += [(REROLE + more, new.upper(), NEXT[middle, new]) for new in "ua" if (middle, new) in NEXT]
            for cost, letter, end in ways:
                found = (cost + INSERT * len(added), audit(added + letter), added + letter)
                best[state, end] = min(best.get((state, end), found), found)
    out = np.full(WIDTH, FAR, np.int64)
    for state in range(4):
        ends = sorted(range(4), key=lambda e: (best[state, e][1] if (state, e) in best else "~", e))
        for order, end in enumerate(ends):
            out[16 + 4 * state + end] = order
            if (state, end) in best:
                out[4 * state + end] = best[state, end][0]
    out[32:] = [fault == BLANK, fault == DUPLICATE, fault == TRUNC, 0, code // 4, code // 4]
    return out, {k: v[2] for k, v in best.items()}


def audit(spelled: str) -> str:
    """Initials of the edits: inserts and reroles are spelled by their role."""
    return spelled.translate(str.maketrans("uaUA", "IIRR"))


def product(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Packed matrices (n, WIDTH) of the runs a and b in sequence, and the state between them for each entry."""
    cost_a, order_a = a[:, :16].reshape(-1, 4, 4), a[:, 16:32].reshape(-1, 4, 4)
    cost_b, order_b = b[:, :16].reshape(-1, 4, 4), b[:, 16:32].reshape(-1, 4, 4)
    both = (cost_a[:, :, :, None] + cost_b[:, None, :, :]) * 4 + order_a[:, :, :, None]  # n, start, between, end
    between = both.argmin(axis=2)
    cost = np.minimum(both.min(axis=2) // 4, FAR)
    ends = np.arange(4)[None, None, :]
    rows = np.arange(len(a))[:, None, None]
    rank = np.take_along_axis(order_a, between, axis=2) * 4 + order_b[rows, between, ends]
    rank = np.where(cost >= FAR, 16 + ends, rank)
    order = rank.argsort(axis=2).argsort(axis=2)
    counts = a[:, 32:36] + b[:, 32:36]
    last, first = a[:, 37], b[:, 36]
    legal = ((last == 0) & (first == 1)) | ((last == 1) & (first == 2)) | ((last == 2) & (first == 1))
    counts[:, 3] += ~legal
    out = np.concatenate([cost.reshape(-1, 16), order.reshape(-1, 16), counts, a[:, 36:37], b[:, 37:38]], axis=1)
    return out, between.astype(np.int8)


def folded(parts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """Products of ragged runs of packed matrices (``sizes`` of them each, at least one), and per step the runs that go on
    with the states in between."""
    first = np.cumsum(sizes) - sizes
    out, steps = parts[first].copy(), []
    for t in range(1, int(sizes.max(initial=0))):
        on = np.flatnonzero(sizes > t)
        out[on], between = product(out[on], parts[first[on] + t])
        steps.append((on, between))
    return out, steps


def unfolded(sizes: np.ndarray, steps: list, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last state of every part, given those of the runs."""
    first = np.cumsum(sizes) - sizes
    starts, ends = np.empty(int(sizes.sum()), np.int64), np.empty(int(sizes.sum()), np.int64)
    end = end.copy()
    for t in range(len(steps), 0, -1):
        on, between = steps[t - 1]
        middle = between[np.arange(len(on)), start[on], end[on]]
        starts[first[on] + t], ends[first[on] + t] = middle, end[on]
        end[on] = middle
    starts[first], ends[first] = start, end
    return starts, ends


class Grammar:
    """Rules (pairs of symbols) with one matrix and one rope of states each, made bottom-up."""

    def __init__(self, rules: list[tuple[str, str]]):
        self.rules = rules
        self.number = {chr(97 + i): i for i in range(16)} | {chr(RULE_0 + i): 16 + i for i in range(len(rules))}
        rows = [row_matrix(i) for i in range(16)]
        self.spelled = [s for _, s in rows]
        self.matrices = np.concatenate([np.stack([m for m, _ in rows]), np.zeros((len(rules), WIDTH), np.int64)])
        self.ropes: list[tuple[int, int, np.ndarray]] = []
        for i, (a, b) in enumerate(rules):
            a, b = self.number[a], self.number[b]
            made, between = product(self.matrices[a][None], self.matrices[b][None])
            self.matrices[16 + i] = made[0]
            self.ropes.append((a, b, between[0]))
        self.spell = cache(self._spell)

    def compress(self, sequences: list[str]) -> list[str]:
        """Each rule replaces its pair from left to right, in the order of the rules."""
        joined = "\n".join(sequences)
        for i, (a, b) in enumerate(self.rules):
            joined = joined.replace(a + b, chr(RULE_0 + i))
        return joined.split("\n")

    def fold(self, sequences: list[str]):
        """Packed matrices of the sequences, with sizes, symbols and steps of the products."""
        short = self.compress(sequences)
        sizes = np.fromiter(map(len, short), np.int64, len(short))
        symbols = np.fromiter((self.number[c] for s in short for c in s), np.int64, int(sizes.sum()))
        out, steps = folded(self.matrices[symbols], sizes)
        return out, sizes, symbols, steps

    def _spell(self, symbol: int, start: int, end: int) -> str:
        if symbol < 16:
            return self.spelled[symbol][start, end]
        a, b, between = self.ropes[symbol - 16]
        middle = int(between[start, end])
        return self.spell(a, start, middle) + self.spell(b, middle, end)

    def edits(self, sequences: list[str], start: np.ndarray, end: np.ndarray) -> list[str]:
        """How each sequence is edited on its way between the states."""
        _, sizes, symbols, steps = self.fold(sequences)
        starts, ends = unfolded(sizes, steps, start, end)
        parts = [self.spell(*x) for x in zip(symbols.tolist(), starts.tolist(), ends.tolist())]
        at = np.concatenate(([0], np.cumsum(sizes))).tolist()
        return ["".join(parts[a:b]) for a, b in zip(at, at[1:])]


def pair_counts(sequences: list[str], weights: np.ndarray, grammar: Grammar) -> tuple[np.ndarray, np.ndarray]:
    """(pair, occurrences) of neighbouring symbols in the compressed sequences."""
    points = np.frombuffer("\n".join(grammar.compress(sequences)).encode("utf-16-le"), "<u2").astype(np.int64)
    apart = points == 10
    of = np.cumsum(apart)[:-1]
    inside = ~(apart[:-1] | apart[1:])
    pairs, at = np.unique((points[:-1] << 16 | points[1:])[inside], return_inverse=True)
    return pairs, np.bincount(at, weights[of[inside]], len(pairs)).astype(np.int64)


def repair_grammar(sequences: DataFrame, rounds: int = ROUNDS, rules: int = RULES) -> list[tuple[str, str]]:
    """Re-Pair over all rows of ``sequences`` (``seq, n``: a sequence and how often it occurs), ``rules`` pairs a round."""
    found: list[tuple[str, str]] = []
    for _ in range(rounds):
        known = list(found)

        def work(batches: Batches, known=known) -> Batches:
            grammar = Grammar(known)
            for batch in batches:
                pairs, n = pair_counts(batch.column("seq").to_pylist(), batch.column("n").to_numpy(), grammar)
                yield pa.RecordBatch.from_arrays([pa.array(pairs), pa.array(n)], ["pair", "n"])

        counts = sequences.mapInArrow(work, "pair bigint, n bigint").groupBy("pair").agg(F.sum("n").alias("n"))
        best = counts.where("n > 1").orderBy(F.desc("n"), "pair").limit(rules).collect()
        found += [(chr(r["pair"] >> 16), chr(r["pair"] & 0xFFFF)) for r in best]
        if not best:
            break
    return found


# --- rows -------------------------------------------------------------------------------------------------------------


def _keyed(df: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """Key columns that are never null: ``c0, c`` (conversation), ``t0, t`` (turn, nulls first), ``role``, ``h`` (hash of
    the text); and ``text``."""
    return df.select(
        F.col(conv).isNull().alias("c0"), F.coalesce(F.col(conv).cast("string"), F.lit("")).alias("c"),
        F.col(turn).isNotNull().alias("t0"), F.coalesce(F.col(turn).cast("bigint"), F.lit(0)).alias("t"),
        F.coalesce(F.col(role).cast("string"), F.lit(" ")).alias("role"), F.coalesce(F.col(text), F.lit(" ")).alias("text"),
    ).withColumn("h", F.sha2("text", 256))


def symbols(rows: DataFrame) -> DataFrame:
    """Narrow rows (no texts) with their ``place`` in the conversation (from 0) and their ``symbol``, stored."""
    trimmed = F.rtrim("text", F.lit(BLANKS))
    state = F.when(trimmed == "", BLANK).when(F.substring(trimmed, -1, 1).isin(".", "!", "?"), NONE).otherwise(TRUNC)
    first = F.substring("role", 1, 1)
    role = F.when(first == "s", 0).when(first == "u", 1).when(first == "a", 2).otherwise(3)
    narrow = rows.select(*KEY, "t0", "t", "role", "h", state.alias("state"), role.alias("kind"))
    placed = cut(number_within(narrow, KEY, ["t0", "t", "role", "h"], "place").withColumn("place", F.col("place") - 1))
    same = [*KEY, "role", "h"]
    earliest = placed.where(F.col("state") != BLANK).groupBy(*same).agg(F.min("place").alias("place"), F.count("*").alias("n"))
    again = cut(earliest.where("n > 1").select(*same, F.col("place").alias("earliest")))
    joined = placed.join(again, same, "left")
    fault = F.when((F.col("state") != BLANK) & (F.col("place") > F.col("earliest")), DUPLICATE).otherwise(F.col("state"))
    return cut(joined.select(*KEY, "t0", "t", "role", "h", "place", F.char(97 + 4 * F.col("kind") + fault).alias("symbol")))


def _in_order(of: str, then: str) -> Column:
    """``then`` of the group's rows in the order of ``of``."""
    return F.transform(F.array_sort(F.collect_list(F.struct(of, then))), lambda x: x[then])


def _packed(column: pa.Array) -> np.ndarray:
    """Rows of packed matrices from binary values."""
    return np.frombuffer(b"".join(column.to_pylist()), np.int64).reshape(-1, WIDTH)


def _binary(matrices: np.ndarray) -> pa.Array:
    return pa.array([m.tobytes() for m in np.ascontiguousarray(matrices)], pa.binary())


def _keys(batch: pa.RecordBatch, names: list[str]) -> list[pa.Array]:
    return [batch.column(n) for n in names]


def _chunk_matrices(chunks: DataFrame, grammar: Grammar) -> DataFrame:
    """``c0, c, idx, m`` of each chunk."""
    rules = chunks.sparkSession.sparkContext.broadcast(grammar.rules)

    def work(batches: Batches) -> Batches:
        grammar = Grammar(rules.value)
        for batch in batches:
            different, at = np.unique(np.array(batch.column("seq").to_pylist(), object), return_inverse=True)
            made = grammar.fold(different.tolist())[0][at] if len(at) else np.zeros((0, WIDTH), np.int64)
            yield pa.RecordBatch.from_arrays([*_keys(batch, ["c0", "c", "idx"]), _binary(made)], ["c0", "c", "idx", "m"])

    return chunks.select("c0", "c", "idx", "seq").mapInArrow(work, "c0 boolean, c string, idx bigint, m binary")


def _fold_level(below: DataFrame) -> DataFrame:
    """``c0, c, idx, parts, m``: groups of FAN rows of the level below and their products."""
    grouped = below.groupBy(*KEY, F.floor(F.col("idx") / FAN).cast("bigint").alias("idx")).agg(_in_order("idx", "m").alias("parts"))

    def work(batches: Batches) -> Batches:
        for batch in batches:
            parts = batch.column("parts")
            made, _ = folded(_packed(parts.flatten()), np.diff(parts.offsets.to_numpy()).astype(np.int64))
            yield pa.RecordBatch.from_arrays([*_keys(batch, ["c0", "c", "idx", "parts"]), _binary(made)], ["c0", "c", "idx", "parts", "m"])

    return grouped.mapInArrow(work, "c0 boolean, c string, idx bigint, parts array<binary>, m binary")


def _decide(top: DataFrame) -> DataFrame:
    """Per conversation the best last state, what is inserted at the end, and the totals."""

    def work(batches: Batches) -> Batches:
        closing = np.array([INSERT * len(CLOSING[s]) for s in range(4)])
        for batch in batches:
            m = _packed(batch.column("m"))
            whole = (m[:, :4] + closing) * 4 + m[:, 16:20]
            end = whole.argmin(axis=1)
            cost = whole.min(axis=1) // 4
            columns = [pa.array(end), pa.array([CLOSING[e] for e in end.tolist()], pa.string()), pa.array(cost), *[pa.array(m[:, 32 + k]) for k in range(4)]]
            names = ["end", "tail", "cost", "blank", "duplicate", "truncated", "illegal"]
            yield pa.RecordBatch.from_arrays([*_keys(batch, KEY), *columns], [*KEY, *names])

    kinds = "c0 boolean, c string, end bigint, tail string, cost bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint"
    return top.select(*KEY, "m").mapInArrow(work, kinds)


def _descend(level: DataFrame, ways: DataFrame) -> DataFrame:
    """``c0, c, idx, start, end, tail`` of the parts of each group whose way is known."""

    def work(batches: Batches) -> Batches:
        for batch in batches:
            parts = batch.column("parts")
            sizes = np.diff(parts.offsets.to_numpy()).astype(np.int64)
            _, steps = folded(_packed(parts.flatten()), sizes)
            starts, ends = unfolded(sizes, steps, batch.column("start").to_numpy(), batch.column("end").to_numpy())
            of = np.repeat(np.arange(len(sizes)), sizes)
            inside = np.arange(len(of)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            last = inside == sizes[of] - 1
            tails = [t if z else "" for t, z in zip(batch.column("tail").take(pa.array(of)).to_pylist(), last.tolist())]
            columns = [
                *[batch.column(k).take(pa.array(of)) for k in KEY], pa.array(batch.column("idx").to_numpy()[of] * FAN + inside),
                pa.array(starts), pa.array(ends), pa.array(tails, pa.string()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["c0", "c", "idx", "start", "end", "tail"])

    joined = level.select("c0", "c", "idx", "parts").join(ways, ["c0", "c", "idx"])
    return joined.mapInArrow(work, "c0 boolean, c string, idx bigint, start bigint, end bigint, tail string")


def _chunk_edits(chunks: DataFrame, ways: DataFrame, grammar: Grammar) -> DataFrame:
    """``c0, c, idx, edits``: per row of a chunk inserted initials, then K, U, A or D; the last row of all also has the tail."""
    rules = chunks.sparkSession.sparkContext.broadcast(grammar.rules)

    def work(batches: Batches) -> Batches:
        grammar, row = Grammar(rules.value), re.compile("[ua]*[KUAD]")
        for batch in batches:
            spelled = grammar.edits(batch.column("seq").to_pylist(), batch.column("start").to_numpy(), batch.column("end").to_numpy())
            edits = [row.findall(s) for s in spelled]
            for own, tail in zip(edits, batch.column("tail").to_pylist()):
                own[-1] += tail
            yield pa.RecordBatch.from_arrays([*_keys(batch, ["c0", "c", "idx"]), pa.array(edits, pa.list_(pa.string()))], ["c0", "c", "idx", "edits"])

    joined = chunks.select("c0", "c", "idx", "seq").join(ways, ["c0", "c", "idx"])
    return joined.mapInArrow(work, "c0 boolean, c string, idx bigint, edits array<string>")


def _conv_id(df: DataFrame, conv: str) -> Column:
    """The id back from its key."""
    return F.when(~F.col("c0"), F.col("c").cast(df.schema[conv].dataType)).alias("conv_id")


def repair(
    df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
) -> tuple[DataFrame, DataFrame]:
    """Conversations and rows after the cheapest repair.

    Conversations: ``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit``, one per id of ``df``; rows: ``conv_id, place,
    part, role, text, edit`` (Keep, Rerole or Insert) in the order of place and part. Rows are taken by turn, nulls first;
    rows of one turn by role, then by a hash of the text. Null roles and texts are one space; null ids are one conversation. A row
    whose role has another initial than s, u, a (or none) can only be reroled or deleted. Repeated rows are duplicates. Texts are
    shuffled once and by keys that only equal rows share, so neither long texts nor long conversations meet in one task. Empty
    in, empty out.
    """
    rows = _keyed(df, conv, turn, role, text)
    placed = symbols(rows)
    chunk = F.floor(F.col("place") / CHUNK).cast("bigint")
    chunks = cut(placed.groupBy(*KEY, chunk.alias("idx")).agg(F.array_join(_in_order("place", "symbol"), "").alias("seq")))
    different = cut(chunks.groupBy("seq").agg(F.count("*").alias("n")))
    grammar = Grammar(repair_grammar(different))
    levels = [cut(_chunk_matrices(chunks, grammar))]
    top = chunks.agg(F.coalesce(F.max("idx"), F.lit(0))).first()[0]
    while top:
        levels.append(cut(_fold_level(levels[-1])))
        top //= FAN
    totals = cut(_decide(levels[-1]))
    ways = totals.select(*KEY, F.lit(0).cast("bigint").alias("idx"), F.lit(0).cast("bigint").alias("start"), "end", "tail")
    for level in reversed(levels[1:]):
        ways = cut(_descend(level, ways))
    edits = cut(_chunk_edits(chunks, ways, grammar))
    spelled = edits.select(*KEY, "idx", F.translate(F.array_join("edits", ""), "uaUA", "IIRR").alias("audit"))
    audits = spelled.groupBy(*KEY).agg(F.array_join(_in_order("idx", "audit"), "").alias("audit"))
    turns = placed.groupBy(*KEY, "t0", "t").agg(F.lit(1).alias("one")).where("t0")
    gaps = turns.groupBy(*KEY).agg((F.max("t") - F.min("t") + 1 - F.count("t")).alias("gaps"))
    whole = placed.select(*KEY).distinct().join(totals, KEY, "left").join(audits, KEY, "left").join(gaps, KEY, "left")
    zero = [F.coalesce(c, F.lit(0).cast("bigint")).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    summary = whole.select(_conv_id(df, conv), *zero, "audit")
    own = F.split(F.get("edits", (F.col("place") % CHUNK).cast("int")), "")
    steps = (
        placed.withColumn("idx", chunk).join(edits, [*KEY, "idx"])
        .select(*KEY, "t0", "t", "role", "h", "place", F.posexplode(own).alias("part", "letter")).where("letter <> 'D'")
    )
    once = rows.groupBy(*KEY, "t0", "t", "role", "h").agg(F.first("text").alias("text"))
    kept = steps.where("letter in ('K', 'U', 'A')").join(once, [*KEY, "t0", "t", "role", "h"])
    role = F.when(F.upper("letter") == "U", "user").when(F.upper("letter") == "A", "assistant").otherwise(F.col("role"))
    edit = F.when(F.col("letter") == "K", "K").when(F.col("letter").isin("U", "A"), "R").otherwise("I")
    added = steps.where("letter in ('u', 'a')").withColumn("text", F.lit(""))
    out = kept.unionByName(added).select(_conv_id(df, conv), "place", "part", role.alias("role"), "text", edit.alias("edit"))
    return summary, out


def digests(rows: DataFrame) -> DataFrame:
    """``conv_id, repaired_sha256`` of the rows ``role:text``, joined by newlines, of each conversation in ``rows`` (of ``repair``).

    A hash of a whole conversation is sequential by its nature: its rows pass sorted through one task, which holds one batch.
    """
    kind = rows.schema["conv_id"].dataType.simpleString()

    def work(batches: Batches) -> Batches:
        own, state = None, None
        ids, found = [], []

        def out() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays([pa.array(ids, names[0].type), pa.array(found, pa.string())], ["conv_id", "repaired_sha256"])
            ids.clear()
            found.clear()
            return made

        for batch in batches:
            names = [batch.column("conv_id")]
            for conv, line in zip(names[0].to_pylist(), batch.column("line").to_pylist()):
                if state is None or conv != own:
                    if state is not None:
                        ids.append(own)
                        found.append(state.hexdigest())
                    own, state = conv, hashlib.sha256(line.encode())
                else:
                    state.update(b"\n" + line.encode())
            if ids:
                yield out()
        if state is not None:
            ids.append(own)
            found.append(state.hexdigest())
            yield out()

    lines = rows.select("conv_id", "place", "part", F.concat("role", F.lit(":"), "text").alias("line"))
    return lines.repartition("conv_id").sortWithinPartitions("conv_id", "place", "part").select("conv_id", "line").mapInArrow(
        work, f"conv_id {kind}, repaired_sha256 string"
    )


def repaired_conversations(df: DataFrame) -> DataFrame:
    """One row per id of ``df`` (``conv_id, turn, role, text``) after damage and repair: counts, cost, audit and digest.

    A conversation that lost all its rows has zeros, an empty audit and the hash of nothing.
    """
    summary, rows = repair(damaged(df))
    ids = df.select("conv_id").distinct()
    nothing = F.lit(hashlib.sha256(b"").hexdigest())

    def beside(left: DataFrame, right: DataFrame) -> DataFrame:
        right = right.withColumnRenamed("conv_id", "_conv")
        return left.join(right, left["conv_id"].eqNullSafe(right["_conv"]), "left").drop("_conv")

    out = beside(beside(ids, summary), digests(rows))
    counts = [F.coalesce(c, F.lit(0).cast("bigint")).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return out.select("conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", nothing).alias("repaired_sha256"))
