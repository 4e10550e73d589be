"""Near duplicates by SimHash, found with Golay-code fuzzy hashing.

A fingerprint has 64 bits: two segments of 23 bits and a rest of 18. Each segment is decoded to the indices of all
codewords of the binary Golay code (23, 12) within distance 4, one or six of them. Any two segments that differ
in two bits or less share such an index (the test goes through all cases), so indices work as hash keys that forgive two errors.

Four errors over (segment, segment, rest) leave one of these cases, each with keys of its own:

* rest equal: one segment has two errors or less: rest and an index of that segment;
* rest not equal, one segment equal: that segment as it is;
* else at most (1, 2) or (2, 1) errors in the segments: an index of each.

That gives about 41 keys of 23 to 30 bits for a fingerprint. Only different fingerprints are joined, so groups of
copies of any size cost one row. Rows that share a key meet in one task, sorted by key, and are verified there on
all 64 bits; what leaves the task is a spanning forest of the verified links, not pairs. A key with more than
``block`` fingerprints is split into blocks, and every two blocks meet in a task of their own, so no link is lost
and no task holds more than two blocks of a key.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mailtax.functions.staging import cut
from mailtax.llm.common import Batches, per_batch, row_key, texts
from mailtax.llm.components import connected_components, forest

GENERATOR = 0b110001110101  # x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1
RADIUS = 4
BLOCK = 2000


def golay_codewords() -> np.ndarray:
    """The 4096 codewords; the index of a codeword is its upper 12 bits."""
    words = np.arange(4096, dtype=np.int64) << 11
    rest = words.copy()
    for bit in range(22, 10, -1):
        rest ^= np.where(rest >> bit & 1, GENERATOR << (bit - 11), 0)
    return words | rest


def _syndromes(words: np.ndarray) -> np.ndarray:
    rest = words.astype(np.int64)
    for bit in range(22, 10, -1):
        rest = rest ^ np.where(rest >> bit & 1, GENERATOR << (bit - 11), 0)
    return rest


def golay_table() -> tuple[np.ndarray, np.ndarray]:
    """Per syndrome the error patterns of up to RADIUS bits that lead to a codeword: (2048, 6) and their number."""
    errors = np.array([sum(1 << i for i in c) for k in range(RADIUS + 1) for c in combinations(range(23), k)], np.int64)
    syndromes = _syndromes(errors)
    order = np.argsort(syndromes, kind="stable")
    counts = np.bincount(syndromes, minlength=2048)
    table = np.zeros((2048, counts.max()), np.int64)
    column = np.arange(len(order)) - np.repeat(np.cumsum(counts) - counts, counts)
    table[syndromes[order], column] = errors[order]
    return table, counts


def golay_indices(words: np.ndarray, table: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(row, codeword index) of all codewords within RADIUS of each 23-bit word."""
    patterns, counts = table
    syndrome = _syndromes(words)
    n = counts[syndrome]
    row = np.repeat(np.arange(len(words)), n)
    column = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
    return row, (words[row] ^ patterns[syndrome[row], column]) >> 11


def fuzzy_keys(fingerprints: np.ndarray, table: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(row, key): two fingerprints with 4 differing bits or less share a key at least."""
    fp = fingerprints.astype(np.uint64)
    a, b, rest = (fp & 0x7FFFFF).astype(np.int64), (fp >> 23 & 0x7FFFFF).astype(np.int64), (fp >> 46).astype(np.int64)
    row_a, index_a = golay_indices(a, table)
    row_b, index_b = golay_indices(b, table)
    first_b = np.searchsorted(row_b, np.arange(len(fp) + 1))
    times = (first_b[1:] - first_b[:-1])[row_a]
    row_ab = np.repeat(row_a, times)
    which = np.arange(len(row_ab)) - np.repeat(np.cumsum(times) - times, times) + first_b[row_ab]
    every = np.arange(len(fp))
    parts = [
        (row_a, rest[row_a] << 12 | index_a, 0),
        (row_b, rest[row_b] << 12 | index_b, 1),
        (every, a, 2),
        (every, b, 3),
        (row_ab, np.repeat(index_a, times) << 12 | index_b[which], 4),
    ]
    return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] << 3 | p[2] for p in parts])


def shingles(text: bytes, words: int) -> np.ndarray:
    """Hashes of the shingles of ``words`` words, repeats included; A-Z count as a-z. Fewer words are one shingle, none give none."""
    split = text.lower().split()
    joined, digest = b" ".join(split), xxhash.xxh64_intdigest
    if len(split) <= words:
        return np.array([digest(joined, 42)] if split else [], np.uint64)
    length = np.fromiter(map(len, split), np.int64, len(split)) + 1
    end = np.cumsum(length) - 1
    start = (end - length + 1)[: len(split) - words + 1].tolist()
    return np.fromiter((digest(joined[s:e], 42) for s, e in zip(start, end[words - 1:].tolist())), np.uint64, len(start))


def fingerprint(text: bytes, words: int) -> int:
    """SimHash of the shingles of ``words`` words, repeats included; A-Z count as a-z; 0 without words."""
    hashes = shingles(text, words)
    if len(hashes) < 2:
        return int(hashes[0]) if len(hashes) else 0
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 15):
        ones += np.unpackbits(hashes[at:at + (1 << 15)].view(np.uint8), bitorder="little").reshape(-1, 64).sum(0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 4) -> DataFrame:
    """``doc_id, k1, k2, fp`` (64 bits as a signed long) for every row; null texts count as empty."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        values = np.fromiter(
            (fingerprint(t, words) for t in batch.column("text").cast(pa.binary()).to_pylist()), np.uint64, batch.num_rows
        )
        columns = [batch.column("doc_id"), batch.column("k1"), batch.column("k2"), pa.array(values.view(np.int64))]
        return pa.RecordBatch.from_arrays(columns, ["doc_id", "k1", "k2", "fp"])

    rows = texts(df, id_col, text_col)
    return rows.mapInArrow(per_batch(work), rows.drop("text").schema.add("fp", "long"))


def _keys(values: DataFrame) -> DataFrame:
    def work(batches: Batches) -> Batches:
        table = golay_table()
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                fp = batch.column("fp").to_numpy()[at:at + 4096]
                row, key = fuzzy_keys(fp.view(np.uint64), table)
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(fp[row])], ["key", "fp"])

    return values.select("fp").mapInArrow(work, "key bigint, fp bigint")


def _near(a: np.ndarray, b: np.ndarray, bits: int) -> np.ndarray:
    return np.bitwise_count((a ^ b).view(np.uint64)) <= bits  # of a negative number numpy would count the absolute value


def _bucket_links(group: np.ndarray, fp: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links within runs of equal ``group`` (sorted). Small runs: all pairs in lanes; large ones: a search that
    takes every row out of the rest once."""
    edge = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1], [True])))
    size = np.diff(edge)
    u, v = [], []
    small = np.repeat(size, size)
    at = np.flatnonzero((small > 1) & (small <= 16))
    for lag in range(1, 16):
        at = at[at + lag < len(group)]
        at = at[group[at] == group[at + lag]]
        if not len(at):
            break
        hit = at[_near(fp[at], fp[at + lag], bits)]
        u.append(fp[hit])
        v.append(fp[hit + lag])
    for first, n in zip(edge[:-1][size > 16], size[size > 16]):
        rest = np.unique(fp[first:first + n])
        while len(rest):
            todo, rest = [rest[0]], rest[1:]
            while todo and len(rest):
                x = todo.pop()
                near = _near(rest, x, bits)
                found, rest = rest[near], rest[~near]
                u.append(np.full(len(found), x))
                v.append(found)
                todo.extend(found)
    return (np.concatenate(u), np.concatenate(v)) if u else (fp[:0], fp[:0])


def near_links(values: DataFrame, bits: int = 4, block: int = BLOCK) -> DataFrame:
    """Links ``u, v`` that join exactly the fingerprints (column ``fp``, each once) reachable over steps of ``bits``
    (4 at most) differing bits or less."""
    keys = _keys(values)
    hot = cut(keys.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > block))
    blocks = F.coalesce(F.ceil(F.col("n") / block), F.lit(1)).cast("int")
    mine = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    met = (
        keys.join(hot, "key", "left")
        .withColumn("blocks", blocks)
        .withColumn("mine", mine)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(
            F.xxhash64("key", F.least("mine", "other"), F.greatest("mine", "other")).alias("meet"), "fp"
        )
    )

    def work(batches: Batches) -> Batches:
        """Runs may go on over batches; verified links are reduced to a forest as they come."""
        group, fp = np.zeros(0, np.int64), np.zeros(0, np.int64)
        u, v = np.zeros(0, np.int64), np.zeros(0, np.int64)

        def take(upto: int) -> None:
            nonlocal group, fp, u, v
            x, y = _bucket_links(group[:upto], fp[:upto], bits)
            u, v = forest(np.concatenate((u, x)), np.concatenate((v, y)))
            group, fp = group[upto:], fp[upto:]

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], ["u", "v"])

        for batch in batches:
            group = np.concatenate((group, batch.column("meet").to_numpy()))
            fp = np.concatenate((fp, batch.column("fp").to_numpy()))
            if len(group) > 200_000 and group[0] != group[-1]:
                take(int(np.searchsorted(group, group[-1])))
                if len(u) > 1_000_000:
                    yield out()
                    u, v = u[:0], v[:0]
        if len(group):
            take(len(group))
        if len(u):
            yield out()

    return met.repartition("meet").sortWithinPartitions("meet").mapInArrow(work, "u bigint, v bigint")


def first_rows(values: DataFrame, links: DataFrame) -> DataFrame:
    """``fp, first``: per node of ``values`` (``fp, first``, stored) the smallest ``first`` of its component over ``links``."""
    found = cut(connected_components(links))
    rooted = cut(
        values.join(found.withColumnRenamed("node", "fp"), "fp", "left")
        .select("fp", F.coalesce("root", "fp").alias("root"), "first")
    )
    least = cut(rooted.groupBy("root").agg(F.min("first").alias("first")))
    return cut(rooted.select("fp", "root").join(least, "root").select("fp", "first"))


def components(prints: DataFrame, bits: int = 4, block: int = BLOCK) -> DataFrame:
    """``fp, first``: per fingerprint the first row ``(doc_id is null, doc_id, k1, k2)`` of its component."""
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "k1", "k2")).alias("first")
    values = cut(prints.groupBy("fp").agg(first))
    return first_rows(values, near_links(values, bits, block))


def near_duplicates(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, bits: int = 4, block: int = BLOCK
) -> DataFrame:
    """One row per row of ``df``: ``doc_id, fingerprint`` (16 hex digits), ``component_id``, ``is_first`` and the
    row's key ``k1, k2``.

    ``component_id`` is the smallest id reachable over links of ``bits`` differing bits or less; null ids never are the
    smallest unless the component has no other. ``is_first`` marks the one (id, text) that stands for the component;
    repeated rows of it are all marked. Null and empty texts and those of white space have fingerprint 0 and link
    like any other. A text of fewer words than a shingle is one shingle. Empty in, empty out.
    """
    prints = cut(fingerprints(df, id_col, text_col, words))
    return prints.join(components(prints, bits, block), "fp").select(
        "doc_id",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("first.doc_id").alias("component_id"),
        ((F.col("first.k1") == F.col("k1")) & (F.col("first.k2") == F.col("k2"))).alias("is_first"),
        "k1",
        "k2",
    )


def only_rows(df: DataFrame, stay: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The rows of ``df`` with a key in ``stay`` (``k1, k2``), each once."""
    k1, k2 = row_key(id_col, text_col)
    packed = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), k1, k2)
    once = packed.join(stay, ["k1", "k2"], "left_semi").dropDuplicates(["k1", "k2"])
    return once.select("row.*")


def keep_first(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``df`` without all but one of each component; of repeated rows one stays."""
    stay = cut(near_duplicates(df, id_col, text_col, **options).where("is_first").select("k1", "k2").distinct())
    return only_rows(df, stay, id_col, text_col)
