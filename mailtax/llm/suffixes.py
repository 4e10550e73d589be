"""Removal of repeated byte strings by bucket-pointer refinement over a sparse, distributed suffix array.

A string of ``length`` bytes is repeated if it starts at two places of the corpus. Sorting every suffix would shuffle
many times the corpus, so only sampled suffixes are kept: each window of ``length`` bytes is represented by its
*anchor*, the start of the smallest q-gram (by a rolling hash) in it. The choice depends on the window's bytes alone,
so equal windows have equal anchors at equal offsets, and a window is known by (anchor, offset of its start before it).
With ``m`` offsets (a power of two) and q = length - m + 1, every window of an anchor holds its whole q-gram.

1. *Initial buckets*: anchors with the same q-gram. A bucket of one is final: none of its windows is repeated. In a
   bucket whose anchors also agree on all bytes their windows cover, all windows are repeated.
2. Mixed buckets keep one anchor for each class of equal surroundings; a class of several is repeated as a whole and
   stays only as a partner for others. These few anchors get the bytes around them.
3. *Refinement*: an item is (anchor, range of offsets); the bytes all windows of the range share extend the parent's
   to the left and the right. Halving the range gives each half a new bucket: the old bucket's identifier with the
   identifiers of the bytes at the later offsets. Items alone in their bucket are dropped, items that agree on all
   bytes of their range are repeated, others are halved again with the new identifiers, down to single windows.
   Buckets of up to ``block`` items are refined inside a task, many at a time; larger ones are refined by Spark,
   one halving per round, until they are small or done, so no bucket has to fit into a task.

Nothing is sampled, capped or approximate apart from 64-bit hashes that are compared within buckets.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mailtax.functions.staging import cut
from mailtax.llm.common import Batches, texts

BASE = np.uint64(0x9E3779B97F4A7C15)
CHUNK = 1 << 18
BLOCK = 8192  # largest bucket that is refined inside a task, about 60 MB of prefix sums
HELD = 2048  # small buckets are refined together, so many items at a time
EDGE = np.iinfo(np.uint64).max


class Rolling:
    """Polynomial hashes of byte ranges in 64 bits, from prefix sums."""

    def __init__(self, size: int) -> None:
        self.letter = np.random.default_rng(7).integers(0, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
        one = np.ones(1, np.uint64)
        self.power = np.cumprod(np.concatenate((one, np.full(size, BASE))))
        inverse = np.uint64(pow(int(BASE), -1, 1 << 64))
        self.back = np.cumprod(np.concatenate((one, np.full(size, inverse))))

    def prefixes(self, data: np.ndarray) -> np.ndarray:
        out = np.zeros((*data.shape[:-1], data.shape[-1] + 1), np.uint64)
        np.cumsum(self.letter[data] * self.power[:data.shape[-1]], axis=-1, out=out[..., 1:])
        return out


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ x >> np.uint64(31)) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ x >> np.uint64(29)


def offsets_per_anchor(length: int) -> int:
    """The largest power of two that leaves q-grams of about a third of ``length``."""
    return 1 << max(0, int(length * 0.65).bit_length() - 1)


def anchors(data: np.ndarray, length: int, rolling: Rolling) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, smallest, largest offset): window at anchor - offset, for all windows of ``data``; ties to the left."""
    m = offsets_per_anchor(length)
    q, n = length - m + 1, len(data) - length + 1
    runs, begins = [], []
    for at in range(0, n, CHUNK):
        windows = min(CHUNK, n - at)
        prefix = rolling.prefixes(data[at:at + windows + length - 1])
        key = mix((prefix[q:] - prefix[:-q]) * rolling.back[:len(prefix) - q])
        here = np.uint64(2 * CHUNK - 1)
        key = (key & ~here) | np.arange(len(key), dtype=np.uint64)
        rows = np.full(len(key) + -len(key) % m, EDGE)
        rows[:len(key)] = key
        rows = rows.reshape(-1, m)
        before = np.minimum.accumulate(rows, axis=1).ravel()
        after = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
        least = (np.minimum(after[:windows], before[m - 1:m - 1 + windows]) & here).astype(np.int64) + at
        first = np.flatnonzero(np.concatenate(([True], least[1:] != least[:-1])))
        runs.append(least[first])
        begins.append(first + at)
    if not runs:
        return (np.zeros(0, np.int64),) * 3
    anchor, begin = np.concatenate(runs), np.concatenate(begins)
    new = np.concatenate(([True], anchor[1:] != anchor[:-1]))  # a run may go on in the next chunk
    anchor, begin = anchor[new], begin[new]
    last = np.concatenate((begin[1:], [n])) - 1
    return anchor, anchor - last, anchor - begin


def _anchor_table(rows: DataFrame, length: int) -> DataFrame:
    q = length - offsets_per_anchor(length) + 1

    def work(batches: Batches) -> Batches:
        rolling = Rolling(CHUNK + length)
        for batch in batches:
            row, found, gram, span = [], [], [], []
            for i, text in enumerate(batch.column("text").cast(pa.binary()).to_pylist()):
                if len(text) < length:
                    continue
                anchor, low, high = anchors(np.frombuffer(text, np.uint8), length, rolling)
                row.append(np.full(len(anchor), i))
                found.append(np.stack((anchor, low, high)))
                for a, lo, hi in zip(anchor.tolist(), low.tolist(), high.tolist()):
                    gram.append(xxhash.xxh3_64_intdigest(text[a:a + q]))
                    span.append(xxhash.xxh3_64_intdigest(text[a - hi:a - lo + length], lo << 32 | hi))
            if not row:
                continue
            at, (anchor, low, high) = pa.array(np.concatenate(row)), np.concatenate(found, axis=1)
            columns = [batch.column("k1").take(at), batch.column("k2").take(at), pa.array(anchor), pa.array(low << 32 | high)]
            columns += [pa.array(np.array(x, np.uint64).view(np.int64)) for x in (gram, span)]
            yield pa.RecordBatch.from_arrays(columns, ["k1", "k2", "anchor", "offsets", "gram", "span"])

    schema = "k1 bigint, k2 bigint, anchor bigint, offsets bigint, gram bigint, span bigint"
    return rows.mapInArrow(work, schema)


def halve(item: dict[str, np.ndarray], prefix: np.ndarray, rolling: Rolling, m: int, length: int) -> tuple[dict, np.ndarray]:
    """One refinement of all items (arrays ``bucket, member, x, y, need, low, high``): the halves that share their
    new bucket with another, and (member, first, last offset) of the ranges found repeated. ``prefix``: rolling prefix sums per
    member, column 0 at anchor - (m - 1)."""

    def part(member: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((prefix[member, end] - prefix[member, start]) * rolling.back[start])

    zero, middle = m - 1, (item["x"] + item["y"]) // 2
    both = {k: np.concatenate((v, v)) for k, v in item.items()}
    old_x, old_y = both["x"], both["y"]
    both["x"], both["y"] = np.concatenate((item["x"], middle + 1)), np.concatenate((middle, item["y"]))
    both["first"], both["last"] = np.maximum(both["x"], both["low"]), np.minimum(both["y"], both["high"])
    keep = both["first"] <= both["last"]
    both, old_x, old_y = {k: v[keep] for k, v in both.items()}, old_x[keep], old_y[keep]
    who = both["member"]
    left = part(who, zero - both["x"], zero - old_x)
    right = part(who, zero - old_y + length, zero - both["y"] + length)
    keys = np.stack((both["bucket"].astype(np.uint64), both["x"].astype(np.uint64), left, right), axis=1)
    bucket, size = _ranks(keys)
    both["bucket"] = bucket
    span = part(who, zero - both["last"], zero - both["first"] + length)
    keys = np.stack((bucket.astype(np.uint64), (both["first"] << 32 | both["last"]).astype(np.uint64), span), axis=1)
    same, copies = _ranks(keys)
    twice = copies[same] > 1
    done = twice & both["need"]
    found = np.stack((who[done], both["first"][done], both["last"][done]))
    _, one = np.unique(same, return_index=True)  # of a class the first stays, as a partner only if it is repeated
    stays = np.zeros(len(who), bool)
    stays[one] = True
    both["need"] = both["need"] & ~twice
    useful = np.zeros(len(size), bool)
    useful[bucket[both["need"]]] = True
    stays &= (size[bucket] > 1) & useful[bucket] & (both["x"] < both["y"])
    both.pop("first"), both.pop("last")
    return {k: v[stays] for k, v in both.items()}, found


def _ranks(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Identifiers 0, 1, ... of equal rows, by sorting, and how often each occurs."""
    order = np.lexsort(keys.T[::-1])
    new = np.concatenate(([True], (keys[order][1:] != keys[order][:-1]).any(axis=1))) if len(keys) else np.zeros(0, bool)
    rank = np.empty(len(keys), np.int64)
    rank[order] = np.cumsum(new) - 1
    return rank, np.bincount(rank) if len(keys) else np.zeros(0, np.int64)


def _refine_in_tasks(items: DataFrame, length: int) -> DataFrame:
    """``k1, k2, anchor, first, last`` of the ranges found repeated, in buckets that fit into a task."""
    m = offsets_per_anchor(length)

    def solve(rows: pa.Table, rolling: Rolling) -> pa.RecordBatch:
        n = rows.num_rows
        column = {c: rows.column(c).to_numpy() for c in ("low", "high", "x", "y", "need")}
        _, bucket = np.unique(rows.column("bucket").to_numpy(), return_inverse=True)
        data = np.zeros((n, length + 2 * m - 2), np.uint8)
        for i, (around, high) in enumerate(zip(rows.column("around").to_pylist(), column["high"].tolist())):
            data[i, m - 1 - high:m - 1 - high + len(around)] = np.frombuffer(around, np.uint8)
        prefix = rolling.prefixes(data)
        item = column | {"bucket": bucket, "member": np.arange(n)}
        ranges = [np.zeros((3, 0), np.int64)]
        while len(item["x"]):
            item, found = halve(item, prefix, rolling, m, length)
            ranges.append(found)
        member, first, last = np.concatenate(ranges, axis=1)
        at = pa.array(member)
        columns = [rows.column(c).take(at).combine_chunks() for c in ("k1", "k2", "anchor")] + [pa.array(first), pa.array(last)]
        return pa.RecordBatch.from_arrays(columns, ["k1", "k2", "anchor", "first", "last"])

    def work(batches: Batches) -> Batches:
        rolling = Rolling(length + 2 * m)
        held: pa.Table | None = None
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            held = rows if held is None else pa.concat_tables([held, rows])
            buckets = held.column("bucket").to_numpy()
            if held.num_rows >= HELD and buckets[0] != buckets[-1]:
                n = int(np.searchsorted(buckets, buckets[-1]))  # the last bucket may go on
                yield solve(held.slice(0, n), rolling)
                held = held.slice(n)
        if held is not None and held.num_rows:
            yield solve(held, rolling)

    schema = "k1 bigint, k2 bigint, anchor bigint, first bigint, last bigint"
    return items.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(work, schema)


def _refine_in_spark(items: DataFrame, length: int) -> tuple[DataFrame, DataFrame]:
    """The same halving for items of large buckets, one round: (items left, ranges found)."""
    zero = F.col("high")  # place of the anchor in the bytes around it

    def part(start: F.Column, end: F.Column) -> F.Column:
        """Bytes from anchor + start to anchor + end."""
        return F.col("around").substr((zero + start + 1).cast("int"), (end - start).cast("int"))

    middle = F.floor((F.col("x") + F.col("y")) / 2)
    halves = F.explode(F.array(
        F.struct(F.col("x").alias("x"), middle.alias("y")), F.struct((middle + 1).alias("x"), F.col("y").alias("y"))
    )).alias("h")
    halved = (
        items.select("*", halves)
        .withColumns({"first": F.greatest("h.x", "low"), "last": F.least("h.y", "high")})
        .where("first <= last")
        .withColumn("bucket", F.xxhash64(
            "bucket", "h.x", part(-F.col("h.x"), -F.col("x")), part(length - F.col("y"), length - F.col("h.y"))
        ))
        .withColumn("class", F.xxhash64("bucket", "first", "last", part(-F.col("last"), length - F.col("first"))))
        .withColumns({"x": F.col("h.x"), "y": F.col("h.y")})
        .drop("h")
    )
    halved = cut(halved)
    member = F.struct("k1", "k2", "anchor")
    classes = cut(halved.groupBy("bucket", "class").agg(
        F.count("*").alias("copies"), F.min(member).alias("one"), F.max("need").alias("needed")
    ))
    sizes = classes.groupBy("bucket").agg(
        F.sum("copies").alias("size"), F.max(F.col("needed") & (F.col("copies") == 1)).alias("useful")
    )
    known = halved.join(classes.select("class", "copies", "one"), "class").join(sizes, "bucket")
    known = cut(known)
    found = known.where("copies > 1 and need").select("k1", "k2", "anchor", "first", "last")
    left = (
        known.where((F.col("one") == member) & (F.col("size") > 1) & F.col("useful") & (F.col("x") < F.col("y")))
        .withColumn("need", F.col("need") & (F.col("copies") == 1))
        .select(*items.columns)
    )
    return left, found


def _refine(items: DataFrame, length: int, block: int) -> DataFrame:
    ranges = []
    while True:
        sizes = cut(items.groupBy("bucket").agg(F.count("*").alias("size")).where(F.col("size") > block))
        if sizes.isEmpty():
            break
        small = items.join(sizes, "bucket", "left_anti")
        ranges.append(cut(_refine_in_tasks(small, length)))
        items, found = _refine_in_spark(items.join(sizes.select("bucket"), "bucket"), length)
        items = cut(items)
        ranges.append(found)
    ranges.append(cut(_refine_in_tasks(items, length)))
    out = ranges[0]
    for more in ranges[1:]:
        out = out.union(more)
    return out


def _spans(ranges: DataFrame, length: int) -> DataFrame:
    """Byte spans per row, as ``spans``: array of start << 32 | end; a document's spans meet in one row, each once, however often
    the row is repeated."""
    start = F.col("anchor") - F.col("last")
    packed = F.shiftleft(start, 32) + F.col("anchor") - F.col("first") + length
    return ranges.groupBy("k1", "k2").agg(F.collect_set(packed).alias("spans"))


def repeated_spans(df: DataFrame, length: int, id_col: str = "doc_id", text_col: str = "text", block: int = BLOCK) -> DataFrame:
    """``doc_id, text, spans`` for every row of ``df``; ``spans`` (null: none) are byte ranges, packed as
    start << 32 | end, not merged, whose union is what repeated strings of ``length`` bytes cover."""
    rows = texts(df, id_col, text_col)
    table = cut(_anchor_table(rows, length))
    low, high = F.shiftright("offsets", 32), F.col("offsets").bitwiseAND((1 << 32) - 1)
    buckets = cut(
        table.groupBy("gram").agg(F.count("*").alias("n"), F.min("span").alias("a"), F.max("span").alias("b")).where("n > 1")
        .select("gram", (F.col("a") != F.col("b")).alias("mixed"))
    )
    shared = cut(table.join(buckets, "gram"))
    mixed = shared.where("mixed")
    classes = cut(
        mixed.groupBy("gram", "span").agg(F.count("*").alias("n"), F.min(F.struct("k1", "k2", "anchor", "offsets")).alias("one"))
    )
    repeated = cut(classes.where("n > 1").select("gram", "span"))
    whole = shared.where("not mixed").select("k1", "k2", "anchor", "offsets").union(
        mixed.join(repeated, ["gram", "span"]).select("k1", "k2", "anchor", "offsets")
    )
    ranges = whole.select("k1", "k2", "anchor", low.alias("first"), high.alias("last"))
    members = classes.select("one.*", F.col("gram").alias("bucket"), (F.col("n") == 1).alias("need"))
    wanted = cut(members.groupBy("k1", "k2").agg(F.collect_list(F.struct("anchor", "offsets", "bucket", "need")).alias("w")))
    around = F.col("text").cast("binary").substr(
        (F.col("anchor") - F.col("high") + 1).cast("int"), (F.col("high") - F.col("low") + length).cast("int")
    )
    items = cut(
        rows.drop("doc_id").join(wanted, ["k1", "k2"])
        .select("k1", "k2", "text", F.explode("w").alias("w"))
        .select("k1", "k2", "text", "w.*", F.shiftright("w.offsets", 32).alias("low"),
                F.col("w.offsets").bitwiseAND((1 << 32) - 1).alias("high"))
        .select("k1", "k2", "anchor", "low", "high", "bucket", "need", around.alias("around"),
                F.lit(0).cast("bigint").alias("x"), F.lit(offsets_per_anchor(length) - 1).cast("bigint").alias("y"))
    )
    spans = cut(_spans(ranges.union(_refine(items, length, block)), length))
    return rows.join(spans, ["k1", "k2"], "left").select("doc_id", "text", "spans")


def remove_repeats(
    df: DataFrame, length: int = 400, id_col: str = "doc_id", text_col: str = "text", block: int = BLOCK
) -> DataFrame:
    """One row per row of ``df``: ``doc_id, n_bytes, n_removed, n_spans, kept`` (the remaining bytes, binary) and ``removed``
    (merged byte spans as start, end in turns).

    Texts are UTF-8 bytes, null counts as empty. Every byte is removed that a string of ``length`` bytes covers
    which also starts anywhere else, in the same text or another; texts shorter than ``length`` stay whole. Repeated
    rows repeat each other. The judgement is on the input, so overlapping strings all count. Empty in, empty out.
    """

    def work(batches: Batches) -> Batches:
        for batch in batches:
            out: list[list] = [[], [], [], [], []]
            for text, spans in zip(batch.column("text").cast(pa.binary()).to_pylist(), batch.column("spans")):
                pieces, removed, at, edges = [], 0, 0, []
                packed = np.sort(spans.values.to_numpy()) if spans.is_valid else np.zeros(0, np.int64)
                start, end = packed >> 32, np.maximum.accumulate(packed & 0xFFFFFFFF) if len(packed) else packed
                new = np.flatnonzero(np.concatenate(([True], start[1:] > end[:-1]))) if len(packed) else packed
                for s, e in zip(start[new].tolist(), end[np.concatenate((new[1:], [len(end)])) - 1].tolist() if len(packed) else []):
                    pieces.append(text[at:s])
                    removed, at = removed + e - s, e
                    edges += [s, e]
                pieces.append(text[at:])
                for to, x in zip(out, (len(text), removed, len(new), b"".join(pieces), edges)):
                    to.append(x)
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int64())]
            columns = [batch.column("doc_id")] + [pa.array(x, k) for x, k in zip(out, kinds)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_bytes", "n_removed", "n_spans", "kept", "removed"])

    found = repeated_spans(df, length, id_col, text_col, block)
    kind = found.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary, removed array<bigint>"
    return found.mapInArrow(work, schema)
