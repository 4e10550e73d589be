"""Packing of token ids into rows of fixed length by best fit decreasing.

Documents longer than a row are split into full rows and a rest, so no token is lost. The pieces of a shard are placed
in falling order of length, each into the row with the least room that still fits it. Rows are counted by room in the
leaves of a segment tree, so the search takes the logarithm of the row length, whatever the number of rows is. A shard
is a bounded run of documents of one task: memory does not grow with the data and nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mailtax.llm.bpe import encode
from mailtax.llm.common import Batches

ROW_TOKENS = 2048
SHARD_TOKENS = 4_000_000
PAD = 50256


class Rooms:
    """Open rows by room left: a segment tree of counts over 0 .. capacity, and a stack of rows for each room."""

    def __init__(self, capacity: int) -> None:
        self.leaves = 1 << capacity.bit_length()
        self.tree = [0] * (2 * self.leaves)
        self.rows: list[list[int]] = [[] for _ in range(capacity + 1)]

    def add(self, room: int, row: int) -> None:
        self.rows[room].append(row)
        self._count(room, 1)

    def _count(self, room: int, by: int) -> None:
        node = self.leaves + room
        while node:
            self.tree[node] += by
            node >>= 1

    def take(self, size: int) -> tuple[int, int] | None:
        """(row, room) with the least room of ``size`` or more, taken out; None if there is no such row."""
        node, tree = self.leaves + size, self.tree
        if not tree[node]:
            while node > 1 and (node & 1 or not tree[node + 1]):  # up to the first right sibling that holds rows
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.leaves:
                node = 2 * node if tree[2 * node] else 2 * node + 1
        room = node - self.leaves
        self._count(room, -1)
        return self.rows[room].pop(), room


def best_fit_decreasing(sizes: list[int], capacity: int) -> list[list[int]]:
    """Pieces (places in ``sizes``, each from 1 to ``capacity``) per row; among equal sizes the first comes first."""
    rooms, rows = Rooms(capacity), []
    for piece in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        found = rooms.take(sizes[piece])
        row, room = found if found else (len(rows), capacity)
        if not found:
            rows.append([])
        rows[row].append(piece)
        if room > sizes[piece]:
            rooms.add(room - sizes[piece], row)
    return rows


def _shards(batches: Batches, limit: int) -> Iterator[tuple[list, list[np.ndarray]]]:
    """Runs of documents of up to ``limit`` tokens, or of one longer document."""
    ids, tokens, held = [], [], 0
    for batch in batches:
        for doc, data in zip(batch.column("doc_id").to_pylist(), batch.column("ids").to_pylist()):
            found = np.frombuffer(data or b"", "<u4")
            if held and held + len(found) > limit:
                yield ids, tokens
                ids, tokens, held = [], [], 0
            if len(found):
                ids.append(doc)
                tokens.append(found)
                held += len(found)
    if ids:
        yield ids, tokens


def pack_shard(tokens: list[np.ndarray], capacity: int, pad: int) -> dict:
    """Matrix of ids (rows, capacity), per piece its place: row, column, document, first token, length; per row the cumulative
    lengths of its segments (from 0, the padding last if there is any); positions that begin anew with each segment."""
    pieces = [(d, s, min(capacity, len(t) - s)) for d, t in enumerate(tokens) for s in range(0, len(t), capacity)]
    rows = best_fit_decreasing([n for *_, n in pieces], capacity)
    matrix = np.full((len(rows), capacity), pad, np.uint32)
    positions = np.zeros((len(rows), capacity), np.uint32)
    steps = np.arange(capacity, dtype=np.uint32)
    lengths, places = [], []
    for r, row in enumerate(rows):
        at, edges = 0, [0]
        for piece in row:
            d, s, n = pieces[piece]
            matrix[r, at:at + n] = tokens[d][s:s + n]
            positions[r, at:at + n] = steps[:n]
            places.append((r, at, d, s, n))
            at += n
            edges.append(at)
        if at < capacity:
            positions[r, at:] = steps[:capacity - at]
            edges.append(capacity)
        lengths.append(edges)
    return {"matrix": matrix, "positions": positions, "lengths": lengths, "places": places}


def pack(
    encoded: DataFrame, row_tokens: int = ROW_TOKENS, pad: int = PAD, shard_tokens: int = SHARD_TOKENS, width: int = 2,
    id_col: str = "doc_id", ids_col: str = "ids",
) -> DataFrame:
    """One row per packed row: ``shard, row, input_ids`` and ``position_ids`` (binary, ``row_tokens`` little-endian unsigned
    values of ``width`` bytes; an id that needs more raises an error), ``cu_seqlens`` (array of int), ``n_tokens`` (without padding) and ``segments``: array of
    (doc_id, first token, length) in the order of the row.

    ``encoded`` holds binary ids as ``bpe.encode`` makes them. Null and empty ids take no place. Every token is in
    exactly one row; repeated rows are packed each. ``shard`` names the first document of the shard.
    """
    rows = encoded.select(F.col(id_col).alias("doc_id"), F.col(ids_col).alias("ids"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    doc_type = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}.get(kind)
    if doc_type is None:
        raise ValueError(f"ids of type {kind}")
    segment = pa.struct([("doc_id", doc_type), ("first", pa.int32()), ("length", pa.int32())])

    def work(batches: Batches) -> Batches:
        for ids, tokens in _shards(batches, shard_tokens):
            packed = pack_shard(tokens, row_tokens, pad)
            if packed["matrix"].max(initial=0) >= 1 << 8 * width or row_tokens > 1 << 8 * width:
                raise ValueError(f"values need more than {width} bytes")
            segments: list[list] = [[] for _ in packed["lengths"]]
            for r, _, d, s, n in packed["places"]:
                segments[r].append({"doc_id": ids[d], "first": s, "length": n})
            count = len(segments)
            for at in range(0, count, 512):
                end = min(at + 512, count)
                columns = [
                    pa.array([ids[0]] * (end - at), doc_type),
                    pa.array(range(at, end), pa.int32()),
                    pa.array([r.tobytes() for r in packed["matrix"][at:end].astype(f"<u{width}")], pa.binary()),
                    pa.array([r.tobytes() for r in packed["positions"][at:end].astype(f"<u{width}")], pa.binary()),
                    pa.array(packed["lengths"][at:end], pa.list_(pa.int32())),
                    pa.array([sum(s["length"] for s in x) for x in segments[at:end]], pa.int32()),
                    pa.array(segments[at:end], pa.list_(segment)),
                ]
                names = ["shard", "row", "input_ids", "position_ids", "cu_seqlens", "n_tokens", "segments"]
                yield pa.RecordBatch.from_arrays(columns, names)

    schema = (
        f"shard {kind}, row int, input_ids binary, position_ids binary, cu_seqlens array<int>, n_tokens int, "
        f"segments array<struct<doc_id: {kind}, first: int, length: int>>"
    )
    return rows.mapInArrow(work, schema)


def pack_texts(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``pack`` over the ids that ``df``'s texts have under the tokenizer at ``path``."""
    return pack(encode(df, path, id_col, text_col), **options)


def write_packed(packed: DataFrame, folder: str) -> None:
    """Store packed rows as Parquet files with binary id matrices, one row group after the other as they come."""
    packed.write.mode("overwrite").parquet(folder)
