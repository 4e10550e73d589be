"""Exact top-k search by inner product with an impact-ordered index, score at a time.

Vectors are split into blocks. The postings of a block (dimension, vector, value; zeros have none) lie sorted by falling absolute
value, the impact, and are cut into segments at quantised impacts: segment 0 holds the largest. A batch of queries goes through the
segments in this order and adds query weight times value to the scores. After each segment the part of a vector's score still
open is bounded by the norm of its values not yet read times the norm of the query. When the vectors whose upper bound reaches the
k-th largest lower bound of a query are few, the segments left are not read: that is the proof that no other vector can be among
the first k. The possible members are then scored exactly. A block's index is built once, by the task that holds the block, and
all queries stream by it; blocks give their own first k per query, which Spark merges.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mailtax.llm.common import Batches

SEGMENTS = 8
BLOCK_ROWS = 8192
QUERY_ROWS = 256
EXACT = 1 << 53


def quantised(vector: Column, scale: int = 256) -> Column:
    """floor(scale * x) of every component as long; null if the vector is null or holds null or non-finite values."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.when(
        vector.isNotNull() & fine, F.transform(vector, lambda x: F.floor(x.cast("double") * float(scale)).cast("bigint"))
    )


class Block:
    """The impact-ordered postings of some vectors (rows of longs)."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        order = np.argsort(ids, kind="stable")
        self.ids, self.vectors = ids[order], vectors[order]
        vector, dimension = np.nonzero(self.vectors)
        value = self.vectors[vector, dimension].astype(np.float64)
        falling = np.argsort(-np.abs(value), kind="stable")
        self.vector, self.dimension, self.value = vector[falling].astype(np.int32), dimension[falling].astype(np.int32), value[falling]
        top = float(np.abs(value).max(initial=0.0))
        edges = [top * (1 - (s + 1) / SEGMENTS) ** 2 for s in range(SEGMENTS - 1)]
        self.ends = [*np.searchsorted(-np.abs(self.value), [-e for e in edges]).tolist(), len(self.value)]
        self.open, rest = [], np.zeros(len(self.ids))  # norm of a vector's values after each segment
        for s in range(SEGMENTS - 1, -1, -1):
            self.open.append(np.sqrt(rest) * (1 + 1e-9))
            part = slice(self.ends[s - 1] if s else 0, self.ends[s])
            rest = rest + np.bincount(self.vector[part], self.value[part] ** 2, len(self.ids))
        self.open.reverse()
        self.small = top * top * max(1, vectors.shape[1]) < EXACT
        self.read = 0  # postings read by the last batch of queries

    def segments(self):
        """Each segment's postings as a matrix (dimension, vector), made as it is read."""
        begin = 0
        for end, rest in zip(self.ends, self.open):
            tile = np.zeros((self.vectors.shape[1], len(self.ids)))
            tile[self.dimension[begin:end], self.vector[begin:end]] = self.value[begin:end]
            begin = self.read = end
            yield tile, rest

    def search(self, query_ids: np.ndarray, queries: np.ndarray, k: int) -> list[tuple[int, int, int]]:
        """(query, vector, score) of the first k vectors per query, its own id left out."""
        weights = queries.astype(np.float64)
        norm = np.sqrt((weights * weights).sum(axis=1))
        scores = np.zeros((len(queries), len(self.ids)))
        possible = np.ones(scores.shape, bool)
        own = query_ids[:, None] == self.ids[None, :]
        slack = 1e-6 * (1 + norm[:, None] * max((x.max(initial=0.0) for x in self.open), default=0.0))
        for segment, rest in self.segments():
            scores += weights @ segment
            spread = norm[:, None] * rest[None, :] + slack
            low = np.where(own, -np.inf, scores - spread)
            n = min(k, low.shape[1])
            bar = np.partition(low, low.shape[1] - n, axis=1)[:, low.shape[1] - n]
            possible = (scores + spread >= bar[:, None]) & ~own
            if possible.sum() <= 4 * k * len(queries):
                break
        out = []
        for q, (query_id, query) in enumerate(zip(query_ids.tolist(), queries)):
            members = np.flatnonzero(possible[q])
            ids = self.ids[members]
            if self.small and np.abs(query).max(initial=0) ** 2 * max(1, len(query)) < EXACT:
                exact = self.vectors[members] @ query
                best = [(int(exact[i]), int(ids[i])) for i in np.lexsort((ids, -exact))[:k]]
            else:  # Python integers do not overflow
                exact = [sum(int(a) * int(b) for a, b in zip(self.vectors[m], query)) for m in members]
                best = sorted(zip(exact, ids.tolist()), key=lambda x: (-x[0], x[1]))[:k]
            out += [(query_id, i, s) for s, i in best]
        return out


def _matrix(vectors: pa.Array, width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width), np.int64)
    for row, values in enumerate(vectors):
        out[row, :len(values)] = values.values.to_numpy()
    return out


def top_k(
    queries: DataFrame, candidates: DataFrame, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 256
) -> DataFrame:
    """``query_id, rank`` (from 1), ``vec_id, score``: the ``k`` highest inner products of quantised vectors per query, all
    if there are fewer; ties go to the smaller id; a vector is no candidate for the query of its own id.

    Vectors that are null or hold null or non-finite components take no part, nor do null ids; shorter vectors count as
    filled up with zeros. Repeated rows of an id and vector count once. Scores beyond 64 bits raise an error.

    A candidate lies in one block and a query goes to every block, so the work is queries times blocks. A task holds one block of
    bounded size at a time, and a bounded batch of queries.
    """

    def clean(df: DataFrame) -> DataFrame:
        found = df.select(F.col(id_col).alias("id"), quantised(F.col(vector_col), scale).alias("v"))
        return found.where("id is not null and v is not null").distinct()

    asked, there = clean(queries), clean(candidates)
    blocks = max(1, -(-there.count() // BLOCK_ROWS))
    own = F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int")
    left = asked.select("id", "v", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("b"), F.lit(True).alias("asks"))
    right = there.select("id", "v", own.alias("b"), F.lit(False).alias("asks"))

    def solve(block: Block | None, rows: pa.Table, width: int) -> pa.RecordBatch:
        found: list[tuple[int, int, int]] = []
        if block is not None:
            ids, vectors = rows.column("id").to_numpy(), _matrix(rows.column("v").combine_chunks(), width)
            for at in range(0, len(ids), QUERY_ROWS):
                found += block.search(ids[at:at + QUERY_ROWS], vectors[at:at + QUERY_ROWS], k)
        columns = zip(*found) if found else ([], [], [])
        return pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in columns], ["query_id", "vec_id", "score"])

    def work(batches: Batches) -> Batches:
        """Blocks come one after the other, their candidates before their queries."""
        at, held, block, width = None, [], None, 0
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            keys = rows.column("b").to_numpy() * 2 + rows.column("asks").to_numpy()
            edges = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]
            for begin, end in zip(edges, edges[1:]):
                part = rows.slice(begin, end - begin)
                b, asks = divmod(int(keys[begin]), 2)
                if b != at:
                    at, held, block, width = b, [], None, 0
                if not asks:
                    held.append(part)
                    continue
                need = max((len(v) for v in part.column("v")), default=0)
                if held or need > width:  # the first queries of a block, or wider ones than before
                    table = pa.concat_tables(held) if held else None
                    if table is not None:
                        ids, lists = table.column("id").to_numpy(), table.column("v").combine_chunks()
                        width = max(need, max((len(v) for v in lists), default=0))
                        block = Block(ids, _matrix(lists, width))
                    elif block is not None:
                        wider = np.zeros((len(block.ids), need), np.int64)
                        wider[:, :width] = block.vectors
                        block, width = Block(block.ids, wider), need
                    held = []
                yield solve(block, part, width)

    met = left.union(right).repartition("b").sortWithinPartitions("b", "asks")
    partial = met.mapInArrow(work, "query_id bigint, vec_id bigint, score bigint")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")  # Spark keeps k rows a query before its shuffle
    return partial.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def top_k_sql(k: int = 5, every: int = 50, scale: int = 256) -> str:
    """DuckDB SQL for the query: rows whose id is divisible by ``every`` against all rows."""
    return f"""
    WITH v AS (SELECT DISTINCT vec_id, [CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS e FROM embeddings
               WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
                 AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
    c AS (SELECT vec_id, unnest(e) AS x, generate_subscripts(e, 1) AS d FROM v),
    scored AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(sum(q.x * c.x) AS BIGINT) AS score
               FROM c q JOIN c ON q.d = c.d AND q.vec_id <> c.vec_id WHERE q.vec_id % {every} = 0 GROUP BY 1, 2)
    SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
    FROM scored QUALIFY rank <= {k}"""
