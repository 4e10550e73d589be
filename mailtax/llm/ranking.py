"""Ranked lexical search by NRA (no random access) over impact-sorted postings.

A term counts in a document with an integer impact that does not depend on the query, so the postings of a term can be read
in falling impact by every item. One pass over the texts stores, for each document, its length and how often each term of the
items occurs in it; df, N and L are counted over all documents. Runs of documents with a bounded number of postings are
blocks: a task sorts the postings of its block once by (term, falling impact) and answers all items over them. Per item it
reads the lists of its terms in step and keeps for each document met

* a lower score: the impacts read so far;
* an upper score: the lower one plus, for each list where the document was not met yet, the impact last read there.

It goes on until no document outside can reach the k-th best lower score, and every document that can has equal bounds; so
members, ties and scores are settled by sequential reads alone. The best of the blocks are merged by a ranked window.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mailtax.functions.staging import cut
from mailtax.llm.common import Batches, texts

TERM = re.compile(rb"[0-9a-z\x80-\xff]+")  # of lower-cased UTF-8: digits, letters and all bytes of other characters
BETWEEN = re.compile(rb"[^0-9A-Za-z\x80-\xff]")
TERM_CHARACTERS = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SLICE = 1 << 20  # bytes of a text that are split at a time
BLOCK_POSTINGS = 2_000_000
MAX_TERMS = 200_000  # distinct terms of a block of items, which are broadcast
FIRST_READ = 256
GROWTH = 4


def _terms(text: Column) -> Column:
    """The terms of a short text, natively; null has none."""
    return F.coalesce(F.regexp_extract_all(F.translate(text, UPPER, LOWER), F.lit(TERM_CHARACTERS), F.lit(0)), F.array().cast("array<string>"))


def term_counts(text: bytes, number: dict[bytes, int]) -> tuple[int, Counter]:
    """Terms of the text with repeats, and how often each numbered term occurs (None: all others)."""
    size, counts, at = 0, Counter(), 0
    while at < len(text):
        end = at + SLICE
        if end < len(text):  # not within a term
            stop = BETWEEN.search(text, end)
            end = stop.start() if stop else len(text)
        found = TERM.findall(text[at:end].lower())
        size += len(found)
        counts.update(map(number.get, found))
        at = end
    return size, counts


def nra(lists: list[tuple[np.ndarray, np.ndarray]], documents: int, k: int) -> tuple[np.ndarray, np.ndarray, int]:
    """(documents, exact scores) that hold all of the k best, ties included, and the number of postings read.

    ``lists``: documents (each once) and their impacts above 0, falling.
    """
    lower, met = np.zeros(documents, np.int64), np.zeros(documents, bool)
    done, depth, read = 0, FIRST_READ, 0
    while True:
        frontier = []
        for docs, impact in lists:
            new = docs[done:depth]
            lower[new] += impact[done:depth]
            met[new] = True
            read += len(new)
            frontier.append(int(impact[depth - 1]) if depth < len(docs) else 0)
        beyond = sum(frontier)  # the most that a document not met yet can score
        there = np.flatnonzero(met)
        least = int(np.partition(lower[there], len(there) - k)[len(there) - k]) if len(there) >= k else 0
        if beyond < least or not beyond:
            open_to = np.full(documents, beyond, np.int64)
            for (docs, _), last in zip(lists, frontier):
                if last:
                    open_to[docs[:depth]] -= last
            able = there[lower[there] + open_to[there] >= least]
            if not open_to[able].any():
                return able, lower[able], read
        done, depth = depth, depth * GROWTH


class Block:
    """The impact-sorted postings of a run of documents."""

    def __init__(self, ids: pa.Array, length: np.ndarray, doc: np.ndarray, term: np.ndarray, tf: np.ndarray, weight: np.ndarray, n: int, words: int):
        m = 50 + 50 * length * n // words
        impact = weight[term] * (1_000_000_000 * tf // (1000 * tf + 20 * m[doc]))
        order = np.lexsort((doc, -impact, term))
        order = order[impact[order] > 0]
        self.doc, self.term, self.impact = doc[order], term[order], impact[order]
        self.ids, self.place = ids, np.empty(len(ids), np.int64)
        self.place[pc.array_sort_indices(ids).to_numpy()] = np.arange(len(ids))  # nulls last

    def search(self, wanted: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Places in ``ids`` and scores of the k best, ties by id."""
        first, last = np.searchsorted(self.term, wanted), np.searchsorted(self.term, wanted, "right")
        lists = [(self.doc[a:b], self.impact[a:b]) for a, b in zip(first, last) if a < b]
        if not lists:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        docs, score, _ = nra(lists, len(self.ids), k)
        best = np.lexsort((self.place[docs], -score))[:k]
        return docs[best], score[best]


def _postings(rows: DataFrame, number: dict[bytes, int]) -> DataFrame:
    """``doc_id, n, terms, tfs`` of each row that has a term."""
    shared = rows.sparkSession.sparkContext.broadcast(number)

    def work(batches: Batches) -> Batches:
        number = shared.value
        for batch in batches:
            size, sizes, terms, tfs = [], [0], [], []
            for text in batch.column("text").cast(pa.binary()).to_pylist():
                n, counts = term_counts(text, number)
                counts.pop(None, None)
                size.append(n)
                terms.extend(counts.keys())
                tfs.extend(counts.values())
                sizes.append(len(terms))
            at = pa.array(sizes, pa.int32())
            columns = [
                batch.column("doc_id"), pa.array(size, pa.int64()),
                pa.ListArray.from_arrays(at, pa.array(terms, pa.int32())), pa.ListArray.from_arrays(at, pa.array(tfs, pa.int64())),
            ]
            out = pa.RecordBatch.from_arrays(columns, ["doc_id", "n", "terms", "tfs"])
            yield out.filter(pc.greater(out.column("n"), 0))

    return rows.mapInArrow(work, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, n bigint, terms array<int>, tfs array<bigint>")


def _best(stored: DataFrame, asked: list[np.ndarray], weight: np.ndarray, n: int, words: int, k: int, block: int) -> DataFrame:
    """``item, doc_id, score``: the k best of each block and item."""
    shared = stored.sparkSession.sparkContext.broadcast((asked, weight))

    def solve(batches: list[pa.RecordBatch]) -> Batches:
        asked, weight = shared.value
        rows = pa.Table.from_batches(batches).combine_chunks()
        terms, tfs = rows.column("terms").combine_chunks(), rows.column("tfs").combine_chunks()
        doc = np.repeat(np.arange(len(rows)), pc.list_value_length(terms).to_numpy())
        ids = rows.column("doc_id").combine_chunks()
        index = Block(ids, rows.column("n").to_numpy(), doc, terms.flatten().to_numpy(), tfs.flatten().to_numpy(), weight, n, words)
        for item, wanted in enumerate(asked):
            docs, score = index.search(wanted, k)
            if len(docs):
                columns = [pa.array(np.full(len(docs), item)), ids.take(pa.array(docs)), pa.array(score)]
                yield pa.RecordBatch.from_arrays(columns, ["item", "doc_id", "score"])

    def work(batches: Batches) -> Batches:
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += len(batch.column("terms").flatten()) + batch.num_rows
            if size >= block:
                yield from solve(held)
                held, size = [], 0
        if held:
            yield from solve(held)

    return stored.mapInArrow(work, f"item bigint, doc_id {stored.schema['doc_id'].dataType.simpleString()}, score bigint")


def rank_documents(
    documents: DataFrame, items: DataFrame, k: int = 50, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
    item_text_col: str = "text", block: int = BLOCK_POSTINGS, max_terms: int = MAX_TERMS,
) -> DataFrame:
    """``item_id, rank`` (from 1), ``doc_id, score``: the k documents with the highest score above 0 per item, all if fewer.

    Every row of ``documents`` is a document, also one that is repeated or has no id; null and empty texts have no term. Equal
    scores go by id, null ids last. Rows of ``items`` with one id are one item with the terms of all; null is an id of its own.
    Items without a term, and all if no document has one, have no rows. Texts of any length are split in slices. The terms of the
    items are broadcast in blocks of about ``max_terms``; each block of items is one pass over the texts. Empty in, empty out.
    """
    rows = texts(documents, id_col, text_col, key=False)
    asked = cut(
        items.select(F.col(item_col).alias("item_id"), F.explode(_terms(F.col(item_text_col))).alias("term")).distinct()
    )
    blocks = max(1, -(-asked.count() // max_terms))
    part = F.pmod(F.xxhash64(F.col("item_id").isNull(), "item_id"), F.lit(blocks))
    out = None
    for b in range(blocks):
        mine = asked.where(part == b).groupBy("item_id").agg(F.array_sort(F.collect_set("term")).alias("terms")).collect()
        number = {t: i for i, t in enumerate(sorted({t.encode() for r in mine for t in r["terms"]}))}
        stored = cut(_postings(rows, number))
        total = stored.agg(F.count("*").alias("n"), F.coalesce(F.sum("n"), F.lit(0)).alias("words")).first()
        n, words = total["n"], total["words"]
        weight = np.zeros(len(number), np.int64)
        for r in stored.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count("*").alias("df")).collect():
            weight[r["t"]] = math.floor(1000 * math.log((2 * n + 2) / (2 * r["df"] + 1)))
        wanted = [np.array([number[t.encode()] for t in r["terms"]], np.int64) for r in mine]
        best = _best(stored, wanted, weight, n, max(1, words), k, block)
        names = items.sparkSession.createDataFrame(
            [(i, r["item_id"]) for i, r in enumerate(mine)], f"item bigint, item_id {asked.schema['item_id'].dataType.simpleString()}"
        )
        order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))  # Spark keeps k rows an item before its shuffle
        ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        ranked = ranked.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")
        out = ranked if out is None else out.union(ranked)
    return out


def rank_sql(k: int = 50) -> str:
    """DuckDB SQL for ``rank_documents(documents, benchmark)``."""

    def terms(table: str, key: str) -> str:
        return f"SELECT {key}, unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '{TERM_CHARACTERS}')) AS term FROM {table}"

    return f"""
    WITH d AS (SELECT row_number() OVER () AS r, doc_id, text FROM documents),
    tf AS (SELECT r, term, count(*) AS tf FROM ({terms('d', 'r')}) GROUP BY 1, 2),
    len AS (SELECT r, CAST(sum(tf) AS BIGINT) AS n FROM tf GROUP BY 1),
    total AS (SELECT count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS words FROM len),
    df AS (SELECT term, count(*) AS df FROM tf GROUP BY 1),
    q AS (SELECT DISTINCT item_id, term FROM ({terms('benchmark', 'item_id')})),
    scored AS (
      SELECT item_id, r, CAST(sum(CAST(floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE)) AS BIGINT)
                                  * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * n_docs) // words)))) AS BIGINT) AS score
      FROM q JOIN tf USING (term) JOIN df USING (term) JOIN len USING (r) CROSS JOIN total GROUP BY 1, 2)
    SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank, doc_id, score
    FROM scored JOIN d USING (r) WHERE score > 0 QUALIFY rank <= {k}"""
