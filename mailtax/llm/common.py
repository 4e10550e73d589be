"""Helpers the operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Batches = Iterator[pa.RecordBatch]


def row_key(id_col: str, text_col: str) -> list[Column]:
    """``k1, k2``: 128 bits that stand for (id, text). Never null; repeated rows share them."""
    there = F.coalesce(F.col(text_col), F.lit(""))
    return [
        F.xxhash64(F.lit(1), F.col(id_col).isNull(), F.col(id_col), there).alias("k1"),
        F.xxhash64(there, F.col(id_col), F.lit(2)).alias("k2"),
    ]


def texts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", key: bool = True) -> DataFrame:
    """Only ``doc_id`` and ``text`` (null: empty) of ``df``, with the row key; other columns never clash."""
    columns = [F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")]
    return df.select(*columns, *(row_key(id_col, text_col) if key else []))


def per_batch(work: Callable[[pa.RecordBatch], pa.RecordBatch]) -> Callable[[Batches], Batches]:
    """A function for ``mapInArrow`` that turns each batch into one."""

    def run(batches: Batches) -> Batches:
        for batch in batches:
            yield work(batch)

    return run


def fold(id_col: str, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; null ids belong to fold 0."""
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(parts)), F.lit(0)).cast("int")


def bounded_sample(df: DataFrame, rows: int, on: list[Column]) -> DataFrame:
    """About ``rows`` rows at most, chosen by a hash of ``on``: the same rows on every run, without a sort.

    One counting job fixes the share; the expected size is ``rows`` and exceeds it by chance only by a few
    square roots.
    """
    share = min(1.0, rows / max(1, df.count()))
    return df if share == 1.0 else df.where(F.pmod(F.xxhash64(F.lit(17), *on), F.lit(1 << 30)) < int(share * (1 << 30)))
