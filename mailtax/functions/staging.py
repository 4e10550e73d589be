"""Store intermediate results in the folder all executors share."""

from __future__ import annotations

import tempfile
import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

COMPACT = {"compression": "zstd", "parquet.writer.version": "PARQUET_2_0"}
LONG = 5  # seconds from which a job that stores a result is long: its shuffle files are then removed at once

_scratch: ContextVar[str | None] = ContextVar("scratch", default=None)


def shared_folder(spark: SparkSession) -> str:
    """The session's checkpoint folder. Only a local session, whose executors are threads of the driver, may lack one; it
    then gets a temporary folder."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if context.master != "local" and not context.master.startswith("local["):
                raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
            folder = tempfile.mkdtemp(prefix="mailtax-")
        context.setCheckpointDir(folder)
    return context.getCheckpointDir()


@contextmanager
def scratch(spark: SparkSession) -> Iterator[str]:
    """Keep everything that ``cut`` stores inside the block in one folder and delete it at the end.

    Results must be written before the block ends, as they read what was stored. Blocks may be nested; the outermost
    one counts.
    """
    if _scratch.get() is not None:
        yield _scratch.get()
        return
    folder = f"{shared_folder(spark)}/mailtax-{uuid.uuid4()}"
    token = _scratch.set(folder)
    try:
        yield folder
    finally:
        _scratch.reset(token)
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` once and go on from the files, so later jobs neither repeat nor depend on its lineage.

    Parquet keeps column pruning and size statistics for the readers, which a row checkpoint would lose. Results
    of an aggregation are also stored before a large table is joined to them on the same key: adaptive execution
    splits a hot key only where both join sides come straight from a shuffle, not where one side still has the
    partitioning of its aggregation. Outside of a ``scratch`` block the files stay until the folder is cleaned.
    The files are written for size, as every byte is written and read again: keys as differences, ids by their entropy.
    """
    spark = df.sparkSession
    path = _new_folder(spark)
    with _shuffles_removed(spark):
        df.write.options(**COMPACT).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def cut_in_buckets(df: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """As ``cut``, in buckets of ``key``; the stored rows twice, by bucket and plain.

    Jobs that group by the key, join by it, or by it and more, read the first without a shuffle. It is for keys with few rows
    each on both sides of a join, as no bucket is split; the second is read, and its hot keys are split, like any other table.
    """
    spark = df.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    name, path = f"mailtax_{uuid.uuid4().hex}", _new_folder(spark)
    writer = df.repartition(buckets, key).write.format("parquet").options(path=path, **COMPACT)
    with _shuffles_removed(spark):
        writer.bucketBy(buckets, key).sortBy(key).saveAsTable(name)
    stored = spark.table(name)
    spark.sql(f"DROP TABLE {name}")  # the files stay, the catalogue keeps no name of them
    return stored, spark.read.schema(df.schema).parquet(path)


@contextmanager
def _shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Remove what a long job shuffled once its result is stored, as nothing reads it again.

    Spark deletes the shuffle files of a plan when the driver collects the plan as garbage. A driver with a large heap does so once
    in half an hour, and until then the files of all steps of a run lie side by side. So garbage is collected after long jobs.
    """
    begin = time.monotonic()
    yield
    if time.monotonic() - begin >= LONG:
        spark.sparkContext._jvm.System.gc()


def _new_folder(spark: SparkSession) -> str:
    return f"{_scratch.get() or shared_folder(spark)}/mailtax-{uuid.uuid4()}"
