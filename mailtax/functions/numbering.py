"""Exact row numbers inside groups of any size.

A window over the group puts the whole group in one task. Here the rows are range-partitioned by group and
order, so a large group covers many partitions; each slice of a group is numbered by itself and shifted by the
size of the slices before it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mailtax.functions.staging import cut


def number_within(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[str],
    name: str,
    *,
    totals: dict[str, Column] | None = None,
) -> DataFrame:
    """Add ``name`` = 1..n in each group by ``order``, and per-group sums of the ``totals`` expressions.

    ``group`` columns must not be NULL and ``group + order`` must identify a row. The range split is stored
    before it is read twice: its bounds come from a sample, and both readers must see the same ones, also
    after an executor is lost.
    """
    totals = totals or {}
    spark = df.sparkSession
    slices = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = cut(
        df.repartitionByRange(slices, *group, *order).withColumn("_slice", F.spark_partition_id())
    )
    # At most one row per group and slice, so this window sees at most `slices` rows of a group.
    counted = placed.groupBy(*group, "_slice").agg(
        F.count("*").alias("_rows"), *[F.sum(c).alias(f"_sum_{n}") for n, c in totals.items()]
    )
    whole = Window.partitionBy(*group)
    earlier = whole.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    shifts = counted.select(
        *group,
        "_slice",
        F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"),
        *[F.sum(f"_sum_{n}").over(whole).alias(n) for n in totals],
    )
    inside = Window.partitionBy(*group, "_slice").orderBy(*order)
    return (
        placed.withColumn("_inside", F.row_number().over(inside))
        .join(shifts, [*group, "_slice"])
        .withColumn(name, (F.col("_before") + F.col("_inside")).cast("bigint"))
        .drop("_slice", "_before", "_inside")
    )
