from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from mailtax.functions.numbering import number_within


def test_large_group_is_numbered_over_many_slices(spark):
    """One group holds most rows; numbers equal a plain window and no slice holds the whole group."""
    df = spark.range(60000).select(
        F.when(F.col("id") % 3 == 0, F.col("id") % 100).otherwise(-1).alias("g"),
        F.when(F.col("id") % 7 != 0, F.xxhash64("id")).alias("o"),
        F.col("id").alias("tie"),
    )
    found = number_within(df, ["g"], ["o", "tie"], "n", totals={"rows": F.lit(1), "ties": F.col("tie")})
    whole = Window.partitionBy("g")
    expected = df.select(
        "g",
        "o",
        "tie",
        F.sum(F.lit(1)).over(whole).cast("bigint").alias("rows"),
        F.sum("tie").over(whole).alias("ties"),
        F.row_number().over(whole.orderBy("o", "tie")).cast("bigint").alias("n"),
    )
    columns = expected.columns
    assert found.select(columns).exceptAll(expected).count() == 0
    assert found.count() == 60000


def test_hot_group_spreads(spark):
    df = spark.range(20000).select(F.lit(1).alias("g"), F.col("id").alias("o"))
    placed = df.repartitionByRange(8, "g", "o").groupBy(F.spark_partition_id()).count().collect()
    assert len(placed) == 8
    assert max(r[1] for r in placed) < 5000
    last = number_within(df, ["g"], ["o"], "n").agg(F.max("n"), F.countDistinct("n")).first()
    assert tuple(last) == (20000, 20000)
