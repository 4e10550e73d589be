"""Plans that must hold at scale: no cross or nested-loop joins, pruned scans, reuse, and spread hot keys."""

from __future__ import annotations

import pytest
from conftest import AS_OF
from pyspark.sql import functions as F

import __spark_entry__ as entry
from mailtax import schemas
from mailtax.functions.rules import LETTER_SHOP
from mailtax.functions.staging import cut
from mailtax.operators import allocate as al
from mailtax.operators import lines as ln
from mailtax.operators import points as pt
from mailtax.operators import qualify as ql
from mailtax.plans.queries import all_queries

SF_DIR = "/root/testdata/sf0.001"


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(all_queries()))
def test_no_nested_loops_and_no_python(spark, name):
    plan = plan_of(entry.queries()[name](spark, SF_DIR))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEvalPython", "MapInPandas"):
        assert operator not in plan, operator
    assert "SinglePartition" not in plan or name in ("referential_checks",) or "Subquery" in plan


def test_no_window_over_a_batch_in_the_allocation(spark):
    assert "Window" not in plan_of(entry.queries()["sales_tax_details"](spark, SF_DIR))


def test_allocation_reads_stored_addresses(spark):
    """The joins behind the addresses are not in the plan, neither for the rows nor for the totals."""
    plan = plan_of(entry.queries()["sales_tax_allocation"](spark, SF_DIR))
    assert "transaction_guid" not in plan and plan.count("FileScan") == 2


def test_existence_guard_is_a_subquery(spark):
    plan = plan_of(entry.queries()["session_line_item_batches"](spark, SF_DIR))
    assert "Subquery" in plan and "CollectLimit 1" in plan


def test_scans_are_pruned_and_filters_pushed(spark):
    plan = entry.queries()["active_clients"](spark, SF_DIR)._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
    assert "ReadSchema: struct<file_stream_config_id:string,date_added:timestamp_ntz,is_active:boolean>" in plan
    assert "EqualTo(is_active,true)" in plan and "GreaterThanOrEqual(date_added" in plan
    details = plan_of(entry.queries()["taxable_line_items"](spark, SF_DIR))
    assert "return_detail_id" not in details and "detail_id" not in details


HOT = 7


@pytest.fixture
def skewed(spark, billing, tmp_path):
    """100 lines of one category each; every third detail belongs to one line, many have no piece id."""
    count = 240000
    base = spark.range(count).withColumn("line", F.when(F.col("id") % 3 == 0, HOT).otherwise(F.col("id") % 150))
    piece = F.when(F.col("id") % 4 != 1, F.concat(F.lit("p"), F.col("id")))
    frames = {
        "details": base.select(
            F.col("id").alias("detail_key"), F.col("line").alias("category_key"), piece.alias("data_stream_detail_id")
        ),
        "host1_pieces": base.where(piece.isNotNull()).select(
            piece.alias("data_stream_detail_id"), F.concat(F.lit("c"), F.col("id") % 50).alias("city"),
            F.lit("s").alias("state"), F.lpad(F.col("id").cast("string"), 6, "0").alias("zip"),
            F.lit(False).alias("is_foreign"),
        ),
        "invoice_line_items": base.groupBy(F.col("line").alias("invoice_line_item_key")).agg(
            F.count("*").alias("quantity")
        ).select("*", F.lit(10).alias("invoice_key"), F.lit(1).alias("line_item_key"),
                 F.lit(1000).cast("decimal(19,4)").alias("extended_amount")),
        "activities": base.select("line").distinct().select(
            F.col("line").alias("invoice_line_item_key"), F.col("line").alias("category_key"),
            F.lit(1).alias("rate_model_key"), F.lit(1).alias("rate_key"),
            F.lit(True).alias("include_in_sales_tax_batch"),
        ),
    }
    t = billing(
        line_items=[{"line_item_key": 1, "module": "a." + LETTER_SHOP, "sales_tax_code_key": 1,
                     "use_customer_tax_address": False, "is_exportable": True}],
        rate_models=[{"rate_model_key": 1}],
        rates=[{"rate_key": 1, "rate_type_key": 6}],
        transaction_types=[{"transaction_type_id": 1,
                            "transaction_type_guid": "7cd5755a-3827-4d05-ac9e-fe40322947e5"}],
    )
    for name, df in frames.items():
        full = df.select(*[
            (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schemas.schema(name)
        ])
        full.write.parquet(str(tmp_path / name))
        t[name] = spark.read.parquet(str(tmp_path / name))
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "256KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.shuffle.partitions": "32",
        "spark.sql.files.maxPartitionBytes": "256KB",
    }
    old = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield t, count
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_hot_line_is_split_in_joins_and_counted_right(spark, skewed):
    t, count = skewed
    todo = ln.non_service_lines(ln.covered_lines(t))
    pieces = ql.match_pieces(t, todo)
    pieces.write.format("noop").mode("overwrite").save()  # the whole join without broadcasts
    listed = pieces.select("invoice_line_item_key", "detail_key", "host1")
    listed.collect()
    assert "skew=true" in plan_of(listed)
    assert listed.count() == count
    assert listed.where("host1 is null").count() == count // 4

    status = ql.line_status(t, todo, pieces)
    hot = status.where(F.col("invoice_line_item_key") == HOT).first()
    assert hot["warning"] is None and hot["calculated_quantity"] > count // 3
    assert status.agg(F.sum("detail_count")).first()[0] == count


def test_hot_piece_id_is_split(spark, skewed, tmp_path):
    """Half of all details carry one id, which both hosts know."""
    t, count = skewed
    zero = "00000000-0000-0000-0000-000000000000"
    hot = F.when(F.col("detail_key") % 2 == 0, zero).otherwise(F.col("data_stream_detail_id"))
    t["details"].withColumn("data_stream_detail_id", hot).write.parquet(str(tmp_path / "hot"))
    t["details"] = spark.read.parquet(str(tmp_path / "hot"))
    one = t["host1_pieces"].limit(1).withColumn("data_stream_detail_id", F.lit(zero))
    t["host1_pieces"] = t["host1_pieces"].union(one)
    t["host2_pieces"] = t["host2_pieces"].select(
        *[(F.lit(zero) if f.name == "data_stream_detail_id" else F.lit(None)).cast(f.dataType).alias(f.name)
          for f in schemas.schema("host2_pieces")]
    ).union(spark.createDataFrame([(zero, *[None] * (len(schemas.columns("host2_pieces")) - 1))], schemas.schema("host2_pieces")))
    todo = ln.non_service_lines(ln.covered_lines(t))
    pieces = ql.match_pieces(t, todo)
    spark.conf.set("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "64KB")  # equal ids compress well
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "32KB")
    tasks = pieces.select("detail_key", "host1", "host2", F.spark_partition_id().alias("task"))
    sizes = [r["n"] for r in tasks.groupBy("task").agg(F.count("*").alias("n"), F.count("host1")).collect()]
    assert sum(sizes) == count
    assert max(sizes) < 0.25 * count  # whole outputs of map tasks are the finest split, and one task mapped the hot line
    listed = pieces.select("detail_key", "host1", "host2")
    listed.collect()
    assert "skew=true" in plan_of(listed)
    assert pieces.where("host2 is not null").count() == count // 2
    t["activity_categories"] = t["details"].select("category_key").distinct()
    hosts = {r["host_system_id"] for r in ln.infer_host_system(t, todo).collect()}
    assert hosts == {1}


def test_hot_category_is_split_when_activities_meet_coverage(spark, skewed):
    """Two thirds of all activities share one category."""
    t, _ = skewed
    acts = spark.range(300000).select(
        F.col("id").alias("invoice_line_item_key"),
        F.when(F.col("id") % 3 > 0, HOT).otherwise(F.col("id")).alias("category_key"),
        F.lit(True).alias("include_in_sales_tax_batch"),
    )
    guids = spark.range(1000).select(F.concat(F.lit("g"), "id").alias("transaction_guid"),
                                     F.lit(True).alias("is_active"))
    details = spark.range(20000).select(
        F.col("id").alias("category_key"), F.concat(F.lit("g"), F.col("id") % 2000).alias("transaction_guid")
    )
    covered = ln.covered_categories({"delivery_points": guids}, ln.category_transactions({"details": details}))
    assert covered.count() == 10000
    joined = acts.join(covered.withColumn("covered", F.lit(True)), "category_key", "left")
    assert joined.where("covered").select("invoice_line_item_key").distinct().count() > 200000
    joined.collect()
    assert "skew=true" in plan_of(joined)


def test_hot_batch_is_allocated_and_numbered_in_pieces(spark, skewed):
    """The addresses of one batch are a third of all; the amounts still add up, line by line."""
    t, _ = skewed
    todo = ln.non_service_lines(ln.covered_lines(t))
    pieces = ql.match_pieces(t, todo)
    status = ql.line_status(t, todo, pieces)
    points = pt.generate_delivery_points(status, pieces, as_of=AS_OF)
    world = {
        **t,
        "delivery_points": points,
        "taxable_line_items": pt.taxable_line_items_of(pt.session_line_links(status)),
    }
    lines = ln.taxable_lines(ln.covered_lines(t), status.select("invoice_line_item_key"))
    addresses = al.batch_addresses(world, lines, bridge="taxable_line_item")
    addresses = cut(addresses)
    allocated = al.allocate(addresses).select("sales_tax_batch_key", "quantity", "rate")
    allocated.collect()
    assert "skew=true" in plan_of(allocated)
    totals = {
        r["k"]: r
        for r in al.allocate(addresses).groupBy(F.col("sales_tax_batch_key").alias("k")).agg(
            F.count("*").alias("n"), F.sum(F.col("rate") * F.col("quantity")).alias("amount")
        ).collect()
    }
    assert len(totals) == 100 and totals[HOT]["n"] > 50000
    assert all(abs(float(r["amount"]) - 1000) < 1e-5 for r in totals.values())
    numbered = al.rate_distribution(addresses)
    check = numbered.groupBy("sales_tax_batch_key").agg(
        F.max("line_number").alias("m"), F.countDistinct("line_number").alias("d"), F.count("*").alias("n"),
        F.max("lines_per_batch").alias("l"),
    )
    for r in check.collect():
        assert r["m"] == r["d"] == r["n"] == r["l"] == totals[r["sales_tax_batch_key"]]["n"]


@pytest.fixture
def large_scans(spark):
    """As for tables too large to be broadcast."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "1",
    }
    old = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def scoped(spark, t, every):
    return cut(t["sessions"].select("session_key").where(F.pmod(F.xxhash64("session_key"), F.lit(every)) == 0))


def test_keys_of_a_small_scope_filter_the_scans(spark, large_scans):
    """For 1 % of the sessions a Bloom filter of the scope's keys is applied where details, points and pieces are scanned."""
    from mailtax.sources.standins import standin_tables

    t = standin_tables(spark, SF_DIR)
    some = scoped(spark, t, 100)
    assert ln.is_few(t, some) and 0 < some.count() < 0.05 * t["sessions"].count()
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    assert "might_contain" in plan(ln.linked_transactions(t, some))
    seen = []
    original = ln.within

    def watched(rows, keys, key):
        out = original(rows, keys, key)
        seen.append((key, plan(out)))
        return out

    ln.within = watched
    try:
        covered = ln.covered_lines(t, some)
        todo = cut(ln.non_service_lines(covered))
        ql.match_pieces(t, todo, few=True)
    finally:
        ln.within = original
    assert {k for k, _ in seen} == {"category_key", "transaction_guid", "data_stream_detail_id"}
    assert all("might_contain" in p for k, p in seen), [k for k, p in seen if "might_contain" not in p]


def test_a_scope_of_all_sessions_reads_the_tables_whole(spark, large_scans):
    """All sessions, named one by one, get the plan of a run without a scope, and the same rows."""
    from mailtax.sources.standins import standin_tables

    t = standin_tables(spark, SF_DIR)
    every = scoped(spark, t, 1)
    assert not ln.is_few(t, every) and not ln.is_few(t, None)
    assert "might_contain" not in ln.linked_transactions(t, every)._jdf.queryExecution().optimizedPlan().toString()
    rows = lambda s: sorted(map(tuple, ln.non_service_line_items(t, sessions=s).collect()))
    assert rows(every) == rows(None)
    third = scoped(spark, t, 3)
    keys = {r["session_key"] for r in third.collect()}
    assert ln.is_few(t, third) and rows(third) == [r for r in rows(None) if r[1] in keys]


def test_bucketed_records_are_not_shuffled(spark, skewed):
    """The pieces' side has no exchange, every third detail shares one id and is broadcast its record, and the rows are the same."""
    t, count = skewed
    details = t["details"].withColumn("data_stream_detail_id", F.when(F.col("detail_key") % 3 == 0, "p0").otherwise(F.col("data_stream_detail_id")))
    t = {**t, "details": cut(details)}
    todo = cut(ln.non_service_lines(ln.covered_lines(t)))
    plain = cut(ql.match_pieces(t, todo))
    bucketed = ql.store_host_pieces(t, "host_pieces_of_plans", 32)
    try:
        found = ql.match_pieces(bucketed, todo, hot=1000)
        plan = plan_of(found)
        assert "SelectedBucketsCount" in plan and plan.count("Bucketed: true") >= 1 and "BroadcastHashJoin" in plan
        join = next(line for line in plan.splitlines() if "SortMergeJoin" in line or "ShuffledHashJoin" in line)
        below = plan[plan.index(join):].splitlines()
        depth = lambda line: len(line) - len(line.lstrip(" :|+-"))
        sides = [i for i, line in enumerate(below) if i and depth(line) == depth(below[1])][:2]
        right = []
        for line in below[sides[1]:]:
            if right and depth(line) <= depth(below[sides[1]]):
                break
            right.append(line)
        assert not any("Exchange" in line for line in right) and any("Bucketed: true" in line for line in right)
        found = cut(found)
        assert found.count() == plain.count() == count
        columns = [c for c in found.columns if not c.startswith("host")] + ["host1.city"]
        assert found.select(columns).exceptAll(plain.select(columns)).isEmpty()
    finally:
        spark.sql("DROP TABLE host_pieces_of_plans")
