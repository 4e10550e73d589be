"""What is shuffled and stored: ids as bytes, derived tables not twice, lines and host records not more often than needed."""

from __future__ import annotations

import time
from decimal import Decimal
from hashlib import md5
from uuid import UUID

import pytest
from pyspark.sql import functions as F

from mailtax.functions import staging
from mailtax.functions.expressions import packed_id, packed_key, packed_number, unpacked_id, uuid_from
from mailtax.functions.rules import INTERNATIONAL_POSTAGE_CANADA, LETTER_SHOP, POSTAGE, module_number, numbered_module
from mailtax.functions.staging import cut, cut_in_buckets
from mailtax.operators import allocate as al
from mailtax.operators import lines as ln
from mailtax.operators import qualify as ql
from mailtax.operators.checks import referential_checks
from mailtax.plans.queries import JOBS, _generated
from mailtax.plans.run import generate
from mailtax.sources.standins import standin_tables

SF_DIR = "/root/testdata/sf0.001"


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_ids_are_packed_one_to_one(spark):
    plain = "0123456789abcdef0123456789abcdef"
    hyphens = "01234567-89ab-cdef-0123-456789abcdef"
    texts = [
        plain, hyphens, plain.upper(), plain + "\n", plain[:-1], plain[:-1] + "g", hyphens + "\n", "0" * 31 + "-", "-" * 36,
        "0123456789ab-cdef-0123-4567-89abcdef", "", " ", "none 5", "a" * 16, "\0" * 18, "\0" * 16, "é", None,
    ]
    rows = spark.createDataFrame([(x,) for x in texts], "id string")
    found = rows.select("id", packed_id(F.col("id")).alias("p"), unpacked_id(packed_id(F.col("id"))).alias("back")).collect()
    assert [r["back"] for r in found] == [r["id"] for r in found]
    assert len({bytes(r["p"]) for r in found if r["p"] is not None}) == len(texts) - 1
    size = {r["id"]: len(r["p"]) for r in found if r["p"] is not None}
    assert size[plain] == 16 and size[hyphens] == 17
    numbers = spark.range(-2, 3).select(packed_number(F.col("id")).alias("p"))
    assert {len(r["p"]) for r in numbers.collect()} == {8}
    assert numbers.distinct().count() == 5 and numbers.where(unpacked_id(F.col("p")).isNotNull()).isEmpty()


def test_modules_are_numbered(spark):
    rows = spark.createDataFrame([(f"A.B.{LETTER_SHOP}",), (f"A.{POSTAGE}",), ("A.Unknown.Module",), (None,)], "m string")
    back = [r[0] for r in rows.select(numbered_module(module_number(F.col("m")))).collect()]
    assert back == [LETTER_SHOP, POSTAGE, None, None]


def test_stored_buckets_need_no_shuffle_and_leave_no_table(spark):
    before = {t.name for t in spark.catalog.listTables()}
    by_key, plain = cut_in_buckets(spark.range(100).select((F.col("id") % 10).alias("k"), "id"), "k")
    assert {t.name for t in spark.catalog.listTables()} == before
    assert "Exchange" not in plan_of(by_key.groupBy("k", "id").count())
    assert "Exchange" in plan_of(plain.groupBy("k", "id").count())
    assert by_key.exceptAll(plain).isEmpty() and by_key.count() == plain.count() == 100


def test_details_and_host_pieces_are_not_stored_again(spark):
    t = standin_tables(spark, SF_DIR)
    files = set(t["invoice_line_items"].inputFiles())
    stored = set(t["details"].inputFiles())
    assert stored and not stored & files
    for name in ("host1_pieces", "host2_pieces", "delivery_points", "return_details"):
        assert stored <= set(t[name].inputFiles()), name


def test_lines_are_grouped_by_invoice_without_a_shuffle(spark):
    t = standin_tables(spark, SF_DIR)
    assert "Exchange" not in plan_of(t["invoice_line_items"].groupBy("invoice_key").count())


def test_status_reads_stored_lines_without_a_shuffle(spark):
    """With large tables the pieces are shuffled to the lines, not the lines to the pieces, and no line to its customer."""
    old = {k: spark.conf.get(k, None) for k in ("spark.sql.autoBroadcastJoinThreshold",)}
    t = standin_tables(spark, SF_DIR)
    made = generate(t)
    assert not {"rate", "extended_amount", "group_key"} & set(made.invoiced.columns)
    assert "customer_id" in made.invoiced.columns
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        todo = ln.non_service_lines(made.invoiced.withColumns(
            {"module": F.lit("x"), "use_customer_tax_address": F.lit(False)}))
        status = ql.line_status(t, todo, made.pieces).select("invoice_line_item_key", "calculated_quantity", "customer_id")
        assert plan_of(status).count("Exchange") == 1
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_records_are_shuffled_once_and_not_stored(spark, billing):
    t = billing()
    todo = ln.non_service_lines(ln.covered_lines(t))
    plan = plan_of(ql.match_pieces(t, todo))
    assert "FullOuter" not in plan


def test_records_of_an_id_that_many_details_share(spark, billing):
    """The hot id's rows are the same as without the separate join, also where a host knows it twice."""
    details = [{"detail_key": i, "category_key": 5, "data_stream_detail_id": "hot" if i < 40 else (None if i % 3 == 0 else f"p{i}")}
               for i in range(60)]
    t = billing(
        line_items=[{"line_item_key": 1, "module": "a." + LETTER_SHOP, "sales_tax_code_key": 1,
                     "use_customer_tax_address": False, "is_exportable": True}],
        invoice_line_items=[{"invoice_line_item_key": 3, "invoice_key": 10, "line_item_key": 1, "quantity": 60}],
        activities=[{"invoice_line_item_key": 3, "category_key": 5, "include_in_sales_tax_batch": True}],
        details=details,
        host1_pieces=[{"data_stream_detail_id": "hot", "city": "A"}, {"data_stream_detail_id": "hot", "city": "B"},
                      {"data_stream_detail_id": "p41", "city": "C"}],
        host2_pieces=[{"data_stream_detail_id": "hot", "city": "D"}, {"data_stream_detail_id": "p41", "city": "E"}],
    )
    todo = cut(ln.non_service_lines(ln.covered_lines(t)))
    assert ql._shared_ids(t["details"], 39) == ["hot"] and ql._shared_ids(t["details"], 40) == []
    columns = ["detail_key", "data_stream_detail_id", "host1.city", "host2.city", "quantity1", "quantity2"]
    apart, together = (sorted(map(str, ql.match_pieces(t, todo, hot=h).select(columns).collect())) for h in (39, 40))
    assert apart == together and len(apart) == 40 * 2 + 20


def _world(billing):
    """Two lines; host 1 knows one id twice, both hosts know another; a foreign piece to Canada in odd spelling."""
    modules = {1: LETTER_SHOP, 2: INTERNATIONAL_POSTAGE_CANADA}
    return billing(
        line_items=[{"line_item_key": k, "module": "a." + m, "sales_tax_code_key": 1, "use_customer_tax_address": False,
                     "is_exportable": True} for k, m in modules.items()],
        invoice_line_items=[{"invoice_line_item_key": k + 2, "invoice_key": 10, "line_item_key": k, "quantity": 4} for k in modules],
        activities=[{"invoice_line_item_key": k + 2, "category_key": k, "include_in_sales_tax_batch": True} for k in modules],
        details=[{"detail_key": 10 * k + i, "category_key": k, "data_stream_detail_id": x}
                 for k in modules for i, x in enumerate(["a", "b", "c", "0123456789abcdef0123456789abcdef", None])],
        host1_pieces=[{"data_stream_detail_id": "a", "city": "A", "country": "canada ", "is_foreign": True},
                      {"data_stream_detail_id": "a", "city": "B", "country": "CANADA", "is_foreign": False},
                      {"data_stream_detail_id": "b", "city": "C", "country": "Cuba", "is_foreign": True}],
        host2_pieces=[{"data_stream_detail_id": "b", "city": "D"},
                      {"data_stream_detail_id": "0123456789abcdef0123456789abcdef", "city": "E", "page_count": 3, "paper_page_count": 2}],
    )


def _rows(df):
    return sorted(map(str, df.collect()))


def test_jobs_that_tell_no_address_shuffle_none(spark, billing):
    t = standin_tables(spark, SF_DIR)
    assert "city" not in plan_of(JOBS["reconcile_quantity"](t)) and "city" in plan_of(ql.match_pieces(t, cut(ln.non_service_lines(ln.covered_lines(t)))))
    t = _world(billing)
    todo = cut(ln.non_service_lines(ln.covered_lines(t)))
    whole, short = (ql.match_pieces(t, todo, places=p) for p in (True, False))
    assert short.schema["host1"].dataType.names == ["country", "is_foreign", "is_force_mailed", "is_active"]
    columns = ["invoice_line_item_key", "detail_key", "data_stream_detail_id", "quantity1", "quantity2"]
    flags = [F.col("host1").isNull(), F.col("host2").isNull()]
    assert _rows(whole.select(*columns, *flags)) == _rows(short.select(*columns, *flags))
    status = [ql.line_status(t, todo, p) for p in (whole, short)]
    assert _rows(status[0]) == _rows(status[1]) and status[1].agg(F.sum("calculated_quantity")).first()[0] == 6 + 1


def test_stored_records_are_one_row_for_each_of_the_hosts(spark, billing):
    t = _world(billing)
    todo = cut(ln.non_service_lines(ln.covered_lines(t)))
    bucketed = ql.store_host_pieces(t, "host_pieces_of_shuffles", 4)
    try:
        stored = bucketed[ql.HOST_PIECES]
        assert stored.count() == 3 + 2 and stored.where("host1 is not null and host2 is not null").isEmpty()
        columns = ["detail_key", "data_stream_detail_id", "host1.city", "host2.city", "quantity1", "quantity2"]
        for hot in (1, 100):  # with and without ids whose records are broadcast
            assert _rows(ql.match_pieces(bucketed, todo, hot=hot).select(columns)) == _rows(ql.match_pieces(t, todo).select(columns))
    finally:
        spark.sql("DROP TABLE host_pieces_of_shuffles")


def test_generation_stores_what_its_job_tells(spark):
    t = standin_tables(spark, SF_DIR)
    assert "detail_key" not in generate(t, detail_keys=False).pieces.columns
    made = generate(t, places=False)
    assert "city" not in made.pieces.schema["host1"].dataType.names and "detail_key" in made.pieces.columns
    assert _rows(made.status) == _rows(generate(t).status)


def test_checks_shuffle_ids_as_bytes(billing):
    t = {name: cut(rows) if name in ("details", "host1_pieces") else rows for name, rows in _world(billing).items()}
    found = referential_checks(
        t, primary_keys={"details": "data_stream_detail_id"}, not_null={}, defaults={},
        foreign_keys=[("details", "data_stream_detail_id", "host1_pieces", "data_stream_detail_id"), ("details", "category_key", "activities", "category_key")],
    )
    assert "unhex" in plan_of(found)
    assert [r["violations"] for r in found.collect()] == [5, 4, 0]


def test_an_id_names_its_digest_once(spark):
    rows = spark.createDataFrame([("a", 1), (None, 2)], "x string, k int").select("k", uuid_from(F.lit("p"), "x", "k").alias("id"))
    assert plan_of(rows).count("md5(") == 1
    assert [r["id"] for r in rows.sort("k").collect()] == [str(UUID(md5(b).hexdigest())) for b in (b"p|a|1", b"p||2")]


def test_keys_of_ids_are_never_null(spark):
    texts = spark.createDataFrame([("0123456789abcdef" * 2,), ("",), (None,)], "id string")
    key = texts.select("id", packed_id(F.col("id")).alias("p"), packed_key(F.col("id")).alias("key"))
    assert not key.schema["key"].nullable
    for row in key.collect():
        assert bytes(row["key"]) == (b"" if row["id"] is None else bytes(row["p"])) and bool(row["key"]) == (row["id"] is not None)


@pytest.mark.parametrize("bridge", al.BRIDGES)
def test_no_filter_spells_and_packs_an_id(spark, bridge):
    """A filter on a key that may be NULL would repeat the whole id as often as the key names it."""
    after, lines = _generated(standin_tables(spark, SF_DIR))
    filters = [x for x in plan_of(al.batch_addresses(after, lines, bridge=bridge)).splitlines() if "Filter (" in x]
    assert filters and not any("unhex" in x for x in filters)


def test_no_filter_packs_the_ids_of_records(spark):
    t = standin_tables(spark, SF_DIR)
    lines = ln.covered_lines(t)
    filters = [x for x in plan_of(ql.match_pieces(t, lines, places=False)).splitlines() if "Filter (" in x]
    assert filters and not any("unhex" in x for x in filters)


@pytest.mark.parametrize("bridge", ["taxable_line_item", "details"])
def test_rows_without_a_transaction_meet_no_point(spark, billing, bridge):
    guids = [None, "", "g"]
    t = billing(
        activities=[{"invoice_line_item_key": 1, "category_key": 1, "rate_model_key": 1, "rate_key": 1, "include_in_sales_tax_batch": True}],
        rate_models=[{"rate_model_key": 1, "price": Decimal("1")}],
        rates=[{"rate_key": 1, "rate_type_key": 1}],
        details=[{"detail_key": i, "category_key": 1, "transaction_guid": g} for i, g in enumerate(guids)],
        taxable_line_items=[
            {"invoice_line_item_key": 1, "session_key": 1, "transaction_guid": g, "host_system_id": 1, "ignore": False} for g in guids
        ],
        delivery_points=[
            {"delivery_point_id": f"p{i}", "transaction_guid": g, "city": f"C{i}", "quantity": 1, "is_active": True}
            for i, g in enumerate([*guids, None])
        ],
    )
    lines = spark.createDataFrame(
        [(1, 1, 1, Decimal("5"), True, 9, False)],
        "sales_tax_batch_key bigint, invoice_line_item_key bigint, session_key bigint, extended_amount decimal(19,4), "
        "is_exportable boolean, client_configuration_key bigint, use_customer_tax_address boolean",
    )
    assert sorted(r["city"] for r in al.batch_addresses(t, lines, bridge=bridge).collect()) == ["C1", "C2"]
    assert [r[0] for r in ln.covered_categories(t, ln.category_transactions(t)).collect()] == [1]


def test_a_long_job_leaves_no_shuffle_files(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(staging, "LONG", 0)
    manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffled() -> set[str]:
        return {x for x in manager.getAllFiles().mkString("\n").splitlines() if "/shuffle_" in x}

    before = shuffled()
    spark.range(1000).repartition(7, "id").write.parquet(f"{tmp_path}/plain")
    assert shuffled() - before, "a job leaves its files until the driver collects garbage"
    stored, (by_key, _) = cut(spark.range(1000).repartition(7, "id")), cut_in_buckets(spark.range(1000), "id")
    end = time.monotonic() + 20
    while shuffled() - before and time.monotonic() < end:
        time.sleep(0.2)
    assert not shuffled() - before
    assert stored.count() == by_key.count() == 1000
