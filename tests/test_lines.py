from __future__ import annotations

from conftest import AS_OF

from mailtax.functions.rules import POSTAGE
from mailtax.operators import lines as ln
from mailtax.operators import reports as rp

RUN = {"as_of": AS_OF, "user": "u"}


def world(billing, **more):
    """Lines 1..5: covered, half covered, uncovered, service without points, not flagged."""
    item = {"sales_tax_code_key": 1, "tax_category": "Print", "module": "x." + POSTAGE, "is_exportable": True}
    line = lambda k, i: {"invoice_line_item_key": k, "invoice_key": 10, "line_item_key": i,
                         "vendor_item_key": i, "group_key": f"g{k}", "quantity": k}
    act = lambda k, c, f=True: {"invoice_line_item_key": k, "category_key": c,
                                "include_in_sales_tax_batch": f}
    rows = {
        "line_items": [
            {"line_item_key": 1, "use_customer_tax_address": False, "vendor_item_key": 2, **item},
            {"line_item_key": 2, "use_customer_tax_address": True, "vendor_item_key": 1, **item},
        ],
        "invoice_line_items": [line(1, 1), line(2, 1), line(3, 1), line(4, 2), line(5, 1)],
        "activities": [act(1, 100), act(2, 100), act(2, 200), act(3, 300), act(3, None), act(4, 400),
                       act(5, 100, False), act(5, 200, None)],
        "details": [
            {"detail_key": 1, "category_key": 100, "transaction_guid": "t1", "data_stream_detail_id": "p1"},
            {"detail_key": 2, "category_key": 100, "transaction_guid": None, "data_stream_detail_id": "p2"},
            {"detail_key": 3, "category_key": 200, "transaction_guid": "t2", "data_stream_detail_id": "p3"},
            {"detail_key": 4, "category_key": 300, "transaction_guid": None, "data_stream_detail_id": None},
        ],
        "delivery_points": [
            {"delivery_point_id": "a", "transaction_guid": "t1", "quantity": 1, "is_active": True},
            {"delivery_point_id": "b", "transaction_guid": "t2", "quantity": 1, "is_active": False},
        ],
        "vendor_items": [{"vendor_item_key": 1, "vendor_item_name": "own"},
                         {"vendor_item_key": 2, "vendor_item_name": "catalogue"}],
        "activity_categories": [{"category_key": k} for k in (100, 200, 300, 400)],
        "host1_pieces": [{"data_stream_detail_id": "p1"}],
        "host2_pieces": [{"data_stream_detail_id": "p3"}],
    }
    return billing(**{**rows, **more})


def keys(df):
    return sorted(r["invoice_line_item_key"] for r in df.select("invoice_line_item_key").collect())


def test_taxable_lines_are_covered_or_service(billing):
    found = ln.taxable_line_items(world(billing), **RUN)
    assert keys(found) == [1, 2, 4]
    row = found.where("invoice_line_item_key = 1").first()
    assert (row["status_key"], row["tax_code"], row["user_added"], row["is_active"]) == (5, "P0", "u", True)
    again = ln.taxable_line_items(world(billing), **RUN)
    ids = lambda df: {r["sales_tax_batch_id"] for r in df.collect()}
    assert ids(found) == ids(again) and len(ids(found)) == 3


def test_unknown_status_gives_null(billing):
    t = world(billing, sales_tax_batch_statuses=[])
    assert {r["status_key"] for r in ln.taxable_line_items(t, **RUN).collect()} == {None}


def test_uncovered_is_per_activity(billing):
    assert keys(ln.non_service_line_items(world(billing))) == [2, 3]


def test_session_filter_by_key_and_id(billing, spark):
    t = world(billing)
    by_key = spark.createDataFrame([(1,)], "session_key bigint")
    by_id = spark.createDataFrame([("S1",)], "session_id string")
    other = spark.createDataFrame([(2,)], "session_key bigint")
    assert keys(ln.non_service_line_items(t, sessions=by_key)) == [2, 3]
    assert keys(ln.non_service_line_items(t, sessions=by_id)) == [2, 3]
    assert keys(ln.non_service_line_items(t, sessions=other)) == []


def test_unrestricted_batches_need_some_detail_anywhere(billing):
    assert keys(ln.session_line_item_batches(world(billing), **RUN)) == [1, 2, 3, 4]
    assert keys(ln.session_line_item_batches(world(billing), strict=True, **RUN)) == [1, 2, 3]
    assert keys(ln.session_line_item_batches(world(billing, details=[]), **RUN)) == []
    only_null = [{"invoice_line_item_key": 3, "category_key": None, "include_in_sales_tax_batch": True}]
    assert keys(ln.session_line_item_batches(world(billing, activities=only_null), **RUN)) == []
    assert keys(ln.session_line_item_batches(world(billing, client_configurations=[]), **RUN)) == []


def test_host_system(billing):
    t = world(billing)
    hosts = ln.infer_host_system(t, ln.session_lines(t))
    found = {r["invoice_line_item_key"]: r["host_system_id"] for r in hosts.collect()}
    assert found == {1: 1, 2: 1, 3: 0, 4: 0, 5: 1}


def test_lines_are_numbered_per_session(billing):
    batches = [{"activity_batch_key": 7, "activity_batch_id": "b7", "is_native_batch": False}]
    categories = [{"category_key": k, "activity_batch_key": 7} for k in (100, 200, 300, 400)]
    t = world(billing, activity_batches=batches, activity_categories=categories)
    found = ln.line_item_batches_by_module(t, ln.session_lines(t)).collect()
    assert {(r["invoice_line_item_key"], r["meta_group_key"]) for r in found} == {(k, k) for k in range(1, 6)}
    assert len(found) == 7


def test_vendor_item_from_line_or_catalogue(billing):
    t = world(billing)
    names = lambda df: [r["vendor_item_name"] for r in df.collect()]
    assert names(rp.non_service_lines_with_item(t)) == ["own", "own"]
    assert names(rp.non_service_lines_with_item(t, through_catalogue=True)) == ["catalogue", "catalogue"]
