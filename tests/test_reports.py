from __future__ import annotations

from conftest import AS_OF

from mailtax.operators import reports as rp
from mailtax.operators.checks import referential_checks
from mailtax.operators.lines import host_of_batches, session_line_item_batches


def test_returns_and_updates_are_counted_per_shared_category(billing, spark):
    t = billing(
        invoice_line_items=[{"invoice_line_item_key": k} for k in (1, 2)],
        activities=[{"invoice_line_item_key": k, "category_key": 5} for k in (1, 2)],
        details=[{"detail_key": n, "category_key": 5, "return_detail_id": r}
                 for n, r in enumerate(["a", "a", "b", "c", None])],
        return_details=[{"return_detail_id": x, "return_reason_id": y} for x, y in (("a", "r"), ("b", "u"), ("c", "n"))],
        return_reasons=[
            {"return_reason_id": "r", "is_returned": True, "is_updated": False},
            {"return_reason_id": "u", "is_returned": False, "is_updated": True},
            {"return_reason_id": "n", "is_returned": None, "is_updated": False},
        ],
    )
    found = {tuple(r) for r in rp.return_update_counts(t).collect()}
    assert found == {(1, 2, 1), (2, 2, 1)}
    one = spark.createDataFrame([(2,)], "invoice_line_item_key bigint")
    assert [tuple(r) for r in rp.return_update_counts(t, one).collect()] == [(2, 2, 1)]
    assert rp.line_item_details(t, one).count() == 5


def test_transactions_of_one_line(billing, spark):
    t = billing(
        invoice_line_items=[{"invoice_line_item_key": k} for k in (1, 2)],
        activities=[{"invoice_line_item_key": k, "category_key": k} for k in (1, 2)],
        details=[{"detail_key": n, "category_key": c, "transaction_guid": g}
                 for n, (c, g) in enumerate([(1, "x"), (1, "x"), (1, None), (2, "y")])],
        transactions=[{"transaction_id": n, "transaction_guid": g} for n, g in enumerate(["x", "y", "z"])],
    )
    one = spark.createDataFrame([(1,)], "invoice_line_item_key bigint")
    assert [r["transaction_guid"] for r in rp.transactions_for_line(t, one).collect()] == ["x"]
    assert rp.transactions_for_line(t).count() == 2


def test_category_totals_of_stored_headers(billing, table):
    """The two literal headers of a return service, with two activities on one of them."""
    headers = table("sales_tax_batches", [
        {"invoice_line_item_key": k, "status_key": 1, "group_key": "ReturnLogic", "line_item_key": i,
         "tax_code": "SD020900", "tax_category": "Service"} for k, i in ((3111643, 29), (3111642, 32))
    ])
    t = billing(
        invoice_line_items=[{"invoice_line_item_key": k, "line_item_key": i} for k, i in ((3111643, 29), (3111642, 32))],
        line_items=[{"line_item_key": i, "module": f"m{i}"} for i in (29, 32)],
        activities=[{"invoice_line_item_key": k, "category_key": c, "client_line_item_key": i}
                    for k, c, i in ((3111643, 1, 29), (3111643, 2, 29), (3111642, 3, 32), (3111642, 1, 29))],
        client_line_items=[{"client_line_item_key": i, "line_item_key": i} for i in (29, 32)],
        activity_categories=[{"category_key": c, "batch_total": 10 * c, "total_suppressed": c, "total_updated": 0,
                              "total_returned": 1} for c in (1, 2, 3)],
    )
    found = [(r["invoice_line_item_key"], r["module"], r["batch_total"], r["total_suppressed"], r["total_returned"])
             for r in rp.category_totals(t, headers).collect()]
    assert found == [(3111642, "m32", 30, 3, 1), (3111643, "m29", 30, 3, 2)]


def test_host_of_batches_by_user(billing):
    t = billing(activity_batches=[
        {"activity_batch_key": 1, "user_added": "a", "is_native_batch": False},
        {"activity_batch_key": 2, "user_added": "b", "is_native_batch": False},
        {"activity_batch_key": 3, "user_added": "c", "is_native_batch": False},
        {"activity_batch_key": 4, "user_added": "a", "is_native_batch": True},
    ])
    found = {tuple(r) for r in host_of_batches(t, {"a": 1, "b": 2}).collect()}
    assert found == {(1, 1), (2, 2), (3, 0)}


def test_checks_find_every_kind_of_violation(billing, table):
    links = table("session_line_links", [
        {"session_line_id": "a", "session_key": 1, "invoice_line_item_key": 1, "line_item_key": 1, "host_system_id": 0},
        {"session_line_id": "a", "session_key": 8, "invoice_line_item_key": 1, "line_item_key": 1, "host_system_id": 1},
        {"session_line_id": "a", "session_key": 8, "invoice_line_item_key": 2, "line_item_key": None,
         "host_system_id": None},
    ])
    t = billing(invoice_line_items=[{"invoice_line_item_key": 1}], line_items=[{"line_item_key": 1}])
    t["session_line_links"] = links
    rows = referential_checks(t).where("table_name = 'session_line_links' AND violations > 0").collect()
    assert {(r["check_name"], r["key_name"], r["violations"]) for r in rows} == {
        ("primary_key", "session_line_id", 2),
        ("foreign_key", "session_key -> sessions.session_key", 2),
        ("foreign_key", "invoice_line_item_key -> invoice_line_items.invoice_line_item_key", 1),
        ("not_null", "line_item_key", 1),
        ("not_null", "host_system_id", 1),
        ("default", "host_system_id", 1),
    }
    assert referential_checks(t).count() == 2 + 7 + 7 + 5 + 2


def test_header_columns_of_empty_world(billing):
    assert session_line_item_batches(billing(), as_of=AS_OF, user="u").count() == 0
