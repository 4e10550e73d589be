"""The qualification rules, reconciliation, and everything generated from them."""

from __future__ import annotations

import pytest
from conftest import AS_OF
from pyspark.sql import functions as F

from mailtax.functions import rules as r
from mailtax.operators import allocate as al
from mailtax.operators import lines as ln
from mailtax.operators import points as pt
from mailtax.operators import qualify as ql

RUN = {"as_of": AS_OF, "user": "u"}
UNKNOWN = "Other.NoSuchCalculator"
MODULES = [*r.TYPE_GUID, UNKNOWN]

# Pieces of either host, as (foreign, country, force mail, active) and (pages, sheets, force mail, foreign).
HOST1 = [
    (True, "canada ", True, True),
    (True, "FRANCE", False, False),
    (False, "USA", None, None),
    (None, "CANADA", True, True),
]
HOST2 = [(1, 1, False, False), (2, 1, True, True), (3, 2, True, None), (6, 3, None, False), (None, None, None, None)]

ALL = "all"
# Quantity per piece by module: the expected values, spelled out.
EXPECTED1 = {
    r.LETTER_SHOP: ALL, r.ADDITIONAL_POSTAGE: ALL, r.INSERTS: ALL, r.ADDITIONAL_PAGES: ALL, r.DUPLEX: ALL,
    r.POSTAGE: [1, None, None, 1],
    r.INTERNATIONAL_POSTAGE: [1, 1, None, None],
    r.ADDITIONAL_POSTAGE_INTERNATIONAL: [1, 1, None, None],
    r.INTERNATIONAL_POSTAGE_CANADA: [1, None, None, None],
    r.FORCE_MAIL_POSTAGE: [1, None, None, 1],
    r.FORCE_MAIL_SPECIAL_HANDLING: [1, None, None, 1],
    UNKNOWN: [None] * 4,
}
EXPECTED2 = {
    r.LETTER_SHOP: ALL, r.ADDITIONAL_POSTAGE: ALL, r.INSERTS: ALL, r.POSTAGE: ALL,
    r.ADDITIONAL_PAGES: [None, 0, 1, 2, None],
    r.DUPLEX: [None, 1, 1, 3, None],
    r.INTERNATIONAL_POSTAGE: [None] * 5,
    r.ADDITIONAL_POSTAGE_INTERNATIONAL: [None] * 5,
    r.INTERNATIONAL_POSTAGE_CANADA: [None] * 5,
    r.FORCE_MAIL_POSTAGE: [None, 1, 1, None, None],
    r.FORCE_MAIL_SPECIAL_HANDLING: [None, 1, 1, None, None],
    UNKNOWN: [None] * 5,
}


def line_key(host, module):
    return host * 100 + MODULES.index(module)


@pytest.fixture
def matrix(billing):
    """One line per host and module, each with all pieces of its host and one detail without a piece."""
    lines, acts, details = [], [], []
    for host, pieces in ((1, HOST1), (2, HOST2)):
        for module in MODULES:
            key = line_key(host, module)
            lines.append({"invoice_line_item_key": key, "invoice_key": 10, "quantity": len(pieces) + 1,
                          "line_item_key": MODULES.index(module), "vendor_item_key": 1})
            acts.append({"invoice_line_item_key": key, "category_key": key, "include_in_sales_tax_batch": True})
            for n in range(len(pieces) + 1):
                known = n < len(pieces)
                details.append({"detail_key": key * 10 + n, "category_key": key,
                                "data_stream_detail_id": f"h{host}-{n}" if known else None})
    item = {"sales_tax_code_key": 1, "use_customer_tax_address": False, "is_exportable": True}
    return billing(
        line_items=[{"line_item_key": i, "module": "Billing." + m, **item} for i, m in enumerate(MODULES)],
        invoice_line_items=lines,
        activities=acts,
        details=details,
        activity_categories=[{"category_key": a["category_key"]} for a in acts],
        host1_pieces=[
            {"data_stream_detail_id": f"h1-{n}", "city": "Town" if n % 2 else "TOWN ", "state": "st", "zip": "1",
             "is_foreign": a, "country": b, "is_force_mailed": c, "is_active": d}
            for n, (a, b, c, d) in enumerate(HOST1)
        ],
        host2_pieces=[
            {"data_stream_detail_id": f"h2-{n}", "city": "Burg", "state": "st", "zip": "2",
             "page_count": a, "paper_page_count": b, "is_force_mailed": c, "is_foreign": d}
            for n, (a, b, c, d) in enumerate(HOST2)
        ],
        transaction_types=[
            {"transaction_type_id": i, "transaction_type_guid": g.upper()}
            for i, g in enumerate(sorted(set(r.TYPE_GUID.values())))
        ],
        vendor_items=[{"vendor_item_key": 1, "vendor_item_name": "Item"}],
    )


@pytest.fixture
def stages(matrix):
    todo = ln.non_service_lines(ln.covered_lines(matrix))
    pieces = ql.match_pieces(matrix, todo)
    return todo, pieces, ql.line_status(matrix, todo, pieces)


def expected_quantities(host, module):
    wanted = (EXPECTED1 if host == 1 else EXPECTED2)[module]
    size = len(HOST1 if host == 1 else HOST2)
    return [1] * (size + 1) if wanted == ALL else [*wanted, None]


def test_rule_matrix(stages):
    todo, pieces, _ = stages
    found = {row["detail_key"]: row["quantity"] for row in ql.qualify_details(todo, pieces).collect()}
    for host in (1, 2):
        for module in MODULES:
            key = line_key(host, module)
            wanted = expected_quantities(host, module)
            assert [found.get(key * 10 + n) for n in range(len(wanted))] == wanted, (host, module)


def test_reconciliation_and_first_warning(stages):
    _, _, status = stages
    rows = {row["invoice_line_item_key"]: row for row in status.collect()}
    for host in (1, 2):
        for module in MODULES:
            row = rows[line_key(host, module)]
            wanted = [q for q in expected_quantities(host, module) if q is not None]
            total = sum(wanted) if wanted else None
            invoiced = len(HOST1 if host == 1 else HOST2) + 1
            assert row["host_system_id"] == host
            assert row["calculated_quantity"] == total
            assert row["is_match"] == (total == invoiced)
            assert row["detail_count"] == len(wanted)
            if module == UNKNOWN:
                text = f"Cannot match line item calculator module Billing.{module} to a billing transaction type guid."
            elif host == 2 and module in (r.INTERNATIONAL_POSTAGE, r.INTERNATIONAL_POSTAGE_CANADA,
                                          r.ADDITIONAL_POSTAGE_INTERNATIONAL):
                text = (f"No btdpd-generation line item calculator module match found for Billing.{module} "
                        "with host system id 2")
            elif total != invoiced:
                shown = "NULL" if total is None else total
                text = f"Calculated quantity ({shown}) does not match invoiced quantity ({invoiced})"
            else:
                text = None
            assert row["warning"] == text, (host, module)


def test_customer_host_and_type_failures_come_first(matrix):
    def warnings(**changed):
        t = {**matrix, **changed}
        todo = ln.non_service_lines(ln.covered_lines(t))
        return {x["warning"] for x in ql.line_status(t, todo).collect()}

    none = lambda name: matrix[name].limit(0)
    assert warnings(customers=none("customers")) == {"Customer id could not be identified."}
    unknown = warnings(host1_pieces=none("host1_pieces"), host2_pieces=none("host2_pieces"))
    assert unknown == {"Line item host system could not be identified for delivery point data generation."}
    missing = warnings(transaction_types=none("transaction_types"))
    assert all(w.startswith("Cannot ") for w in missing) and len(missing) == 10


def test_account_codes_ignore_case_and_trailing_spaces(matrix, table):
    t = {**matrix, "customers": table("customers", [{"customer_id": 78, "account": "a9 "}])}
    assert [r["customer_id"] for r in ql.session_customers(t).collect()] == [78]


def test_unknown_hosts_are_silent_by_default(matrix):
    t = {**matrix, "host1_pieces": matrix["host1_pieces"].limit(0)}
    status = ql.line_status(t, ln.non_service_lines(ln.covered_lines(t)))
    hosts = status.where("host_system_id = 0").count()
    assert hosts == len(MODULES)
    told = pt.invoice_warnings(status, **RUN).count()
    assert pt.invoice_warnings(status, include_unknown_host=True, **RUN).count() == told + hosts


def test_accepted_and_rejected_split_all_lines(stages):
    _, _, status = stages
    made = pt.generate_billing_transactions(status, as_of=AS_OF)
    rejected = pt.invoice_warnings(status, **RUN)
    assert made.count() + rejected.count() == status.count()
    row = made.orderBy(F.desc("transaction_id")).first()
    assert (row["transaction_status_id"], row["location_id"], row["customer_id"]) == (3, 4, 77)
    assert row["transaction_id"] < 0 and row["quantity"] == len(HOST1) + 1


def test_points_group_addresses_and_keep_the_raw_flag(stages):
    _, pieces, status = stages
    points = pt.generate_delivery_points(status, pieces, as_of=AS_OF)
    line = line_key(1, r.LETTER_SHOP)
    rows = points.where(F.col("transaction_id") == -line).collect()
    found = sorted((x["city"], x["state_region"], x["postal_code"], x["destination_code"], x["quantity"]) for x in rows)
    # Two foreign pieces in two spellings; one domestic piece with a false and one with a NULL flag.
    assert found == [("TOWN", "ST", "1", "D", 1), ("TOWN", "ST", "1", "D", 1), ("TOWN", "ST", "1", "F", 2)]
    assert len({x["delivery_point_id"] for x in rows}) == 3


def test_links_and_last_line_wins(stages):
    _, pieces, status = stages
    links = pt.link_details_to_transactions(status, pieces)
    assert links.count() == pt.accepted(status).agg(F.sum("detail_count")).first()[0]
    assert links.select("category_detail_id").distinct().count() == links.count()


def test_shared_category(billing, matrix, table):
    """Two lines share a category: one link per line, and only the larger key with ``last_wins``."""
    low, high = line_key(1, r.LETTER_SHOP), line_key(1, r.INSERTS)
    low, high = sorted((low, high))
    acts = [{"invoice_line_item_key": k, "category_key": low, "include_in_sales_tax_batch": True} for k in (low, high)]
    t = {**matrix, "activities": table("activities", acts)}
    todo = ln.non_service_lines(ln.covered_lines(t))
    pieces = ql.match_pieces(t, todo)
    status = ql.line_status(t, todo, pieces)
    both = pt.link_details_to_transactions(status, pieces).collect()
    assert len(both) == 2 * (len(HOST1) + 1)
    last = pt.link_details_to_transactions(status, pieces, last_wins=True).collect()
    assert len(last) == len(HOST1) + 1
    assert {x["invoice_line_item_key"] for x in last} == {high}
    assert {x["transaction_guid"] for x in last} < {x["transaction_guid"] for x in both}


def test_summary_and_details_of_mismatches(matrix, stages):
    _, pieces, status = stages
    names = {1: "first", 2: "second"}
    rows = ql.qualification_summary(matrix, status, host_names=names).collect()
    assert {x["host"] for x in rows} == {"first", "second"} and {x["item"] for x in rows} == {"Item"}
    bad = ql.qualification_summary(matrix, status, only_mismatched=True)
    assert bad.count() == status.where(~F.col("is_match")).count()
    details = ql.mismatched_details(matrix, status, pieces)
    line = line_key(2, r.DUPLEX)
    found = details.where(F.col("invoice_line_item_key") == line).orderBy("detail_key").collect()
    assert [(x["page_count"], x["quantity"]) for x in found] == [(2, 1), (3, 1), (6, 3)]


def test_generated_points_are_not_multiplied_by_details(matrix, stages, table):
    """Over the details N details of one transaction count N times; over the line they count once."""
    _, pieces, status = stages
    line = line_key(1, r.LETTER_SHOP)
    points = pt.generate_delivery_points(status, pieces, as_of=AS_OF)
    links = pt.link_details_to_transactions(status, pieces).select("detail_key", "transaction_guid")
    stamped = matrix["details"].drop("transaction_guid").join(links, "detail_key", "left")
    act = [{"invoice_line_item_key": line, "category_key": line, "include_in_sales_tax_batch": True,
            "rate_model_key": 1, "rate_key": 1}]
    t = {
        **matrix,
        "activities": table("activities", act),
        "rate_models": table("rate_models", [{"rate_model_key": 1}]),
        "rates": table("rates", [{"rate_key": 1, "rate_type_key": 6}]),
        "details": stamped,
        "delivery_points": points,
        "transactions": pt.generate_billing_transactions(status, as_of=AS_OF),
        "taxable_line_items": pt.taxable_line_items_of(pt.session_line_links(status)),
    }
    lines = ln.taxable_lines(ln.covered_lines(t))
    total = lambda bridge: al.batch_addresses(t, lines, bridge=bridge).agg(F.sum("quantity")).first()[0]
    pieces_of_line = len(HOST1)
    assert total("taxable_line_item") == pieces_of_line
    assert total("provenance_tag") == pieces_of_line
    assert total("details") == pieces_of_line * (len(HOST1) + 1)
    with pytest.raises(ValueError):
        al.batch_addresses(t, lines, bridge="other")
