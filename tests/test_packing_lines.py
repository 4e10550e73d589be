"""Line items are shuffled with their small values as one number; values that do not fit come back as they were."""

from __future__ import annotations

import random
from datetime import date

from pyspark.sql import functions as F

from mailtax.functions.expressions import packed_fields, unpacked_fields
from mailtax.sources.standins import LINE_BITS, packed_lines, unpacked_lines

SCHEMA = """l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_returnflag string,
    l_linestatus string, discounted boolean, l_shipdate date"""
PLAIN = (1, 2, 3, 4, 5.0, "A", "F", True, date(1996, 9, 13))
ODD = [
    (2, None, -1, 2**26 - 1, 2**26), (3, None, -1, 0, 15, 16), (4, None, -1.0, 0.5, 127.0, 128.0, float("nan"), float("inf")),
    (5, None, "", "a", "Z", "AB", "é", "A\n", "\0"), (6, None, "", "o", "AZ", "[", "@"), (7, None, False),
    (8, None, date(1969, 12, 31), date(1970, 1, 1), date(2059, 9, 18), date(2059, 9, 19), date(1, 1, 1)),
]


def test_lines_come_back_as_they_were(spark):
    rows = [PLAIN] + [(*PLAIN[:i], value, *PLAIN[i + 1:]) for i, *values in ODD for value in values]
    df = spark.createDataFrame(rows, SCHEMA)
    packed = packed_lines(df)
    assert packed.columns == ["l_orderkey", "l_partkey", "small", "whole"]
    back = unpacked_lines(packed, df.schema)
    assert [(f.name, f.dataType) for f in back.schema] == [(f.name, f.dataType) for f in df.schema]
    assert sorted(map(str, back.collect())) == sorted(map(str, df.collect()))
    assert packed.where("small is null").count() == packed.where("whole is not null").count() == 30
    assert sum(LINE_BITS.values()) <= 63


def test_fields_are_packed_one_to_one(spark):
    draw = random.Random(5)
    rows = [(draw.randrange(8), draw.randrange(2**40), draw.randrange(2**20)) for _ in range(500)] + [(7, 2**40 - 1, 2**20 - 1), (0, 0, 0)]
    bits = [3, 40, 20]
    df = spark.createDataFrame(rows, "a bigint, b bigint, c bigint")
    packed = df.select("*", packed_fields([(F.col(c), n) for c, n in zip("abc", bits, strict=True)]).alias("p"))
    back = packed.select(*unpacked_fields(F.col("p"), bits)).collect()
    assert [tuple(r) for r in back] == rows and packed.select("p").distinct().count() == len(set(rows))


def test_jobs_store_what_they_tell(spark, billing):
    """Quantities need no customer, and the columns of a status are the lines' own."""
    from mailtax.operators import lines as ln
    from mailtax.operators import qualify as ql
    from mailtax.plans.run import generate

    t = billing(
        line_items=[{"line_item_key": 1, "module": "a.LetterShop.LetterShopLineItemCalculator", "sales_tax_code_key": 1,
                     "use_customer_tax_address": False, "is_exportable": True}],
        invoice_line_items=[{"invoice_line_item_key": 3, "invoice_key": 10, "line_item_key": 1, "vendor_item_key": 8, "quantity": 2}],
        activities=[{"invoice_line_item_key": 3, "category_key": 5, "include_in_sales_tax_batch": True}],
        details=[{"detail_key": i, "category_key": 5, "data_stream_detail_id": f"p{i}"} for i in range(2)],
        host1_pieces=[{"data_stream_detail_id": "p0", "city": "A"}],
    )
    todo = ln.non_service_lines(ln.covered_lines(t))
    pieces = ql.match_pieces(t, todo)
    whole, short = ql.line_status(t, todo, pieces), ql.line_status(t, todo.drop("session_key"), pieces, warned=False)
    assert set(whole.columns) - set(short.columns) == {"session_key", "customer_id", "warning"}
    assert short.collect() == whole.select(short.columns).collect()
    assert ql.qualification_summary(t, short).collect() == ql.qualification_summary(t, whole).collect()
    made = generate(t, vendor_items=False)
    assert "vendor_item_key" not in made.invoiced.columns and "vendor_item_key" in generate(t).status.columns
    assert made.status.first()["warning"] == whole.first()["warning"]


def test_points_are_spelled_after_they_are_counted(spark, billing):
    from datetime import datetime

    from mailtax.operators import points as pt

    status = spark.createDataFrame([(3, 1, 7, None), (4, 2, 7, None)],
                                   "invoice_line_item_key bigint, host_system_id int, session_key bigint, warning string")
    pieces = spark.createDataFrame(
        [(3, ("a", "s ", None, None), None, 1, None), (3, ("A ", "S", None, None), None, 1, None), (4, None, ("b", "s", "1 ", True), None, 1)],
        """invoice_line_item_key bigint, host1 struct<city: string, state: string, zip: string, is_foreign: boolean>,
           host2 struct<city: string, state: string, zip: string, is_foreign: boolean>, quantity1 bigint, quantity2 bigint""",
    )
    counts = pt.point_counts(status, pieces)
    assert not {"transaction_guid", "tag", "user_added"} & set(counts.columns)
    points = {r["transaction_id"]: r for r in pt.delivery_points_of(counts, as_of=datetime(2024, 1, 31)).collect()}
    assert (points[-3]["city"], points[-3]["postal_code"], points[-3]["quantity"]) == ("A", None, 2)
    assert points[-4]["destination_code"] == "F" and points[-4]["user_added"].startswith("btdp-gen|7|2|4|" + points[-4]["transaction_guid"])
    assert points[-3]["delivery_point_id"] != points[-4]["delivery_point_id"]
    whole = pt.generate_delivery_points(status, pieces, as_of=datetime(2024, 1, 31))
    assert sorted(map(str, whole.collect())) == sorted(map(str, points.values()))
