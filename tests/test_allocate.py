from __future__ import annotations

import random
from datetime import datetime
from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from mailtax.functions.expressions import pro_rata_rate
from mailtax.operators import allocate as al

SCHEMA = (
    "sales_tax_batch_key bigint, session_key bigint, city string, state_region string, postal_code string, "
    "destination_code string, rate_type_key int, extended_amount decimal(19,4), unit_price decimal(19,4), "
    "is_exportable boolean, client_configuration_key bigint, quantity bigint"
)


def addresses(spark, batches):
    """``(amount, [(rate type, unit price, quantity), ...])`` per batch, addresses in order of the lines."""
    rows = []
    for key, (amount, lines) in enumerate(batches):
        for i, (kind, price, quantity) in enumerate(lines):
            rows.append((key, 1, "C", "S", f"{i:05d}", "D", kind, Decimal(amount), Decimal(price), True, 9, quantity))
    return spark.createDataFrame(rows, SCHEMA)


def rates(df):
    rows = df.orderBy("sales_tax_batch_key", "postal_code").collect()
    return [r["rate"] for r in rows]


@pytest.mark.parametrize(
    ("amount", "lines", "expected"),
    [
        ("150", [(6, "0", 7), (6, "0", 3), (6, "0", 2)], ["12.5", "12.5", "12.5"]),
        ("150", [(1, "12.5", 7), (1, "12.5", 3), (1, "12.5", 2)], ["12.5", "12.5", "12.5"]),
        ("6.03", [(1, "0.41", 7), (1, "0.45", 6), (1, "0.46", 1)], ["0.41", "0.45", "0.46"]),
        ("100", [(6, "0", 3), (6, "0", 3), (6, "0", 1)], ["14.286", "14.286", "14.284"]),
        ("10", [(None, "99", 3), (None, "99", 1)], ["2.5", "2.5"]),
        ("10", [(8, "99", 3), (8, "99", 1)], ["2.5", "2.5"]),
    ],
)
def test_worked_examples(spark, amount, lines, expected):
    assert rates(al.allocate(addresses(spark, [(amount, lines)]))) == [Decimal(x) for x in expected]


def test_tiered_example_adds_up(spark):
    df = al.allocate(addresses(spark, [("6.03", [(1, "0.41", 7), (1, "0.45", 6), (1, "0.46", 1)])]))
    assert df.agg(F.sum(F.col("rate") * F.col("quantity"))).first()[0] == Decimal("6.03")


def test_rate_is_rounded_to_eight_places_before_three(spark):
    # 0.0004999999|.. per piece: 0.0005 at eight places, hence 0.001 at three.
    row = spark.createDataFrame([(Decimal("4999.9999"), 10**7)], "a decimal(19,4), q bigint").select(
        pro_rata_rate(F.col("a"), F.col("q")).alias("r"), F.round(F.col("a") / F.col("q"), 3).alias("direct")
    ).first()
    assert row["r"] == Decimal("0.00050000")
    assert row["direct"] == 0
    assert Decimal(row["r"]).quantize(Decimal("0.001"), ROUND_HALF_UP) == Decimal("0.001")


def brute_force(batches):
    places = lambda x, n: x.quantize(Decimal(1).scaleb(-n), ROUND_HALF_UP)
    out = []
    for amount, lines in batches:
        total = sum(q for _, _, q in lines)
        mills = places(places(Decimal(amount) / total, 8), 3)
        for i, (kind, price, quantity) in enumerate(lines):
            if kind is not None and kind not in (6, 8):
                rate = Decimal(price)
            elif i == len(lines) - 1:
                given = sum(mills * q for _, _, q in lines[:-1])
                rate = places(places(places(Decimal(amount), 3) - given, 3) / quantity, 6)
            else:
                rate = mills
            out.append(rate)
    return out


def random_batches(count):
    pick = random.Random(7)
    return [
        (
            f"{pick.randrange(1, 10**8) / 10000:.4f}",
            [
                (pick.choice([6, 8, None, 1, 3]), f"{pick.randrange(0, 99999) / 100:.2f}", pick.randrange(1, 500))
                for _ in range(pick.randrange(1, 12))
            ],
        )
        for _ in range(count)
    ]


def test_random_batches_match_line_by_line_rule(spark):
    batches = random_batches(300)
    assert rates(al.allocate(addresses(spark, batches))) == brute_force(batches)


def test_fixed_batch_keeps_its_amount(spark):
    batches = [(a, [(6, "0", q) for _, _, q in lines]) for a, lines in random_batches(200)]
    given = al.allocate(addresses(spark, batches)).groupBy("sales_tax_batch_key").agg(
        F.sum(F.col("rate") * F.col("quantity")).alias("given")
    )
    for row in given.collect():
        amount, lines = batches[row["sales_tax_batch_key"]]
        target = Decimal(amount).quantize(Decimal("0.001"), ROUND_HALF_UP)
        assert abs(row["given"] - target) <= Decimal("0.0000005") * lines[-1][2]


def test_distribution_numbers_lines_and_repeats_the_rate(spark):
    batches = random_batches(100)
    rows = al.rate_distribution(addresses(spark, batches)).collect()
    by_batch = {}
    for r in rows:
        by_batch.setdefault(r["sales_tax_batch_key"], []).append(r)
    assert len(by_batch) == len(batches)
    for key, lines in by_batch.items():
        lines.sort(key=lambda r: r["line_number"])
        assert [r["line_number"] for r in lines] == list(range(1, len(lines) + 1))
        assert {r["lines_per_batch"] for r in lines} == {len(lines)}
        assert [r["postal_code"] for r in lines] == sorted(r["postal_code"] for r in lines)
        total = sum(r["quantity"] for r in lines)
        expected = (Decimal(batches[key][0]) / total).quantize(Decimal("1e-8"), ROUND_HALF_UP)
        assert {r["pro_rata_rate"] for r in lines} == {expected}


ZERO = [("1", [(6, "0", 1), (6, "0", 0)]), ("2", [(6, "0", 0)]), ("3", [(1, "5", 1), (1, "5", 0)])]


def test_zero_quantity_raises(spark):
    for batch in ZERO[:2]:
        with pytest.raises(PySparkException, match="zero"):
            al.allocate(addresses(spark, [batch])).collect()
    assert rates(al.allocate(addresses(spark, ZERO[2:]))) == [Decimal(5), Decimal(5)]


def test_zero_quantity_becomes_a_warning(spark):
    df = addresses(spark, ZERO)
    kept = al.allocate(df, on_zero="warn")
    assert {r[0] for r in kept.select("sales_tax_batch_key").collect()} == {2}
    warned = al.zero_quantity_warnings(df, as_of=datetime(2024, 1, 31), user="u")
    assert sorted(r[0] for r in warned.select("sales_tax_batch_key").collect()) == [0, 1]
    with pytest.raises(ValueError):
        al.allocate(df, on_zero="ignore")


def test_destination_and_export_flags(spark):
    codes = ["D", "F", "N", None]
    rows = [(k, 1, "C", "S", "1", c, 6, Decimal(1), Decimal(0), True, 9, 1) for k, c in enumerate(codes)]
    found = al.delivery_details(al.allocate(spark.createDataFrame(rows, SCHEMA)))
    flags = {r["sales_tax_batch_key"]: (r["is_foreign"], r["should_export"]) for r in found.collect()}
    assert flags == {0: (False, True), 1: (True, False), 2: (True, False), 3: (True, False)}


def test_only_fully_blank_addresses_are_filled(spark, billing):
    t = billing()
    rows = [(1, 9, "", "  ", None), (2, 9, None, None, None), (3, 9, "X", "", ""), (4, 8, "", "", "")]
    details = spark.createDataFrame(
        rows, "k bigint, client_configuration_key bigint, city string, region string, zip string"
    )
    found = {r["k"]: (r["city"], r["region"], r["zip"]) for r in al.fill_blank_addresses(t, details).collect()}
    home = ("HOME", "HS", "00009")
    assert found == {1: home, 2: home, 3: ("X", "", ""), 4: ("", "", "")}


def test_no_price_and_a_price_of_zero_stay_apart_and_cities_fold(billing, spark):
    """Two activities of a line, one with price NULL and one with 0, and a city in two spellings."""
    from mailtax.operators.allocate import batch_addresses, rate_distribution

    t = billing(
        activities=[{"invoice_line_item_key": 1, "category_key": k, "rate_model_key": k, "rate_key": 1,
                     "include_in_sales_tax_batch": True} for k in (1, 2)],
        rate_models=[{"rate_model_key": 1, "price": None}, {"rate_model_key": 2, "price": Decimal(0)}],
        rates=[{"rate_key": 1, "rate_type_key": 1}],
        taxable_line_items=[],
        details=[{"detail_key": k, "category_key": k, "transaction_guid": "g"} for k in (1, 2)],
        transactions=[{"transaction_guid": "g", "transaction_id": 1}],
        delivery_points=[{"transaction_guid": "g", "city": c, "state_region": "tx ", "postal_code": "1",
                          "destination_code": "D", "quantity": 2, "is_active": True} for c in ("AUSTIN", "Austin")],
    )
    lines = spark.createDataFrame(
        [(1, 1, 1, Decimal(10), False, 9, False)],
        "sales_tax_batch_key bigint, invoice_line_item_key bigint, session_key bigint, extended_amount decimal(19,4), "
        "is_exportable boolean, client_configuration_key bigint, use_customer_tax_address boolean",
    )
    found = rate_distribution(batch_addresses(t, lines)).orderBy("line_number").collect()
    assert [(r["city"], r["state_region"], r["quantity"], r["unit_price"]) for r in found] == [("AUSTIN", "TX", 4, 0)] * 2
    assert [(r["line_number"], r["lines_per_batch"]) for r in found] == [(1, 2), (2, 2)]
