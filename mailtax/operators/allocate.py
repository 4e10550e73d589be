"""Spread invoiced amounts over delivery addresses and build the final tax detail rows."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mailtax.functions.expressions import RATE_TYPE, blank, folded, nonzero, packed_key, pro_rata_rate, uuid_from
from mailtax.functions.numbering import number_within
from mailtax.functions.rules import FIXED_RATE_TYPES, HOST1, HOST2
from mailtax.functions.staging import cut
from mailtax.operators.lines import Tables, audit, category_transactions, flagged_activities

ADDRESS = ["city", "state_region", "postal_code"]
HOME = ["taxable_city", "taxable_state", "taxable_postal_code", "has_home"]
# Lines of a batch are ordered by postal code; the other columns make the order total.
ORDER = ["postal_code", "city", "state_region", "destination_code", "rate_type_key", "unit_price"]
# Why the amount of a batch cannot be spread.
LOST = "quantity of a batch is out of range"
NO_PIECES = "total quantity of a batch is zero"
EMPTY_LAST = "quantity of the last address of a batch is zero"
BRIDGES = ("details", "taxable_line_item", "provenance_tag")


def batch_addresses(
    t: Tables,
    lines: DataFrame,
    *,
    bridge: str = "details",
    linked: DataFrame | None = None,
    tag_prefix: str = "btdp-gen",
    flag_overflow: bool = False,
) -> DataFrame:
    """Quantity per batch, address and rate: delivery points reached through one of three bridges.

    ``lines`` are ``taxable_lines`` or ``lines_of_batches``. The bridges:

    ``details``            activity -> details -> transaction, the way of native data. A transaction shared
                           by N details of a category counts N times.
    ``taxable_line_item``  line -> its generated transaction (``taxable_line_items`` table).
    ``provenance_tag``     line -> its generated transaction, read from the tag of the transaction.

    ``linked`` are stored ``linked_transactions`` for the first of them. A quantity beyond 64 bits raises or, with
    ``flag_overflow``, is NULL and its row marked in the column ``out_of_range``.
    """
    if bridge not in BRIDGES:
        raise ValueError(f"bridge must be one of {BRIDGES}, not {bridge!r}")
    rated = _rated_activities(t, lines)
    places = [folded(F.col(c)).alias(c) for c in (*ADDRESS, "destination_code")]  # one spelling, as generated points have
    guid = packed_key(F.col("transaction_guid")).alias("packed")  # before the joins: they shuffle it
    known = F.col("transaction_guid").isNotNull()
    points = t["delivery_points"].where(F.col("is_active") & known).select(guid, *places, "quantity")
    times = F.lit(1)
    if bridge == "details":
        linked = category_transactions(t) if linked is None else linked
        reached = rated.join(linked.select("category_key", guid, "detail_count"), "category_key")
        times = F.col("detail_count")
    elif bridge == "taxable_line_item":
        own = t["taxable_line_items"].where(
            F.col("host_system_id").isin(HOST1, HOST2) & (F.col("ignore") == F.lit(False))
        )
        own = own.where(known).select("invoice_line_item_key", "session_key", guid)
        reached = rated.join(own, ["invoice_line_item_key", "session_key"])
    else:
        tagged = tagged_transactions(t, tag_prefix).where(known).select("invoice_line_item_key", "session_key", guid)
        reached = rated.join(tagged, ["invoice_line_item_key", "session_key"])
    grouped = reached.join(points, "packed").groupBy(
        "sales_tax_batch_key", "session_key", *ADDRESS, "destination_code", "rate_type_key",
        "extended_amount", "unit_price", "is_exportable", "client_configuration_key",
    )
    if not flag_overflow:
        return grouped.agg(F.sum(F.col("quantity") * times).alias("quantity"))
    counted = F.try_multiply(F.col("quantity"), times)
    lost = F.max(F.col("quantity").isNotNull() & counted.isNull()) | ((F.count(counted) > 0) & F.try_sum(counted).isNull())
    return grouped.agg(F.when(~lost, F.try_sum(counted)).alias("quantity"), lost.alias("out_of_range"))


def _rated_activities(t: Tables, lines: DataFrame) -> DataFrame:
    """Flagged activities of the lines with the amount and the rate they carry; no price differs from a price of 0."""
    delivered = lines.where(F.col("use_customer_tax_address") == F.lit(False)).select(
        "sales_tax_batch_key", "invoice_line_item_key", "session_key", "extended_amount", "is_exportable",
        "client_configuration_key",
    )
    acts = flagged_activities(t).select("invoice_line_item_key", "category_key", "rate_model_key", "rate_key")
    return (
        delivered.join(acts, "invoice_line_item_key")
        .join(t["rate_models"], "rate_model_key")
        .join(t["rates"], "rate_key")
        .withColumnRenamed("price", "unit_price")
        .drop("rate_model_key", "rate_key")
    )


def tagged_transactions(t: Tables, tag_prefix: str = "btdp-gen") -> DataFrame:
    """(session, line, transaction) read from the provenance tag, so that tags join by equality."""
    parts = F.split("user_added", "[|]")
    return (
        t["transactions"]
        .where(F.col("user_added").startswith(tag_prefix + "|") & (F.size(parts) == 5))
        .select(
            parts[1].try_cast("bigint").alias("session_key"),
            parts[3].try_cast("bigint").alias("invoice_line_item_key"),
            "transaction_guid",
        )
    )


def rate_distribution(addresses: DataFrame, *, on_zero: str = "raise") -> DataFrame:
    """Number the address rows of each batch and give the pro-rata rate per piece.

    The rows of a batch are numbered in slices, so one batch may hold any share of the data. The numbering
    stores its input once (see ``number_within``), hence a job starts when this is called.
    """
    numbered = number_within(
        addresses,
        ["sales_tax_batch_key"],
        ORDER,
        "line_number",
        totals={"lines_per_batch": F.lit(1), "total_quantity": F.col("quantity")},
    )
    return numbered.select(
        "sales_tax_batch_key",
        *ADDRESS,
        "quantity",
        "line_number",
        "lines_per_batch",
        pro_rata_rate(F.col("extended_amount"), _total(on_zero)).alias("pro_rata_rate"),
        F.col("extended_amount").cast("decimal(25,3)").alias("line_item_price"),
        _price().alias("unit_price"),
        "rate_type_key",
        "destination_code",
        "is_exportable",
    )


def _price() -> Column:
    return F.coalesce("unit_price", F.lit(0).cast("decimal(19,4)"))


def _total(on_zero: str) -> Column:
    return nonzero(F.col("total_quantity"), NO_PIECES, on_zero)


def client_homes(t: Tables) -> DataFrame:
    return t["client_configurations"].select(
        "client_configuration_key", "taxable_city", "taxable_state", "taxable_postal_code"
    )


@dataclass(frozen=True)
class Spread:
    """Stored address rows, and the stored totals and last row of each of their batches."""

    rows: DataFrame
    totals: DataFrame


def spread(addresses: DataFrame, homes: DataFrame | None = None) -> Spread:
    """Totals and last row of every batch, found once for the allocation, the warnings and the failures of a run.

    A batch needs only its total and its last row; no task sees a whole batch. The order is one of texts, which an
    aggregation could only follow by sorting all rows. So the rows are aggregated by hash with the first bytes of the postal
    code as a number, which keeps its order; only the few rows that share the highest number of their batch are compared in
    full. Jobs start when this is called; ``addresses`` is read more than once and should be stored. With ``homes`` (the
    clients' taxable addresses) each row also gets its client's, through the totals, so the rows are not joined to clients.
    """
    total = F.try_sum("quantity") if "out_of_range" in addresses.columns else F.sum("quantity")
    lost = (F.count("quantity") > 0) & total.isNull()
    if "out_of_range" in addresses.columns:
        lost = lost | F.max("out_of_range")
    session = F.max("session_key") if "session_key" in addresses.columns else F.lit(None).cast("bigint")
    sums = cut(addresses.groupBy(F.col("sales_tax_batch_key").alias("batch")).agg(
        session.alias("session"),
        total.alias("total_quantity"),
        F.max(_is_fixed(F.col("rate_type_key"))).alias("has_fixed"),
        F.max(_postal_number()).alias("highest"),
        lost.alias("lost"),
        F.max("client_configuration_key").alias("client"),
    ))
    near = addresses.select(F.col("sales_tax_batch_key").alias("batch"), _postal_number().alias("highest"), *ORDER, "quantity")
    last = F.max(F.struct(*ORDER, F.col("quantity").alias("last_quantity"))).alias("last")
    lasts = near.join(sums.select("batch", "highest"), ["batch", "highest"], "left_semi").groupBy("batch").agg(last)
    totals = sums.drop("highest").join(lasts, "batch", "left")
    if homes is not None:
        home = homes.withColumns({"client": F.col("client_configuration_key"), "has_home": F.lit(True)})
        totals = totals.join(home.drop("client_configuration_key"), "client", "left")
    return Spread(addresses.drop("out_of_range"), cut(totals.drop("client")))


def _postal_number() -> Column:
    """The first 7 bytes of the postal code as a number that keeps the order of the texts; NULL comes first."""
    start = F.hex(F.substring(F.col("postal_code").cast("binary"), 1, 7))
    return F.coalesce(F.conv(F.rpad(start, 14, "0"), 16, 10).cast("bigint"), F.lit(-1).cast("bigint"))


def allocate(
    addresses: DataFrame | Spread, *, on_zero: str = "raise", homes: DataFrame | None = None
) -> DataFrame:
    """Rate per address row; fixed amounts leave their rounding remainder on the last row.

    Every row of a batch has the same pro-rata rate, so the amount given to the earlier rows is that rate times their
    quantity, and a row needs the total and the last row of its batch alone (see ``spread``).
    """
    found = addresses if isinstance(addresses, Spread) else spread(addresses, homes)
    totals = found.totals.drop("session", "lost")
    if on_zero == "warn":
        totals = found.totals.where(problem().isNull()).drop("session", "lost")
    rows = found.rows.join(totals, found.rows["sales_tax_batch_key"] == totals["batch"]).drop("batch")
    is_last = F.col("total_quantity") != 0  # a total of zero is found out first
    for c in ORDER:
        is_last = is_last & F.col(c).eqNullSafe(F.col("last")[c])
    mills = F.round(pro_rata_rate(F.col("extended_amount"), _total(on_zero)), 3)
    price = F.col("extended_amount").cast("decimal(25,3)")
    earlier = mills * (F.col("total_quantity") - F.col("quantity"))
    quantity = nonzero(F.col("quantity"), EMPTY_LAST, on_zero)
    remainder = F.round(price - earlier, 3) / quantity
    rate = (
        F.when(~_is_fixed(F.col("rate_type_key")), _price().cast(RATE_TYPE))
        .when(is_last, remainder.cast(RATE_TYPE))
        .otherwise(mills.cast(RATE_TYPE))
    )
    return rows.withColumn("rate", rate).drop("total_quantity", "has_fixed", "last")


def _is_fixed(rate_type: Column) -> Column:
    """Fixed-amount rate types; an unknown rate type counts as fixed."""
    return F.coalesce(rate_type.isin(*FIXED_RATE_TYPES), F.lit(True))


def problem() -> Column:
    """Of ``Spread.totals``: why a batch cannot be spread, NULL if it can."""
    last = F.col("last")
    return (
        F.when(F.col("lost"), LOST)
        .when(F.col("has_fixed") & (F.col("total_quantity") == 0), NO_PIECES)
        .when(_is_fixed(last["rate_type_key"]) & (last["last_quantity"] == 0), EMPTY_LAST)
    )


def zero_quantity_warnings(addresses: DataFrame | Spread, *, as_of: datetime, user: str) -> DataFrame:
    """Batches that ``on_zero='warn'`` leaves out, with the reason."""
    found = addresses if isinstance(addresses, Spread) else spread(addresses)
    return found.totals.where(problem().isNotNull()).select(
        F.col("batch").alias("sales_tax_batch_key"),
        F.col("session").alias("session_key"),
        F.lit("Amount cannot be spread: zero quantity.").alias("message"),
        *audit(user, as_of),
    )


def failed_sessions(found: Spread) -> DataFrame:
    """``session_key, error``: sessions with a batch that cannot be spread, and the first such batch."""
    first = F.min(F.struct("batch", problem().alias("why"))).alias("first")
    bad = found.totals.where(problem().isNotNull()).groupBy(F.col("session").alias("session_key")).agg(first)
    text = F.concat(F.lit("Batch "), F.col("first.batch").cast("string"), F.lit(": "), F.col("first.why"))
    return bad.select("session_key", text.alias("error"))


def delivery_details(allocated: DataFrame) -> DataFrame:
    """Detail rows of the print and postage batches, addresses as delivered."""
    domestic = F.coalesce(F.col("destination_code") == "D", F.lit(False))
    spelled = [F.coalesce(F.col(c).cast("string"), F.lit("\0")) for c in ORDER]
    homes = [c for c in HOME if c in allocated.columns]
    return allocated.select(
        uuid_from(F.lit("detail"), F.col("sales_tax_batch_key"), *spelled).alias("sales_tax_batch_detail_id"),
        "sales_tax_batch_key",
        "session_key",
        "client_configuration_key",
        "quantity",
        "rate",
        "city",
        F.col("state_region").alias("region"),
        F.col("postal_code").alias("zip"),
        (~domestic).alias("is_foreign"),
        F.when(domestic, F.col("is_exportable")).otherwise(False).alias("should_export"),
        *homes,
    )


def fill_blank_addresses(t: Tables, details: DataFrame) -> DataFrame:
    """Give rows with no city, region and zip at all their client's taxable address; details that carry it from
    ``allocate`` are not joined again."""
    if "has_home" not in details.columns:
        home = client_homes(t).withColumn("has_home", F.lit(True))
        details = details.join(home, "client_configuration_key", "left")
    empty = blank(F.col("city")) & blank(F.col("region")) & blank(F.col("zip"))
    use_home = F.coalesce(F.col("has_home"), F.lit(False)) & empty
    return (
        details.withColumns(
            {
                "city": F.when(use_home, F.col("taxable_city")).otherwise(F.col("city")),
                "region": F.when(use_home, F.col("taxable_state")).otherwise(F.col("region")),
                "zip": F.when(use_home, F.col("taxable_postal_code")).otherwise(F.col("zip")),
            }
        )
        .drop(*HOME)
    )


def service_lines(t: Tables, lines: DataFrame) -> DataFrame:
    """Detail rows of lines taxed at the customer's own address."""
    return (
        lines.where(F.col("use_customer_tax_address"))
        .groupBy(
            "sales_tax_batch_key", "session_key", "client_configuration_key", "is_exportable", "rate",
            "extended_amount",
        )
        .agg(F.sum("quantity").alias("quantity"))
        .join(client_homes(t), "client_configuration_key")
        .select(
            uuid_from(F.lit("service"), F.col("sales_tax_batch_key")).alias("sales_tax_batch_detail_id"),
            "sales_tax_batch_key",
            "session_key",
            "client_configuration_key",
            "quantity",
            F.coalesce("rate", F.lit(0)).cast(RATE_TYPE).alias("rate"),
            F.col("taxable_city").alias("city"),
            F.col("taxable_state").alias("region"),
            F.col("taxable_postal_code").alias("zip"),
            F.lit(False).alias("is_foreign"),
            F.col("is_exportable").alias("should_export"),
        )
    )


def sales_tax_details(
    t: Tables,
    lines: DataFrame,
    addresses: DataFrame | Spread,
    *,
    as_of: datetime,
    user: str,
    on_zero: str = "raise",
) -> DataFrame:
    """Final tax detail rows: allocated delivery rows with blanks filled, and the service lines.

    ``addresses`` are the stored ``batch_addresses`` of the lines, of one bridge or several together, or their ``spread``
    with the clients' homes.
    """
    allocated = allocate(addresses, on_zero=on_zero, homes=client_homes(t))
    delivered = fill_blank_addresses(t, delivery_details(allocated))
    return (
        delivered.unionByName(service_lines(t, lines))
        .drop("client_configuration_key")
        .select("*", *audit(user, as_of))
    )
