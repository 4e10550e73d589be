"""Generated transactions, their delivery points, the links back to the details, and the warnings."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mailtax import schemas
from mailtax.functions.expressions import concat_null_as_empty, folded, uuid_from
from mailtax.functions.rules import EXCLUDED_STATUS_ID, HOST1, HOST2, LOCATION_ID, UNKNOWN_HOST
from mailtax.operators.lines import audit
from mailtax.operators.qualify import by_host

TAG_PREFIX = "btdp-gen"


def transaction_guid(line: Column | str = "invoice_line_item_key") -> Column:
    return uuid_from(F.lit("transaction"), line)


def provenance_tag(prefix: str = TAG_PREFIX) -> Column:
    """``prefix|session|host|line|transaction``, kept in ``user_added`` of everything generated."""
    return concat_null_as_empty(
        F.lit(prefix), F.lit("|"), F.col("session_key"), F.lit("|"), F.col("host_system_id"), F.lit("|"),
        F.col("invoice_line_item_key"), F.lit("|"), transaction_guid(),
    )


def accepted(status: DataFrame) -> DataFrame:
    return status.where(F.col("warning").isNull())


def generate_billing_transactions(
    status: DataFrame, *, as_of: datetime, tag_prefix: str = TAG_PREFIX
) -> DataFrame:
    """One transaction per accepted line.

    Generated ids are the negated line key: unique, the same on a rerun, and apart from native ids.
    """
    now = F.lit(as_of).cast("timestamp_ntz")
    values = {
        "transaction_id": -F.col("invoice_line_item_key"),
        "transaction_guid": transaction_guid(),
        "transaction_type_id": F.col("transaction_type_id"),
        "transaction_status_id": F.lit(EXCLUDED_STATUS_ID),
        "customer_id": F.col("customer_id"),
        "location_id": F.lit(LOCATION_ID),
        "transaction_date": now,
        "quantity": F.col("invoiced_quantity"),
        "user_added": provenance_tag(tag_prefix),
        "date_added": now,
        "is_active": F.lit(True),
    }
    return _shaped(accepted(status), "transactions", values)


def _shaped(df: DataFrame, table: str, values: dict[str, Column]) -> DataFrame:
    """Rows of ``table``; columns without a value are NULL."""
    return df.select(
        *[
            values.get(field.name, F.lit(None)).cast(field.dataType).alias(field.name)
            for field in schemas.schema(table)
        ]
    )


def generate_delivery_points(
    status: DataFrame, pieces: DataFrame, *, as_of: datetime, tag_prefix: str = TAG_PREFIX
) -> DataFrame:
    """Qualified details of accepted lines counted per address.

    The count is taken under each host's rules before the lines are joined, so only address rows meet the
    line table. The foreign flag itself is a key: a NULL and a false flag give two domestic points.
    """
    return delivery_points_of(point_counts(status, pieces), as_of=as_of, tag_prefix=tag_prefix)


def point_counts(status: DataFrame, pieces: DataFrame) -> DataFrame:
    """What ``delivery_points_of`` makes points of: the counts per address of the accepted lines, with host and session. Ids and
    tags take more room than all these and follow from them, so they are spelled after what is shuffled and stored."""
    lines = accepted(status).select("invoice_line_item_key", "host_system_id", "session_key")
    return _address_counts(pieces).join(lines, ["invoice_line_item_key", "host_system_id"])


def delivery_points_of(counts: DataFrame, *, as_of: datetime, tag_prefix: str = TAG_PREFIX) -> DataFrame:
    key = [transaction_guid(), *map(F.col, ("city", "state_region", "postal_code", "foreign_flag"))]
    spelled = [F.coalesce(c.cast("string"), F.lit("\0")) for c in key]
    values = {
        "delivery_point_id": uuid_from(F.lit("point"), *spelled),
        "transaction_id": -F.col("invoice_line_item_key"),
        "transaction_guid": transaction_guid(),
        "city": F.col("city"),
        "state_region": F.col("state_region"),
        "postal_code": F.col("postal_code"),
        "destination_code": F.when(F.col("foreign_flag"), "F").otherwise("D"),
        "quantity": F.col("quantity"),
        "user_added": provenance_tag(tag_prefix),
        "date_added": F.lit(as_of).cast("timestamp_ntz"),
        "is_active": F.lit(True),
    }
    return _shaped(counts, "delivery_points", values)


def _address_counts(pieces: DataFrame) -> DataFrame:
    """Qualified details per line, host and address, from one pass over ``pieces``."""

    def side(host: int, record: str, quantity: str) -> Column:
        place = F.col(record)
        address = F.struct(
            F.lit(host).alias("host_system_id"),
            folded(place["city"]).alias("city"),
            folded(place["state"]).alias("state_region"),
            F.rtrim(place["zip"]).alias("postal_code"),
            place["is_foreign"].alias("foreign_flag"),
        )
        return F.when(place.isNotNull() & F.col(quantity).isNotNull(), address)

    sides = F.array_compact(F.array(side(HOST1, "host1", "quantity1"), side(HOST2, "host2", "quantity2")))
    return (
        pieces.select("invoice_line_item_key", F.inline(sides))
        .groupBy("invoice_line_item_key", "host_system_id", "city", "state_region", "postal_code", "foreign_flag")
        .agg(F.count("*").alias("quantity"))
    )


def delivery_point_preview(status: DataFrame, pieces: DataFrame) -> DataFrame:
    """Address counts of reconciled lines before anything is generated, with a Yes/No foreign column."""
    matched = status.where(F.col("is_match")).select("invoice_line_item_key", "host_system_id")
    return _address_counts(pieces).join(matched, ["invoice_line_item_key", "host_system_id"]).select(
        "invoice_line_item_key",
        "host_system_id",
        F.col("quantity").alias("detail_count"),
        "city",
        "state_region",
        "postal_code",
        F.when(F.col("foreign_flag"), "Yes").otherwise("No").alias("is_foreign"),
    )


def link_details_to_transactions(
    status: DataFrame, pieces: DataFrame, *, last_wins: bool = False
) -> DataFrame:
    """One row per (detail, line) of the accepted lines, naming the generated transaction.

    A detail can belong to several lines. ``last_wins`` keeps only the line with the largest key for each
    detail, which is what overwriting one column in line order would leave.
    """
    host = F.col("host_system_id")
    lines = accepted(status).select(
        "invoice_line_item_key", "host_system_id", "session_key", "line_item_key", "module"
    )
    qualified = by_host(host, F.col("quantity1"), F.col("quantity2")).isNotNull()
    rows = pieces.select("invoice_line_item_key", "detail_key", "quantity1", "quantity2")
    rows = rows.join(lines, "invoice_line_item_key").where(qualified)
    if last_wins:
        payload = F.struct("invoice_line_item_key", "host_system_id", "session_key", "line_item_key", "module")
        rows = rows.groupBy("detail_key").agg(F.max(payload).alias("line")).select("detail_key", "line.*")
    values = {
        "category_detail_id": uuid_from(
            F.lit("category-detail"), F.col("invoice_line_item_key"), F.col("detail_key")
        ),
        "transaction_guid": transaction_guid(),
        **{c: F.col(c) for c in ("session_key", "invoice_line_item_key", "line_item_key", "module",
                                 "host_system_id", "detail_key")},
    }
    return _shaped(rows, "category_detail_links", values)


def session_line_links(status: DataFrame) -> DataFrame:
    """One row per line: its host and, if it was accepted, its generated transaction."""
    values = {
        "session_line_id": uuid_from(F.lit("session-line"), F.col("invoice_line_item_key")),
        "transaction_guid": F.when(F.col("warning").isNull(), transaction_guid()),
        **{c: F.col(c) for c in ("session_key", "invoice_line_item_key", "line_item_key", "host_system_id")},
    }
    return _shaped(status, "session_line_links", values)


def taxable_line_items_of(links: DataFrame) -> DataFrame:
    """The line bridge of the allocation, from ``session_line_links``."""
    return links.where(F.col("transaction_guid").isNotNull()).select(
        "invoice_line_item_key", "session_key", "transaction_guid", "host_system_id",
        F.lit(False).alias("ignore"),
    )


def invoice_warnings(
    status: DataFrame, *, as_of: datetime, user: str, include_unknown_host: bool = False
) -> DataFrame:
    """One row per rejected line with the message of the first rule it fails.

    Lines of an unknown host are left out by default: generation is not tried for them.
    """
    rejected = status.where(F.col("warning").isNotNull())
    if not include_unknown_host:
        rejected = rejected.where(F.col("host_system_id") != UNKNOWN_HOST)
    added_by, added, active = audit(user, as_of)
    values = {
        "invoice_warning_id": uuid_from(F.lit("warning"), F.col("invoice_line_item_key"), F.col("warning")),
        "session_key": F.col("session_key"),
        "line_item_key": F.col("line_item_key"),
        "message": F.col("warning"),
        "is_resolved": F.lit(False),
        "user_added": added_by,
        "date_added": added,
        "is_active": active,
    }
    return _shaped(rejected, "invoice_warnings", values)
