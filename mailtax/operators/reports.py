"""Lookups, audits and reconciliation reports around the tax run.

Jobs about "one line" or "one client" take a DataFrame of keys, or none for all of them.
"""

from __future__ import annotations

from collections import ChainMap
from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mailtax.functions.staging import cut
from mailtax.operators.lines import Tables, lines_with_details, non_service_line_items, of_known_clients, session_lines


def _only(df: DataFrame, keys: DataFrame | None, key: str) -> DataFrame:
    return df if keys is None else df.join(keys.select(key), key, "left_semi")


def category_totals(t: Tables, batches: DataFrame) -> DataFrame:
    """Module and activity totals per batch line."""
    acts = t["activities"].select("invoice_line_item_key", "category_key", "client_line_item_key")
    own_item = t["invoice_line_items"].select(
        "invoice_line_item_key", F.col("line_item_key").alias("invoiced_item_key")
    )
    client_items = t["client_line_items"].withColumnRenamed("line_item_key", "invoiced_item_key")
    return (
        batches.select("invoice_line_item_key", "group_key", "line_item_key")
        .join(own_item, "invoice_line_item_key")
        .join(acts, "invoice_line_item_key")
        .join(t["line_items"].select("line_item_key", "module"), "line_item_key")
        .join(client_items, ["invoiced_item_key", "client_line_item_key"])
        .join(t["activity_categories"], "category_key")
        .groupBy("invoice_line_item_key", "group_key", "line_item_key")
        .agg(
            F.min("module").alias("module"),
            F.sum("batch_total").alias("batch_total"),
            F.sum("total_suppressed").alias("total_suppressed"),
            F.sum("total_updated").alias("total_updated"),
            F.sum("total_returned").alias("total_returned"),
        )
        .orderBy("invoice_line_item_key")
    )


def return_update_counts(t: Tables, line_keys: DataFrame | None = None) -> DataFrame:
    """Returned and updated mail pieces per line, from the return reasons of its details.

    Details are counted per category and return record first, so a category is aggregated before the lines
    that share it are joined.
    """
    counted = (
        t["details"]
        .where(F.col("return_detail_id").isNotNull())
        .groupBy("category_key", "return_detail_id")
        .agg(F.count("*").alias("detail_count"))
    )
    flags = (
        counted.join(t["return_details"], "return_detail_id")
        .join(t["return_reasons"], "return_reason_id")
        .groupBy("category_key")
        .agg(
            F.sum(F.col("is_returned").cast("int") * F.col("detail_count")).alias("num_returns"),
            F.sum(F.col("is_updated").cast("int") * F.col("detail_count")).alias("num_updates"),
        )
    )
    acts = _only(t["activities"], line_keys, "invoice_line_item_key")
    lines = t["invoice_line_items"].select("invoice_line_item_key")
    return (
        acts.select("invoice_line_item_key", "category_key")
        .join(lines, "invoice_line_item_key", "left_semi")
        .join(cut(flags), "category_key")
        .groupBy("invoice_line_item_key")
        .agg(F.sum("num_returns").alias("num_returns"), F.sum("num_updates").alias("num_updates"))
    )


def line_item_details(t: Tables, line_keys: DataFrame | None = None) -> DataFrame:
    """Details behind each line, with the line key."""
    acts = _only(t["activities"], line_keys, "invoice_line_item_key")
    lines = t["invoice_line_items"].select("invoice_line_item_key")
    return (
        acts.select("invoice_line_item_key", "category_key")
        .join(lines, "invoice_line_item_key", "left_semi")
        .join(t["details"], "category_key")
    )


def transactions_for_line(t: Tables, line_keys: DataFrame | None = None) -> DataFrame:
    """Transactions named by some detail of the lines."""
    acts = _only(t["activities"], line_keys, "invoice_line_item_key")
    categories = acts.join(
        t["invoice_line_items"].select("invoice_line_item_key"), "invoice_line_item_key", "left_semi"
    ).select("category_key")
    guids = (
        t["details"]
        .where(F.col("transaction_guid").isNotNull())
        .join(cut(categories.distinct()), "category_key", "left_semi")
        .select("transaction_guid")
        .distinct()
    )
    return t["transactions"].join(guids, "transaction_guid", "left_semi")


def session_line_item_report(
    t: Tables, *, sessions: DataFrame | None = None, strict: bool = False
) -> DataFrame:
    """Taxable lines with catalogue names, quantity and flags; ``strict`` as in the batch job."""
    lines = session_lines(t, sessions).join(lines_with_details(t, strict), "invoice_line_item_key", "left_semi")
    names = t["line_items"].select("line_item_key", "line_item_name", "line_item_description")
    return (
        of_known_clients(t, lines)
        .join(names, "line_item_key")
        .select("invoice_line_item_key", "line_item_name", "line_item_description", "quantity",
                "use_customer_tax_address", "is_exportable")
        .orderBy("invoice_line_item_key")
    )


def clients_with_invoices(t: Tables) -> DataFrame:
    """Client configurations with any invoice, by name."""
    invoiced = t["invoices"].select("client_configuration_key")
    return (
        t["client_configurations"]
        .join(t["clients"].select("client_key"), "client_key", "left_semi")
        .join(invoiced, "client_configuration_key", "left_semi")
        .select("client_configuration_key", "client_configuration_name")
        .orderBy("client_configuration_name")
    )


def active_clients(t: Tables, *, as_of: datetime, days: int = 30) -> DataFrame:
    """Clients with an invoice and an active file stream in the ``days`` up to ``as_of``, both ends included."""
    since, until = (F.lit(x).cast("timestamp_ntz") for x in (as_of - timedelta(days=days), as_of))
    streams = t["file_streams"].where(F.col("is_active") & F.col("date_added").between(since, until))
    configs = (
        t["file_stream_configs"]
        .join(streams.select("file_stream_config_id").distinct(), "file_stream_config_id", "left_semi")
        .join(t["host_client_configs"], "client_configuration_id", "left_semi")
        .select("client_configuration_id")
    )
    active = t["client_configurations"].join(configs, "client_configuration_id", "left_semi")
    return clients_with_invoices(ChainMap({"client_configurations": active}, t))


def invoices_for_client(t: Tables, clients: DataFrame | None = None) -> DataFrame:
    """Invoices of the given clients, newest first."""
    return (
        _only(t["invoices"], clients, "client_configuration_key")
        .select("session_key", "client_configuration_key", "invoice_billing_date", "date_added", "user_added",
                "date_edited", "is_active")
        .orderBy("client_configuration_key", F.desc("date_added"))
    )


def activity_category_types(t: Tables, lines: DataFrame) -> DataFrame:
    """Distinct activity category types of each line, with its module."""
    types = t["activity_category_types"].select("category_type_key", "category_type_id", "category_type_name")
    categories = (
        t["activity_categories"]
        .join(t["activity_batches"].select("activity_batch_key"), "activity_batch_key", "left_semi")
        .select("category_key", "category_type_key")
    )
    return (
        lines.select("invoice_line_item_key", "module")
        .join(t["activities"].select("invoice_line_item_key", "category_key"), "invoice_line_item_key")
        .join(categories, "category_key")
        .select("invoice_line_item_key", "module", "category_type_key")
        .distinct()
        .join(types, "category_type_key")
        .select("category_type_id", "category_type_name", "invoice_line_item_key", "module")
    )


def non_service_lines_with_item(
    t: Tables, *, sessions: DataFrame | None = None, through_catalogue: bool = False
) -> DataFrame:
    """Lines without delivery points and the vendor item they sell, taken from the line or the catalogue."""
    rows = non_service_line_items(t, sessions=sessions)
    if through_catalogue:
        item = t["line_items"].select("line_item_key", "vendor_item_key")
        rows = rows.join(item, "line_item_key")
    else:
        item = t["invoice_line_items"].select("invoice_line_item_key", "vendor_item_key")
        rows = rows.join(item, "invoice_line_item_key")
    return (
        rows.join(t["vendor_items"], "vendor_item_key").drop("vendor_item_key").orderBy("invoice_line_item_key")
    )
