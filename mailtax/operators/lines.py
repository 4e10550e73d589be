"""Which invoice line items are taxable, which still need delivery points, and where they come from."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mailtax.functions.expressions import packed_id, packed_key, unpacked_id, uuid_from
from mailtax.functions.numbering import number_within
from mailtax.functions.rules import HOST1, HOST2, NEW_BATCH_STATUS_ID, UNKNOWN_HOST
from mailtax.functions.staging import cut

Tables = Mapping[str, DataFrame]


def audit(user: str, as_of: datetime) -> list[Column]:
    return [
        F.lit(user).alias("user_added"),
        F.lit(as_of).cast("timestamp_ntz").alias("date_added"),
        F.lit(True).alias("is_active"),
    ]


def scoped_sessions(t: Tables, sessions: DataFrame | None = None) -> DataFrame:
    """Keys and ids of the sessions named by ``session_key`` or ``session_id``; of all without ``sessions``."""
    scope = t["sessions"].select("session_key", F.lower("session_id").alias("session_id"))
    if sessions is None:
        return scope
    if "session_key" in sessions.columns:
        return cut(scope.join(sessions.select("session_key"), "session_key", "left_semi"))
    return cut(scope.join(sessions.select(F.lower("session_id").alias("session_id")), "session_id", "left_semi"))


FEW = 0.5  # a scope of up to this share of all sessions narrows the large tables first


def is_few(t: Tables, sessions: DataFrame | None) -> bool:
    """Whether a scope is small enough, by count, for its keys to narrow the large tables before they are joined."""
    if sessions is None:
        return False
    every = t["sessions"].count()
    return every == 0 or scoped_sessions(t, sessions).count() <= FEW * every


def within(rows: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Rows of a large table whose key is among the stored ``keys``.

    Few keys are broadcast. For more, Spark makes a Bloom filter of them and applies it where the large table is scanned, before
    it is shuffled, if the keys come from a filtered table; their smallest one serves as that filter and drops nothing.
    """
    low = keys.agg(F.min(key)).first()[0]
    bounded = keys if low is None else keys.where(F.col(key) >= F.lit(low))
    return rows.join(bounded, key, "left_semi")


def session_lines(t: Tables, sessions: DataFrame | None = None) -> DataFrame:
    """Invoice line items of the sessions with their session, client and catalogue columns."""
    return with_catalogue(t, invoiced_lines(t, sessions))


def invoiced_lines(t: Tables, sessions: DataFrame | None = None, *, customers: DataFrame | None = None) -> DataFrame:
    """``session_lines`` without the catalogue's columns, which are many and the same for many lines: for what is shuffled or
    stored. With ``customers`` (one row per session) each line also has its ``customer_id``, found once per invoice."""
    scope = scoped_sessions(t, sessions).select("session_key")
    invoices = t["invoices"].select("invoice_key", "session_key", "client_configuration_key")
    invoices = invoices.join(scope, "session_key", "left_semi")
    if customers is not None:
        invoices = invoices.join(customers, "session_key", "left")
    return t["invoice_line_items"].join(invoices, "invoice_key").drop("invoice_key")


def with_catalogue(t: Tables, lines: DataFrame) -> DataFrame:
    """Lines with the columns of the catalogue item they name."""
    catalogue = t["line_items"].drop("vendor_item_key", "line_item_name", "line_item_description")
    return lines.join(catalogue, "line_item_key").join(t["sales_tax_codes"], "sales_tax_code_key").drop("sales_tax_code_key")


def flagged_activities(t: Tables) -> DataFrame:
    return t["activities"].where(F.col("include_in_sales_tax_batch"))


def category_transactions(t: Tables, categories: DataFrame | None = None) -> DataFrame:
    """(category, transaction, number of details): the details, aggregated before any join needs them.

    ``categories`` limits the details first, for runs over few sessions.
    """
    details = t["details"]
    if categories is not None:
        details = within(details, cut(categories.select("category_key").distinct()), "category_key")
    return (
        details
        .where(F.col("transaction_guid").isNotNull() & F.col("category_key").isNotNull())
        .groupBy("category_key", packed_id(F.col("transaction_guid")).alias("packed"))
        .agg(F.count("*").alias("detail_count"))
        .select("category_key", unpacked_id(F.col("packed")).alias("transaction_guid"), "detail_count")
    )


def linked_transactions(t: Tables, sessions: DataFrame | None = None) -> DataFrame:
    """``category_transactions`` of the flagged activities in scope; of all if the scope is a large part of them."""
    if not is_few(t, sessions):
        return category_transactions(t)
    return category_transactions(t, _scoped_activities(t, session_lines(t, sessions)).select("category_key"))


def _scoped_activities(t: Tables, lines: DataFrame) -> DataFrame:
    return flagged_activities(t).join(lines.select("invoice_line_item_key"), "invoice_line_item_key", "left_semi")


def covered_categories(t: Tables, linked: DataFrame, *, few: bool = False) -> DataFrame:
    """Categories with at least one detail whose transaction has an active delivery point.

    ``few`` says that ``linked`` is a small part of the data; the points are then filtered by it first.
    """
    active = t["delivery_points"].where(F.col("is_active")).select("transaction_guid")
    if few:
        active = within(active, cut(linked.select("transaction_guid").distinct()), "transaction_guid")
    guid = packed_key(F.col("transaction_guid")).alias("packed")
    # Not distinct: a semi join keeps one row of each, and stored ones would be shuffled twice.
    guids = active.where(F.col("transaction_guid").isNotNull()).select(guid)
    return cut(linked.select("category_key", guid).join(guids, "packed", "left_semi").select("category_key").distinct())


def new_status_key(t: Tables) -> Column:
    """Key of the 'new' batch status, NULL if the status table does not know it."""
    new = t["sales_tax_batch_statuses"].where(F.lower("status_id") == NEW_BATCH_STATUS_ID)
    return new.agg(F.min("status_key")).scalar()


def covered_lines(
    t: Tables, sessions: DataFrame | None = None, *, linked: DataFrame | None = None
) -> DataFrame:
    """Lines with flagged activities and two flags: has it a covered activity, has it an uncovered one.

    The jobs below are filters on it. ``linked`` are stored ``linked_transactions``.
    """
    return with_catalogue(t, invoiced_covered_lines(t, sessions, linked=linked))


def invoiced_covered_lines(
    t: Tables, sessions: DataFrame | None = None, *, linked: DataFrame | None = None, customers: DataFrame | None = None
) -> DataFrame:
    """``covered_lines`` without the catalogue's columns (see ``invoiced_lines``); the last join is by line."""
    lines = invoiced_lines(t, sessions, customers=customers)
    few = is_few(t, sessions)
    linked = linked_transactions(t, sessions) if linked is None else linked
    covered = covered_categories(t, linked, few=few).withColumn("covered", F.lit(True))
    acts = _scoped_activities(t, lines) if few else flagged_activities(t)
    hit = F.coalesce(F.col("covered"), F.lit(False))
    coverage = (
        acts.select("invoice_line_item_key", "category_key")
        .join(covered, "category_key", "left")
        .groupBy("invoice_line_item_key")
        .agg(F.max(hit).alias("has_covered"), F.max(~hit).alias("has_uncovered"))
    )
    return lines.join(coverage, "invoice_line_item_key")


def taxable_lines(lines: DataFrame, generated: DataFrame | None = None) -> DataFrame:
    """``covered_lines`` that get a batch: a covered activity, or taxed at the customer's address.

    A line has one batch, so the line key also is the batch key; a rerun gives the same keys. ``generated``
    names lines that got delivery points in this run and therefore count as covered; lines may be flagged before.
    """
    taxable = F.col("has_covered") | F.col("use_customer_tax_address")
    if generated is not None:
        lines = flag_generated(lines, generated)
    if "is_generated" in lines.columns:
        taxable = taxable | F.col("is_generated").isNotNull()
    return lines.where(taxable).withColumn("sales_tax_batch_key", F.col("invoice_line_item_key"))


def flag_generated(lines: DataFrame, generated: DataFrame) -> DataFrame:
    """Lines with ``is_generated``: true for those named by ``generated``, NULL for the others."""
    keys = generated.select("invoice_line_item_key", F.lit(True).alias("is_generated"))
    return lines.join(keys, "invoice_line_item_key", "left")


def lines_of_batches(t: Tables, batches: DataFrame, sessions: DataFrame | None = None) -> DataFrame:
    """Lines of stored batch headers, which may have keys of their own; input of the allocation jobs."""
    keys = batches.select("invoice_line_item_key", "sales_tax_batch_key")
    return session_lines(t, sessions).join(keys, "invoice_line_item_key")


def batch_headers(t: Tables, lines: DataFrame, *, as_of: datetime, user: str) -> DataFrame:
    line = F.col("invoice_line_item_key")
    return lines.select(
        line.alias("sales_tax_batch_key"),
        uuid_from(F.lit("batch"), line).alias("sales_tax_batch_id"),
        "session_key",
        "invoice_line_item_key",
        new_status_key(t).alias("status_key"),
        "group_key",
        "line_item_key",
        "tax_code",
        "tax_category",
        *audit(user, as_of),
    )


def taxable_line_items(
    t: Tables, *, sessions: DataFrame | None = None, as_of: datetime, user: str
) -> DataFrame:
    """Batch headers of the taxable lines."""
    return batch_headers(t, taxable_lines(covered_lines(t, sessions)), as_of=as_of, user=user)


def session_line_item_batches(
    t: Tables, *, sessions: DataFrame | None = None, as_of: datetime, user: str, strict: bool = False
) -> DataFrame:
    """Batch headers without the delivery-point test.

    A flagged activity needs a category key, and some detail must exist anywhere; ``strict`` asks for a
    detail of that category instead.
    """
    lines = session_lines(t, sessions).join(lines_with_details(t, strict), "invoice_line_item_key", "left_semi")
    return batch_headers(t, of_known_clients(t, lines), as_of=as_of, user=user)


def lines_with_details(t: Tables, strict: bool) -> DataFrame:
    acts = flagged_activities(t).where(F.col("category_key").isNotNull())
    if strict:
        acts = acts.join(cut(t["details"].select("category_key").distinct()), "category_key", "left_semi")
    else:
        acts = acts.where(t["details"].select(F.lit(1)).exists())
    return acts.select("invoice_line_item_key")


def of_known_clients(t: Tables, lines: DataFrame) -> DataFrame:
    """Lines whose session belongs to an existing client configuration."""
    known = t["sessions"].join(
        t["client_configurations"].select("client_configuration_key"), "client_configuration_key", "left_semi"
    )
    return lines.join(known.select("session_key"), "session_key", "left_semi")


def non_service_line_items(t: Tables, *, sessions: DataFrame | None = None) -> DataFrame:
    """Lines with a flagged activity that has no active delivery point, taxed at delivery addresses.

    The test is per activity: a line with one covered and one uncovered activity is included.
    """
    return non_service_lines(covered_lines(t, sessions)).select(
        "invoice_line_item_key", "session_key", "group_key", "line_item_key", "tax_code", "tax_category"
    )


def non_service_lines(lines: DataFrame) -> DataFrame:
    """``covered_lines`` that still need delivery points, with all columns: input of the generation jobs."""
    return lines.where((F.col("use_customer_tax_address") == F.lit(False)) & F.col("has_uncovered"))


def host_of(in_host1: Column, in_host2: Column) -> Column:
    """Host of a line from the flags 'some detail is known to host 1 / host 2'."""
    return F.when(in_host1, HOST1).when(in_host2, HOST2).otherwise(UNKNOWN_HOST).cast("int")


def known_pieces(table: DataFrame, ids: DataFrame | None) -> DataFrame:
    """Piece records of a host, limited to ``ids`` if these are a small part of the data.

    The later outer join could not broadcast the small side; this filter can.
    """
    return table if ids is None else within(table, ids, "data_stream_detail_id")


def infer_host_system(t: Tables, lines: DataFrame, *, few: bool = False) -> DataFrame:
    """1 or 2 after the host that knows the line's details, 0 where neither does.

    The details of a line come from one host, so any known detail decides. ``few`` says that the lines are a
    small part of the data.
    """
    details = t["details"].select("category_key", "data_stream_detail_id")
    streams = (
        lines.select("invoice_line_item_key")
        .join(t["activities"].select("invoice_line_item_key", "category_key"), "invoice_line_item_key")
        .join(t["activity_categories"].select("category_key"), "category_key", "left_semi")
        .join(details, "category_key")
        .where(F.col("data_stream_detail_id").isNotNull())
        .drop("category_key")
    )
    streams = cut(streams) if few else streams
    ids = cut(streams.select("data_stream_detail_id").distinct()) if few else None
    first, second = (
        known_pieces(t[f"{name}_pieces"].select("data_stream_detail_id"), ids).select(
            "data_stream_detail_id", F.lit(name == "host1").alias("in_host1"), F.lit(name == "host2").alias("in_host2")
        )
        for name in ("host1", "host2")
    )
    hosts = first.union(second).groupBy("data_stream_detail_id").agg(
        F.max("in_host1").alias("in_host1"), F.max("in_host2").alias("in_host2")
    )
    return line_hosts(lines, streams.join(cut(hosts), "data_stream_detail_id"))


def line_hosts(lines: DataFrame, known: DataFrame) -> DataFrame:
    """Host of each line from ``known``: its details, or some of them, with the flags ``in_host1`` and ``in_host2``."""
    flags = known.groupBy("invoice_line_item_key").agg(
        F.max("in_host1").alias("in_host1"), F.max("in_host2").alias("in_host2")
    )
    return lines.select("invoice_line_item_key").join(flags, "invoice_line_item_key", "left").select(
        "invoice_line_item_key", host_of(F.col("in_host1"), F.col("in_host2")).alias("host_system_id")
    )


def host_of_batches(t: Tables, batch_users: Mapping[str, int]) -> DataFrame:
    """The other way to tell the host: by the user that added a non-native activity batch."""
    pairs = [F.lit(part) for item in batch_users.items() for part in item]
    host = F.try_element_at(F.create_map(*pairs), F.col("user_added"))
    return (
        t["activity_batches"]
        .where(F.col("is_native_batch") == F.lit(False))
        .select("activity_batch_key", F.coalesce(host, F.lit(UNKNOWN_HOST)).alias("host_system_id"))
    )


def line_item_batches_by_module(t: Tables, lines: DataFrame) -> DataFrame:
    """(module, batch id, number of the line in its session, native flag) for each activity of the lines."""
    numbered = number_within(
        lines.select("session_key", "invoice_line_item_key", "module"),
        ["session_key"],
        ["invoice_line_item_key"],
        "meta_group_key",
    )
    categories = t["activity_categories"].select("category_key", "activity_batch_key")
    batches = t["activity_batches"].select("activity_batch_key", "activity_batch_id", "is_native_batch")
    return (
        numbered.join(t["activities"].select("invoice_line_item_key", "category_key"), "invoice_line_item_key")
        .join(categories, "category_key")
        .join(batches, "activity_batch_key")
        .select("session_key", "invoice_line_item_key", "module", "activity_batch_id", "meta_group_key",
                "is_native_batch")
    )
