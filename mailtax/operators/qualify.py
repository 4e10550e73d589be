"""Qualify mail-piece details, reconcile them with the invoiced quantity, and classify each line."""

from __future__ import annotations

from collections import ChainMap
from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mailtax.functions import rules
from mailtax.functions.expressions import concat_null_as_empty, folded, packed_id, packed_key, packed_number, unpacked_id
from mailtax.functions.rules import HOST1, HOST2, UNKNOWN_HOST
from mailtax.functions.staging import cut
from mailtax.operators.lines import Tables, host_of, known_pieces, line_hosts

HOST_NAMES = {HOST1: "Host 1", HOST2: "Host 2"}


def calculator_transaction_type(t: Tables, lines: DataFrame) -> DataFrame:
    """Transaction type guid and id of each line's calculator module; NULL where there is none."""
    guid = rules.type_guid(F.col("module"))
    return with_type_id(
        t, lines.select("invoice_line_item_key", "module", guid.alias("transaction_type_guid"))
    )


def with_type_id(t: Tables, df: DataFrame) -> DataFrame:
    types = (
        t["transaction_types"]
        .groupBy(F.lower("transaction_type_guid").alias("transaction_type_guid"))
        .agg(F.min("transaction_type_id").alias("transaction_type_id"))
    )
    return df.join(types, "transaction_type_guid", "left")


HOST_PIECES = "host_pieces"
HOT_DETAILS = 100_000


def _known(t: Tables, ids: DataFrame | None = None, *, places: bool = True) -> list[DataFrame]:
    """``piece_id`` (a ``packed_id``) and the record of both hosts' pieces, limited to ``ids`` if given; without ``places`` only
    what the rules read of a record."""
    hosts = []
    for name in ("host1", "host2"):
        table = known_pieces(t[f"{name}_pieces"], ids).where("data_stream_detail_id is not null")
        kept = [F.col(c) for c in table.columns if c != "data_stream_detail_id"] if places else rules.ruled_columns(table)
        record = F.struct(*kept).alias(name)
        hosts.append(table.select(packed_key(F.col("data_stream_detail_id")).alias("piece_id"), record))
    return hosts


def host_records(t: Tables, ids: DataFrame | None = None, *, places: bool = True) -> DataFrame:
    """``piece_id, host1, host2``: the records of both hosts brought together, limited to ``ids`` if given."""
    first, second = _known(t, ids, places=places)
    return first.join(second, "piece_id", "full")


def store_host_pieces(t: Tables, table_name: str, buckets: int) -> Tables:
    """Bring the hosts' records together once per load, as a catalogue table in ``buckets`` buckets of the piece id, and give the
    tables with it. Runs over these join the records where they lie: no run shuffles or stores them again. A row holds the
    record of one host, so the records are shuffled once and not joined; a run joins each host's rows to its pieces."""
    first, second = _known(t)
    none = {h: F.lit(None).cast(df.schema[h].dataType) for h, df in (("host1", first), ("host2", second))}
    records = first.withColumn("host2", none["host2"]).unionByName(second.withColumn("host1", none["host1"]))
    records.repartition(buckets, "piece_id").write.mode("overwrite").bucketBy(buckets, "piece_id").sortBy("piece_id").saveAsTable(table_name)
    return ChainMap({HOST_PIECES: records.sparkSession.table(table_name)}, t)


def _shared_apart(
    pieces: DataFrame, plain: Callable[[DataFrame], DataFrame], shared: DataFrame, records: DataFrame
) -> DataFrame:
    """``plain(pieces)``, but with the ``records`` of the ``shared`` ids broadcast to the pieces that have them."""
    few = F.broadcast(shared)
    own = cut(records.join(few, "piece_id", "left_semi"))
    return plain(pieces.join(few, "piece_id", "left_anti")).unionByName(
        pieces.join(few, "piece_id", "left_semi").join(F.broadcast(own), "piece_id", "left")
    )


SHARE = 0.001


def _shared_ids(details: DataFrame, hot: int) -> list[str]:
    """Piece ids of more than ``hot`` details, if these are more than ``SHARE`` of all: none is missed, and none is shuffled."""
    ids = details.where("data_stream_detail_id is not null").select(F.col("data_stream_detail_id").alias("id"))
    often = ids.freqItems(["id"], SHARE).first()[0]
    counted = ids.where(F.col("id").isin(often)).groupBy("id").agg(F.count("*").alias("n"))
    return [row["id"] for row in counted.where(F.col("n") > hot).select("id").collect()]


def match_pieces(
    t: Tables, lines: DataFrame, *, few: bool = False, hot: int = HOT_DETAILS, places: bool = True
) -> DataFrame:
    """Every detail of the lines with both hosts' piece records and the quantity it has on either host.

    This is the one wide join of the run: details meet the piece records once, on the piece id, and the host
    jobs, the reconciliation and the delivery points all read the result. Where the records were brought together at load time
    (``store_host_pieces``), they are read from their buckets and only the details are shuffled. Else the details and
    both hosts' records are shuffled once each, with the ids as bytes; the records of an id that many details share are broadcast
    to these. A detail without a piece id gets a join
    key of its own, so such details spread over all tasks. ``few`` says that the lines are a small part of the data; their
    details are then stored, and the piece tables filtered by them before they are joined. Without ``places`` the records
    hold only what the rules read, for jobs that tell no address.
    """
    acts = t["activities"].select("invoice_line_item_key", "category_key")
    piece_id = F.coalesce(packed_id(F.col("data_stream_detail_id")), packed_number(F.col("detail_key")))
    details = t["details"].select("detail_key", "category_key", piece_id.alias("piece_id"))
    pieces = (
        lines.select("invoice_line_item_key", rules.module_number(F.col("module")).alias("module_number"))
        .join(acts, "invoice_line_item_key")
        .join(details, "category_key")
    )
    if HOST_PIECES in t:
        stored = t[HOST_PIECES]
        first, second = (stored.where(F.col(h).isNotNull()).select("piece_id", h) for h in ("host1", "host2"))
    else:
        pieces = cut(pieces) if few else pieces
        known = pieces.select(unpacked_id(F.col("piece_id")).alias("data_stream_detail_id"))
        ids = cut(known.where("data_stream_detail_id is not null").distinct()) if few else None
        first, second = _known(t, ids, places=places)
    plain = lambda rows: rows.join(first, "piece_id", "left").join(second, "piece_id", "left")
    if shared := _shared_ids(t["details"], hot):
        keys = lines.sparkSession.createDataFrame([(x,) for x in shared], "id string").select(packed_id(F.col("id")).alias("piece_id"))
        if HOST_PIECES in t:
            own = (df.join(F.broadcast(keys), "piece_id", "left_semi") for df in (first, second))
            records = next(own).join(next(own), "piece_id", "full")
        else:
            records = host_records(t, keys.select(unpacked_id(F.col("piece_id")).alias("data_stream_detail_id")), places=places)
        pieces = _shared_apart(pieces, plain, keys, records)
    else:
        pieces = plain(pieces)
    pieces = pieces.withColumn("data_stream_detail_id", unpacked_id(F.col("piece_id")))
    key = rules.numbered_module(F.col("module_number"))
    return pieces.select(
        "invoice_line_item_key",
        "category_key",
        "detail_key",
        "data_stream_detail_id",
        "host1",
        "host2",
        rules.host1_quantity(key, F.col("host1")).alias("quantity1"),
        rules.host2_quantity(key, F.col("host2")).alias("quantity2"),
    )


def by_host(host: Column, value1: Column, value2: Column) -> Column:
    return F.when(host == HOST1, value1).when(host == HOST2, value2)


def line_status(
    t: Tables, lines: DataFrame, pieces: DataFrame | None = None, *, few: bool = False, warned: bool = True
) -> DataFrame:
    """One row per line: host, transaction type, customer, quantities and the first rule it fails.

    Sums are taken under both hosts' rules while the host is found, so a line of any size is aggregated once
    and its details are not joined back to it. ``calculated_quantity`` is NULL where nothing qualified, which
    never matches. Reports of the quantities alone do without the rules (``warned``) and thus without customers; of the session
    and the items, columns that the lines do not hold are left out.
    """
    pieces = match_pieces(t, lines, few=few, places=False) if pieces is None else pieces
    sums = pieces.groupBy("invoice_line_item_key").agg(
        F.max(F.col("host1").isNotNull()).alias("in_host1"),
        F.max(F.col("host2").isNotNull()).alias("in_host2"),
        F.sum("quantity1").alias("quantity1"),
        F.sum("quantity2").alias("quantity2"),
        F.count("quantity1").alias("count1"),
        F.count("quantity2").alias("count2"),
        F.max(F.col("host1").isNotNull() & F.col("quantity1").isNotNull()).alias("located1"),
        F.max(F.col("host2").isNotNull() & F.col("quantity2").isNotNull()).alias("located2"),
    )
    host = F.col("host_system_id")
    own = [c for c in ("session_key", "line_item_key", "vendor_item_key", "customer_id") if c in lines.columns]
    status = (
        lines.select("invoice_line_item_key", *own, "module", "quantity")
        .join(sums, "invoice_line_item_key", "left")
        .withColumn("host_system_id", host_of(F.col("in_host1"), F.col("in_host2")))
        .withColumn("calculated_quantity", by_host(host, F.col("quantity1"), F.col("quantity2")))
        .withColumn(
            "detail_count", F.coalesce(by_host(host, F.col("count1"), F.col("count2")), F.lit(0).cast("bigint"))
        )
        .withColumn("has_address", F.coalesce(by_host(host, F.col("located1"), F.col("located2")), F.lit(False)))
        .withColumnRenamed("quantity", "invoiced_quantity")
        .withColumn(
            "is_match",
            F.coalesce(F.col("calculated_quantity") == F.col("invoiced_quantity"), F.lit(False)),
        )
        .withColumn("transaction_type_guid", rules.type_guid(F.col("module")))
        .drop("in_host1", "in_host2", "quantity1", "quantity2", "count1", "count2", "located1", "located2")
    )
    if not warned:
        return with_type_id(t, status)
    if "customer_id" not in own:
        status = status.join(cut(session_customers(t, lines.select("session_key") if few else None)), "session_key", "left")
    return with_type_id(t, status).withColumn("warning", _first_failure())


def session_customers(t: Tables, sessions: DataFrame | None = None) -> DataFrame:
    """The customer whose account belongs to a session's client; the smallest id if there are several."""
    invoices = t["invoices"].select("session_key", "client_configuration_key")
    if sessions is not None:
        invoices = invoices.join(sessions, "session_key", "left_semi")
    accounts = (
        t["client_configurations"]
        .select("client_configuration_key", folded(F.col("account_code")).alias("account"))
        .join(t["customers"].withColumn("account", folded(F.col("account"))), "account")
    )
    return (
        invoices.join(accounts, "client_configuration_key")
        .groupBy("session_key")
        .agg(F.min("customer_id").alias("customer_id"))
    )


def _first_failure() -> Column:
    """Message of the first rule a line fails, NULL for an accepted line."""
    module, host = F.col("module"), F.col("host_system_id")
    calculated = F.coalesce(F.col("calculated_quantity").cast("string"), F.lit("NULL"))
    # The warning texts.
    return (
        F.when(F.col("customer_id").isNull(), F.lit("Customer id could not be identified."))
        .when(
            host == UNKNOWN_HOST,
            F.lit("Line item host system could not be identified for delivery point data generation."),
        )
        .when(
            F.col("transaction_type_guid").isNull(),
            concat_null_as_empty(
                F.lit("Cannot match line item calculator module "),
                module,
                F.lit(" to a billing transaction type guid."),
            ),
        )
        .when(
            F.col("transaction_type_id").isNull(),
            concat_null_as_empty(
                F.lit("Cannot find billing transaction type id for billing transaction type guid "),
                F.col("transaction_type_guid"),
            ),
        )
        .when(
            ~rules.is_supported(host, module),
            concat_null_as_empty(
                F.lit("No btdpd-generation line item calculator module match found for "),
                module,
                F.lit(" with host system id "),
                host,
            ),
        )
        .when(
            ~F.col("is_match"),
            concat_null_as_empty(
                F.lit("Calculated quantity ("),
                calculated,
                F.lit(") does not match invoiced quantity ("),
                F.col("invoiced_quantity"),
                F.lit(")"),
            ),
        )
    )


def qualify_details(lines: DataFrame, pieces: DataFrame) -> DataFrame:
    """Details that qualify under the rule of their line's host and module, with their quantity."""
    flags = pieces.select(
        "invoice_line_item_key", F.col("host1").isNotNull().alias("in_host1"), F.col("host2").isNotNull().alias("in_host2")
    )
    hosts = cut(line_hosts(lines, flags).where(F.col("host_system_id") != UNKNOWN_HOST))
    piece_id = packed_id(F.col("data_stream_detail_id")).alias("piece_id")
    counted = pieces.where(F.col("quantity1").isNotNull() | F.col("quantity2").isNotNull())
    return (
        counted.select("invoice_line_item_key", "detail_key", piece_id, "quantity1", "quantity2")
        .join(hosts, "invoice_line_item_key")
        .withColumn("quantity", by_host(F.col("host_system_id"), F.col("quantity1"), F.col("quantity2")))
        .where(F.col("quantity").isNotNull())
        .select(
            "invoice_line_item_key", "host_system_id", "detail_key",
            unpacked_id(F.col("piece_id")).alias("data_stream_detail_id"), "quantity",
        )
    )


def reconcile_quantity(status: DataFrame) -> DataFrame:
    """Calculated against invoiced quantity per line."""
    return status.select("invoice_line_item_key", "calculated_quantity", "invoiced_quantity", "is_match")


def qualification_summary(
    t: Tables,
    status: DataFrame,
    *,
    only_mismatched: bool = False,
    host_names: Mapping[int, str] = HOST_NAMES,
) -> DataFrame:
    """Readable report of the reconciliation, one row per line."""
    host = F.lit("Unknown")
    for key, name in host_names.items():
        host = F.when(F.col("host_system_id") == key, F.lit(name)).otherwise(host)
    rows = status.where(~F.col("is_match")) if only_mismatched else status
    return rows.join(t["vendor_items"], "vendor_item_key", "left").select(
        host.alias("host"),
        "invoice_line_item_key",
        F.format_number("calculated_quantity", 0).alias("calc"),
        F.format_number("invoiced_quantity", 0).alias("inv"),
        F.col("is_match").alias("valid"),
        F.col("vendor_item_name").alias("item"),
        F.format_number("detail_count", 0).alias("cat_details"),
        "module",
    )


def qualification_log(summary_status: DataFrame) -> DataFrame:
    """One text line per line item: key, match flag, both quantities, module."""
    return summary_status.select(
        "invoice_line_item_key",
        concat_null_as_empty(
            F.col("invoice_line_item_key"),
            F.lit(" - Matched: "),
            F.col("is_match").cast("int"),
            F.lit(" - Calc: "),
            F.col("calculated_quantity"),
            F.lit(" - Inv: "),
            F.col("invoiced_quantity"),
            F.lit(" - Module: "),
            F.col("module"),
        ).alias("line"),
    )


def mismatched_details(t: Tables, status: DataFrame, pieces: DataFrame) -> DataFrame:
    """Qualified details of lines that do not reconcile, where the host has a piece record for them.

    Host 2 rows carry the piece record.
    """
    host = F.col("host_system_id")
    bad = status.where(~F.col("is_match")).select("invoice_line_item_key", "host_system_id")
    present = F.coalesce(by_host(host, F.col("host1").isNotNull(), F.col("host2").isNotNull()), F.lit(False))
    record = [
        F.when(host == HOST2, F.col("host2")[c]).alias(c)
        for c in t["host2_pieces"].columns
        if c != "data_stream_detail_id"
    ]
    return (
        pieces.join(bad, "invoice_line_item_key")
        .withColumn("quantity", by_host(host, F.col("quantity1"), F.col("quantity2")))
        .where(F.col("quantity").isNotNull() & present)
        .select("host_system_id", "invoice_line_item_key", "detail_key", "data_stream_detail_id", "quantity",
                *record)
    )
