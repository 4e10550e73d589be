"""Every job as a named query over the stand-in tables: ``fn(spark, sf_dir) -> DataFrame``.

Money columns leave as whole millionths (``rate_u`` and the like), so that results compare exactly between
engines; audit columns are left out.
"""

from __future__ import annotations

import uuid
from collections import ChainMap
from collections.abc import Callable
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mailtax.operators import allocate as al
from mailtax import schemas
from mailtax.functions.staging import cut, cut_in_buckets, shared_folder
from mailtax.operators import checks
from mailtax.operators import lines as ln
from mailtax.operators import points as pt
from mailtax.operators import qualify as ql
from mailtax.operators import reports as rp
from mailtax.plans.run import AMOUNTS, SUCCESS, generate, run_outcome, sales_tax_run, with_session
from mailtax.sources.logs import (
    label_log_records,
    parse_log_blocks,
    parse_log_lines,
    rejected_records,
    unwrap_json_levels,
    unwrap_nested_json,
    write_labelled,
)
from mailtax.sources.standins import standin_tables
from mailtax.sources.tables import latest_outcomes
from mailtax.streaming.logs import read_labelled, stream_labelled_logs

AS_OF = datetime(2024, 1, 31)
USER = "tax-run"
RUN = {"as_of": AS_OF, "user": USER}
Query = Callable[[SparkSession, str], DataFrame]


def _micro(amount: Column) -> Column:
    return F.round(amount * 1000000).cast("bigint")


def _batch_columns(df: DataFrame) -> DataFrame:
    return df.drop("user_added", "date_added", "is_active")


def _taxed(t: ln.Tables) -> DataFrame:
    return ln.taxable_lines(ln.covered_lines(t))


def _todo(t: ln.Tables) -> DataFrame:
    return ln.non_service_lines(ln.covered_lines(t))


def _status(t: ln.Tables, *, warned: bool = True, vendor_items: bool = False) -> DataFrame:
    """The line status with what a job tells of it: the rules a line fails, or its vendor item."""
    customers = ql.session_customers(t) if warned else None
    untold = [*AMOUNTS, *([] if warned else ["session_key"]), *([] if vendor_items else ["vendor_item_key"])]
    invoiced = ln.invoiced_covered_lines(t, customers=customers).drop(*untold)
    by_line, rows = (ln.non_service_lines(ln.with_catalogue(t, x)) for x in cut_in_buckets(invoiced, "invoice_line_item_key"))
    return ql.line_status(t, by_line, ql.match_pieces(t, rows, places=False), warned=warned)


def _quantities(t: ln.Tables) -> DataFrame:
    return _status(t, warned=False)


def _summary(t: ln.Tables, **options: bool) -> DataFrame:
    return ql.qualification_summary(t, _status(t, warned=False, vendor_items=True), **options)


def _generated(t: ln.Tables) -> tuple[ln.Tables, DataFrame]:
    """The tables with this run's points, transactions and line bridge, and the lines they serve."""
    made = generate(t, amounts=True, detail_keys=False, vendor_items=False)
    done = pt.accepted(made.status).where("has_address").select("invoice_line_item_key")
    new = {
        "delivery_points": pt.generate_delivery_points(made.status, made.pieces, as_of=AS_OF),
        "transactions": pt.generate_billing_transactions(made.status, as_of=AS_OF),
        "taxable_line_items": pt.taxable_line_items_of(pt.session_line_links(made.status)),
    }
    lines = ln.taxable_lines(made.lines, done).where("is_generated")
    return ChainMap(new, t), lines


def _distribution_columns(df: DataFrame) -> DataFrame:
    return df.select(
        "sales_tax_batch_key", "city", "state_region", "postal_code", "quantity", "line_number",
        "lines_per_batch",
        (F.col("pro_rata_rate") * 100000000).cast("bigint").alias("pro_rata_e8"),
        _micro(F.col("line_item_price")).alias("price_u"),
        _micro(F.col("unit_price")).alias("unit_price_u"),
        F.col("rate_type_key").cast("bigint").alias("rate_type_key"),
        "destination_code", "is_exportable",
    )


def _detail_columns(df: DataFrame) -> DataFrame:
    return df.select(
        "sales_tax_batch_key", "quantity", _micro(F.col("rate")).alias("rate_u"), "city", "region", "zip",
        "is_foreign", "should_export",
    )


def _native_addresses(t: ln.Tables) -> DataFrame:
    return al.batch_addresses(t, _taxed(t))


def _sales_tax_details(t: ln.Tables) -> DataFrame:
    lines = cut(_taxed(t))
    return al.sales_tax_details(t, lines, cut(al.batch_addresses(t, lines)), **RUN)


def _bridged(t: ln.Tables, bridge: str) -> DataFrame:
    after, lines = _generated(t)
    return al.rate_distribution(al.batch_addresses(after, lines, bridge=bridge))


def _points(t: ln.Tables) -> DataFrame:
    made = generate(t, detail_keys=False, vendor_items=False)
    return pt.generate_delivery_points(made.status, made.pieces, as_of=AS_OF).select(
        "transaction_id", "transaction_guid", "city", "state_region", "postal_code", "country_code",
        "destination_code", "quantity", "user_added", "is_active",
    )


def _preview(t: ln.Tables) -> DataFrame:
    made = generate(t, detail_keys=False, vendor_items=False)
    return _whole(pt.delivery_point_preview(made.status, made.pieces), "host_system_id")


def _whole(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("bigint") for c in columns})


def _transactions(t: ln.Tables) -> DataFrame:
    rows = pt.generate_billing_transactions(_status(t), as_of=AS_OF).select(
        "transaction_id", "transaction_guid", "transaction_type_id", "transaction_status_id", "customer_id",
        "location_id", "quantity", "user_added", "is_active",
    )
    return _whole(rows, "transaction_status_id", "location_id")


def _links(t: ln.Tables, last_wins: bool = False) -> DataFrame:
    made = generate(t, places=False, vendor_items=False)
    links = pt.link_details_to_transactions(made.status, made.pieces, last_wins=last_wins)
    return _whole(links.drop("category_detail_id"), "host_system_id")


def _session_links(t: ln.Tables) -> DataFrame:
    return _whole(pt.session_line_links(_status(t)).drop("session_line_id"), "host_system_id")


def _warnings(t: ln.Tables) -> DataFrame:
    return pt.invoice_warnings(_status(t), **RUN).select(
        "session_key", "line_item_key", "message", "is_resolved", "user_added", "is_active"
    )


def _mismatched(t: ln.Tables) -> DataFrame:
    made = generate(t, piece_ids=True, vendor_items=False)
    rows = ql.mismatched_details(t, made.status, made.pieces)
    return _whole(rows, "host_system_id", "page_count", "paper_page_count").drop("data_stream_detail_id")


def _qualified(t: ln.Tables) -> DataFrame:
    todo = cut(_todo(t).select("invoice_line_item_key", "module"))
    return _whole(ql.qualify_details(todo, cut(ql.match_pieces(t, todo, places=False))), "host_system_id")


def _qualified_in_buckets(t: ln.Tables) -> DataFrame:
    """As ``_qualified``, over records that were bucketed at load time."""
    name = f"host_pieces_{uuid.uuid4().hex}"
    todo = cut(_todo(t).select("invoice_line_item_key", "module"))
    bucketed = ql.store_host_pieces(t, name, 8)
    pieces = cut(ql.match_pieces(bucketed, todo, places=False))
    todo.sparkSession.sql(f"DROP TABLE {name}")
    return _whole(ql.qualify_details(todo, pieces), "host_system_id")


def _host(t: ln.Tables) -> DataFrame:
    return _whole(ln.infer_host_system(t, cut(_todo(t))), "host_system_id")


def _checks(t: ln.Tables) -> DataFrame:
    """All declared constraints, and some keys that the data violate."""
    made = generate(t, places=False, vendor_items=False)
    links = {
        "category_detail_links": pt.link_details_to_transactions(made.status, made.pieces),
        "session_line_links": pt.session_line_links(made.status),
    }
    return checks.referential_checks(
        ChainMap(links, t),
        primary_keys={**schemas.PRIMARY_KEYS, "details": "category_key"},
        foreign_keys=[
            *schemas.FOREIGN_KEYS,
            ("details", "data_stream_detail_id", "host1_pieces", "data_stream_detail_id"),
            ("client_configurations", "account_code", "customers", "account"),
        ],
        not_null={**schemas.NOT_NULL, "details": ["transaction_guid", "return_detail_id"]},
    )


def _transactions_of_lines(t: ln.Tables) -> DataFrame:
    return rp.transactions_for_line(t).select("transaction_id", "transaction_guid", "customer_id", "quantity")


def _invoices(t: ln.Tables) -> DataFrame:
    day = {c: F.date_format(c, "yyyy-MM-dd") for c in ("invoice_billing_date", "date_added")}
    return rp.invoices_for_client(t).withColumns(day).drop("date_edited")


def _run(t: ln.Tables) -> DataFrame:
    return _detail_columns(sales_tax_run(t, **RUN).sales_tax_batch_details)


def _run_batches(t: ln.Tables) -> DataFrame:
    return _batch_columns(sales_tax_run(t, **RUN).sales_tax_batches)


def _small_count_nothing(t: ln.Tables, below: int) -> ln.Tables:
    """The tables with native points of which small ones count nothing."""
    points = t["delivery_points"]
    none = F.when(F.col("quantity") < below, F.lit(0)).otherwise(F.col("quantity")).cast(points.schema["quantity"].dataType)
    return ChainMap({"delivery_points": points.withColumn("quantity", none)}, t)


def _run_zero_warnings(t: ln.Tables) -> DataFrame:
    return _batch_columns(sales_tax_run(_small_count_nothing(t, 10), on_zero="warn", **RUN).zero_quantity_warnings)


def _run_outcomes(t: ln.Tables) -> DataFrame:
    """Sessions with their own outcome: those with a batch that counts nothing fail, the others succeed."""
    run = sales_tax_run(_small_count_nothing(t, 4), **RUN)
    outcome = run_outcome(ln.scoped_sessions(t), SUCCESS, "Success", as_of=AS_OF, published_at=AS_OF, failures=run.failures)
    return _whole(outcome.select("session_key", "return_code", "return_message"), "return_code")


def _run_of_good_sessions(t: ln.Tables) -> DataFrame:
    """Rows of each result per session in a run of which some sessions fail; those have none."""
    run = sales_tax_run(_small_count_nothing(t, 4), **RUN)
    counts = [
        with_session(rows).groupBy("session_key").agg(F.count("*").alias("rows")).select(F.lit(name).alias("table_name"), "session_key", "rows")
        for name, rows in run.tables().items()
    ]
    return reduce(DataFrame.unionByName, counts)


def _latest_sessions(t: ln.Tables) -> DataFrame:
    """Sessions with invoices in the last year there are invoices for."""
    billed = t["invoices"].select("session_key", F.year("invoice_billing_date").alias("year"))
    last = billed.agg(F.max("year").alias("year"))
    return cut(billed.join(last, "year").select("session_key").distinct())


def _run_of_sessions(t: ln.Tables) -> DataFrame:
    return _detail_columns(sales_tax_run(t, sessions=_latest_sessions(t), **RUN).sales_tax_batch_details)


def _taxable_of_sessions(t: ln.Tables) -> DataFrame:
    return _batch_columns(ln.taxable_line_items(t, sessions=_latest_sessions(t), **RUN))


def outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as the runs of their customers: business date and time of publication run against each other."""
    o = spark.read.parquet(f"{sf_dir}/orders.parquet")
    code = F.when(F.col("o_orderstatus") == "F", 1).when(F.col("o_orderstatus") == "O", -102).otherwise(0)
    audit = o.select(
        F.col("o_custkey").alias("session_key"),
        F.concat(F.lit("run-"), F.col("o_orderkey").cast("string")).alias("run_id"),
        code.alias("return_code"),
        F.col("o_orderpriority").alias("return_message"),
        F.col("o_orderdate").cast("timestamp_ntz").alias("as_of"),
        F.make_timestamp_ntz(
            F.lit(2030) - F.year("o_orderdate"), F.lit(1), F.lit(1), F.lit(0), F.lit(0), F.lit(0)
        ).alias("published_at"),
    )
    return latest_outcomes(audit).select("session_key", "run_id", "return_code", "return_message")


def _event_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table written as log lines: level by event type, log name by user."""
    level = (
        F.when(F.col("event_type") == "error", "ERROR")
        .when(F.col("event_type") == "view", "TRACE")
        .when(F.col("event_type") == "click", "DEBUG")
        .otherwise("INFO")
    )
    name = F.when(F.col("event_type") == "purchase", "App-ApiTiming").otherwise("App-ApiContent")
    at = F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSS")
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    return events.select("event_id", "props", at.alias("at"), level.alias("level"), name.alias("name"))


def _log_columns(df: DataFrame) -> DataFrame:
    return df.select(
        F.date_format("logged_at", "yyyy-MM-dd HH:mm:ss.SSSS").alias("logged_at"), "level", "log_name", "message",
        F.col("day").cast("string").alias("day"),
    )


def log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _event_log(spark, sf_dir)
    line = F.concat(
        F.lit("DateTime: "), "at", F.lit("|MessageLevel:"), "level", F.lit("|LogName:"), "name", F.lit("|"),
        F.col("event_id").cast("string"), F.lit(" | "), "props",
    )
    return _log_columns(parse_log_lines(e.select(line.alias("value"))))


def log_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records whose messages have several lines, as ``read_log_records`` gives them."""
    e = _event_log(spark, sf_dir)
    record = F.concat(
        F.col("at"), F.lit("|MessageLevel:"), "level", F.lit("|LogName:"), "name", F.lit("|"),
        F.col("event_id").cast("string"), F.lit("\n  at "), "props", F.lit("\r\n"),
    )
    return _log_columns(parse_log_lines(e.select(record.alias("value"))))


def _damaged_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event log with records that fit no layout (every seventh) or have an unknown level (purchases)."""
    e = _event_log(spark, sf_dir)
    label = F.when(F.col("event_id") % 7 == 0, "Log:").otherwise("LogName:")
    level = F.when(F.col("name") == "App-ApiTiming", "NOTICE").otherwise(F.col("level"))
    record = F.concat(
        F.lit("DateTime: "), "at", F.lit("|MessageLevel:"), level, F.lit("|"), label, "name", F.lit("|"),
        F.col("event_id").cast("string"), F.lit("\n  at "), "props",
    )
    return e.select(record.alias("value"))


def rejected_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rejected_records(label_log_records(_damaged_log(spark, sf_dir)))


def log_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many records had each verdict, as they were counted while they were written; read = all the others together."""
    folder = f"{shared_folder(spark)}/mailtax-{uuid.uuid4()}"
    counts = write_labelled(label_log_records(_damaged_log(spark, sf_dir)), folder)
    return spark.createDataFrame(sorted(counts.items()), "verdict string, records bigint")


def streamed_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The damaged log as files, streamed to its end: kept and rejected records."""
    folder = f"{shared_folder(spark)}/mailtax-{uuid.uuid4()}"
    _damaged_log(spark, sf_dir).write.text(f"{folder}/in")
    query = stream_labelled_logs(spark, f"{folder}/in", f"{folder}/out", f"{folder}/checkpoint")
    query.awaitTermination()
    found = read_labelled(spark, f"{folder}/out")
    return found.select(
        F.date_format("logged_at", "yyyy-MM-dd HH:mm:ss.SSSS").alias("logged_at"), "level", "log_name", "message",
        "verdict", "reason", "raw",
    )


def log_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _event_log(spark, sf_dir)
    block = F.concat(
        F.lit("DateTime: "), "at", F.lit("\r\nLogLevel: "), "level", F.lit("\r\nMessage: "),
        F.col("event_id").cast("string"), F.lit("\r\n"), "props", F.lit("\r\n\r\n"),
    )
    return _log_columns(parse_log_blocks(e.select(block.alias("value")), log_name="App-Application"))


def nested_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    time = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    text = F.col("props")
    for level in (3, 2, 1):
        name = F.concat(F.col("event_id").cast("string"), F.lit(f"-{level}"))
        text = F.to_json(F.struct(name.alias("Name"), time.alias("Time"), text.alias("Data")))
    opened = unwrap_nested_json(e.select(text.alias("value")))
    times = {c: F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS") for c in ("time1", "time2", "time3")}
    return opened.withColumns(times)


def payload_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payloads of depth 1 to 5; the innermost of every eleventh is cut off."""
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    time = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    depth = F.col("event_id") % 5 + 1
    text = F.col("props")
    for level in (5, 4, 3, 2, 1):
        name = F.concat(F.col("event_id").cast("string"), F.lit(f"-{level}"))
        inner = F.when((depth == level) & (F.col("event_id") % 11 == 0), F.lit('{"Name": "cut o')).otherwise(text)
        text = F.when(depth >= level, F.to_json(F.struct(name.alias("Name"), time.alias("Time"), inner.alias("Data")))).otherwise(text)
    opened = unwrap_json_levels(e.select(F.col("event_id").alias("id"), text.alias("value")))
    return _whole(opened.withColumn("time", F.date_format("time", "yyyy-MM-dd HH:mm:ss.SSSSSS")), "level")


def _over_standins(job: Callable[[ln.Tables], DataFrame]) -> Query:
    return lambda spark, sf_dir: job(standin_tables(spark, sf_dir))


JOBS: dict[str, Callable[[ln.Tables], DataFrame]] = {
    "rate_distribution": lambda t: _distribution_columns(al.rate_distribution(_native_addresses(t))),
    "rate_distribution_line_bridge": lambda t: _distribution_columns(_bridged(t, "taxable_line_item")),
    "rate_distribution_tag_bridge": lambda t: _distribution_columns(_bridged(t, "provenance_tag")),
    "sales_tax_allocation": lambda t: _detail_columns(al.delivery_details(al.allocate(cut(_native_addresses(t))))),
    "sales_tax_service_lines": lambda t: _detail_columns(al.service_lines(t, _taxed(t))),
    "sales_tax_address_fill": lambda t: _detail_columns(
        al.fill_blank_addresses(t, al.delivery_details(al.allocate(cut(_native_addresses(t)))))
    ),
    "sales_tax_details": lambda t: _detail_columns(_sales_tax_details(t)),
    "taxable_line_items": lambda t: _batch_columns(ln.taxable_line_items(t, **RUN)),
    "session_line_item_batches": lambda t: _batch_columns(ln.session_line_item_batches(t, **RUN)),
    "session_line_item_batches_strict": lambda t: _batch_columns(
        ln.session_line_item_batches(t, strict=True, **RUN)
    ),
    "non_service_line_items": lambda t: ln.non_service_line_items(t),
    "infer_host_system": _host,
    "host_of_batches": lambda t: _whole(
        ln.host_of_batches(t, {"loader-F": 1, "loader-O": 2}), "host_system_id"
    ),
    "line_item_batches_by_module": lambda t: ln.line_item_batches_by_module(t, ln.session_lines(t)),
    "calculator_transaction_type": lambda t: ql.calculator_transaction_type(t, ln.session_lines(t)),
    "qualify_details": _qualified,
    "qualify_details_bucketed": _qualified_in_buckets,
    "reconcile_quantity": lambda t: ql.reconcile_quantity(_quantities(t)),
    "qualification_summary": _summary,
    "qualification_summary_mismatched": lambda t: _summary(t, only_mismatched=True),
    "qualification_log": lambda t: ql.qualification_log(_quantities(t)),
    "mismatched_details": _mismatched,
    "delivery_point_preview": _preview,
    "generate_delivery_points": _points,
    "generate_billing_transactions": _transactions,
    "link_details_to_transactions": _links,
    "link_details_last_wins": lambda t: _links(t, last_wins=True),
    "session_line_links": _session_links,
    "invoice_warnings": _warnings,
    "referential_checks": _checks,
    "category_totals": lambda t: rp.category_totals(t, ln.session_line_item_batches(t, **RUN)),
    "return_update_counts": lambda t: rp.return_update_counts(t),
    "line_item_details": lambda t: rp.line_item_details(t),
    "transactions_for_line": _transactions_of_lines,
    "session_line_item_report": lambda t: rp.session_line_item_report(t),
    "active_clients": lambda t: rp.active_clients(t, as_of=AS_OF),
    "clients_with_invoices": lambda t: rp.clients_with_invoices(t),
    "invoices_for_client": _invoices,
    "activity_category_types": lambda t: rp.activity_category_types(t, ln.session_lines(t)),
    "non_service_lines_with_item": lambda t: rp.non_service_lines_with_item(t),
    "non_service_lines_with_catalogue_item": lambda t: rp.non_service_lines_with_item(
        t, through_catalogue=True
    ),
    "sales_tax_run": _run,
    "sales_tax_run_sessions": _run_of_sessions,
    "taxable_line_items_sessions": _taxable_of_sessions,
    "sales_tax_run_batches": _run_batches,
    "sales_tax_run_zero_warnings": _run_zero_warnings,
    "sales_tax_run_outcomes": _run_outcomes,
    "sales_tax_run_good_sessions": _run_of_good_sessions,
}


def all_queries() -> dict[str, Query]:
    found = {name: _over_standins(job) for name, job in JOBS.items()}
    found["parse_log_lines"] = log_lines
    found["parse_log_records"] = log_records
    found["latest_outcomes"] = outcomes
    found["parse_log_blocks"] = log_blocks
    found["rejected_log_records"] = rejected_logs
    found["log_record_counts"] = log_verdicts
    found["stream_log_records"] = streamed_logs
    found["unwrap_nested_json"] = nested_payloads
    found["unwrap_json_levels"] = payload_levels
    return found
