"""The whole tax run for any number of sessions, and its publication."""

from __future__ import annotations

import uuid
from collections import ChainMap
from dataclasses import dataclass
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mailtax.functions.staging import cut, cut_in_buckets, scratch
from mailtax.operators import allocate, lines, points, qualify
from mailtax.operators.lines import Tables
from mailtax.sources.publication import Manifest, RunIsPublished, check_run_id, publish
from mailtax.sources.tables import is_published, last_outcomes, write_run

SUCCESS, NOT_COMPLETED, FAILED = 1, 0, -102


@dataclass(frozen=True)
class TaxRun:
    """Results of a run; all of them read the stored piece matching and line status. ``failures``: ``session_key, error``."""

    transactions: DataFrame
    delivery_points: DataFrame
    category_detail_links: DataFrame
    session_line_links: DataFrame
    invoice_warnings: DataFrame
    sales_tax_batch_details: DataFrame
    sales_tax_batches: DataFrame
    zero_quantity_warnings: DataFrame
    failures: DataFrame

    def tables(self) -> dict[str, DataFrame]:
        return {name: rows for name, rows in vars(self).items() if name != "failures"}


ON_ZERO = ("session", "warn", "raise")


def sales_tax_run(
    t: Tables,
    *,
    sessions: DataFrame | None = None,
    as_of: datetime,
    user: str,
    on_zero: str = "session",
) -> TaxRun:
    """Generate what is missing, then tax everything, for all sessions in one set of jobs.

    The lines, the match of their details with the hosts' pieces, and the line status are stored, since the
    later results all read them. A line whose transaction was generated with addresses takes them from that
    transaction, every other line from its details. A batch whose amount cannot be spread (nothing to spread it over, or a
    quantity beyond 64 bits) fails its session: the session is listed in ``failures`` with the first such batch, and no result has
    rows of it, while all other sessions go through. With ``on_zero='warn'`` only the batch is left out, header and details,
    and listed in ``zero_quantity_warnings``; with ``on_zero='raise'`` the run stops.
    """
    if on_zero not in ON_ZERO:
        raise ValueError(f"on_zero must be one of {ON_ZERO}, not {on_zero!r}")
    made = generate(t, sessions, amounts=True, vendor_items=False)
    status, pieces = made.status, made.pieces
    counts = cut(points.point_counts(status, pieces))
    new_points = points.delivery_points_of(counts, as_of=as_of)
    links = points.session_line_links(status)
    generated = points.accepted(status).where("has_address").select("invoice_line_item_key")

    flagged = lines.flag_generated(made.invoiced, generated)
    taxed = cut(lines.taxable_lines(lines.with_catalogue(t, flagged)))
    with_new = ChainMap(
        {"taxable_line_items": points.taxable_line_items_of(links), "delivery_points": new_points}, t
    )
    new = F.coalesce("is_generated", F.lit(False))
    flag = on_zero != "raise"
    native = allocate.batch_addresses(t, taxed.where(~new), linked=made.linked, flag_overflow=flag)
    by_line = allocate.batch_addresses(with_new, taxed.where(new), bridge="taxable_line_item", flag_overflow=flag)
    addresses = cut(native.unionByName(by_line))
    spread = allocate.spread(addresses, allocate.client_homes(t))
    failures = allocate.failed_sessions(spread)
    failures = cut(failures if on_zero == "session" else failures.limit(0))
    if not failures.isEmpty():
        status, taxed, counts = (without(failures, df) for df in (status, taxed, counts))
        new_points = points.delivery_points_of(counts, as_of=as_of)
        spread = allocate.Spread(without(failures, spread.rows), without(failures, spread.totals, "session"))
    warnings = cut(allocate.zero_quantity_warnings(spread, as_of=as_of, user=user))
    left_out = warnings.select(F.col("sales_tax_batch_key").alias("invoice_line_item_key"))
    return TaxRun(
        transactions=points.generate_billing_transactions(status, as_of=as_of),
        delivery_points=new_points,
        category_detail_links=points.link_details_to_transactions(status, pieces),
        session_line_links=points.session_line_links(status),
        invoice_warnings=points.invoice_warnings(status, as_of=as_of, user=user),
        sales_tax_batch_details=allocate.sales_tax_details(
            t, taxed, spread, as_of=as_of, user=user, on_zero="warn" if on_zero == "warn" else "raise"
        ),
        sales_tax_batches=lines.batch_headers(
            t, taxed.join(left_out, "invoice_line_item_key", "left_anti"), as_of=as_of, user=user
        ),
        zero_quantity_warnings=warnings,
        failures=failures,
    )


def without(failures: DataFrame, rows: DataFrame, session: str = "session_key") -> DataFrame:
    """Rows of the sessions that did not fail."""
    return rows.join(failures.select(F.col("session_key").alias(session)), session, "left_anti")


def with_session(rows: DataFrame) -> DataFrame:
    """Rows with their session, which generated ones only name in their tag."""
    if "session_key" in rows.columns:
        return rows
    return rows.withColumn("session_key", F.split("user_added", "[|]")[1].cast("bigint"))


@dataclass(frozen=True)
class Generation:
    """Stored stages of the generation: the transactions behind the activities (stored where an allocation or a small scope reads
    them again), lines with coverage (``invoiced`` as they are stored by line, without the catalogue's columns), matched pieces, and
    the status of each line."""

    linked: DataFrame
    invoiced: DataFrame
    lines: DataFrame
    pieces: DataFrame
    status: DataFrame


AMOUNTS = ["group_key", "client_configuration_key", "rate", "extended_amount"]


def generate(
    t: Tables,
    sessions: DataFrame | None = None,
    *,
    amounts: bool = False,
    piece_ids: bool = False,
    places: bool = True,
    detail_keys: bool = True,
    vendor_items: bool = True,
) -> Generation:
    """Match and classify the lines that lack delivery points.

    Columns that the generation does not read are neither shuffled nor stored unless they are asked for: what the allocation
    needs of the lines (``amounts``), and the id the pieces were matched by (``piece_ids``). Jobs that tell no address leave out
    the ``places`` of the records, those that tell no detail the ``detail_keys``, those that tell no vendor item the ``vendor_items``.
    """
    few = lines.is_few(t, sessions)
    linked = lines.linked_transactions(t, sessions)
    linked = cut(linked) if few or amounts else linked
    customers = qualify.session_customers(t, lines.scoped_sessions(t, sessions) if few else None)
    invoiced = lines.invoiced_covered_lines(t, sessions, linked=linked, customers=customers)
    untold = [*([] if amounts else AMOUNTS), *([] if vendor_items else ["vendor_item_key"])]
    invoiced, rows = cut_in_buckets(invoiced.drop(*untold), "invoice_line_item_key")
    todo = lines.non_service_lines(lines.with_catalogue(t, rows))
    pieces = qualify.match_pieces(t, todo, few=few, places=places).drop("category_key")
    kept = {"data_stream_detail_id": piece_ids, "detail_key": detail_keys}
    pieces = cut(pieces.drop(*[c for c, keep in kept.items() if not keep]))
    covered = lines.with_catalogue(t, invoiced)
    status = cut(qualify.line_status(t, lines.non_service_lines(covered), pieces, few=few))
    return Generation(linked, invoiced, covered, pieces, status)


def run_sales_tax(
    t: Tables,
    root: str,
    run_id: str,
    *,
    sessions: DataFrame | None = None,
    as_of: datetime,
    user: str,
    on_zero: str = "session",
) -> tuple[int, str]:
    """Run, write all result tables under ``root`` and, last, one audit row per session, and publish them with a manifest.

    A session that fails has an outcome of its own and no rows; the others are published. Whatever else stops the run fails all its
    sessions. Readers go by the manifests (``read_published``), so a failed run changes nothing for them and a later run
    replaces the earlier results of its sessions. A run that failed as a whole may be tried again under its id; the id of a
    published run is refused, also where another writer published it meanwhile. Intermediate results are deleted after the
    audit rows. Returns 1 and 'Success', or -102 and what failed.
    """
    scope = lines.scoped_sessions(t, sessions)
    spark = scope.sparkSession
    check_run_id(run_id)
    if is_published(spark, root, run_id):
        raise RunIsPublished(run_id)
    attempt, counts = uuid.uuid4().hex, {}
    with scratch(spark):
        try:
            results = sales_tax_run(t, sessions=sessions, as_of=as_of, user=user, on_zero=on_zero)
            for table, rows in results.tables().items():
                counts[table] = write_run(with_session(rows), root, table, run_id, cluster_by="session_key", attempt=attempt)
            failures, code, message = results.failures, SUCCESS, "Success"
        except Exception as error:  # whatever stopped the run becomes its outcome
            failures, code, message = None, FAILED, f"{ERROR}{error}"
        now = datetime.now(UTC).replace(tzinfo=None)
        audit = run_outcome(scope, code, message, as_of=as_of, published_at=now, failures=failures)
        counts["run_audit"] = write_run(audit, root, "run_audit", run_id, attempt=attempt)
        publish(spark, root, Manifest(run_id, attempt, code == SUCCESS, counts))
        if failures is not None and (failed := failures.count()):
            return FAILED, f"{ERROR}{failed} of {counts['run_audit']} sessions failed."
    return code, message


ERROR = "Error creating the sales tax batches. "


def run_outcome(
    sessions: DataFrame, code: int, message: str, *, as_of: datetime, published_at: datetime, failures: DataFrame | None = None
) -> DataFrame:
    """Audit rows of a run: code and message for each of its sessions, for those in ``failures`` (``session_key, error``) their own.
    ``as_of`` is the business date, ``published_at`` (UTC) decides which run of a session is the latest."""
    code, message = F.lit(code), F.lit(message)
    if failures is not None:
        sessions = sessions.join(failures, "session_key", "left")
        failed = F.col("error").isNotNull()
        code = F.when(failed, FAILED).otherwise(code)
        message = F.when(failed, F.concat(F.lit(ERROR), "error")).otherwise(message)
    return sessions.select(
        "session_key",
        "session_id",
        code.alias("return_code"),
        message.alias("return_message"),
        F.lit(as_of).cast("timestamp_ntz").alias("as_of"),
        F.lit(published_at).cast("timestamp_ntz").alias("published_at"),
    )


def session_outcomes(spark: SparkSession, t: Tables, root: str) -> DataFrame:
    """Latest outcome of every session; a session that never got an audit row is 'not completed'."""
    return (
        t["sessions"]
        .select("session_key", "session_id")
        .join(last_outcomes(spark, root), "session_key", "left")
        .select(
            "session_key",
            "session_id",
            F.coalesce("return_code", F.lit(NOT_COMPLETED)).alias("return_code"),
            F.coalesce("return_message", F.lit("Process not completed.")).alias("return_message"),
            "as_of",
        )
    )
