"""Outcomes per session, atomic publication, and the removal of superseded runs."""

from __future__ import annotations

import os
from concurrent.futures import ThreadPoolExecutor
from datetime import UTC, datetime, timedelta

import pytest
from conftest import AS_OF
from pyspark.sql import functions as F
from test_run import EXPECTED, USER, detail_rows, world  # noqa: F401

from mailtax.plans import run as plan
from mailtax.plans.run import run_sales_tax, sales_tax_run, session_outcomes, with_session
from mailtax.sources import publication
from mailtax.sources.publication import Manifest, RunIsPublished, manifests, publish
from mailtax.sources.tables import (
    last_outcomes,
    read_published,
    read_run,
    remove_superseded,
    row_counts,
    write_run,
)

ROW = "session_key bigint, session_id string, client_configuration_key bigint"


def outcomes(spark, t, root):
    return {r["session_key"]: (r["return_code"], r["return_message"]) for r in session_outcomes(spark, t, root).collect()}


def no_pieces(t, world):  # noqa: F811
    return world(delivery_points=[{**r.asDict(), "quantity": 0} for r in t["delivery_points"].collect()])


def test_nothing_was_run_yet(world, spark, tmp_path):  # noqa: F811
    root = str(tmp_path / "never")
    t = world()
    assert outcomes(spark, t, root) == {k: (0, "Process not completed.") for k in (1, 2, 3)}
    assert read_published(spark, root, "sales_tax_batch_details").isEmpty()
    assert last_outcomes(spark, root).isEmpty() and row_counts(spark, root).isEmpty()
    assert remove_superseded(spark, root, grace=timedelta(0)) == {"withdrawn": [], "deleted": []}


def test_one_session_fails_alone(world, spark, tmp_path):  # noqa: F811
    """Session 1 has a batch without pieces: no result has a row of it, sessions 2 and 3 are published, their codes differ."""
    root = str(tmp_path / "out")
    good = world()
    bad = no_pieces(good, world)
    run = sales_tax_run(bad, as_of=AS_OF, user=USER)
    assert [(r["session_key"], r["error"]) for r in run.failures.collect()] == [
        (1, "Batch 1: total quantity of a batch is zero")
    ]
    for name, rows in run.tables().items():
        assert with_session(rows).where("session_key = 1").isEmpty(), name
    assert [r["session_key"] for r in run.invoice_warnings.collect()] == [2]

    assert run_sales_tax(good, root, "run-1", as_of=AS_OF, user=USER) == (1, "Success")
    code, message = run_sales_tax(bad, root, "run-2", as_of=AS_OF, user=USER)
    assert (code, message) == (-102, "Error creating the sales tax batches. 1 of 3 sessions failed.")
    error = "Error creating the sales tax batches. Batch 1: total quantity of a batch is zero"
    assert outcomes(spark, good, root) == {1: (-102, error), 2: (1, "Success"), 3: (1, "Success")}
    # Session 1 keeps the results of its last good run, sessions 2 and 3 have those of the second.
    assert detail_rows(read_published(spark, root, "sales_tax_batch_details")) == EXPECTED
    runs = read_published(spark, root, "invoice_warnings").select("session_key", "run_id").collect()
    assert [tuple(r) for r in runs] == [(2, "run-2")]


def test_quantity_out_of_range_fails_its_session(world, spark):  # noqa: F811
    t = world()
    points = [r.asDict() for r in t["delivery_points"].collect()]
    huge = world(delivery_points=[{**p, "quantity": 2**62} for p in points])
    run = sales_tax_run(huge, as_of=AS_OF, user=USER)
    assert [tuple(r) for r in run.failures.collect()] == [(1, "Batch 1: quantity of a batch is out of range")]
    assert run.sales_tax_batch_details.isEmpty() and run.invoice_warnings.count() == 1
    with pytest.raises(Exception, match="OVERFLOW"):
        sales_tax_run(huge, as_of=AS_OF, user=USER, on_zero="raise").sales_tax_batch_details.collect()
    with pytest.raises(ValueError, match="on_zero"):
        sales_tax_run(t, as_of=AS_OF, user=USER, on_zero="ignore")


def test_two_writers_of_one_id(spark, tmp_path):
    """Of many writers that finish at once exactly one publishes; the others are refused and leave no files."""
    root = str(tmp_path)
    rows = spark.createDataFrame([(1, "s1", 9)], ROW)
    tries = [Manifest("run-1", f"a{k}", True, {"sessions": 1}) for k in range(6)]
    for m in tries:
        write_run(rows, root, "sessions", "run-1", attempt=m.attempt)

    def attempt(m):
        try:
            publish(spark, root, m)
        except RunIsPublished:
            return False
        return True

    with ThreadPoolExecutor(6) as pool:
        won = list(pool.map(attempt, tries))
    assert sum(won) == 1
    winner = tries[won.index(True)]
    assert manifests(spark, root) == [winner]
    assert os.listdir(f"{root}/sessions/run_id=run-1") == [f"attempt={winner.attempt}"]
    assert read_run(spark, root, "sessions", "run-1").count() == 1


def test_the_slower_of_two_runs_is_refused(world, spark, tmp_path, monkeypatch):  # noqa: F811
    """Another writer publishes the same id between this run's check and its audit rows."""
    root = str(tmp_path / "out")
    t = world()
    inner = plan.sales_tax_run
    other = []

    def slow(*args, **options):
        if not other:
            other.append(True)
            assert run_sales_tax(t, root, "run-1", as_of=AS_OF, user="other") == (1, "Success")
        return inner(*args, **options)

    monkeypatch.setattr(plan, "sales_tax_run", slow)
    with pytest.raises(ValueError, match="published"):
        run_sales_tax(t, root, "run-1", as_of=AS_OF, user=USER)
    rows = read_published(spark, root, "sales_tax_batch_details")
    assert detail_rows(rows) == EXPECTED and {r["user_added"] for r in rows.collect()} == {"other"}
    assert len(os.listdir(f"{root}/sales_tax_batch_details/run_id=run-1")) == 1


def test_readers_open_live_folders_only(world, spark, tmp_path):  # noqa: F811
    """Neither superseded nor unnamed nor failed folders are in the plan."""
    root = str(tmp_path / "out")
    t = world()
    for k in (1, 2):
        run_sales_tax(t, root, f"run-{k}", as_of=AS_OF, user=USER)
    first = spark.createDataFrame([(1,)], "session_key bigint")
    run_sales_tax(t, root, "run-3", sessions=first, as_of=AS_OF, user=USER)
    run_sales_tax(no_pieces(t, world), root, "run-4", as_of=AS_OF, user=USER, on_zero="raise")
    write_run(t["sessions"].limit(0), root, "sales_tax_batches", "run-5", attempt="lost")
    rows = read_published(spark, root, "sales_tax_batches")
    opened = {f.split("run_id=")[1].split("/")[0] for f in rows.inputFiles() if "/sales_tax_batches/" in f}
    assert opened == {"run-2", "run-3"}
    assert sorted(r["sales_tax_batch_key"] for r in rows.collect()) == [1, 2, 3]


def test_rows_are_counted_as_they_are_written(world, spark, tmp_path):  # noqa: F811
    root = str(tmp_path / "out")
    run_sales_tax(world(), root, "run-1", as_of=AS_OF, user=USER)
    counts = {r["table_name"]: r["rows"] for r in row_counts(spark, root).collect()}
    assert counts["run_audit"] == 3 and counts["sales_tax_batch_details"] == 6 and counts["zero_quantity_warnings"] == 0
    assert counts == {name: read_run(spark, root, name, "run-1").count() for name in counts}


def test_removal_spares_open_readers(world, spark, tmp_path):  # noqa: F811
    root = str(tmp_path / "out")
    t = world()
    run_sales_tax(t, root, "run-1", as_of=AS_OF, user="first")
    open_reader = read_published(spark, root, "sales_tax_batch_details")
    run_sales_tax(no_pieces(t, world), root, "run-2", as_of=AS_OF, user=USER, on_zero="raise")
    run_sales_tax(t, root, "run-2", as_of=AS_OF, user=USER)
    write_run(t["sessions"], root, "sessions", "run-9", attempt="crashed")

    done = remove_superseded(spark, root, grace=timedelta(hours=1))
    assert done["withdrawn"][0] == "run-1" and len(done["withdrawn"]) == 2 and done["deleted"] == []
    assert {r["user_added"] for r in open_reader.collect()} == {"first"} and open_reader.count() == 6
    assert {r["user_added"] for r in read_published(spark, root, "sales_tax_batch_details").collect()} == {USER}
    assert outcomes(spark, t, root) == {k: (1, "Success") for k in (1, 2, 3)}
    with pytest.raises(ValueError, match="published"):  # the id stays taken
        run_sales_tax(t, root, "run-1", as_of=AS_OF, user=USER)

    later = datetime.now(UTC) + timedelta(hours=2)
    deleted = remove_superseded(spark, root, grace=timedelta(hours=1), now=later)["deleted"]
    assert "sessions/run_id=run-9/attempt=crashed" in deleted
    assert sum(d.startswith("sales_tax_batch_details/run_id=run-1/") for d in deleted) == 1
    assert detail_rows(read_published(spark, root, "sales_tax_batch_details")) == EXPECTED
    assert not any("run_id=run-1/" in f for f in read_published(spark, root, "run_audit").inputFiles())


def test_half_written_manifests_and_odd_ids(spark, tmp_path):
    root = str(tmp_path)
    files = publication.Files(spark, root)
    assert files.create(f"{root}/manifests/run-1", "") and not files.create(f"{root}/manifests/run-1", "x")
    assert manifests(spark, root) == []
    for bad in ("../x", "a/b", "a.failed-b", ""):
        with pytest.raises(ValueError, match="run id"):
            write_run(spark.createDataFrame([], ROW), root, "sessions", bad)


def test_totals_need_no_sort(spark):
    """The first aggregation, over all addresses, is by hash; only rows near the last one are compared as texts."""
    from mailtax.operators import allocate

    rows = [(b, 1, f"C{n}", "S", f"{10000 + n}" if n % 3 else None, "D", 6, None, True, 9, n) for b in (1, 2) for n in range(50)]
    ddl = ("sales_tax_batch_key long, session_key long, city string, state_region string, postal_code string, destination_code string, "
           "rate_type_key long, unit_price decimal(19,4), is_exportable boolean, client_configuration_key long, quantity long")
    df = spark.createDataFrame(rows, ddl).withColumn("extended_amount", F.lit(100).cast("decimal(19,4)"))
    plans = []
    original = allocate.cut

    def watched(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return original(df)

    allocate.cut = watched
    try:
        found = allocate.spread(df)
    finally:
        allocate.cut = original
    assert "HashAggregate" in plans[0] and "SortAggregate" not in plans[0] and "ObjectHash" not in plans[0]
    assert len(plans) == 2 and "LeftSemi" in plans[1]
    last = {r["batch"]: (r["last"]["postal_code"], r["last"]["last_quantity"]) for r in found.totals.collect()}
    assert last == {1: ("10049", 49), 2: ("10049", 49)}


def test_postal_numbers_keep_the_order(spark, rng=None):
    import random

    from mailtax.operators.allocate import _postal_number

    rng = random.Random(3)
    codes = [None, "", "\0", "0", "00", "12345", "12345-6789", "12345-6788", "é1", "Zürich", "漢字漢字", "ZZZZZZZZZ"]
    codes += ["".join(rng.choices("019AZ é", k=rng.randint(0, 9))) for _ in range(300)]
    rows = spark.createDataFrame([(c,) for c in codes], "postal_code string").select("postal_code", _postal_number().alias("n")).collect()
    rows.sort(key=lambda r: (r["postal_code"] is not None, (r["postal_code"] or "").encode()))
    numbers = [r["n"] for r in rows]
    assert numbers == sorted(numbers)
