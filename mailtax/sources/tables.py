"""Read the logical tables from files or a catalogue, and write and read published results."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from mailtax import schemas
from mailtax.sources import publication

GUID_COLUMNS = ("session_id", "status_id", "transaction_guid", "transaction_type_guid", "data_stream_detail_id",
                "return_detail_id", "return_reason_id", "client_configuration_id", "file_stream_config_id")


class LazyTables(Mapping[str, DataFrame]):
    """Tables built on first use, so that a job only resolves the ones it reads."""

    def __init__(self, builders: Mapping[str, Callable[[], DataFrame]]):
        self._builders = dict(builders)
        self._built: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = self._builders[name]()
        return self._built[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._builders)

    def __len__(self) -> int:
        return len(self._builders)


def read_tables(
    spark: SparkSession, locations: Mapping[str, str], *, data_format: str = "parquet"
) -> LazyTables:
    """``{logical name: location}`` to tables. A location with a slash is a path, else a catalogue name.

    Only the declared columns are read, cast to their declared types.
    """

    def load(name: str, location: str) -> DataFrame:
        raw = spark.read.format(data_format).load(location) if "/" in location else spark.table(location)
        return conform(raw, name)

    return LazyTables({n: (lambda n=n, loc=loc: load(n, loc)) for n, loc in locations.items()})


def conform(df: DataFrame, table: str) -> DataFrame:
    """Columns and types of the table's schema, GUIDs in lower case."""
    return df.select(
        *[
            (F.lower(f.name) if f.name in GUID_COLUMNS else F.col(f.name)).cast(f.dataType).alias(f.name)
            for f in schemas.schema(table)
        ]
    )


def write_run(
    df: DataFrame, root: str, table: str, run_id: str, *, cluster_by: str | None = None, attempt: str | None = None
) -> int:
    """Write one run's rows of a table and return how many they are, counted as they are written.

    With ``attempt`` they go to a folder of that try alone, which readers see once its manifest names it (``sources/publication``).
    Without, to ``root/table/run_id=...``, replacing what was there as a whole: a try without rows leaves none. Rows are
    clustered by key inside files, which lets readers skip files. The rebalance splits large keys over several files and
    merges small ones.
    """
    publication.check_run_id(run_id)
    counted = Observation(f"rows of {table}")
    out = df.drop("run_id")
    if cluster_by is not None:
        out = out.hint("rebalance", cluster_by).sortWithinPartitions(cluster_by)
    path = f"{root}/{table}/run_id={run_id}" if attempt is None else publication.attempt_folder(root, table, run_id, attempt)
    out.observe(counted, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(path)
    return counted.get["rows"]


def _ddl(table: str) -> str:
    return schemas.SCHEMAS[table]


def read_run(spark: SparkSession, root: str, table: str, run_id: str) -> DataFrame:
    """Rows that one run wrote: of its published try, else of all its failed ones; of a run without manifests what lies in its folder."""
    mine = [m for m in publication.manifests(spark, root) if m.run_id == run_id]
    done = [m for m in mine if m.published]
    if mine:
        return publication.read_attempts(spark, root, table, _ddl(table), done or mine)
    rows = spark.read.schema(_ddl(table) + ("" if "run_id" in schemas.columns(table) else ", run_id string"))
    return rows.option("basePath", f"{root}/{table}").parquet(f"{root}/{table}/run_id={run_id}")


def _audit(spark: SparkSession, root: str) -> DataFrame:
    found = publication.manifests(spark, root)
    return publication.read_attempts(spark, root, "run_audit", _ddl("run_audit"), found)


def read_published(spark: SparkSession, root: str, table: str) -> DataFrame:
    """Rows of the last successful run of each session; none if nothing was published yet.

    Only runs with a manifest count, and only the folders of those that some session's latest results come from are opened. What a
    failed or unfinished try left behind is never read.
    """
    good = latest_outcomes(_audit(spark, root).where(F.col("return_code") == 1)).select("run_id", "session_key")
    live = {r["run_id"] for r in good.select("run_id").distinct().collect()}
    wanted = [m for m in publication.manifests(spark, root) if m.published and m.run_id in live]
    rows = publication.read_attempts(spark, root, table, _ddl(table), wanted)
    return rows.join(good, ["run_id", "session_key"], "left_semi")


def last_outcomes(spark: SparkSession, root: str) -> DataFrame:
    """Code, message and times of each session's latest run; no rows if nothing ran yet."""
    return latest_outcomes(_audit(spark, root))


def latest_outcomes(audit: DataFrame) -> DataFrame:
    """Of audit rows the one published last per session, whatever business date its run was for."""
    last = F.max(F.struct("published_at", "run_id", "return_code", "return_message", "as_of")).alias("last")
    return audit.groupBy("session_key").agg(last).select("session_key", "last.*")


def is_published(spark: SparkSession, root: str, run_id: str) -> bool:
    """Whether a run of this id was published."""
    return publication.is_published(spark, root, run_id)


def row_counts(spark: SparkSession, root: str) -> DataFrame:
    """``run_id, attempt, published, table_name, rows``: how many rows every try wrote, from the manifests."""
    found = [(m.run_id, m.attempt, m.published, t, n) for m in publication.manifests(spark, root) for t, n in m.rows.items()]
    return spark.createDataFrame(found, "run_id string, attempt string, published boolean, table_name string, rows bigint")


def remove_superseded(spark: SparkSession, root: str, *, grace: timedelta, now: datetime | None = None) -> dict[str, list[str]]:
    """Withdraw runs that neither results nor the last outcome of any session come from, and delete what no manifest names, both
    with a time of grace for open readers (``sources/publication``)."""
    audit = _audit(spark, root)
    used = latest_outcomes(audit).select("run_id").union(latest_outcomes(audit.where("return_code = 1")).select("run_id"))
    ids = {r["run_id"] for r in used.distinct().collect()}
    every = publication.manifests(spark, root)
    done = {m.run_id for m in every if m.published}
    live = {m.name for m in every if m.run_id in ids and (m.published or m.run_id not in done)}
    return publication.remove_superseded(spark, root, schemas.SCHEMAS, live, grace=grace, now=now)
