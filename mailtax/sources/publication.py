"""Atomic publication of runs: attempts, manifests, and the removal of what no manifest names.

Every try of a run writes to folders of its own, ``root/<table>/run_id=<id>/attempt=<attempt>``, so two writers of one id
never touch each other's files. A try becomes visible with a small file that names its attempt, and how many rows it wrote to
which table:

* ``root/manifests/<id>`` for a run that is published. It is created only where there is none, so of two writers of one id one
  wins and the other is refused;
* ``root/manifests/<id>.failed-<attempt>`` for a try that failed; the id may be tried again.

Readers list the manifests and open the folders of the runs they need, nothing else. ``remove_superseded`` withdraws the manifests
of runs that no session's latest results or outcome come from, and deletes folders that no manifest names, both only after a
time of grace, so readers that are open keep their files. The file system must create files atomically where overwriting is
off, as HDFS and the object stores' connectors with conditional writes do.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Iterator
from dataclasses import asdict, dataclass, field
from datetime import UTC, datetime, timedelta

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

MANIFESTS, RETIRED = "manifests", "retired"


class RunIsPublished(ValueError):
    """The id of a published run is taken."""

    def __init__(self, run_id: str):
        super().__init__(f"run {run_id!r} is published; choose another id")


@dataclass(frozen=True)
class Manifest:
    """What one try of a run left: its attempt, whether it is published, and the rows of its tables."""

    run_id: str
    attempt: str
    published: bool
    rows: dict[str, int] = field(default_factory=dict)
    retired_at: float | None = None

    @property
    def name(self) -> str:
        return self.run_id if self.published else f"{self.run_id}.failed-{self.attempt}"

    def folder(self, root: str, table: str) -> str:
        return attempt_folder(root, table, self.run_id, self.attempt)


def check_run_id(run_id: str) -> None:
    if not re.fullmatch(r"[A-Za-z0-9._-]+", run_id) or ".failed-" in run_id:
        raise ValueError(f"a run id may hold letters, digits, dots, hyphens and underscores only, not {run_id!r}")


def attempt_folder(root: str, table: str, run_id: str, attempt: str) -> str:
    return f"{root}/{table}/run_id={run_id}/attempt={attempt}"


class Files:
    """The few file operations that publication needs, on whatever file system ``root`` is on."""

    def __init__(self, spark: SparkSession, root: str):
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(root).getFileSystem(spark._jsc.hadoopConfiguration())
        self._read = spark._jvm.org.apache.commons.io.IOUtils.toString

    def create(self, path: str, text: str) -> bool:
        """Write a file that must not exist yet; False if it does."""
        try:
            out = self._fs.create(self._path(path), False)
        except Py4JJavaError as error:
            if "AlreadyExists" in error.java_exception.getClass().getName():
                return False
            raise
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()
        return True

    def text(self, path: str) -> str:
        stream = self._fs.open(self._path(path))
        try:
            return self._read(stream, "UTF-8")
        finally:
            stream.close()

    def entries(self, path: str) -> Iterator[tuple[str, float]]:
        """Name and time of change of everything in a folder, nothing if there is no such folder."""
        at = self._path(path)
        if self._fs.exists(at):
            for status in self._fs.listStatus(at):
                yield status.getPath().getName(), status.getModificationTime() / 1000

    def delete(self, path: str) -> None:
        self._fs.delete(self._path(path), True)


def publish(spark: SparkSession, root: str, manifest: Manifest) -> None:
    """Make a try visible. A second published try of an id is refused and its folders are deleted."""
    files = Files(spark, root)
    text = json.dumps({k: v for k, v in asdict(manifest).items() if v is not None})
    free = not manifest.published or manifest.name not in {n for n, _ in files.entries(f"{root}/{RETIRED}")}
    if not (free and files.create(f"{root}/{MANIFESTS}/{manifest.name}", text)):
        for table in manifest.rows:
            files.delete(manifest.folder(root, table))
        raise RunIsPublished(manifest.run_id)


def manifests(spark: SparkSession, root: str, place: str = MANIFESTS) -> list[Manifest]:
    """All manifests, sorted by name; one that is just being written does not count yet. Their number is that of the runs since
    the last removal."""
    files = Files(spark, root)
    found = []
    for name, _ in sorted(files.entries(f"{root}/{place}")):
        if not name.startswith("."):
            try:
                found.append(Manifest(**json.loads(files.text(f"{root}/{place}/{name}"))))
            except json.JSONDecodeError:
                continue
    return found


def is_published(spark: SparkSession, root: str, run_id: str) -> bool:
    """Whether the id is taken by a published run, also by one that was withdrawn later."""
    files = Files(spark, root)
    return any(run_id == name for place in (MANIFESTS, RETIRED) for name, _ in files.entries(f"{root}/{place}"))


def read_attempts(spark: SparkSession, root: str, table: str, ddl: str, wanted: Iterable[Manifest]) -> DataFrame:
    """Rows of a table from the folders of the given tries alone, with their ``run_id``."""
    paths = [m.folder(root, table) for m in wanted if table in m.rows]
    ddl = ", ".join([ddl, *[c for c in ("session_key bigint", "run_id string") if not re.search(rf"\b{c.split()[0]} ", ddl)]])
    if not paths:
        return spark.createDataFrame([], ddl)
    rows = spark.read.schema(ddl + ", attempt string").option("basePath", f"{root}/{table}").parquet(*paths)
    return rows.drop("attempt")


def remove_superseded(
    spark: SparkSession, root: str, tables: Iterable[str], live: set[str], *, grace: timedelta, now: datetime | None = None
) -> dict[str, list[str]]:
    """Withdraw the manifests not named in ``live`` and delete folders that nothing names.

    A withdrawn run is out of sight for readers at once, but its folders stay for ``grace``; so do folders younger than that without a
    manifest, which may belong to a run at work. ``grace`` must exceed the longest run and the longest read. Returns the
    names of what was withdrawn and the folders deleted.
    """
    files = Files(spark, root)
    at = (now or datetime.now(UTC)).timestamp()
    withdrawn = []
    for m in manifests(spark, root):
        if m.name not in live:
            files.create(f"{root}/{RETIRED}/{m.name}", json.dumps({**asdict(m), "retired_at": at}))
            files.delete(f"{root}/{MANIFESTS}/{m.name}")
            withdrawn.append(m.name)
    named = {(m.run_id, m.attempt) for m in manifests(spark, root)}
    named |= {(m.run_id, m.attempt) for m in manifests(spark, root, RETIRED) if at - m.retired_at < grace.total_seconds()}
    retired = {(m.run_id, m.attempt) for m in manifests(spark, root, RETIRED)}
    deleted = []
    for table in tables:
        for run, _ in files.entries(f"{root}/{table}"):
            for attempt, changed in files.entries(f"{root}/{table}/{run}"):
                key = (run.removeprefix("run_id="), attempt.removeprefix("attempt="))
                if not attempt.startswith("attempt=") or key in named:
                    continue
                if key in retired or at - changed >= grace.total_seconds():
                    files.delete(f"{root}/{table}/{run}/{attempt}")
                    deleted.append(f"{table}/{run}/{attempt}")
    return {"withdrawn": withdrawn, "deleted": deleted}
