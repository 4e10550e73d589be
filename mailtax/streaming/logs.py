"""The log parser as a stream: new files are parsed once and appended per day and level."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from mailtax.sources.logs import RECORD_START, label_log_records, parse_log_lines, write_labelled


def stream_logs(
    spark: SparkSession,
    source: str,
    target: str,
    checkpoint: str,
    *,
    min_level: str = "DEBUG",
    log_names: list[str] | None = None,
) -> StreamingQuery:
    """Parse the log files that have arrived in ``source`` and stop when all are done.

    The parser keeps no state, so a run may be repeated at any interval with the same ``checkpoint``.
    """
    lines = spark.readStream.option("lineSep", f"\n{RECORD_START}").text(source)
    records = parse_log_lines(lines, min_level=min_level, log_names=log_names)
    return (
        records.writeStream.format("parquet")
        .partitionBy("day", "level")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


LABELLED = (
    "logged_at timestamp_ntz, log_name string, message string, reason string, raw string, batch_id bigint, verdict string, day date, "
    "level string"
)


def stream_labelled_logs(
    spark: SparkSession, source: str, target: str, checkpoint: str, *, log_name: str | None = None, **options
) -> StreamingQuery:
    """Label the records of the files that have arrived in ``source`` (either layout, see ``label_log_records``) and write kept
    and rejected ones, one folder per micro-batch.

    A batch that is repeated after a failure has the same number and the same files, so it replaces its folder: no record is
    lost or doubled.
    """
    lines = spark.readStream.option("lineSep", f"\n{RECORD_START}").text(source)
    labelled = label_log_records(lines, log_name=log_name, **options)

    def store(batch: DataFrame, batch_id: int) -> None:
        write_labelled(batch, f"{target}/batch_id={batch_id}")

    return (
        labelled.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def read_labelled(spark: SparkSession, target: str) -> DataFrame:
    """What ``stream_labelled_logs`` wrote, with the columns of ``label_log_records``."""
    return spark.read.schema(LABELLED).option("basePath", target).parquet(target).drop("batch_id")
