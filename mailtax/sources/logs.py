"""Read application log lines and wrapped JSON payloads."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from mailtax.functions.staging import cut

# The two layouts, the levels from lowest to highest, and the lowest level kept.
PIPE_LAYOUT = ("DateTime: ", "MessageLevel:", "LogName:")
RECORD_START = "DateTime: "
BLOCK_LAYOUT = r"^DateTime: ([^\r\n]*)\r?\nLogLevel: ([^\r\n]*)\r?\nMessage: ((?s).*?)\s*$"
LEVELS = ("TRACE", "DEBUG", "INFO", "WARN", "ERROR", "FATAL")
MIN_LEVEL = "DEBUG"
PAYLOAD = "Name string, Time timestamp_ntz, Data string"


def kept_levels(min_level: str = MIN_LEVEL) -> tuple[str, ...]:
    return LEVELS[LEVELS.index(min_level):]


def read_log_records(spark: SparkSession, path: str) -> DataFrame:
    """Files of either layout, one record per row: a record goes on until a line break before the next start, so a message
    may have any number of lines, with either line end.

    The start belongs to the separator; the parsers put it back.
    """
    return spark.read.option("lineSep", f"\n{RECORD_START}").text(path)


def _whole_record() -> Column:
    """The record in column ``value`` with its start and without the line breaks that end it."""
    value = F.rtrim(F.col("value"), F.lit("\r\n"))
    return F.when(value.startswith(RECORD_START), value).otherwise(F.concat(F.lit(RECORD_START), value))


KEPT, BELOW, OTHER_LOG, REJECTED = "kept", "below level", "other log", "rejected"


def label_log_records(
    records: DataFrame, *, log_name: str | None = None, min_level: str = MIN_LEVEL, log_names: list[str] | None = None
) -> DataFrame:
    """Every record in column ``value`` with its parts and a ``verdict``: kept, below level, other log, or rejected with a
    ``reason`` and the record as it is in ``raw``.

    Works on a batch and on a stream. Records are of the pipe layout or, with ``log_name``, of the multi-line one, which does not
    name its log. A record is rejected if it does not fit the layout or its level is none of LEVELS.
    ``log_names`` keeps the records of these logs. The message is all that follows the last label, line breaks included.
    """
    whole = records.select(_whole_record().alias("raw"))
    if log_name is None:
        parts = F.col("parts")
        whole = whole.withColumn("parts", F.split("raw", r"\|", len(PIPE_LAYOUT) + 1))
        fits = F.size(parts) == len(PIPE_LAYOUT) + 1
        values = []
        for i, label in enumerate(PIPE_LAYOUT):
            fits = fits & F.get(parts, F.lit(i)).startswith(label)
            values.append(F.substring(F.get(parts, F.lit(i)), len(label) + 1, 2**31 - 1))
        values.append(F.get(parts, F.lit(len(PIPE_LAYOUT))))
    else:
        part = [F.regexp_extract("raw", BLOCK_LAYOUT, i) for i in range(1, 4)]
        fits = F.col("raw").rlike(BLOCK_LAYOUT)
        values = [part[0], part[1], F.lit(log_name), part[2]]
    at, level, name, message = (F.when(fits, v) for v in values)
    when = at.try_cast("timestamp_ntz")  # log times have no zone
    other = F.lit(False) if log_names is None else ~name.isin(*log_names)
    reason = F.when(~F.coalesce(fits, F.lit(False)), "layout").when(~level.isin(*LEVELS), "level")
    verdict = (
        F.when(reason.isNotNull(), REJECTED).when(~level.isin(*kept_levels(min_level)), BELOW).when(other, OTHER_LOG).otherwise(KEPT)
    )
    return whole.select(
        when.alias("logged_at"), level.alias("level"), name.alias("log_name"), message.alias("message"), when.cast("date").alias("day"),
        verdict.alias("verdict"), reason.alias("reason"), F.when(reason.isNotNull(), F.col("raw")).alias("raw"),
    )


def _kept(labelled: DataFrame) -> DataFrame:
    return labelled.where(F.col("verdict") == KEPT).drop("verdict", "reason", "raw")


def parse_log_lines(
    lines: DataFrame, *, min_level: str = MIN_LEVEL, log_names: list[str] | None = None
) -> DataFrame:
    """Records of the pipe layout in column ``value``, one per row; ``label_log_records`` also gives what is dropped here."""
    return _kept(label_log_records(lines, min_level=min_level, log_names=log_names))


def parse_log_blocks(blocks: DataFrame, *, log_name: str, min_level: str = MIN_LEVEL) -> DataFrame:
    """Records of the multi-line layout, one block per row in column ``value``.

    The layout does not name its log, so the caller does.
    """
    return _kept(label_log_records(blocks, log_name=log_name, min_level=min_level))


def rejected_records(labelled: DataFrame) -> DataFrame:
    """``raw, reason`` of the records that fit no layout or have an unknown level."""
    return labelled.where(F.col("verdict") == REJECTED).select("raw", "reason")


def write_labelled(labelled: DataFrame, path: str) -> dict[str, int]:
    """Write kept and rejected records in one pass, under ``verdict=kept`` by day and level and ``verdict=rejected``, replacing what
    is there. Returns how many records were read and how many had each verdict, counted as they pass."""
    counted = Observation("log records")
    verdicts = (KEPT, BELOW, OTHER_LOG, REJECTED)
    counts = [F.count_if(F.col("verdict") == v).alias(v) for v in verdicts]
    watched = labelled.observe(counted, F.count(F.lit(1)).alias("read"), *counts)
    kept = watched.where(F.col("verdict").isin(KEPT, REJECTED)).hint("rebalance", "verdict", "day", "level")
    kept.write.mode("overwrite").partitionBy("verdict", "day", "level").parquet(path)
    return dict(counted.get)


def unwrap_nested_json(payloads: DataFrame, depth: int = 3) -> DataFrame:
    """Open a JSON payload whose ``Data`` field is such a payload again, ``depth`` records deep.

    Gives ``name1, time1, ..., data``; levels after a broken one are NULL.
    """
    columns = []
    text = F.col("value")
    for level in range(1, depth + 1):
        record = F.from_json(text, PAYLOAD)
        columns += [record["Name"].alias(f"name{level}"), record["Time"].alias(f"time{level}")]
        text = record["Data"]
    return payloads.select(*columns, text.alias("data"))


def unwrap_json_levels(payloads: DataFrame, id_col: str = "id") -> DataFrame:
    """Open JSON payloads (column ``value``) whose ``Data`` field is such a payload again, however deep they are.

    One row per payload and level, from 1: ``id, level, name, time, data, broken``. ``data`` is the text of the last level, which is no
    payload any more, and NULL above; a payload is an object with a ``Name``. A text that begins like an object but is none ends its
    payload as ``broken``, with the text itself in ``data``, so nothing is lost; NULL payloads have no rows. Each level is
    one stored pass over the payloads that go on; it ends when none does.
    """
    left = payloads.select(F.col(id_col).alias("id"), F.col("value").alias("text")).where("text is not null")
    done, level = [], 0
    while True:
        level += 1
        record = F.try_parse_json("text")
        name = F.try_variant_get(record, "$.Name", "string")
        opened = left.select(
            "id", "text", record.isNull().alias("unparsed"), name.alias("name"),
            F.try_variant_get(record, "$.Time", "string").try_cast("timestamp_ntz").alias("time"),
            F.try_variant_get(record, "$.Data", "string").alias("inner"),
        )
        starts = F.ltrim("inner").startswith("{")
        within = F.try_parse_json("inner")
        bad = F.coalesce(starts & within.isNull(), F.lit(False))
        more = F.coalesce(starts & F.try_variant_get(within, "$.Name", "string").isNotNull(), F.lit(False))
        broken = F.when(F.col("name").isNull(), True).otherwise(bad)  # a first text that is no payload is broken, too
        opened = cut(opened.select("id", "text", "name", "time", "inner", broken.alias("broken"), more.alias("more")))
        data = F.when(F.col("name").isNull(), F.col("text")).when(~F.col("more"), F.col("inner"))
        done.append(opened.select("id", F.lit(level).alias("level"), "name", "time", data.alias("data"), "broken"))
        left = opened.where("more").select("id", F.col("inner").alias("text"))
        if left.isEmpty():
            break
    return reduce(DataFrame.unionByName, done)


def write_logs(records: DataFrame, path: str) -> None:
    """Append records as parquet, one folder per day and level."""
    records.hint("rebalance", "day", "level").write.mode("append").partitionBy("day", "level").parquet(path)
