from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from mailtax.sources.logs import (
    label_log_records,
    parse_log_blocks,
    parse_log_lines,
    read_log_records,
    rejected_records,
    unwrap_json_levels,
    unwrap_nested_json,
    write_labelled,
    write_logs,
)
from mailtax.streaming.logs import read_labelled, stream_labelled_logs, stream_logs

LINES = [
    "some other line",
    "DateTime: 2024-03-09 08:44:32.1234|MessageLevel:DEBUG|LogName:App-ApiTiming|took 5 ms | ok",
    "DateTime: 2024-03-09 08:44:33.0000|MessageLevel:ERROR|LogName:App-ApiContent|{\"a\": 1}",
    "DateTime: 2024-03-10 00:00:00.5000|MessageLevel:TRACE|LogName:App-ApiTiming|below the level",
    "DateTime: not a time|MessageLevel:INFO|LogName:App-ApiTiming|",
]


def test_lines(spark):
    df = spark.createDataFrame([(x,) for x in LINES], "value string")
    found = {r["message"]: r for r in parse_log_lines(df).collect()}
    assert set(found) == {"took 5 ms | ok", '{"a": 1}', ""}
    row = found["took 5 ms | ok"]
    assert row["logged_at"] == datetime(2024, 3, 9, 8, 44, 32, 123400)
    assert (row["level"], row["log_name"], row["day"]) == ("DEBUG", "App-ApiTiming", date(2024, 3, 9))
    assert found[""]["logged_at"] is None
    routed = parse_log_lines(df, log_names=["App-ApiContent"], min_level="ERROR").collect()
    assert [r["message"] for r in routed] == ['{"a": 1}']


@pytest.mark.parametrize("newline", ["\n", "\r\n"])
def test_blocks_read_from_a_file(spark, tmp_path, newline):
    blocks = [("2024-03-09 08:44:32.1234", "INFO", "one"), ("2024-03-09 08:44:33.1234", "WARN", "two\nlines\n at x()"),
              ("2024-03-09 08:44:34.1234", "TRACE", "no")]
    text = "".join(f"DateTime: {a}\nLogLevel: {b}\nMessage: {c}\n\n" for a, b, c in blocks)
    text = text.replace("\n", newline)
    (tmp_path / "app.log").write_bytes(text.encode())
    raw = read_log_records(spark, str(tmp_path / "app.log"))
    found = parse_log_blocks(raw, log_name="App").orderBy("logged_at").collect()
    assert [(r["level"], r["log_name"], r["message"]) for r in found] == [
        ("INFO", "App", "one"), ("WARN", "App", "two\nlines\n at x()".replace("\n", newline))
    ]


@pytest.mark.parametrize("newline", ["\n", "\r\n"])
def test_messages_of_several_lines(spark, tmp_path, newline):
    trace = "Boom | no\n   at a()\n\n{\n  \"DateTime\": 1\n}"
    heads = ["DateTime: 2024-03-09 08:44:3%d.0000|MessageLevel:%s|LogName:App|" % x for x in ((1, "ERROR"), (2, "TRACE"), (3, "INFO"))]
    text = "rest of an older file\n" + "".join(f"{h}{m}\n" for h, m in zip(heads, (trace, trace, "short")))
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "app.log").write_bytes(text.replace("\n", newline).encode())
    found = parse_log_lines(read_log_records(spark, str(tmp_path / "in"))).orderBy("logged_at").collect()
    expected = [("ERROR", trace.replace("\n", newline)), ("INFO", "short")]
    assert [(r["level"], r["message"]) for r in found] == expected
    query = stream_logs(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "checkpoint"))
    query.awaitTermination(120)
    streamed = spark.read.parquet(str(tmp_path / "out")).orderBy("logged_at").collect()
    assert [(r["level"], r["message"]) for r in streamed] == expected


def test_stream_and_batch_write_the_same_folders(spark, tmp_path):
    source, batch, stream = (str(tmp_path / x) for x in ("in", "batch", "stream"))
    df = spark.createDataFrame([(x,) for x in LINES], "value string")
    df.coalesce(1).write.text(source)
    write_logs(parse_log_lines(df), batch)
    for _ in range(2):  # the second run finds nothing new
        query = stream_logs(spark, source, stream, str(tmp_path / "checkpoint"))
        query.awaitTermination(120)
        assert query.exception() is None
    columns = ["logged_at", "level", "log_name", "message"]
    read = lambda path: sorted(map(str, spark.read.parquet(path).select(columns).collect()))
    assert read(stream) == read(batch) and len(read(batch)) == 3
    assert (tmp_path / "stream" / "day=2024-03-09" / "level=ERROR").is_dir()


def test_nested_payload(spark):
    inner = F.to_json(F.struct(F.lit("1").alias("Name"), F.lit("2024-01-01T10:00:00.5").alias("Time"),
                               F.lit("important").alias("Data")))
    middle = F.to_json(F.struct(F.lit("2").alias("Name"), inner.alias("Data")))
    outer = F.to_json(F.struct(F.lit("3").alias("Name"), middle.alias("Data")))
    broken = F.lit('{"Name": "3", "Data": "not json"}')
    row = unwrap_nested_json(spark.range(1).select(outer.alias("value"))).first()
    assert (row["name1"], row["name2"], row["name3"], row["data"]) == ("3", "2", "1", "important")
    assert row["time3"] == datetime(2024, 1, 1, 10, 0, 0, 500000) and row["time1"] is None
    row = unwrap_nested_json(spark.range(1).select(broken.alias("value"))).first()
    assert (row["name1"], row["name2"], row["data"]) == ("3", None, None)


DAMAGED = [
    *LINES[1:4], "DateTime: 2024-03-09 08:44:33.0000|MessageLevel:NOTICE|LogName:App|odd level", "DateTime: 2024|LogName:App|no level",
    "DateTime: 2024-03-09 08:44:34.0000|MessageLevel:INFO|LogName:Other|other log", "", None,
]


def test_every_record_has_a_verdict(spark):
    df = spark.createDataFrame([(x,) for x in DAMAGED], "value string")
    rows = label_log_records(df, log_names=["App-ApiTiming", "App-ApiContent"]).collect()
    verdicts = sorted((r["verdict"], r["reason"]) for r in rows if r["reason"]), [r["verdict"] for r in rows if not r["reason"]]
    assert verdicts[0] == [
        ("rejected", "layout"), ("rejected", "layout"), ("rejected", "layout"), ("rejected", "level")]
    assert sorted(verdicts[1]) == ["below level", "kept", "kept", "other log"]
    rejects = {r["raw"]: r["reason"] for r in rejected_records(label_log_records(df)).collect()}
    assert rejects[DAMAGED[3]] == "level" and rejects[DAMAGED[4]] == "layout"


def test_counts_come_with_the_one_pass(spark, tmp_path):
    df = spark.createDataFrame([(x,) for x in DAMAGED], "value string")
    path = str(tmp_path / "out")
    counts = write_labelled(label_log_records(df), path)
    assert counts == {"read": 8, "kept": 3, "below level": 1, "other log": 0, "rejected": 4}
    written = spark.read.parquet(path)
    assert {r["verdict"]: r["count"] for r in written.groupBy("verdict").count().collect()} == {"kept": 3, "rejected": 4}
    blocks = spark.createDataFrame([("DateTime: x\nLogLevel: INFO\nMessage: m",), ("DateTime: x\nMessage: m",)], "value string")
    assert write_labelled(label_log_records(blocks, log_name="App"), path)["rejected"] == 1


def test_a_repeated_batch_replaces_itself(spark, tmp_path):
    """The commit of the last batch is lost, so it runs again, with a new file that came meanwhile in a batch of its own."""
    source, target, checkpoint = (str(tmp_path / x) for x in ("in", "out", "checkpoint"))
    known = [x for x in DAMAGED if x]
    spark.createDataFrame([(x,) for x in known], "value string").coalesce(1).write.text(source)

    def run():
        query = stream_labelled_logs(spark, source, target, checkpoint)
        query.awaitTermination(120)
        assert query.exception() is None
        return sorted(map(str, read_labelled(spark, target).collect()))

    first = run()
    assert len(first) == 5
    commits = tmp_path / "checkpoint" / "commits"
    for file in list(commits.iterdir()):
        if file.name.lstrip(".").startswith("0"):
            file.unlink()
    spark.createDataFrame([(LINES[1].replace("took", "later"),)], "value string").coalesce(1).write.mode("append").text(source)
    again = run()
    assert len(again) == len(first) + 1 and set(first) < set(again)
    assert run() == again


def test_payloads_of_any_depth(spark):
    import json

    def wrap(depth, text):
        for level in range(depth, 0, -1):
            text = json.dumps({"Name": f"n{level}", "Time": "2024-01-01T10:00:00", "Data": text})
        return text

    rows = [(1, wrap(1, "end")), (2, wrap(9, "deep")), (3, wrap(2, '{"Name": "cut')), (4, "no payload"), (5, None), (6, wrap(1, None)),
            (7, wrap(2, '{"a": 1}')), (8, '{"Name": "x"'), (9, wrap(1, "{")), (10, "")]
    found = {}
    for r in unwrap_json_levels(spark.createDataFrame(rows, "id long, value string")).orderBy("id", "level").collect():
        found.setdefault(r["id"], []).append((r["level"], r["name"], r["data"], r["broken"]))
    assert found[1] == [(1, "n1", "end", False)]
    assert [x[1] for x in found[2]] == [f"n{k}" for k in range(1, 10)] and found[2][-1][2] == "deep" and not any(x[3] for x in found[2])
    assert found[3] == [(1, "n1", None, False), (2, "n2", '{"Name": "cut', True)]
    assert found[4] == [(1, None, "no payload", True)] and 5 not in found and found[10] == [(1, None, "", True)]
    assert found[6] == [(1, "n1", None, False)] and found[7][-1] == (2, "n2", '{"a": 1}', False)
    assert found[8] == [(1, None, '{"Name": "x"', True)] and found[9] == [(1, "n1", "{", True)]
