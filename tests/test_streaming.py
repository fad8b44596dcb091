"""The live feed over file streams: stream equals batch, replays add nothing."""

import json
import os

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from obslake.plans import ledger, silver
from obslake.session import scratch_path
from obslake.sources import readers, versions
from obslake.streaming import feed, message_log

LINES = [
    {"city": "Paris", "latitude": 48.8, "longitude": 2.3, "timestamp": f"2026-08-27T{h:02d}:{m:02d}",
     "temperature": 20.0 + h, "windspeed": 12.3, "winddirection": 240.0, "weathercode": 1, "precipitation": 0.0,
     "source": "OPENMETEO"}
    for h in (9, 10) for m in (0, 5, 10)
]
BROKEN = [{"city": "Paris", "timestamp": "n/a"}, {"city": "Lyon"}]
IMPOSSIBLE = {"city": "Lyon", "timestamp": "2026-08-27T11:00", "temperature": 999.0, "windspeed": -5.0, "precipitation": None}


@pytest.fixture()
def messages(tmp_path):
    for i, part in enumerate((LINES[:3], LINES[3:] + BROKEN, [IMPOSSIBLE], LINES[:2])):
        (tmp_path / f"part{i}.json").write_text("".join(json.dumps(x) + "\n" for x in part) + "not json\n")
    return str(tmp_path)


def lines_of(spark, path):
    return sorted(r[0] for r in spark.read.text(path).select("value").collect())


def test_feed_to_hours(spark, messages):
    out, book, offsets = (scratch_path(spark, n) for n in ("tree", "ledger", "offsets"))
    for _ in range(2):
        query = feed.start_hourly(feed.file_messages(spark, messages, 1), out, book, offsets, trigger_seconds=None)
        query.awaitTermination()
    batch = feed.by_hour(spark.read.text(messages).select(F.col("value").alias("json_value")))
    assert lines_of(spark, out) == sorted(r[0] for r in batch.select("json_value").collect())
    assert len(lines_of(spark, out)) == 9
    hours = sorted(r["key"] for r in ledger.done_keys(ledger.read_ledger(spark, book), "stream").collect())
    assert hours == ["2026/08/27/09", "2026/08/27/10", "2026/08/27/11"]
    rows = silver.build_silver([silver.normalise_feed(readers.read_feed(spark, out))])
    assert rows.count() == 7
    nine = ledger.done_keys(ledger.read_ledger(spark, book), "stream").where("key LIKE '%/09'")
    assert readers.read_feed(spark, out, complete=nine).count() == 5


def test_replayed_epoch(spark, messages):
    out, book = scratch_path(spark, "tree"), scratch_path(spark, "ledger")
    batch = spark.read.text(messages).select(F.col("value").alias("json_value"))
    for epoch in (4, 4, 5):
        feed.write_hours(batch, epoch, out, book)
    assert len(lines_of(spark, out)) == 2 * 9
    feed.write_hours(batch.where("false"), 6, out, book)
    assert len(lines_of(spark, out)) == 2 * 9


def test_checked_fields(spark, messages):
    batch = spark.read.text(messages).select(F.col("value").alias("json_value"))
    assert {r["city"] for r in feed.checked_fields(batch).collect()} == {"Paris"}


def test_unique_stream_equals_batch(spark, messages):
    out, offsets = scratch_path(spark, "unique"), scratch_path(spark, "offsets")
    feed.start_unique(feed.file_messages(spark, messages), out, offsets).awaitTermination()
    batch = feed.unique_messages(spark.read.text(messages).select(F.col("value").alias("json_value")))
    got = spark.read.parquet(out).drop("epoch")
    assert got.count() == 6
    assert sorted(map(str, got.collect())) == sorted(map(str, batch.select(*got.columns).collect()))


def test_bounded_run(spark, messages):
    out, book, offsets = (scratch_path(spark, n) for n in ("tree", "ledger", "offsets"))
    query = feed.start_hourly(feed.file_messages(spark, messages), out, book, offsets, trigger_seconds=30)
    assert feed.run_for(query, 8) is False
    assert not query.isActive


def test_city_list(spark):
    rows = spark.createDataFrame([('[{"city": "A", "latitude": 1.0, "longitude": 2.0}]',)], "c string")
    assert [tuple(r) for r in feed.city_list(rows, "c").collect()] == [("A", 1.0, 2.0)]
    for bad in ("[]", "{", None):
        rows = spark.createDataFrame([(bad,)], "c string")
        assert feed.city_list(rows, "c").count() == 5


def test_two_checkpoints_do_not_overwrite_each_other(spark, messages):
    out, book = scratch_path(spark, "tree"), scratch_path(spark, "ledger")
    for _ in range(2):
        stream = feed.file_messages(spark, messages)
        feed.start_hourly(stream, out, book, scratch_path(spark, "offsets"), trigger_seconds=None).awaitTermination()
    assert len(lines_of(spark, out)) == 2 * 9


def test_late_rows_are_not_lost(spark):
    """Observations that come hours or days late, and their copies, in batches of their own."""
    source, out, offsets = (scratch_path(spark, n) for n in ("late", "unique", "offsets"))
    times = ["2025-03-02T12:00", "2025-03-02T13:00", "2025-03-02T09:00", "2025-02-01T00:00", "2025-03-02T12:00"]
    for at in times:
        line = f'{{"city": "Lyon", "timestamp": "{at}", "temperature": 10.0, "windspeed": 1.0}}'
        spark.createDataFrame([(line,)], "value string").coalesce(1).write.mode("append").text(source)
        feed.start_unique(feed.file_messages(spark, source), out, offsets).awaitTermination()
    found = [f"{r['timestamp']:%Y-%m-%dT%H:%M}" for r in spark.read.parquet(out).collect()]
    assert sorted(found) == sorted(set(times))


def test_messages_of_one_moment_are_told_apart_by_their_id(spark):
    """Two instruments of a city report at the same time, each message twice, in batches of their own."""
    source, out, offsets = (scratch_path(spark, n) for n in ("ids", "unique", "offsets"))
    line = '{{"id": {0}, "city": "Lyon", "timestamp": "2025-03-02T12:00", "temperature": {0}.0, "windspeed": 1.0}}'
    for sent in ((1, 1), (2, 1), (2,)):
        spark.createDataFrame([(line.format(i),) for i in sent], "value string").coalesce(1).write.mode("append").text(source)
        feed.start_unique(feed.file_messages(spark, source), out, offsets, id_field="id").awaitTermination()
    assert sorted(r["temperature"] for r in spark.read.parquet(out).collect()) == [1.0, 2.0]


def read_all(query):
    try:
        query.processAllAvailable()
        return [p["numInputRows"] for p in query.recentProgress if p["numInputRows"]]
    finally:
        query.stop()


def numbered(spark, start, end):
    return spark.range(start, end).selectExpr("cast(id AS string) AS value")


def log_stream(spark, log, out, check, **choices):
    rows = message_log.read_log(spark, log, **choices)
    return rows.writeStream.format("parquet").option("checkpointLocation", check).trigger(processingTime="0 seconds").start(out)


def test_log_limits_restarts_and_loss(spark):
    log, out, check = (scratch_path(spark, n) for n in ("log", "out", "offsets"))
    message_log.append_messages(numbered(spark, 0, 50), log)
    message_log.append_messages(numbered(spark, 50, 60), log, key="value")
    sizes = read_all(log_stream(spark, log, out, check, from_earliest=True, per_trigger=8))
    assert sum(sizes) == 60 and max(sizes) <= 8
    message_log.append_messages(numbered(spark, 60, 100), log)
    sizes = read_all(log_stream(spark, log, out, check, from_earliest=True, per_trigger=8))  # the limit holds after a restart
    assert sum(sizes) == 40 and max(sizes) <= 8
    found = spark.read.parquet(out)
    assert sorted(int(r["value"]) for r in found.collect()) == list(range(100))
    assert found.select("partition", "offset").distinct().count() == 100

    message_log.append_messages(numbered(spark, 100, 130), log)
    lost = [s for own in message_log.segments(log).values() for s in own[-1:]]
    message_log.append_messages(numbered(spark, 130, 140), log)
    for segment in lost:
        os.remove(segment.path)
    with pytest.raises(StreamingQueryException, match="LostOffsets"):
        read_all(log_stream(spark, log, out, check))
    read_all(log_stream(spark, log, scratch_path(spark, "out"), check, allow_loss=True))
    empty = scratch_path(spark, "log")
    assert read_all(log_stream(spark, empty, scratch_path(spark, "out"), scratch_path(spark, "offsets"))) == []


def test_log_starts_at_the_latest_message(spark):
    log, out, check = (scratch_path(spark, n) for n in ("log", "out", "offsets"))
    message_log.append_messages(numbered(spark, 0, 20), log)
    query = log_stream(spark, log, out, check)
    query.processAllAvailable()
    message_log.append_messages(numbered(spark, 20, 25), log)
    assert sum(read_all(query)) == 5
    assert sorted(int(r["value"]) for r in spark.read.parquet(out).collect()) == list(range(20, 25))


def test_batches_are_commits(spark, messages, monkeypatch):
    """A replayed epoch adds nothing, also after compaction; many commits become one."""
    monkeypatch.setattr(feed, "BATCH_COMMITS", 3)
    root, book = versions.create_root(spark, scratch_path(spark, "lake")), scratch_path(spark, "ledger")
    batch = feed.message_text(spark.read.text(messages))
    rows = feed.normalise_feed(feed.checked_fields(batch))
    for epoch in (0, 0, 1, 2, 2):
        feed.write_hours(batch, epoch, f"{root}/hours", book, "s")
        feed.write_unique(rows, epoch, f"{root}/unique", "s")
    once = feed.by_hour(batch).count()
    hours = readers.read_table(spark, f"{root}/hours")
    assert hours.count() == 3 * once
    assert all(versions.partition_of(f) for f in versions.live_folders(spark, f"{root}/hours"))
    assert readers.read_table(spark, f"{root}/unique").count() == rows.dropDuplicates(feed.UNIQUE_KEY).count()
    assert readers.read_feed(spark, f"{root}/hours").count() == 3 * once
    assert readers.read_feed(spark, f"{root}/hours", ledger.done_keys(ledger.read_ledger(spark, book), "stream")).count() == 3 * once


def test_a_partition_has_several_segments(spark):
    """No task writes or reads a whole partition of a large append; a key keeps to one partition, offsets have no gap."""
    log = scratch_path(spark, "log")
    for _ in range(2):
        rows = spark.range(0, 3000).selectExpr("cast(id % 100 AS string) AS value")
        message_log.append_messages(rows, log, key="value")
    held = message_log.segments(log)
    assert set(held) <= set(range(message_log.PARTITIONS)) and max(s.end - s.first for own in held.values() for s in own) < 1000
    assert all(a.end == b.first for own in held.values() for a, b in zip(own, own[1:])) and sum(own[-1].end for own in held.values()) == 6000
    found = spark.read.format(message_log.FORMAT).load(log)
    assert found.groupBy("value").agg(F.countDistinct("partition").alias("n")).where("n > 1").isEmpty()
    assert found.select("partition", "offset").distinct().count() == 6000
