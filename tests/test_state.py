"""Keyed and windowed state on streams that get their records in several appends."""

from datetime import timedelta
from pathlib import Path

import pytest
from helpers import FEED, START, feed_of
from pyspark.sql import functions as F

from changefeed.operators import progress
from changefeed.sources.store import Heads, append_feed, read_feed, read_pages, stored_ordinal
from changefeed.streaming import state
from changefeed.streaming.runner import append_stream, drain, read_stream


def records(spark, rows):
    """``rows``: shard, partition key, number, seconds after the start, data."""
    made = [(data, "s", key, str(n).zfill(21), START + timedelta(seconds=at), shard) for shard, key, n, at, data in rows]
    return spark.createDataFrame(made, FEED)


def run_update(spark, stream, place, mode="update"):
    def keep(batch, n):
        batch.withColumn("batch", F.lit(n)).write.mode("overwrite").parquet(f"{place}/out/n={n}")

    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", f"{place}/check").foreachBatch(keep)
    writer.trigger(availableNow=True).start().awaitTermination()


def out(spark, place):
    return [r.asDict() for r in spark.read.parquet(f"{place}/out").collect()]


def stream_of(spark, place):
    return read_stream(spark, f"{place}/feed", "s", startingPosition="TRIM_HORIZON", includeShardId="true")


def images(rows):
    text = F.col("data").cast("string")
    return state.current_images(rows, ["partitionKey"], text, F.when(text == "-", "REMOVE").otherwise("INSERT"))


def test_current_image(spark, tmp_path):
    first = [("a", "k", 1, 1, b"one"), ("a", "k", 9, 2, b"nine"), ("b", "j", 2, 3, b"two"), ("b", "i", 3, 3, b"three")]
    second = [("c", "k", 8, 4, b"late"), ("b", "j", 10, 5, b"-"), ("b", "i", 11, 6, b"eleven"), ("c", "h", 12, 7, None)]
    for part in (first, second):
        append_feed(records(spark, part), f"{tmp_path}/feed")
        run_update(spark, images(stream_of(spark, tmp_path)), tmp_path)
    newest = {}
    for r in sorted(out(spark, tmp_path), key=lambda r: r["batch"]):
        newest[r["partitionKey"]] = (int(r["sequenceNumber"]), r["image"], r["removed"])
    want = {"k": (9, "nine", False), "j": (10, None, True), "i": (11, "eleven", False), "h": (12, None, False)}
    assert newest == want
    batch = {r[0]: (int(r[1]), r[2], r[3]) for r in images(read_feed(spark, f"{tmp_path}/feed")).collect()}
    assert batch == want


def test_late_records_of_windows(spark, tmp_path):
    hour = 3600
    appends = [
        [("a", "k", 1, 10, b""), ("a", "k", 2, 20, b""), ("b", "k", 3, 5 * hour, b"")],
        # The newest arrival is at five hours; with two of lateness, windows up to hour three
        # are gone from the batch after the next one on.
        [("e", "k", 6, 5 * hour + 1, b"")],
        [("c", "k", 4, 30, b""), ("d", "k", 5, 3 * hour + 60, b"")],
    ]
    for part in appends:
        append_feed(records(spark, part), f"{tmp_path}/feed")
        run_update(spark, state.window_counts(stream_of(spark, tmp_path), "1 hour", "2 hours"), tmp_path)
    found = {(r["shardId"], (r["start"] - START).seconds // hour): r["records"] for r in out(spark, tmp_path)}
    assert found == {("a", 0): 2, ("b", 5): 1, ("d", 3): 1, ("e", 5): 1}
    plain = state.window_counts(read_feed(spark, f"{tmp_path}/feed"), "1 hour", "2 hours").count()
    assert plain == 5


def test_sessions_merge_across_batches(spark, tmp_path):
    appends = [
        [("a", "k", 1, 0, b""), ("a", "k", 2, 150, b""), ("a", "j", 3, 10, b"")],
        [("b", "k", 4, 80, b"")],
        [("c", "z", 5, 10_000, b"")],
        [("c", "z", 6, 20_000, b"")],
        [("c", "z", 7, 20_001, b"")],
    ]
    for part in appends:
        append_feed(records(spark, part), f"{tmp_path}/feed")
        run_update(spark, state.sessions(stream_of(spark, tmp_path), "100 seconds", "300 seconds"), tmp_path, "append")
    found = sorted((r["partitionKey"], (r["first"] - START).seconds, (r["last"] - START).seconds, r["records"]) for r in out(spark, tmp_path))
    assert found == [("j", 10, 10, 1), ("k", 0, 150, 3), ("z", 10_000, 10_000, 1)]
    batch = state.sessions(read_feed(spark, f"{tmp_path}/feed"), "100 seconds", "300 seconds").collect()
    assert sorted((r["partitionKey"], r["records"]) for r in batch) == [("j", 1), ("k", 3), ("z", 1), ("z", 2)]


def test_interval_join_over_batches(spark, tmp_path):
    appends = [
        [("a", "k", 1, 0, b"l"), ("a", "j", 2, 0, b"l")],
        [("b", "k", 3, 100, b"r"), ("b", "j", 4, 101, b"r"), ("b", "i", 5, 50, b"r")],
        [("c", "i", 6, 20, b"l"), ("c", "i", 7, 60, b"l")],
    ]

    def joined(rows):
        sides = [rows.filter(F.col("data") == F.lit(x).cast("binary")).select("partitionKey", "sequenceNumber", state.ARRIVAL) for x in "lr"]
        return state.interval_join(*sides, "partitionKey", "100 SECONDS", "1 hour")

    for part in appends:
        append_feed(records(spark, part), f"{tmp_path}/feed")
        run_update(spark, joined(stream_of(spark, tmp_path)), tmp_path, "append")
    want = [(1, 3), (6, 5)]
    assert sorted((int(r["sequenceNumber"]), int(r["right_sequenceNumber"])) for r in out(spark, tmp_path)) == want
    plain = joined(read_feed(spark, f"{tmp_path}/feed")).collect()
    assert sorted((int(r["sequenceNumber"]), int(r["right_sequenceNumber"])) for r in plain) == want


# Writing a stream to a feed


def test_stream_to_feed_in_batches(spark, tmp_path):
    append_feed(feed_of(spark, {"a": 20, "b": 7}), f"{tmp_path}/feed", page=5)
    limits = {"executor.maxRecordPerRead": "5", "executor.maxFetchRecordsPerShard": "7"}
    stream = read_stream(spark, f"{tmp_path}/feed", "s", startingPosition="TRIM_HORIZON", includeShardId="true", **limits)
    batches = drain(lambda: append_stream(stream, f"{tmp_path}/copy", f"{tmp_path}/check", "w", page=4))
    assert batches == 2
    rows = stored_ordinal(spark, f"{tmp_path}/copy").select("shardId", "ordinal", "sequenceNumber").collect()
    want = [("a", i, i) for i in range(1, 21)] + [("b", i, 20 + i) for i in range(1, 8)]
    assert sorted((r[0], r[1], int(r[2])) for r in rows) == want
    assert read_pages(spark, f"{tmp_path}/copy").select("append").distinct().count() == 2


def test_replayed_batch_counts_once(spark, tmp_path):
    rows = feed_of(spark, {"a": 9})
    for _ in range(2):
        append_feed(rows, str(tmp_path), once="w.0")
    assert read_feed(spark, str(tmp_path)).count() == 9
    append_feed(feed_of(spark, {"a": 2}, first=10), str(tmp_path), once="w.10")
    append_feed(feed_of(spark, {"a": 2}, first=20), str(tmp_path), once="w.1")
    assert read_feed(spark, str(tmp_path)).count() == 13
    with pytest.raises(ValueError, match="named by"):
        append_feed(rows, str(tmp_path), once="../x")


def test_failed_batch_is_written_anew(spark, tmp_path, monkeypatch):
    from changefeed.sources import store

    append_feed(feed_of(spark, {"a": 9}), f"{tmp_path}/feed")
    write = lambda: append_stream(stream_of(spark, tmp_path), f"{tmp_path}/copy", f"{tmp_path}/check", "w")
    with monkeypatch.context() as patch:
        patch.setattr(store, "_list_pages", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(Exception):
            drain(write)
    assert read_feed(spark, f"{tmp_path}/copy").count() == 0
    assert drain(write) == 1
    assert read_feed(spark, f"{tmp_path}/copy").count() == 9


# Offsets of a stream


def test_offsets_of_a_checkpoint_decode(spark, tmp_path):
    for first in (1, 10):
        append_feed(feed_of(spark, {"a": 4}, first=first), f"{tmp_path}/feed")
        drain(lambda: append_stream(stream_of(spark, tmp_path), f"{tmp_path}/copy", f"{tmp_path}/check", "w"))
    lines = spark.read.text(f"{tmp_path}/check/offsets").filter("value like '%streamName%'")
    found = progress.offset_decode(lines, "value").collect()
    assert sorted((r["batchId"], r["shardId"], int(r["iteratorPosition"])) for r in found) == [(0, "a", 4), (1, "a", 13)]


def test_appends_in_a_row_read_new_listings_only(spark, tmp_path, monkeypatch):
    from changefeed.sources import store

    read, plain = [], store._read
    monkeypatch.setattr(store, "_read", lambda *a: read.append(len(a[4]) if len(a) > 4 else None) or plain(*a))
    heads = store.Heads()
    for first in (1, 10, 20):
        append_feed(feed_of(spark, {"a": 4, "b": 2}, first=first), str(tmp_path), heads=heads)
    append_feed(feed_of(spark, {"a": 4}, first=30), str(tmp_path))
    append_feed(feed_of(spark, {"c": 4}, first=40), str(tmp_path), heads=heads)
    assert read == [0, 0, 0, 3, 1]
    with pytest.raises(ValueError, match="shard a already has records up to .*33"):
        append_feed(feed_of(spark, {"a": 4}, first=32), str(tmp_path), heads=heads)
    assert read_feed(spark, str(tmp_path)).count() == 26


def test_streamed_batch_is_read_once_into_one_file(spark, tmp_path):
    append_feed(feed_of(spark, {"a": 20, "b": 7}), f"{tmp_path}/feed", page=5)
    limits = {"executor.maxRecordPerRead": "5", "executor.maxFetchRecordsPerShard": "7"}
    stream = read_stream(spark, f"{tmp_path}/feed", "s", startingPosition="TRIM_HORIZON", includeShardId="true", **limits)
    read = []
    while not read or read[-1]:
        query = append_stream(stream, f"{tmp_path}/copy", f"{tmp_path}/check", "w", page=4).trigger(availableNow=True).start()
        query.awaitTermination()
        read.append(sum(p["numInputRows"] for p in query.recentProgress))
    assert read == [17, 10, 0]
    assert len(list((tmp_path / "copy" / "data").rglob("*.parquet"))) == 2
    assert sorted(r["records"] for r in read_pages(spark, f"{tmp_path}/copy").collect()) == [1, 2, 2, 2, 4, 4, 4, 4, 4]


def test_late_stream_is_refused(spark, tmp_path):
    append_feed(feed_of(spark, {"a": 5}), f"{tmp_path}/feed")
    append_feed(feed_of(spark, {"b": 2, "a": 1}, first=5), f"{tmp_path}/copy")
    with pytest.raises(Exception, match="shard a already has records up to .*7"):
        drain(lambda: append_stream(stream_of(spark, tmp_path), f"{tmp_path}/copy", f"{tmp_path}/check", "w"))
    assert read_feed(spark, f"{tmp_path}/copy").count() == 3
    assert len(list((tmp_path / "copy" / "data").iterdir())) == 1


def test_unmarked_listing_is_no_append(spark, tmp_path, monkeypatch):
    from changefeed import storage

    heads = Heads()
    append_feed(feed_of(spark, {"a": 2}), str(tmp_path), once="w.0", heads=heads)
    with monkeypatch.context() as patch:
        patch.setattr(storage, "touch", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            append_feed(feed_of(spark, {"a": 3}, first=3), str(tmp_path), once="w.1", heads=heads)
    assert read_feed(spark, str(tmp_path)).count() == 2
    append_feed(feed_of(spark, {"a": 3}, first=3), str(tmp_path), once="w.1", heads=heads)
    assert read_feed(spark, str(tmp_path)).count() == 5


def test_partitions_of_state(spark):
    from changefeed.storage import session_conf

    cores = spark.sparkContext.defaultParallelism
    with session_conf(spark, "spark.sql.shuffle.partitions", "100"):
        assert [state.partitions(spark, n) for n in (0, 6_000_000, 36_000_000, 10**9)] == [cores, cores, 36, 100]
    assert state.partitions(spark, 0) == min(4, cores)


def test_state_takes_the_partitions_it_is_given(spark, tmp_path):
    from changefeed.plans import queries
    from changefeed.storage import shared_dir

    append_feed(records(spark, [("a", "k", 1, 1, b"one"), ("b", "j", 2, 3, b"two")]), f"{tmp_path}/feed")
    rows = images(stream_of(spark, tmp_path))
    folder = Path(shared_dir(spark)) / "changefeed"
    before = set(folder.glob("updates-*"))
    found = queries._latest_of_batches(rows, ["partitionKey"], 3)
    assert found.count() == 2
    (place,) = set(folder.glob("updates-*")) - before
    assert len([d for d in (place / "checkpoint" / "state" / "0").iterdir() if d.name.isdigit()]) == 3
    assert spark.conf.get("spark.sql.shuffle.partitions") == "4"
