import pyarrow.parquet as pq
import pytest
from helpers import as_dict, catalogue_of, feed_of
from pyspark.sql import functions as F

from changefeed.functions.payload import decode_event, typed_attribute
from changefeed.operators import position_log
from changefeed.operators.limits import batch_limit
from changefeed.schema import ENVELOPE, SHARD_KEY, event_schema
from changefeed.sources import options as opts
from changefeed.sources.feed import shard_ranges
from changefeed.sources.store import append_feed, read_feed, write_catalogue
from changefeed.sources.stream import ChangeFeedReader, check_offset, open_path, register
from changefeed.storage import session_conf
from changefeed.streaming.runner import drain, read_stream, write_with_log


def options_of(path, **more):
    return opts.parse_options({"streamname": "s", "path": str(path), **more})


def writer_of(stream, place):
    return (
        stream.writeStream.format("parquet")
        .option("path", f"{place}/out")
        .option("checkpointLocation", f"{place}/checkpoint")
    )


def run(stream, place):
    query = writer_of(stream, place).trigger(availableNow=True).start()
    query.awaitTermination(120)
    return query


def append_one_file(feed, path, page):
    with session_conf(feed.sparkSession, "spark.sql.shuffle.partitions", "1"):
        append_feed(feed, path, page)


def written(spark, place):
    rows = spark.read.schema(ENVELOPE).parquet(f"{place}/out").collect()
    return sorted(int(r.sequenceNumber) for r in rows)


# Options


@pytest.mark.parametrize("given", [{}, {"streamname": ""}])
def test_stream_name_is_required_at_load(spark, tmp_path, given):
    register(spark)
    reader = spark.readStream.format("changefeed").options(**given)
    with pytest.raises(Exception, match="Stream name is a required field"):
        reader.load(str(tmp_path))


def test_options():
    parsed = options_of("/p/")
    assert (parsed.path, parsed.start, parsed.page, parsed.cap) == ("/p", "LATEST", 10_000, 100_000)
    parsed = opts.parse_options(
        {"StreamName": "s", "PATH": "/p", "startingPosition": " Trim_Horizon ",
         "feed.executor.maxRecordPerRead": "5", "executor.maxFetchRecordsPerShard": "12"}
    )
    assert (parsed.start, parsed.page, parsed.cap) == ("TRIM_HORIZON", 5, 12)
    assert options_of("/p", **{"executor.maxrecordperread": "7"}).cap == 100_000
    for bad in (
        {"startingposition": "yesterday"},
        {"executor.maxrecordperread": "0"},
        {"executor.maxfetchrecordspershard": "-1"},
        {"path": ""},
    ):
        with pytest.raises(ValueError):
            opts.parse_options({"streamname": "s", "path": "/p", **bad})


def test_fixed_schema(spark, tmp_path):
    stream = read_stream(spark, str(tmp_path), "s")
    assert stream.schema == ENVELOPE
    assert stream.isStreaming
    with_shard = read_stream(spark, str(tmp_path), "s", includeShardId="true")
    assert with_shard.columns == [*ENVELOPE.names, "shardId"]


def test_own_schema_is_refused_at_start(spark, tmp_path):
    register(spark)
    stream = (
        spark.readStream.format("changefeed").schema("a int").option("streamName", "s").load(str(tmp_path))
    )
    with pytest.raises(Exception, match="fixed schema"):
        run(stream, tmp_path)


# Planning


def standing(offset):
    return {
        s: (at["iteratorType"], int(at["iteratorPosition"])) for s, at in check_offset(offset).items()
    }


@pytest.mark.parametrize("bad", [None, "x", [], {"a": 1}, {"a": {"iteratorType": "LATEST"}}])
def test_bad_offset(bad):
    with pytest.raises(ValueError, match="not an offset"):
        check_offset(bad)


def test_plan_within_limits(spark, tmp_path):
    append_feed(feed_of(spark, {"a": 20, "b": 5}), str(tmp_path), page=5)
    reader = ChangeFeedReader(options_of(tmp_path, startingposition="trim_horizon"))
    assert standing(reader.initialOffset()) == {}
    end = reader.latestOffset()
    assert standing(end) == {
        "a": ("AFTER_SEQUENCE_NUMBER", 20),
        "b": ("AFTER_SEQUENCE_NUMBER", 25),
    }
    assert reader.partitions(end, end) == []
    latest = ChangeFeedReader(options_of(tmp_path))
    assert latest.initialOffset() == latest.latestOffset()
    assert standing(latest.initialOffset()) == standing(end)
    assert latest.partitions(end, end) == []
    reader.stop()


def rows_of(reader, start, end):
    found = []
    for part in reader.partitions(start, end):
        for batch in reader.read(part):
            found += [int(n) for n in batch.column("sequenceNumber").to_pylist()]
    return sorted(found)


def test_plan_with_limits_and_replay(spark, tmp_path):
    append_one_file(feed_of(spark, {"a": 20, "b": 5}), str(tmp_path), page=5)
    limited = options_of(
        tmp_path,
        startingposition="trim_horizon",
        **{"executor.maxrecordperread": "5", "executor.maxfetchrecordspershard": "7"},
    )
    reader = ChangeFeedReader(limited)
    start = reader.initialOffset()
    first = reader.latestOffset()
    assert standing(first) == {"a": ("AFTER_SEQUENCE_NUMBER", 10), "b": ("AFTER_SEQUENCE_NUMBER", 25)}
    assert rows_of(reader, start, first) == [*range(1, 11), *range(21, 26)]
    second = reader.latestOffset()
    assert standing(second)["a"] == ("AFTER_SEQUENCE_NUMBER", 20)
    assert first["a"]["iteratorPosition"] == "10".zfill(21)
    # A restarted reader is first told where the query stands, then goes on from there.
    again = ChangeFeedReader(limited)
    assert again.partitions(first, first) == []
    assert again.latestOffset() == second
    assert rows_of(again, first, second) == list(range(11, 21))
    assert rows_of(again, start, first) == [*range(1, 11), *range(21, 26)]
    again.commit(second)
    assert again.latestOffset() == second


@pytest.mark.parametrize("page, cap", [(5, 7), (2, 0), (100, 0), (3, 4), (7, 20)])
def test_limited_batches_cover_every_row_once(spark, tmp_path, page, cap):
    # Several files, so some pages are short; pages of 5, so most batches end inside one.
    append_feed(feed_of(spark, {"a": 40, "b": 3}).repartition(8), str(tmp_path), page=5)
    reader = ChangeFeedReader(
        options_of(
            tmp_path,
            startingposition="trim_horizon",
            **{"executor.maxrecordperread": str(page), "executor.maxfetchrecordspershard": str(cap)},
        )
    )
    start, rows = reader.initialOffset(), []
    while (end := reader.latestOffset()) != start and len(rows) < 100:
        batch = rows_of(reader, start, end)
        done = len([n for n in rows if n <= 40])
        assert len([n for n in batch if n <= 40]) == min(batch_limit(page, cap), 40 - done)
        rows += batch
        reader.commit(end)
        start = end
    assert sorted(rows) == list(range(1, 44))


def test_closed_shards(spark, tmp_path):
    path = str(tmp_path)
    append_feed(feed_of(spark, {"a": 5, "b": 5}), path)
    write_catalogue(catalogue_of(spark, {"a": (None, None, "1", "5"), "b": ("a", None, "6", None)}), path)
    reader = ChangeFeedReader(options_of(tmp_path, startingposition="trim_horizon"))
    end = reader.latestOffset()
    assert standing(end) == {"a": ("SHARD_END", 5), "b": ("AFTER_SEQUENCE_NUMBER", 10)}
    assert rows_of(reader, reader.initialOffset(), end) == list(range(1, 11))
    # A finished shard stays in the offset when the catalogue drops it, and is not read again.
    write_catalogue(catalogue_of(spark, {"b": (None, None, "6", None)}), path)
    later = reader.latestOffset()
    assert later == end
    assert rows_of(reader, end, later) == []
    fresh = ChangeFeedReader(options_of(tmp_path, startingposition="trim_horizon"))
    fresh.partitions(later, later)
    assert fresh.latestOffset() == later


def test_records_before_their_listing(spark, tmp_path):
    path = str(tmp_path)
    write_catalogue(catalogue_of(spark, {"a": (None, None, "1", None)}), path)
    append_feed(feed_of(spark, {"a": 5, "b": 3}), path)
    reader = ChangeFeedReader(options_of(tmp_path, startingposition="trim_horizon"))
    end = reader.latestOffset()
    assert rows_of(reader, reader.initialOffset(), end) == list(range(1, 9))
    write_catalogue(catalogue_of(spark, {s: (None, None, "1", None) for s in "ab"}), path)
    append_feed(feed_of(spark, {"b": 2}, first=9), path)
    assert rows_of(reader, end, reader.latestOffset()) == [9, 10]


@pytest.mark.parametrize("form", ["{}", "file:{}", "file://{}"])
def test_forms_of_a_path(spark, tmp_path, form):
    path = form.format(tmp_path / "feed")
    append_feed(feed_of(spark, {"a": 5}), path)
    run(read_stream(spark, path, "s", startingPosition="trim_horizon"), tmp_path)
    assert written(spark, tmp_path) == [1, 2, 3, 4, 5]
    assert open_path(path)[1] == str(tmp_path / "feed")


def test_unknown_scheme():
    with pytest.raises(ValueError, match="not on wasbs"):
        open_path("wasbs://c@a.example/feed")


@pytest.mark.parametrize("width", [46, 56])
def test_long_numbers_in_a_stream(spark, tmp_path, width):
    path = str(tmp_path / "feed")
    feed = feed_of(spark, {"a": 12}).withColumn("sequenceNumber", F.expr(f"rpad(sequenceNumber + 10, {width}, '0')"))
    append_feed(feed, path, page=4)
    limits = {"executor.maxRecordPerRead": "5", "executor.maxFetchRecordsPerShard": "2"}
    stream = read_stream(spark, path, "s", startingPosition="trim_horizon", **limits)
    assert drain(lambda: writer_of(stream, tmp_path)) == 3
    assert [n // 10 ** (width - 2) for n in written(spark, tmp_path)] == list(range(11, 23))


def test_unfinished_append_is_not_seen(spark, tmp_path):
    path = str(tmp_path)
    append_feed(feed_of(spark, {"a": 5}), path)
    broken = tmp_path / "pages" / "append=99999999999999999999-broken"
    broken.mkdir()
    (tmp_path / "data" / broken.name).mkdir()
    reader = ChangeFeedReader(options_of(tmp_path, startingposition="trim_horizon"))
    assert standing(reader.latestOffset()) == {"a": ("AFTER_SEQUENCE_NUMBER", 5)}
    assert read_feed(spark, path).count() == 5


def test_hot_shard_gets_several_tasks(spark, tmp_path):
    path = str(tmp_path)
    append_feed(feed_of(spark, {"hot": 4000, "a": 10, "b": 10}).repartition(8), path)
    reader = ChangeFeedReader(options_of(tmp_path, startingposition="trim_horizon"))
    parts = reader.partitions(reader.initialOffset(), reader.latestOffset())
    assert len([p for p in parts if "hot" in p.shards]) > 2
    assert rows_of(reader, reader.initialOffset(), reader.latestOffset()) == list(range(1, 4021))


# Running


def test_other_streams_stay_out(spark, tmp_path):
    path = str(tmp_path / "feed")
    append_feed(feed_of(spark, {"a": 5}).union(feed_of(spark, {"a": 9}, "other", first=100)), path)
    run(read_stream(spark, path, "s", startingPosition="TRIM_HORIZON"), tmp_path)
    assert written(spark, tmp_path) == [1, 2, 3, 4, 5]


def test_latest_is_the_default_and_resumes(spark, tmp_path):
    path = str(tmp_path / "feed")
    append_feed(feed_of(spark, {"a": 1}), path)
    run(read_stream(spark, path, "s"), tmp_path)
    append_feed(feed_of(spark, {"a": 5}, first=2), path)
    run(read_stream(spark, path, "s"), tmp_path)
    assert written(spark, tmp_path) == [2, 3, 4, 5, 6]  # and not 1
    # New shards are read from their beginning.
    append_feed(feed_of(spark, {"child": 3}, first=7), path)
    run(read_stream(spark, path, "s"), tmp_path)
    assert written(spark, tmp_path) == [2, 3, 4, 5, 6, 7, 8, 9]
    run(read_stream(spark, path, "s"), tmp_path)
    assert written(spark, tmp_path) == [2, 3, 4, 5, 6, 7, 8, 9]


def test_limited_stream_steps_over_restarts(spark, tmp_path):
    path = str(tmp_path / "feed")
    append_one_file(feed_of(spark, {"a": 20, "b": 3}), path, page=5)
    limits = {"executor.maxRecordPerRead": "5", "executor.maxFetchRecordsPerShard": "7"}
    stream = read_stream(spark, path, "s", startingPosition="trim_horizon", **limits)
    run(stream, tmp_path)
    assert written(spark, tmp_path) == [*range(1, 11), 21, 22, 23]
    assert drain(lambda: writer_of(stream, tmp_path)) == 1
    assert written(spark, tmp_path) == list(range(1, 24))
    assert drain(lambda: writer_of(stream, tmp_path)) == 0


def test_limited_stream_keeps_going(spark, tmp_path):
    path = str(tmp_path / "feed")
    append_one_file(feed_of(spark, {"a": 20}), path, page=5)
    stream = read_stream(
        spark, path, "s", startingPosition="trim_horizon",
        **{"executor.maxRecordPerRead": "5", "executor.maxFetchRecordsPerShard": "0"},
    )
    query = (
        stream.writeStream.format("parquet").option("path", f"{tmp_path}/out")
        .option("checkpointLocation", f"{tmp_path}/checkpoint")
        .trigger(processingTime="0 seconds").start()
    )
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    sizes = [p["numInputRows"] for p in query.recentProgress if p["numInputRows"]]
    assert sizes == [5, 5, 5, 5]
    assert written(spark, tmp_path) == list(range(1, 21))


def test_position_log_of_a_stream(spark, tmp_path):
    path, log = str(tmp_path / "feed"), str(tmp_path / "log")
    shards = {"a": (None, None, "1", None)}

    def step(counts, first, listing):
        append_feed(feed_of(spark, counts, first=first), path)
        write_catalogue(catalogue_of(spark, listing), path)
        stream = read_stream(
            spark, path, "s", startingPosition="trim_horizon", includeShardId="true"
        )
        writer = write_with_log(
            stream, lambda b, n: b.write.mode("overwrite").parquet(f"{tmp_path}/out/batch={n}"),
            path, log, "s", f"{tmp_path}/checkpoint", min_batches_to_retain=1,
        )
        writer.trigger(availableNow=True).start().awaitTermination(120)

    step({"a": 4}, 1, shards)
    assert as_dict(position_log.log_get(spark, log, 0))["a"][0] == "AFTER_SEQUENCE_NUMBER"
    shards = {"a": (None, None, "1", "6"), "b": ("a", None, "7", None)}
    step({"a": 2, "b": 3}, 5, shards)
    at = as_dict(position_log.log_get(spark, log, 1))
    assert {s: (k, int(p or 0)) for s, (k, p) in at.items()} == {
        "a": ("SHARD_END", 0),
        "b": ("AFTER_SEQUENCE_NUMBER", 9),
    }
    step({"b": 1}, 10, shards)
    assert position_log.log_batch_ids(spark, log) == [1, 2]
    at = as_dict(position_log.log_get(spark, log, 2))
    assert (at["a"][0], int(at["b"][1])) == ("SHARD_END", 10)
    assert sorted(int(r.sequenceNumber) for r in spark.read.parquet(f"{tmp_path}/out").collect()) == list(range(1, 11))


def logged(spark, tmp_path, sink=lambda b, n: b.collect(), **options):
    """One run of a stream with a log."""
    stream = read_stream(spark, str(tmp_path / "feed"), "s", includeShardId="true", **options)
    writer = write_with_log(stream, sink, str(tmp_path / "feed"), str(tmp_path / "log"), "s", f"{tmp_path}/checkpoint")
    writer.trigger(availableNow=True).start().awaitTermination(120)


def test_idle_shard_stays_after_its_head(spark, tmp_path):
    path = str(tmp_path / "feed")
    append_feed(feed_of(spark, {"a": 5, "b": 3}), path)
    write_catalogue(catalogue_of(spark, {s: (None, None, "1", None) for s in "abc"}), path)
    logged(spark, tmp_path)
    append_feed(feed_of(spark, {"a": 2}, first=9), path)
    logged(spark, tmp_path)
    log = str(tmp_path / "log")
    for batch, head in ((0, "5"), (1, "10")):
        assert {s: (k, p.lstrip("0")) for s, (k, p) in as_dict(position_log.log_get(spark, log, batch)).items()} == {
            "a": ("AFTER_SEQUENCE_NUMBER", head), "b": ("AFTER_SEQUENCE_NUMBER", "8"), "c": ("TRIM_HORIZON", ""),
        }


def test_lost_log_fails(spark, tmp_path):
    path = str(tmp_path / "feed")
    for n in range(2):
        append_feed(feed_of(spark, {"a": 2}, first=1 + 2 * n), path)
        write_catalogue(catalogue_of(spark, {"a": (None, None, "1", None)}), path)
        if n:
            position_log.log_purge(spark, str(tmp_path / "log"), 5)
            with pytest.raises(Exception, match="no batch 0"):
                logged(spark, tmp_path, startingPosition="trim_horizon")
        else:
            logged(spark, tmp_path, startingPosition="trim_horizon")


def test_open_parent_fails(spark, tmp_path):
    path = str(tmp_path / "feed")
    append_feed(feed_of(spark, {"a": 2, "b": 2}), path)
    write_catalogue(catalogue_of(spark, {"a": (None, None, "1", None), "b": ("a", None, "3", None)}), path)
    with pytest.raises(Exception, match="has children but is not closed"):
        logged(spark, tmp_path, startingPosition="trim_horizon")


def test_log_settings_are_checked_first(spark, tmp_path):
    stream = read_stream(spark, str(tmp_path), "s", includeShardId="true")
    kind = {"executor.metadata.committer": "other"}
    for log, more in (("/log", {"options": kind}), ("/log", {"min_batches_to_retain": 0}), (None, {})):
        with pytest.raises(ValueError):
            write_with_log(stream, lambda b, n: None, "/feed", log, "s", "/checkpoint", **more)
    named = {"feed.executor.metadata.committer": "dbfs", "feed.executor.metadata.path": "dbfs:/log"}
    assert opts.log_settings(named) == ("dbfs", "dbfs:/log")
    assert opts.log_settings({}) == ("hdfs", None)
    assert write_with_log(stream, lambda b, n: None, "/feed", None, "s", "/checkpoint", options=named)


def test_stream_equals_batch(spark, tmp_path):
    path = str(tmp_path / "feed")
    append_feed(feed_of(spark, {"a": 50, "b": 7}), path)
    run(read_stream(spark, path, "s", startingPosition="trim_horizon"), tmp_path)
    streamed = spark.read.schema(ENVELOPE).parquet(f"{tmp_path}/out")
    stored = read_feed(spark, path).select(*ENVELOPE.names)
    assert sorted(map(tuple, streamed.collect())) == sorted(map(tuple, stored.collect()))
    assert shard_ranges(read_feed(spark, path)).select(*SHARD_KEY, "records").count() == 2


def test_rows_reach_a_function(spark, tmp_path):
    path, seen = str(tmp_path / "feed"), []
    append_feed(feed_of(spark, {"x": 3, "y": 1}, "words", first=41, data=b"plain words"), path)
    stream = read_stream(spark, path, "words", startingPosition="TRIM_HORIZON", includeShardId="true")
    pairs = stream.select("shardId", F.upper(F.decode("data", "UTF-8")).alias("said"))
    pairs.writeStream.foreachBatch(lambda b, n: seen.extend(map(tuple, b.collect()))).trigger(
        availableNow=True
    ).option("checkpointLocation", f"{tmp_path}/checkpoint").start().awaitTermination(120)
    assert sorted(seen) == [("x", "PLAIN WORDS")] * 3 + [("y", "PLAIN WORDS")]


def test_decoded_stream_from_latest(spark, tmp_path):
    path = str(tmp_path / "feed")
    event = event_schema(image={"id": "N", "n": "S"}, keys={"id": "N"})

    def push(numbers, first):
        text = "concat('{\"change\":{\"NewImage\":{\"n\":{\"S\":\"', cast(sequenceNumber as int) - 1, '\"}}}}')"
        rows = feed_of(spark, {"a": numbers}, first=first)
        append_feed(rows.withColumn("data", F.expr(f"cast({text} as binary)")), path)

    def numbers():
        stream = decode_event(read_stream(spark, path, "s", startingPosition="latest"), event)
        run(stream.select(typed_attribute("n", "S", "int", strict=True).alias("n")), tmp_path)
        return sorted(r.n for r in spark.read.schema("n int").parquet(f"{tmp_path}/out").collect())

    push(4, first=8)
    assert numbers() == []
    push(3, first=12)
    assert numbers() == [11, 12, 13]  # not 7 to 10, which came before the start


@pytest.mark.parametrize("limits", [{}, {"executor.maxRecordPerRead": "5", "executor.maxFetchRecordsPerShard": "0"}])
def test_failed_batch_is_replayed_as_it_was(spark, tmp_path, limits):
    path, log = str(tmp_path / "feed"), str(tmp_path / "log")
    append_one_file(feed_of(spark, {"a": 10}), path, page=5)
    write_catalogue(catalogue_of(spark, {"a": (None, None, "1", None)}), path)
    seen = []

    def attempt(fail):
        def sink(batch, n):
            seen.append((n, sorted(int(r.sequenceNumber) for r in batch.collect())))
            if fail:
                raise RuntimeError("lost the sink")

        stream = read_stream(
            spark, path, "s", startingPosition="trim_horizon", includeShardId="true", **limits
        )
        writer = write_with_log(stream, sink, path, log, "s", f"{tmp_path}/checkpoint")
        writer.trigger(availableNow=True).start().awaitTermination(120)

    with pytest.raises(Exception, match="lost the sink"):
        attempt(fail=True)
    assert position_log.log_get(spark, log, 0) is None
    append_one_file(feed_of(spark, {"a": 3}, first=11), path, page=5)
    attempt(fail=False)
    first = list(range(1, 6)) if limits else list(range(1, 11))
    assert seen[:2] == [(0, first), (0, first)]
    assert as_dict(position_log.log_get(spark, log, 0))["a"][1] == str(first[-1]).zfill(21)
    for _ in range(3):
        attempt(fail=False)
    assert sorted(n for _, rows in seen[1:] for n in rows) == list(range(1, 14))


def test_shard_unlisted_while_half_read(spark, tmp_path):
    append_one_file(feed_of(spark, {"a": 20, "b": 20}), str(tmp_path), page=5)
    listing = {"a": (None, None, str(1).zfill(21), None), "b": (None, None, str(21).zfill(21), None)}
    write_catalogue(catalogue_of(spark, listing), str(tmp_path))
    limits = {"executor.maxrecordperread": "5", "executor.maxfetchrecordspershard": "5"}
    reader = ChangeFeedReader(options_of(tmp_path, startingposition="trim_horizon", **limits))
    at, found = reader.initialOffset(), []
    for step in range(5):
        end = reader.latestOffset()
        found += rows_of(reader, at, end)
        at = end
        if not step:
            write_catalogue(catalogue_of(spark, {"a": listing["a"]}), str(tmp_path))
    assert sorted(found) == list(range(1, 41))
    assert standing(at) == {"a": ("AFTER_SEQUENCE_NUMBER", 20), "b": ("SHARD_END", 40)}
    # Neither later listings nor a restart bring a drained shard back.
    write_catalogue(catalogue_of(spark, {"a": listing["a"]}), str(tmp_path))
    again = ChangeFeedReader(options_of(tmp_path, startingposition="trim_horizon", **limits))
    again.partitions(at, at)
    assert rows_of(again, at, again.latestOffset()) == []


def test_shard_unlisted_before_it_is_read(spark, tmp_path):
    append_feed(feed_of(spark, {"a": 20, "b": 20}), f"{tmp_path}/feed", page=5)
    for shards in ("ab", "a"):
        write_catalogue(catalogue_of(spark, {s: (None, None, "1", None) for s in shards}), f"{tmp_path}/feed")
    stream = read_stream(spark, f"{tmp_path}/feed", "s", startingPosition="TRIM_HORIZON")
    drain(lambda: writer_of(stream, tmp_path))
    assert written(spark, tmp_path) == list(range(1, 41))


def test_start_after_end_fails(spark, tmp_path):
    append_feed(feed_of(spark, {"a": 40}), str(tmp_path), page=5)
    reader = ChangeFeedReader(options_of(tmp_path, startingposition="trim_horizon"))
    end = reader.latestOffset()
    early = {**end, "a": {**end["a"], "iteratorPosition": str(3).zfill(21)}}
    with pytest.raises(ValueError, match="starts after its end"):
        reader.partitions(end, early)


def test_batch_ids_of_offsets(spark, tmp_path):
    append_one_file(feed_of(spark, {"a": 20}), str(tmp_path), page=5)
    limits = {"executor.maxrecordperread": "5", "executor.maxfetchrecordspershard": "5"}
    reader = ChangeFeedReader(options_of(tmp_path, startingposition="trim_horizon", **limits))
    at, ids = reader.initialOffset(), []
    for _ in range(4):
        end = reader.latestOffset()
        assert end == reader.latestOffset()
        reader.partitions(at, end)
        ids.append(end["metadata"]["batchId"])
        at = end
    assert ids == ["0", "1", "1", "1"]


def test_reads_are_bounded(spark, tmp_path):
    # One file of many row groups; a read gives small batches, of the rows it was asked for alone.
    payload = F.repeat(F.sha2(F.col("sequenceNumber"), 256), 8).cast("binary")
    append_one_file(feed_of(spark, {"a": 9_000, "b": 9_000}).withColumn("data", payload), str(tmp_path), page=5)
    file = next((tmp_path / "data").rglob("*.parquet"))
    assert pq.ParquetFile(file).num_row_groups > 4
    limits = {"executor.maxrecordperread": "5", "executor.maxfetchrecordspershard": "4"}
    for more, most in (({}, 4_096), (limits, 5)):
        reader = ChangeFeedReader(options_of(tmp_path, startingposition="trim_horizon", **more))
        at, end = reader.initialOffset(), reader.latestOffset()
        (part,) = reader.partitions(at, end)
        sizes = [batch.num_rows for batch in reader.read(part)]
        assert max(sizes) <= most and sum(sizes) == (10 if more else 18_000)
    assert part.runs == [(0, 5), (9_000, 9_005)]
    reader.commit(end)
    at, end = end, reader.latestOffset()
    assert rows_of(reader, at, end) == [*range(6, 11), *range(9_006, 9_011)]


def test_drain_goes_on_in_one_query(spark, tmp_path):
    append_one_file(feed_of(spark, {"a": 40}), f"{tmp_path}/feed", page=5)
    limits = {"executor.maxRecordPerRead": "5", "executor.maxFetchRecordsPerShard": "4"}
    stream = read_stream(spark, f"{tmp_path}/feed", "s", startingPosition="TRIM_HORIZON", **limits)
    started = []
    assert drain(lambda: started.append(0) or writer_of(stream, tmp_path)) == 8
    assert len(started) == 2
    assert written(spark, tmp_path) == list(range(1, 41))


def test_planner_keeps_few_row_groups(spark, tmp_path, monkeypatch):
    from changefeed.sources import stream as module

    monkeypatch.setattr(module, "_KEPT_BYTES", 1)
    append_one_file(feed_of(spark, {"a": 30, "b": 30}), str(tmp_path), page=5)
    append_feed(feed_of(spark, {"a": 30}, first=100), str(tmp_path), page=5)
    limits = {"executor.maxrecordperread": "7", "executor.maxfetchrecordspershard": "6"}
    reader = ChangeFeedReader(options_of(tmp_path, startingposition="trim_horizon", **limits))
    at, found = reader.initialOffset(), []
    while (end := reader.latestOffset()) != at:
        found += rows_of(reader, at, end)
        at = end
        assert len(reader._columns) == 1 and reader._held == sum(c.nbytes for c in reader._columns.values())
    assert sorted(found) == [*range(1, 61), *range(100, 130)]


@pytest.mark.parametrize("order", ["sorted", "mixed"])
def test_planner_holds_few_pages(spark, tmp_path, monkeypatch, order):
    # Listings of any order and of many pages; a row group is read again for the next pages of a shard.
    from changefeed.sources import store, stream as module

    plain = store._list_pages
    if order == "mixed":
        monkeypatch.setattr(store, "_list_pages", lambda *a: plain(*a).orderBy(F.rand(1)).repartition(3))
    append_feed(feed_of(spark, {"a": 300, "b": 100}), str(tmp_path), page=1)
    append_feed(feed_of(spark, {"b": 90, "c": 10}, first=500), str(tmp_path), page=3)
    monkeypatch.setattr(module, "_NEAR_PAGES", 24)
    monkeypatch.setattr(module, "_LISTED_BYTES", 1)
    limits = {"executor.maxrecordperread": "20", "executor.maxfetchrecordspershard": "15"}
    reader = ChangeFeedReader(options_of(tmp_path, startingposition="trim_horizon", **limits))
    at, sizes, found = reader.initialOffset(), [], []
    while (end := reader.latestOffset()) != at:
        batch = rows_of(reader, at, end)
        assert rows_of(reader, at, end) == batch
        sizes.append(len(batch))
        found += batch
        reader.commit(end)
        at = end
        listing = reader._pages
        assert all(len(pages.file) <= 9 for _, pages in listing._near.values()) and len(listing._read) <= 1
        assert sum(len(of) for of in listing.shards.values()) <= 16
    assert sorted(found) == [*range(1, 401), *range(500, 600)]
    assert sizes == [50, *[40] * 8, 30, *[20] * 5]


def test_planner_takes_numbers_that_repeat(spark, tmp_path):
    # Pages of one number and records without one.
    rows = feed_of(spark, {"a": 12}).withColumn(
        "sequenceNumber", F.expr("case when sequenceNumber < 4 then null when sequenceNumber < 9 then '5' else sequenceNumber end")
    )
    append_feed(rows, str(tmp_path), page=2)
    reader = ChangeFeedReader(options_of(tmp_path, startingposition="trim_horizon"))
    at, end = reader.initialOffset(), reader.latestOffset()
    assert rows_of(reader, at, end) == [5] * 5 + [9, 10, 11, 12]
