import pytest
from helpers import as_dict, feed_of, positions_of, seqs
from pyspark.sql import functions as F

from changefeed.operators import positions as pos
from changefeed.operators.limits import batch_slice
from changefeed.operators.positions import apply_positions, live_positions
from changefeed.sources.store import append_feed, stored_from
from changefeed.storage import session_conf


@pytest.mark.parametrize(
    "text, kind",
    [
        ("latest", "LATEST"),
        (" Latest\n", "LATEST"),
        ("trim_horizon", "TRIM_HORIZON"),
        ("\tTRIM_HORIZON ", "TRIM_HORIZON"),
        (None, "LATEST"),
    ],
)
def test_starting_position(spark, text, kind):
    rows = spark.createDataFrame([(text,)], "t string")
    assert rows.select(pos.parse_starting_position(F.col("t")).alias("k")).first().k == kind


@pytest.mark.parametrize("text", ["", "earliest", "trim horizon"])
def test_unknown_starting_position_fails(spark, text):
    rows = spark.createDataFrame([(text,)], "t string")
    with pytest.raises(Exception, match="latest, trim_horizon"):
        rows.select(pos.parse_starting_position(F.col("t"))).collect()


ALL = {
    "a": ("TRIM_HORIZON", ""),
    "b": ("LATEST", ""),
    "c": ("AT_TIMESTAMP", "1704067225000"),
    "d": ("AFTER_SEQUENCE_NUMBER", "33"),
    "e": ("AT_SEQUENCE_NUMBER", "00044"),
    "f": ("SHARD_END", ""),
}


def test_mixed_positions(spark):
    feed = feed_of(spark, {s: 10 for s in [*ALL, "unlisted"]})
    got = pos.apply_positions(feed, positions_of(spark, ALL))
    assert got.columns == feed.columns
    want = (
        [("a", n) for n in range(1, 11)]
        + [("c", n) for n in range(25, 31)]
        + [("d", n) for n in range(34, 41)]
        + [("e", n) for n in range(44, 51)]
    )
    assert [(s, int(n)) for s, n in seqs(got)] == want


@pytest.mark.parametrize("kind, position", [p for p in ALL.values()])
def test_one_position_is_the_same_as_a_filter(spark, kind, position):
    feed = feed_of(spark, {"a": 40, "b": 40})
    every = positions_of(spark, {"a": (kind, position), "b": (kind, position)})
    assert seqs(pos.read_from(feed, kind, position)) == seqs(pos.apply_positions(feed, every))


def test_same_rows_without_a_broadcast(spark):
    # The way taken when positions are too many to send to every executor.
    feed = feed_of(spark, {"hot": 300, **{s: 10 for s in ALL}})
    standing = positions_of(spark, {**ALL, "hot": ("AFTER_SEQUENCE_NUMBER", "20")})
    want = seqs(pos.apply_positions(feed, standing))
    with session_conf(spark, "spark.sql.autoBroadcastJoinThreshold", "-1"):
        shuffled = pos.apply_positions(feed, standing)
        assert "SortMergeJoin" in shuffled._jdf.queryExecution().executedPlan().toString()
        assert seqs(shuffled) == want


def test_unknown_position_fails(spark):
    with pytest.raises(ValueError, match="unknown position"):
        pos.read_from(feed_of(spark, {"a": 1}), "SOMEWHERE")


def test_unequal_lengths_compare_as_numbers(spark):
    feed = feed_of(spark, {"a": 120}, width=1)
    got = pos.read_from(feed, "AFTER_SEQUENCE_NUMBER", "99")
    assert sorted(int(n) for _, n in seqs(got)) == list(range(100, 121))


def test_streams_do_not_mix(spark):
    feed = feed_of(spark, {"a": 3}).union(feed_of(spark, {"a": 3}, stream="other"))
    got = pos.apply_positions(feed, positions_of(spark, {"a": ("TRIM_HORIZON", "")}))
    assert {r.streamName for r in got.collect()} == {"s"}


def test_latest_is_pinned_to_the_head(spark):
    standing = positions_of(
        spark, {"a": ("LATEST", ""), "b": ("LATEST", ""), "c": ("TRIM_HORIZON", "")}
    )
    heads = spark.createDataFrame([("s", "a", "7")], "streamName string, shardId string, headSeq string")
    assert as_dict(pos.pin_latest(standing, heads)) == {
        "a": ("AFTER_SEQUENCE_NUMBER", "7"),
        "b": ("TRIM_HORIZON", ""),
        "c": ("TRIM_HORIZON", ""),
    }


@pytest.mark.parametrize(
    "kind, position", [("LATER", ""), ("trim_horizon", ""), ("AT_TIMESTAMP", "noon"), ("AT_SEQUENCE_NUMBER", None), (None, "1")]
)
def test_position_that_cannot_be_read_fails(spark, tmp_path, kind, position):
    feed, bad = feed_of(spark, {"a": 3}), positions_of(spark, {"a": (kind, position)})
    append_feed(feed, str(tmp_path))
    for read in (
        lambda: apply_positions(feed, bad).collect(),
        lambda: live_positions(bad).collect(),
        lambda: batch_slice(feed, bad).collect(),
        lambda: stored_from(spark, str(tmp_path), bad).collect(),
    ):
        with pytest.raises(Exception, match="not a position that can be read"):
            read()
