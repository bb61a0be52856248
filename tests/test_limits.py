import random
from collections import defaultdict

import pytest
from helpers import as_dict, catalogue_of, feed_of, positions_of, seqs
from pyspark.sql import functions as F

from changefeed.functions.payload import unpack_records
from changefeed.operators import limits
from changefeed.operators.ordinal import with_shard_ordinal
from changefeed.operators.positions import apply_positions
from changefeed.operators.progress import next_positions
from changefeed.schema import SHARD_KEY
from changefeed.sources.feed import shard_ranges
from changefeed.sources.store import (
    append_feed,
    read_feed,
    read_pages,
    stored_from,
    stored_ordinal,
    stored_ranges,
    stored_slice,
)
from changefeed.storage import session_conf

# One shard holds more than a third of all rows.
COUNTS = {"hot": 700, **{f"s{i:02d}": 10 * i for i in range(1, 15)}}


@pytest.fixture(scope="module")
def feed(spark):
    return feed_of(spark, COUNTS).orderBy(F.xxhash64("sequenceNumber")).repartition(16)


def first_rows(feed, limit):
    shards = defaultdict(list)
    for shard, seq in seqs(feed):
        shards[shard].append(seq)
    return sorted((s, n) for s, numbers in shards.items() for n in sorted(numbers)[:limit])


@pytest.mark.parametrize("page, cap, limit", [(5, 12, 15), (5, 10, 15), (5, 9, 10), (10000, 100000, 110000)])
def test_soft_cap(page, cap, limit):
    assert limits.batch_limit(page, cap) == limit


def test_bad_limits():
    with pytest.raises(ValueError):
        limits.batch_limit(0, 1)
    with pytest.raises(ValueError):
        limits.batch_limit(1, -1)


def test_ordinals_of_a_hot_shard(spark, feed):
    got = with_shard_ordinal(feed).select("shardId", "sequenceNumber", "ordinal").collect()
    ranks, seen = {}, defaultdict(int)
    for shard, seq in seqs(feed):
        seen[shard] += 1
        ranks[shard, seq] = seen[shard]
    assert {(r.shardId, r.sequenceNumber): r.ordinal for r in got} == ranks
    assert len(got) == sum(COUNTS.values())


def test_hot_shard_spans_partitions(spark, feed):
    placed = feed.repartitionByRange(*SHARD_KEY, "sequenceNumber")
    placed = placed.withColumn("part", F.spark_partition_id())
    spread = placed.groupBy("shardId").agg(F.countDistinct("part").alias("n"))
    assert {r.shardId: r.n for r in spread.collect()}["hot"] > 1


def test_page_numbers(feed):
    got = limits.page_numbers(feed, 7).groupBy("shardId", "pageNumber").count().collect()
    for row in got:
        last = (COUNTS[row.shardId] - 1) // 7
        assert row["count"] == 7 if row.pageNumber < last else row["count"] <= 7
    assert sum(r["count"] for r in got) == sum(COUNTS.values())


@pytest.mark.parametrize("page, cap", [(5, 12), (100, 50), (3, 600), (1000, 100)])
def test_cap(spark, feed, page, cap):
    got = limits.cap_per_shard(feed, page, cap)
    assert got.columns == feed.columns
    assert seqs(got) == first_rows(feed, limits.batch_limit(page, cap))


@pytest.mark.parametrize("threshold", ["1", "100000"])
def test_cap_counts_parts_of_packs(spark, threshold):
    packs = feed_of(spark, {"a": 9, "b": 2}, data=b"[1, 2, 3]").repartition(3)
    with session_conf(spark, "spark.sql.optimizer.windowGroupLimitThreshold", threshold):
        got = limits.cap_per_shard(unpack_records(packs), 5, 2).collect()
    assert sorted((r.shardId, int(r.sequenceNumber), r.subSequence) for r in got) == [
        ("a", 1, 0), ("a", 1, 1), ("a", 1, 2), ("a", 2, 0), ("a", 2, 1),
        ("b", 10, 0), ("b", 10, 1), ("b", 10, 2), ("b", 11, 0), ("b", 11, 1),
    ]


LENGTHS = [1, 21, 40, 46, 56]


@pytest.fixture(scope="module")
def long_feed(spark):
    # Five numbers of each length, in one shard.
    numbers = [str(5 + i).rjust(n, "7") if n > 1 else str(i + 1) for n in LENGTHS for i in range(5)]
    at = feed_of(spark, {"a": len(numbers)}).collect()
    rows = [(r.data, r.streamName, r.partitionKey, n, r[4], r.shardId) for r, n in zip(at, numbers, strict=True)]
    return spark.createDataFrame(rows, feed_of(spark, {"a": 1}).schema).repartition(4), numbers


@pytest.mark.parametrize("at", range(0, 25, 3))
def test_long_numbers(spark, long_feed, tmp_path, at):
    feed, numbers = long_feed
    after = positions_of(spark, {"a": ("AFTER_SEQUENCE_NUMBER", "000" + numbers[at])})
    want = numbers[at + 1 :]
    assert sorted(r.sequenceNumber for r in apply_positions(feed, after).collect()) == sorted(want)
    first = sorted(want, key=int)[:6]
    assert sorted(r.sequenceNumber for r in limits.batch_slice(feed, after, 3, 4).collect()) == sorted(first)


def test_long_numbers_in_a_store(spark, long_feed, tmp_path):
    feed, numbers = long_feed
    path = str(tmp_path)
    append_feed(feed.filter(F.length("sequenceNumber") <= 40), path, page=4)
    append_feed(feed.filter(F.length("sequenceNumber") > 40), path, page=4)
    with pytest.raises(ValueError, match="out of sequence"):
        append_feed(feed.filter(F.length("sequenceNumber") == 46), path)
    ranges = stored_ranges(read_pages(spark, path)).first()
    assert (ranges.startSeq, ranges.headSeq, ranges.records) == (numbers[0], numbers[-1], 25)
    for at in range(24):
        start = positions_of(spark, {"a": ("AT_SEQUENCE_NUMBER", numbers[at])})
        got = stored_slice(spark, path, start, 3, 4).collect()
        assert sorted(int(r.sequenceNumber) for r in got) == [int(n) for n in numbers[at : at + 6]]


@pytest.fixture(scope="module")
def stored(spark, feed, tmp_path_factory):
    # Three appends: within each shard, later ones hold later numbers.
    path = str(tmp_path_factory.mktemp("feed"))
    numbered = with_shard_ordinal(feed)
    total = numbered.groupBy(*SHARD_KEY).agg(F.max("ordinal").alias("n"))
    thirds = numbered.join(total, SHARD_KEY).withColumn(
        "third", F.floor((F.col("ordinal") - 1) * 3 / F.col("n"))
    )
    for third in range(3):
        append_feed(thirds.filter(F.col("third") == third), path, page=5)
    return path


def test_store_keeps_every_row(spark, feed, stored):
    assert seqs(read_feed(spark, stored)) == seqs(feed)


def test_listing_gives_the_ranges(spark, stored):
    pages = read_pages(spark, stored)
    assert pages.agg(F.max("records")).first()[0] <= 5
    want = shard_ranges(read_feed(spark, stored))
    assert sorted(map(tuple, stored_ranges(pages).collect())) == sorted(map(tuple, want.collect()))


def test_stored_ordinals(spark, feed, stored):
    got = stored_ordinal(spark, stored).select("shardId", "sequenceNumber", "ordinal").collect()
    ranks, seen = {}, defaultdict(int)
    for shard, seq in seqs(feed):
        seen[shard] += 1
        ranks[shard, seq] = seen[shard]
    assert {(r.shardId, r.sequenceNumber): r.ordinal for r in got} == ranks


def test_two_streams_in_one_store(spark, tmp_path):
    # Same shard ids in both streams.
    path = str(tmp_path)
    both = feed_of(spark, {"a": 30, "b": 9}).union(feed_of(spark, {"a": 7}, "other", first=5))
    append_feed(both.repartition(4), path, page=5, files=3)
    numbered = stored_ordinal(spark, path).filter("streamName = 'other'").collect()
    assert sorted((r.ordinal, int(r.sequenceNumber)) for r in numbered) == [
        (i, i + 4) for i in range(1, 8)
    ]
    standing = positions_of(spark, {"a": ("TRIM_HORIZON", "")}).union(
        positions_of(spark, {"a": ("AFTER_SEQUENCE_NUMBER", "8")}, "other")
    )
    got = stored_slice(spark, path, standing, 5, 7).groupBy("streamName").count().collect()
    assert {r.streamName: r["count"] for r in got} == {"s": 10, "other": 3}


def test_append_out_of_sequence_is_refused(spark, tmp_path):
    path = str(tmp_path)
    append_feed(feed_of(spark, {"a": 5}, first=10), path)
    for first in (1, 14):
        with pytest.raises(ValueError, match="out of sequence"):
            append_feed(feed_of(spark, {"a": 3}, first=first), path)
    append_feed(feed_of(spark, {"b": 3}), path)
    append_feed(feed_of(spark, {"a": 3}, first=15), path)
    assert sorted(int(n) for _, n in seqs(read_feed(spark, path))) == [1, 2, 3, *range(10, 18)]


@pytest.mark.parametrize(
    "seed, page, cap", [(0, 5, 12), (1, 3, 4), (2, 10000, 100000), (3, 5, 12)]
)
def test_pruned_slice_is_the_slice(spark, stored, seed, page, cap):
    rng = random.Random(seed)
    kinds = ["TRIM_HORIZON", "LATEST", "AT_TIMESTAMP", "AFTER_SEQUENCE_NUMBER", "AT_SEQUENCE_NUMBER", "SHARD_END"]
    at, first = {}, 1
    for shard, count in COUNTS.items():
        kind, seq = rng.choice(kinds), rng.randrange(first - 1, first + count + 2)
        place = {"AT_TIMESTAMP": str((1704067200 + seq) * 1000)}.get(kind, str(seq) if "SEQ" in kind else "")
        at[shard] = (kind, place)
        first += count
    standing = positions_of(spark, at)
    assert seqs(stored_from(spark, stored, standing)) == seqs(apply_positions(read_feed(spark, stored), standing))
    want = limits.batch_slice(read_feed(spark, stored), standing, page, cap)
    assert seqs(stored_slice(spark, stored, standing, page, cap)) == seqs(want)
    assert first_rows(apply_positions(read_feed(spark, stored), standing), limits.batch_limit(page, cap)) == seqs(want)


def files_read(rows):
    plan = rows._jdf.queryExecution().executedPlan()
    rows.collect()
    found, todo = 0, [plan]
    while todo:
        node = todo.pop()
        if node.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
        elif node.getClass().getSimpleName().endswith("QueryStageExec"):
            todo.append(node.plan())
        elif node.getClass().getSimpleName() == "FileSourceScanExec":
            found += node.metrics().apply("numFiles").value()
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return found


def test_files_are_pruned_by_the_join(spark, stored):
    ends = {s: ("AFTER_SEQUENCE_NUMBER", "1000000") for s in COUNTS}
    assert stored_slice(spark, stored, positions_of(spark, ends)).isEmpty()
    start = positions_of(spark, {"hot": ("TRIM_HORIZON", ""), "s03": ("AT_SEQUENCE_NUMBER", "1")})
    some = stored_from(spark, stored, positions_of(spark, {"s03": ("AT_SEQUENCE_NUMBER", "1")}))
    assert "dynamicpruning" in some._jdf.queryExecution().executedPlan().toString()
    assert 0 < files_read(some) < read_feed(spark, stored).select("part", "append").distinct().count()
    want = limits.batch_slice(read_feed(spark, stored), start, 5, 12)
    assert seqs(stored_slice(spark, stored, start, 5, 12)) == seqs(want)


def test_refused_append_leaves_nothing(spark, tmp_path):
    append_feed(feed_of(spark, {"a": 5}, first=10), str(tmp_path))
    before = sorted(p.name for p in (tmp_path / "data").iterdir())
    with pytest.raises(ValueError, match="out of sequence"):
        append_feed(feed_of(spark, {"a": 5}, first=3), str(tmp_path))
    assert sorted(p.name for p in (tmp_path / "data").iterdir()) == before


@pytest.mark.parametrize("page, cap", [(100, 250)])
def test_slices_cover_every_row_once(spark, feed, stored, page, cap):
    ranges = {r.shardId: (r.startSeq, r.headSeq) for r in shard_ranges(feed).collect()}
    catalogue = catalogue_of(
        spark, {s: (None, None, a, None if s == "s01" else b) for s, (a, b) in ranges.items()}
    )
    standing = positions_of(spark, {s: ("TRIM_HORIZON", "") for s in COUNTS})
    read = []
    for _ in range(10):
        batch = seqs(stored_slice(spark, stored, standing, page, cap))
        if not batch:
            break
        read += batch
        slice_ = stored_slice(spark, stored, standing, page, cap)
        at = as_dict(next_positions(slice_, standing, catalogue))
        standing = positions_of(spark, at)
    assert sorted(read) == seqs(feed)
    assert at.pop("s01") == ("AFTER_SEQUENCE_NUMBER", ranges["s01"][1])
    assert set(at.values()) == {("SHARD_END", "")}
