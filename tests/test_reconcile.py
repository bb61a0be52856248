"""Copies of a feed with planted differences."""

from helpers import feed_of
from pyspark.sql import functions as F

from changefeed.schema import SHARD_KEY
from changefeed.sources import reconcile as rc
from changefeed.sources.store import append_feed, read_feed, read_pages


def differences(spark, place):
    rows = rc.reconcile(spark, f"{place}/one", f"{place}/two").collect()
    return {(r["shardId"], int(r["seqKey"][10:]), r["difference"]) for r in rows}


def number():
    return F.col("sequenceNumber").cast("int")


def copies(spark, place, counts, change):
    rows = feed_of(spark, counts)
    append_feed(rows, f"{place}/one", page=100, files=6)
    append_feed(change(rows), f"{place}/two", page=70, files=4)


def test_equal_copies(spark, tmp_path):
    copies(spark, tmp_path, {"a": 3_000, "b": 40}, lambda rows: rows)
    assert differences(spark, tmp_path) == set()


def test_planted_differences(spark, tmp_path):
    def change(rows):
        lost = rows.filter(~number().isin(1_500, 4_010))
        moved = F.when(number() == 2_700, F.lit(None).cast("string")).otherwise(F.col("partitionKey"))
        twice = rows.filter(number() == 7)
        more = rows.filter(number() == 1).selectExpr("*").withColumn("shardId", F.lit("new"))
        return lost.withColumn("partitionKey", moved).unionByName(twice).unionByName(more)

    copies(spark, tmp_path, {"a": 4_000, "b": 100}, change)
    assert differences(spark, tmp_path) == {
        ("a", 1_500, "missing"),
        ("b", 4_010, "missing"),
        ("a", 2_700, "changed"),
        ("a", 7, "changed"),
        ("new", 1, "added"),
    }


def test_only_differing_files_are_read(spark, tmp_path):
    copies(spark, tmp_path, {"a": 12_000}, lambda rows: rows.filter(number() != 11_500))
    for name in ("one", "two"):
        rc.write_digests(spark, f"{tmp_path}/{name}")
    ranges = rc.differing_ranges(spark, f"{tmp_path}/one", f"{tmp_path}/two")
    assert ranges.select(*SHARD_KEY).distinct().count() == ranges.count() == 1
    files = rc._files(spark, f"{tmp_path}/one", ranges).count()
    assert 1 <= files < read_pages(spark, f"{tmp_path}/one").select("part").distinct().count()
    inside = rc.rows_in_ranges(spark, f"{tmp_path}/one", ranges)
    assert inside.count() == 1_000
    assert "dynamicpruning" in inside._jdf.queryExecution().toString()


def test_digests_of_new_appends_only(spark, tmp_path):
    copies(spark, tmp_path, {"a": 50}, lambda rows: rows)
    assert differences(spark, tmp_path) == set()
    later = feed_of(spark, {"a": 20}, first=51)
    append_feed(later, f"{tmp_path}/one")
    append_feed(later.filter(number() != 60), f"{tmp_path}/two")
    assert differences(spark, tmp_path) == {("a", 60, "missing")}
    runs = rc.complete(spark, f"{tmp_path}/one", "digests")
    assert len(runs) == 2
    assert read_feed(spark, f"{tmp_path}/one").count() == 70
    levels = [rc._stored(spark, f"{tmp_path}/one", n).select(F.sum("records")).head()[0] for n in range(4)]
    assert levels == [70] * 4


def test_large_files_become_more(spark, tmp_path, monkeypatch):
    from changefeed.sources import store

    monkeypatch.setattr(store, "_FILE_BYTES", 20_000)
    append_feed(feed_of(spark, {"a": 1_000, "b": 100}), f"{tmp_path}/many", files=3)
    append_feed(feed_of(spark, {"a": 100}), f"{tmp_path}/few", files=3)
    parts = [read_feed(spark, f"{tmp_path}/{x}").groupBy("part").count().collect() for x in ("many", "few")]
    assert 5 <= len(parts[0]) and max(r["count"] for r in parts[0]) <= 400
    assert len(parts[1]) <= 3
