"""Position log: a keyed table of where each shard stood after each batch.

Entries are appended under ``batch_id`` directories with a version, one more than
the highest that the batch has, and the newest version of a key wins. So a retried
add replaces the first whatever a clock says, a lost executor only repeats its own
task, and a batch of a million shards is a few files rather than a million.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from changefeed import storage
from changefeed.schema import SHARD_KEY

LOG_DIR = "shard-commit"
_PREFIX = "batch_id="

_STORED = T.StructType(
    [
        T.StructField("streamName", T.StringType()),
        T.StructField("shardId", T.StringType()),
        T.StructField("iteratorType", T.StringType()),
        T.StructField("iteratorPosition", T.StringType()),
        T.StructField("version", T.LongType()),
        T.StructField("batch_id", T.LongType()),
    ]
)


def check_log_path(kind: str, path: str) -> str:
    """Validate the log's type and place; any file system Spark can write will do."""
    wanted = kind.strip().lower()
    if wanted not in ("hdfs", "dbfs"):
        raise ValueError(f"position log type must be hdfs or dbfs, not {kind}")
    if wanted == "dbfs" and not path.startswith("dbfs"):
        raise ValueError(f"a dbfs position log needs a dbfs path, not {path}")
    return path


def _root(path: str) -> str:
    return f"{path.rstrip('/')}/{LOG_DIR}"


def _newest(stored: DataFrame) -> DataFrame:
    entry = F.struct("iteratorType", "iteratorPosition")
    return (
        stored.groupBy("batch_id", *SHARD_KEY)
        .agg(F.max_by(entry, "version").alias("_e"))
        .select("batch_id", *SHARD_KEY, "_e.iteratorType", "_e.iteratorPosition")
    )


def log_add(entries: DataFrame, path: str, batch_id: int | None = None) -> None:
    """Add entries; one with the same batch, stream and shard replaces the old one.

    ``entries`` has the position columns, and ``batch_id`` unless it is given.
    """
    if batch_id is not None:
        entries = entries.withColumn("batch_id", F.lit(batch_id).cast("bigint"))
    spark = entries.sparkSession
    stored = _stored(spark, path, log_batch_ids(spark, path))
    if batch_id is not None:
        stored = stored.filter(F.col("batch_id") == batch_id)
    newest = stored.groupBy("batch_id").agg(F.max("version").alias("_newest"))
    incomplete = F.col("iteratorType").isNull() | F.col("iteratorPosition").isNull()
    refuse = F.raise_error(F.lit("a null position cannot be written to the position log"))
    (
        entries.withColumn("batch_id", F.col("batch_id").cast("bigint"))
        .join(newest, "batch_id", "left")
        .select(
            *SHARD_KEY,
            F.when(incomplete, refuse.cast("string"))
            .otherwise(F.col("iteratorType"))
            .alias("iteratorType"),
            "iteratorPosition",
            (F.coalesce("_newest", F.lit(0)) + 1).alias("version"),
            "batch_id",
        )
        .hint("rebalance", "batch_id")
        .write.mode("append")
        .partitionBy("batch_id")
        .parquet(_root(path))
    )


def _stored(spark: SparkSession, path: str, batches: list[int]) -> DataFrame:
    """Every version of the entries of some batches."""
    if not batches:
        return spark.createDataFrame([], _STORED)
    root = _root(path)
    dirs = [f"{root}/{_PREFIX}{b}" for b in batches]
    return spark.read.schema(_STORED).option("basePath", root).parquet(*dirs)


def log_read(spark: SparkSession, path: str) -> DataFrame:
    """All entries, newest version of each key; filters on ``batch_id`` prune directories."""
    return _newest(_stored(spark, path, log_batch_ids(spark, path)))


def log_get(spark: SparkSession, path: str, batch_id: int) -> DataFrame | None:
    """Entries of one batch, or ``None`` for a batch the log does not know."""
    if not storage.exists(spark, f"{_root(path)}/{_PREFIX}{batch_id}"):
        return None
    return _newest(_stored(spark, path, [batch_id]))


def log_batch_ids(spark: SparkSession, path: str) -> list[int]:
    """Batch ids the log holds, ascending; other directories are passed over."""
    found = []
    for name in storage.child_names(spark, _root(path)):
        digits = name.removeprefix(_PREFIX)
        if name.startswith(_PREFIX) and digits.isascii() and digits.removeprefix("-").isdecimal():
            found.append(int(digits))
    return sorted(found)


def log_purge(spark: SparkSession, path: str, threshold: int) -> list[int]:
    """Remove the batches below ``threshold`` from storage; returns their ids."""
    gone = [b for b in log_batch_ids(spark, path) if b < threshold]
    for batch_id in gone:
        storage.delete_dir(spark, f"{_root(path)}/{_PREFIX}{batch_id}")
    return gone


def retention_threshold(current_batch: int, min_batches_to_retain: int) -> int | None:
    """Lowest batch id to keep, or ``None`` while nothing is old enough."""
    if min_batches_to_retain <= 0:
        raise ValueError(f"cannot retain {min_batches_to_retain} batches; keep one or more")
    threshold = current_batch - min_batches_to_retain
    return threshold if threshold >= 0 else None


def log_retain(
    spark: SparkSession, path: str, current_batch: int, min_batches_to_retain: int
) -> list[int]:
    """What a commit of ``current_batch`` does: purge the batches no longer needed."""
    threshold = retention_threshold(current_batch, min_batches_to_retain)
    return [] if threshold is None else log_purge(spark, path, threshold)
