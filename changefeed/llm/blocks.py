"""Bounded blocks of rows, and the small numpy helpers that tasks use on them."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from changefeed.storage import materialise


def block_counts(rows: DataFrame, keys: Sequence[str], size: int) -> DataFrame:
    """Per key, the number of blocks of about ``size`` rows: ``keys, parts``."""
    counted = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return materialise(
        counted.select(*keys, F.ceil(F.col("n") / size).cast("int").alias("parts")), "blocks"
    )


def with_part(rows: DataFrame, counts: DataFrame, keys: Sequence[str], item: Column) -> DataFrame:
    """Adds ``part``, the block of each row within its key, by a hash of ``item``.

    A key with any number of rows is thereby spread over blocks of bounded size.
    """
    return rows.join(counts, list(keys)).withColumn(
        "part", F.pmod(F.xxhash64(item), F.col("parts").cast("bigint")).cast("int")
    ).drop("parts")


def matrix(values: Sequence, width: int) -> np.ndarray:
    """Rows of numbers as a matrix of doubles, short rows filled up with zeros."""
    out = np.zeros((len(values), width))
    for i, row in enumerate(values):
        out[i, : len(row)] = row
    return out


def forest(left: np.ndarray, right: np.ndarray, nodes: int) -> tuple[np.ndarray, np.ndarray]:
    """Links ``nodes - 1`` pairs at most that connect what the given pairs connect."""
    label = np.arange(nodes)
    while True:
        lower = label.copy()
        np.minimum.at(lower, left, label[right])
        np.minimum.at(lower, right, label[left])
        lower = lower[lower]
        if np.array_equal(lower, label):
            linked = np.flatnonzero(label != np.arange(nodes))
            return linked, label[linked]
        label = lower


class Gathered:
    """Columns of many small results, given out as batches of some size."""

    def __init__(self, names: Sequence[str], rows: int = 65_536) -> None:
        self.names, self.rows, self.size = list(names), rows, 0
        self.parts: list[list[np.ndarray]] = [[] for _ in names]

    def add(self, *columns: np.ndarray) -> None:
        for part, column in zip(self.parts, columns, strict=True):
            part.append(column)
        self.size += len(columns[0])

    def take(self, least: int | None = None) -> Iterator[pa.RecordBatch]:
        """A batch, if there are ``least`` rows (by default the size of a batch)."""
        if self.size >= (self.rows if least is None else least):
            columns = [pa.array(np.concatenate(part)) for part in self.parts]
            self.parts, self.size = [[] for _ in self.names], 0
            yield pa.RecordBatch.from_arrays(columns, self.names)


def hash_share(item: Column) -> Column:
    """A number from 0 up to 1 that depends on ``item`` alone."""
    return F.pmod(F.xxhash64(F.lit("sample"), item), F.lit(1 << 31)) / F.lit(float(1 << 31))


def bounded_sample(rows: DataFrame, item: Column, most: int) -> DataFrame:
    """About ``most`` rows, by hash of ``item``; all, if there are no more; never over twice as many."""
    count = rows.count()
    chosen = rows.where(hash_share(item) < most / count) if count > most else rows
    return chosen.limit(2 * most)
