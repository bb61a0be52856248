"""Whitening of embeddings by the leading components of their covariance."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, DecimalType, DoubleType, StructField, StructType

from changefeed.llm.eigen import EPSILON, leading_pairs
from changefeed.storage import materialise

COMPONENTS = 8
STEP, SHIFT = 1024, 100_000
#: Entries of this size or more have no whole number of 64 bits once they are scaled.
MOST = float(2**52)
_LOW, _LIMB = 32, 25
_EXACT = DecimalType(38, 0)


def finite(vector: Column) -> Column:
    """True for a vector that is not null or empty and holds only numbers that can be scaled."""
    sound = F.forall(vector, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < MOST), F.lit(False)))
    return F.coalesce(sound & (F.size(vector) > 0), F.lit(False))


def whole(vectors: pa.Array, step: int = STEP, shift: int = SHIFT) -> np.ndarray:
    """The vectors of one width as rows of whole numbers."""
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(float)
    return np.floor(step * flat).astype(np.int64).reshape(len(vectors), -1) + shift


def _sums(step: int, shift: int):
    """Per batch, width and dimension: rows, sums of upper and lower halves, largest size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column(0)
            widths = vectors.value_lengths().to_numpy()
            for width in np.unique(widths):
                x = whole(vectors.filter(pa.array(widths == width)), step, shift)
                columns = [
                    np.full(width, width, np.int32),
                    np.arange(width, dtype=np.int32),
                    np.full(width, len(x), np.int64),
                    (x >> _LOW).sum(0),
                    (x & ((1 << _LOW) - 1)).sum(0),
                    np.abs(x).max(0),
                ]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c) for c in columns], ["width", "at", "n", "high", "low", "most"]
                )

    return run


def offsets(x: np.ndarray, n: int, sums: np.ndarray, most: int) -> np.ndarray:
    """``n * x - sums``, exactly: 64-bit numbers where they hold it, else Python's."""
    if 2 * n * max(most, 1) < 1 << 62:
        return n * x - sums.astype(np.int64)
    return n * x.astype(object) - sums


def squares(z: np.ndarray) -> list[int]:
    """The sum of squares of each row, exactly."""
    if z.dtype == object or z.shape[1] > 4096 or np.abs(z).max(initial=0) >= 1 << 50:
        return [sum(int(v) * int(v) for v in row) for row in z]
    high, low = z >> _LIMB, z & ((1 << _LIMB) - 1)
    parts = ((high * high).sum(1), (high * low).sum(1), (low * low).sum(1))
    return [
        (a << 2 * _LIMB) + (b << _LIMB + 1) + c for a, b, c in zip(*(p.tolist() for p in parts), strict=True)
    ]


def _products(n: int, sums: np.ndarray, most: int, step: int, shift: int):
    """Per task, the sum of products of centred entries, a row per pair of dimensions."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                centred = (offsets(whole(batch.column(0), step, shift), n, sums, most) / n).astype(float)
                part = centred.T @ centred
                total = part if total is None else total + part
        if total is not None:
            one, other = np.triu_indices(len(total))
            yield pa.RecordBatch.from_arrays(
                [pa.array(one.astype(np.int32)), pa.array(other.astype(np.int32)), pa.array(total[one, other])],
                ["one", "other", "product"],
            )

    return run


def _projected(n: int, sums: np.ndarray, most: int, axes: np.ndarray, step: int, shift: int):
    """Of each vector, its whitened components and the exact square of its offset."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            z = offsets(whole(batch.column(1), step, shift), n, sums, most)
            white = (z / n).astype(float) @ axes
            square = [v if v < 10**38 else None for v in squares(z)]
            starts = pa.array(np.arange(0, white.size + 1, max(white.shape[1], 1))[: len(z) + 1].astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(square, pa.decimal128(38, 0)),
                    pa.ListArray.from_arrays(starts, pa.array(white.ravel())),
                ],
                ["id", "square", "white"],
            )

    return run


def whiten(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    components: int = COMPONENTS,
    step: int = STEP,
    shift: int = SHIFT,
) -> DataFrame:
    """A row per usable vector and component, the first ``components`` at most.

    ``(id_col, component, n, deviation, whitened, explained, identity_error)``.
    Every entry c becomes x = floor(step * c) + shift. Over all n such vectors with
    the sums S of each dimension, ``deviation`` is the exact sum over dimensions of
    (n * x - S)^2, a decimal of 38 digits; ``whitened`` is x - S / n on the
    component, a unit eigenvector of the covariance, over the root of its eigenvalue;
    ``explained`` the eigenvalue's share of the trace; and ``identity_error`` the
    largest absolute entry of the measured covariance of ``whitened`` minus the
    identity.

    A first pass sums each dimension in whole numbers, a second one sums products of
    centred entries, so that nothing cancels; both give rows of partial sums that
    Spark adds up. The driver holds the covariance alone, a square of the width, and
    sends back its leading eigenvectors (:func:`changefeed.llm.eigen.leading_pairs`).
    The projections are written to the shared folder, and their covariance is
    measured on what was written.

    Null and empty vectors, and those with null or non-finite entries, or entries of
    2^52 and more, are left out. Of vectors of several widths those of the most
    common take part (ties: of the widest). Repeated rows count and come as often as
    they are there; a null id stays null. A component without variance is left out,
    so one vector, or equal ones, give no rows; neither does an empty table.
    Components of equal eigenvalues, and signs, are any that fit, the same for all
    rows. A deviation beyond 38 digits is null. Other columns are ignored.
    """
    spark = vectors.sparkSession
    kind = vectors.select(id_col).schema[0]
    usable = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).alias("vector")).where(
        finite(F.col(vector_col))
    )
    parts = usable.select("vector").mapInArrow(
        _sums(step, shift), "width int, at int, n bigint, high bigint, low bigint, most bigint"
    )
    summed = materialise(
        parts.groupBy("width", "at").agg(
            F.sum("n").alias("n"),
            F.sum(F.col("high").cast(DecimalType(19, 0))).alias("high"),
            F.sum(F.col("low").cast(DecimalType(19, 0))).alias("low"),
            F.max("most").alias("most"),
        ),
        "sums",
    )
    widest = summed.where("at = 0").orderBy(F.desc("n"), F.desc("width")).limit(1).select("width", "n")
    shown = widest.collect()
    out = StructType([StructField("id", kind.dataType), StructField("square", _EXACT), StructField("white", ArrayType(DoubleType()))])
    if not shown:
        return _rows(spark.createDataFrame([], out), id_col, 0, [], 0.0)
    width, n = shown[0]
    found = summed.where(F.col("width") == width).orderBy("at").collect()
    sums = np.array([(int(r["high"]) << _LOW) + int(r["low"]) for r in found], dtype=object)
    most = max(r["most"] for r in found)
    chosen = usable.where(F.size("vector") == width)

    products = chosen.select("vector").mapInArrow(
        _products(n, sums, most, step, shift), "one int, other int, product double"
    )
    covariance = np.zeros((width, width))
    for one, other, product in products.groupBy("one", "other").agg(F.sum("product")).collect():
        covariance[one, other] = covariance[other, one] = product / n
    values, axes = leading_pairs(covariance, components)
    varied = values > max(4 * width * EPSILON * max(values[0], 0.0), 0.0)
    values, axes = values[varied], axes[:, varied]
    if not len(values):
        return _rows(spark.createDataFrame([], out), id_col, 0, [], 0.0)

    run = _projected(n, sums, most, axes / np.sqrt(values), step, shift)
    white = materialise(chosen.mapInArrow(run, out), "whitened")
    return _rows(white, id_col, n, values / np.trace(covariance), _identity_error(white, len(values)))


def _identity_error(white: DataFrame, count: int) -> float:
    """The largest entry of the covariance of the whitened rows minus the identity."""
    pairs = [(i, j) for i in range(count) for j in range(i, count)]
    measured = white.agg(
        *(F.covar_pop(F.col("white")[i], F.col("white")[j]).alias(f"c{i}_{j}") for i, j in pairs)
    ).first()
    return max(abs(measured[f"c{i}_{j}"] - (i == j)) for i, j in pairs)


def _rows(white: DataFrame, id_col: str, n: int, explained, error: float) -> DataFrame:
    shares = F.array(*(F.lit(float(e)) for e in explained)).cast("array<double>")
    return white.select("id", "square", F.posexplode("white").alias("at", "whitened")).select(
        F.col("id").alias(id_col),
        (F.col("at") + 1).alias("component"),
        F.lit(n).cast("bigint").alias("n"),
        F.col("square").alias("deviation"),
        "whitened",
        F.get(shares, F.col("at")).alias("explained"),
        F.lit(error).alias("identity_error"),
    )
