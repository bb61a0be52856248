"""Payload decoding: binary to text to a typed document to typed attributes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T


def payload_text(data: Column | str = "data") -> Column:
    return (F.col(data) if isinstance(data, str) else data).cast("string")


def decode_event(
    rows: DataFrame, schema: T.StructType, data: str = "data", into: str = "event"
) -> DataFrame:
    """Add the JSON document in ``data`` as a struct column."""
    return rows.withColumn(into, F.from_json(payload_text(data), schema))


def new_image(name: str, tag: str, event: str = "event", body: str = "change") -> Column:
    """The text inside one tagged attribute of the new image."""
    return F.col(f"{event}.{body}.NewImage.{name}.{tag}")


def typed_attribute(
    name: str,
    tag: str,
    dtype: str,
    event: str = "event",
    body: str = "change",
    strict: bool = False,
) -> Column:
    """One attribute as a typed column; a bad value is null, or fails if ``strict``."""
    text = new_image(name, tag, event, body)
    typed = text.try_cast(dtype)
    if not strict:
        return typed
    failure = F.raise_error(F.concat(F.lit(f"attribute {name} is not {dtype}: "), text))
    return F.when(text.isNotNull() & typed.isNull(), failure.cast(dtype)).otherwise(typed)


def unpack_records(rows: DataFrame, data: str = "data") -> DataFrame:
    """One packed record (a JSON array of sub-documents) to many rows.

    ``subSequence`` numbers the parts from 0. A record that is not packed keeps
    its one row and its bytes, with ``subSequence`` 0; so does an empty pack. A null
    in an array is a part without data.
    """
    text = payload_text(data)
    parts = F.when(
        F.ltrim(text).startswith("["), F.from_json(text, T.ArrayType(T.StringType()))
    )
    kept = [c for c in rows.columns if c != data]
    return rows.select(
        *kept, F.col(data).alias("_packed"), F.posexplode_outer(parts).alias("_part", "_text")
    ).select(
        F.when(F.col("_part").isNull(), F.col("_packed")).otherwise(F.col("_text").cast("binary")).alias(data),
        *kept,
        F.coalesce(F.col("_part"), F.lit(0)).alias("subSequence"),
    )
