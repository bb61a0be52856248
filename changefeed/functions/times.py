"""Arrival times."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def arrival_timestamp(epoch_ms: Column | str) -> Column:
    """Epoch milliseconds to a timestamp."""
    return F.timestamp_millis(_col(epoch_ms))


def arrival_epoch(ts: Column | str) -> Column:
    """Arrival time as whole epoch seconds."""
    return F.unix_seconds(_col(ts))
