"""Sequence numbers: opaque decimal text of any length, compared as numbers."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Digits of the length that stands in front of a key; no text is longer than that can tell.
_LENGTH_DIGITS = 10


def norm_seq(seq: Column | str) -> Column:
    """A key whose text order is number order: the length without leading zeros, then the digits."""
    digits = F.ltrim(F.col(seq) if isinstance(seq, str) else seq, F.lit("0"))
    return F.concat(F.lpad(F.length(digits).cast("string"), _LENGTH_DIGITS, "0"), digits)


def sequence_key(seq: str) -> str:
    """:func:`norm_seq` of one number, for planning on the driver."""
    digits = seq.lstrip("0")
    return f"{len(digits):0{_LENGTH_DIGITS}d}{digits}"
