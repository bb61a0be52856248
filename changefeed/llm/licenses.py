"""License scans: MinHash bands over text windows retrieve, exact containment verifies."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from changefeed.storage import materialise

# Notices of public licenses.
NOTICES = (
    ("apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0."),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("mit", "Released under the MIT License."),
    (
        "mit-text",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        "software and associated documentation files",
    ),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("cc-by-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
)
SHINGLE_WORDS = 5
LEAST_CONTAINMENT = 0.8
#: Words of a window, and from one window's start to the next one's, for notices of up
#: to WINDOW - STRIDE words; both double until a notice fits.
WINDOW, STRIDE = 32, 12
#: Bands of one MinHash each.
BANDS = 256


def words(text: Column) -> Column:
    """Lower-cased runs of letters and digits, in order."""
    plain = F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), "[^\\p{L}\\p{N}]+", " "))
    return F.when(plain == "", F.array().cast("array<string>")).otherwise(F.split(plain, " "))


def shingles(found: Column, size: int) -> Column:
    """Word shingles in order; none if there are fewer words than ``size``."""
    return F.when(
        F.size(found) >= size,
        F.transform(
            F.sequence(F.lit(1), F.size(found) - (size - 1)), lambda i: F.slice(found, i, size)
        ),
    ).otherwise(F.array().cast("array<array<string>>"))


def _once(value: Column) -> Column:
    """A value that later filters and expressions read, and do not compute again."""
    return F.explode(F.array(value))


def _band(hashes: Column, band: Column) -> Column:
    return F.array_min(F.transform(hashes, lambda h: F.xxhash64(h, band)))


def _bands(rows: DataFrame) -> DataFrame:
    """A row per band of ``grams``: ``band, least``, the smallest hash in the band."""
    hashed = rows.withColumn("hashes", F.transform("grams", lambda g: F.xxhash64(g)))
    return hashed.withColumn("band", F.explode(F.sequence(F.lit(0), F.lit(BANDS - 1)))).withColumn(
        "least", _band(F.col("hashes"), F.col("band"))
    )


def templates_of(like: DataFrame, notices: Sequence[tuple[str, str]]) -> DataFrame:
    """``(license, grams)`` of each notice, a short list that the caller gives."""
    given = like.sparkSession.createDataFrame(list(notices), "license string, notice string")
    return given.select(
        "license", F.array_distinct(shingles(words(F.col("notice")), SHINGLE_WORDS)).alias("grams")
    )


def by_window(notices: Sequence[tuple[str, str]], window: int, stride: int) -> dict[int, list[tuple[str, str]]]:
    """The notices by how often window and stride are doubled until a run of words holds them whole."""
    sized: dict[int, list[tuple[str, str]]] = {}
    for name, notice in notices:
        found = "".join(c if c.isalnum() else " " for c in notice).split()
        if len(found) < SHINGLE_WORDS:
            raise ValueError(f"notice {name} has fewer than {SHINGLE_WORDS} words")
        times = 0
        while (window - stride) << times < len(found):
            times += 1
        sized.setdefault(times, []).append((name, notice))
    return sized


def scan_licenses(
    docs: DataFrame,
    notices: Sequence[tuple[str, str]] = NOTICES,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = WINDOW,
    stride: int = STRIDE,
) -> DataFrame:
    """``(id_col, license, containment, first_word, last_word)`` of every notice found.

    A text is cut into windows of ``window`` words, one every ``stride``, so that
    any run of ``window - stride`` words lies whole in one. Longer notices have
    windows and strides of their own, doubled until such a run holds them; so a
    notice of any length is found wherever it starts. A notice is found in a window
    if at least 0.8 of its five-word shingles are; per document and license the
    fullest window is returned, the earliest of equals: its first word, and its last
    one or that of the text.

    Windows and notices meet if they agree in one of 256 bands. A window of 28
    shingles that holds 0.8 of a notice of s shingles has a Jaccard similarity of
    0.8 s / (28 + 0.2 s) or more: 1/28 for s = 1, where 1 - (27/28)^256 = 0.9999 of
    them meet, and more from s = 2 on. In doubled windows the notice has more than
    half the shingles of a run, and the similarity is above 0.2. Windows that hold
    none of the shingles which are smallest in some band of some notice can meet none,
    so they are left out before any band is made; most texts have no other.

    Null and empty texts and texts of fewer than five words give no row; a notice as
    short fails. Without notices nothing is found. Repeated rows count as one document.
    """
    names = [id_col, "license", "containment", "first_word", "last_word"]
    sized = by_window(notices, window, stride)
    if not sized:
        empty = docs.select(id_col).where(F.lit(False))
        return empty.selectExpr(
            "*", "'' AS license", "0D AS containment", "0 AS first_word", "0 AS last_word"
        ).select(*names)
    found = [_scan(docs, some, id_col, text_col, window << n, stride << n) for n, some in sorted(sized.items())]
    best = reduce(DataFrame.unionByName, found)
    if len({name for name, _ in notices}) < len(notices):  # a license with several notices
        place = F.struct("containment", (-F.col("first_word")).alias("back"), "last_word")
        best = best.groupBy(id_col, "license").agg(F.max(place).alias("best"))
        best = best.select(id_col, "license", "best.containment", (-F.col("best.back")).alias("first_word"), "best.last_word")
    return best.select(*names)


def _scan(
    docs: DataFrame, notices: Sequence[tuple[str, str]], id_col: str, text_col: str, window: int, stride: int
) -> DataFrame:
    """Notices that one length of window is enough for."""
    templates = materialise(templates_of(docs, notices), "templates")
    keyed = materialise(
        _bands(templates).select("license", F.col("grams").alias("notice"), "band", "least", "hashes"), "bands"
    )
    smallest = keyed.select(
        F.explode(F.filter("hashes", lambda h: F.xxhash64(h, F.col("band")) == F.col("least"))).alias("hash")
    ).distinct()
    anchors = F.array(*(F.lit(row[0]) for row in smallest.collect()))  # one per notice and band at most
    split = docs.select(F.col(id_col).alias("id"), _once(words(F.col(text_col))).alias("found"))
    held = split.select("id", _once(shingles(F.col("found"), SHINGLE_WORDS)).alias("all")).where(
        F.arrays_overlap(F.transform("all", lambda g: F.xxhash64(g)), anchors)
    )
    words_held = F.size("all") + SHINGLE_WORDS - 1
    # First and last word of each window, the last at most that of the text. Both are made
    # here, as anything made of ``all`` beside the shingles below would keep it in every row.
    starts = F.transform(
        F.sequence(F.lit(0), F.size("all") - 1, F.lit(stride)),
        lambda at: F.struct(at.alias("first"), (F.least(at + window, words_held) - 1).alias("last")),
    )
    windows = (
        held.select("id", "all", F.explode(starts).alias("at"))
        .select(
            "id",
            "at.first",
            "at.last",
            _once(F.array_distinct(F.slice("all", F.col("at.first") + 1, window - SHINGLE_WORDS + 1))).alias("grams"),
        )
        .where(F.arrays_overlap(F.transform("grams", lambda g: F.xxhash64(g)), anchors))
    )
    met = (
        _bands(windows)
        .select("id", "first", "last", "grams", "band", "least")
        .join(keyed.select("license", "notice", "band", "least"), ["band", "least"])
        .dropDuplicates(["id", "first", "license"])
    )
    share = F.size(F.array_intersect("notice", "grams")) / F.size("notice")
    verified = met.withColumn("containment", share).where(F.col("containment") >= LEAST_CONTAINMENT)
    best = verified.groupBy("id", "license").agg(
        F.max(F.struct("containment", (-F.col("first")).alias("back"), "last")).alias("best")
    )
    return best.select(
        F.col("id").alias(id_col),
        "license",
        F.col("best.containment").alias("containment"),
        (-F.col("best.back")).alias("first_word"),
        F.col("best.last").alias("last_word"),
    )
