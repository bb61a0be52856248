"""Substring deduplication by hashing lines and the passages within them."""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DataType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

from changefeed.storage import materialise

#: Words that a repeated passage must have, and that a hashed unit has at least.
LEAST_WORDS, UNIT_WORDS = 50, 12
#: Words beyond either end of a run of units that are compared one by one.
CONTEXT = 32
#: A border follows a word whose hash is the least among so many before and behind it.
REACH, LONGEST = 3, 32
_OUT_ROWS = 100_000
_WORD, _BREAK = re.compile(r"\S+"), re.compile("\n")


def borders(hashes: np.ndarray, line_starts: np.ndarray, reach: int = REACH, longest: int = LONGEST) -> np.ndarray:
    """Words at which parts begin, and the number of words at the end.

    A part begins at the first word of a line, and behind a word whose hash is less
    than that of ``reach`` words before it and not more than that of ``reach`` words
    behind it. So borders depend on the words around them alone, and a passage has
    the same ones wherever it stands. Parts over ``longest`` words, as of one word
    repeated, are cut evenly.
    """
    n = len(hashes)
    least = np.ones(n, bool)
    for step in range(1, reach + 1):
        least[step:] &= hashes[step:] < hashes[:-step]
        least[:-step] &= hashes[:-step] <= hashes[step:]
    found = np.unique(np.concatenate([[0], np.flatnonzero(least) + 1, line_starts, [n]]))
    if np.diff(found).max(initial=0) > longest:
        more = [np.arange(a, b, longest) for a, b in zip(found[:-1], found[1:], strict=True)]
        found = np.append(np.concatenate(more), n)
    return found


def units_of(text: str, hash_of: dict[str, int], unit_words: int = UNIT_WORDS) -> list[tuple[int, int, int, int, int]]:
    """``(first_word, last_word, start, stop, digest)`` of every unit of a text.

    A unit starts at a border and takes parts until it has ``unit_words`` words, so
    units overlap, one for each border but the last few.
    """
    words, starts, stops = [], [], []
    for found in _WORD.finditer(text):
        words.append(found.group().lower())
        starts.append(found.start())
        stops.append(found.end())
    if len(words) < unit_words:
        return []
    hashes = np.fromiter(map(hash_of.__getitem__, words), np.int64, len(words))
    breaks = [m.start() for m in _BREAK.finditer(text)]
    line_starts = np.unique(np.searchsorted(starts, breaks)) if breaks else np.empty(0, int)
    cuts = borders(hashes, line_starts)
    upto = np.searchsorted(cuts, cuts + unit_words)
    out = []
    for first, end in zip(cuts.tolist(), upto.tolist(), strict=True):
        if end == len(cuts):
            break
        last = int(cuts[end])
        digest = xxhash.xxh3_64_intdigest(" ".join(words[first:last]).encode()) - (1 << 63)
        out.append((first, last, starts[first], stops[last - 1], digest))
    return out


class WordHashes(dict):
    """Hashes of words, some hundred thousand of them held."""

    def __missing__(self, word: str) -> int:
        value = zlib.crc32(word.encode())
        if len(self) >= 300_000:
            self.clear()
        self[word] = value
        return value


def _units(kind: DataType, unit_words: int):
    schema = StructType(
        [
            StructField("id", kind),
            StructField("key", LongType()),
            *(StructField(name, IntegerType()) for name in ("first_word", "last_word", "start", "stop")),
            StructField("digest", LongType()),
        ]
    )
    kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hash_of, ids, rows, id_kind = WordHashes(), [], [], None

        def table() -> pa.RecordBatch:
            columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
            out = pa.RecordBatch.from_arrays([pa.array(ids, id_kind), *columns], schema.names)
            ids.clear()
            rows.clear()
            return out

        for batch in batches:
            id_kind = batch.schema.field(0).type
            for id_, key, text in zip(batch.column(0), batch.column(1).to_pylist(), batch.column(2), strict=True):
                found = units_of(text.as_py() or "", hash_of, unit_words)
                ids.extend([id_.as_py()] * len(found))
                rows.extend((key, *unit) for unit in found)
                if len(rows) >= _OUT_ROWS:
                    yield table()
        if rows:
            yield table()

    return run, schema


_CONTEXT_KIND = pa.list_(
    pa.struct(
        [("at", pa.int32()), ("after", pa.bool_()), ("words", pa.list_(pa.string())), ("edges", pa.list_(pa.int32()))]
    )
)


@arrow_udf(
    ArrayType(
        StructType(
            [
                StructField("at", IntegerType()),
                StructField("after", BooleanType()),
                StructField("words", ArrayType(StringType())),
                StructField("edges", ArrayType(IntegerType())),
            ]
        )
    )
)
def _contexts(texts: pa.Array, places: pa.Array) -> pa.Array:
    """The words before or after each place, nearest first, and where each ends on its far side."""
    out = []
    for text, wanted in zip(texts.to_pylist(), places.to_pylist(), strict=True):
        found = [(m.group().lower(), m.start(), m.end()) for m in _WORD.finditer(text)]
        starts, stops, row = [f[1] for f in found], [f[2] for f in found], []
        for place in wanted:
            if place["after"]:
                near = found[bisect_left(starts, place["at"]) :][:CONTEXT]
            else:
                last = bisect_right(stops, place["at"])
                near = found[max(0, last - CONTEXT) : last][::-1]
            far = 2 if place["after"] else 1
            row.append({**place, "words": [f[0] for f in near], "edges": [f[far] for f in near]})
        out.append(row)
    return pa.array(out, _CONTEXT_KIND)


def _named(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``id, key, text``; rows with the same id and text have the same key."""
    id_, text = F.col(id_col), F.col(text_col)
    return docs.select(id_.alias("id"), F.xxhash64(id_, text).alias("key"), text.alias("text"))


def _runs(named: DataFrame, unit_words: int) -> DataFrame:
    """Repeated units of a document that touch, as one row.

    ``head`` and ``tail`` tell where it begins and ends, and where the first and the
    last of its units stand that come first of all.
    """
    run, schema = _units(named.schema["id"].dataType, unit_words)
    units = materialise(named.mapInArrow(run, schema), "units")
    place = F.struct(F.col("id").isNull().alias("no_id"), "id", "key", "first_word", "start", "stop")
    # Most digests are there once; to drop these, digests alone are shuffled.
    several = units.groupBy("digest").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("digest")
    several = materialise(several, "digests")
    # Merge joins of written tables, so that the adaptive join can split a hot digest.
    shared = materialise(units.join(several.hint("merge"), "digest", "left_semi"), "shared")
    firsts = materialise(shared.groupBy("digest").agg(F.min(place).alias("first")), "firsts")
    repeated = shared.join(firsts.hint("merge"), "digest").where("key <> first.key or first_word <> first.first_word")
    along = Window.partitionBy("key", "id").orderBy("first_word", "last_word")
    begins = F.coalesce(F.col("first_word") > F.lag("last_word").over(along), F.lit(True))
    numbered = repeated.withColumn("begins", begins.cast("int")).withColumn("run", F.sum("begins").over(along))
    return materialise(
        numbered.groupBy("key", "id", "run").agg(
            F.min(
                F.struct(
                    "first_word", "start", F.col("first.key").alias("key"), F.col("first.start").alias("at"),
                    F.col("first.id").alias("id"),
                )
            ).alias("head"),
            F.max(
                F.struct("last_word", "stop", F.col("first.key").alias("key"), F.col("first.stop").alias("at"))
            ).alias("tail"),
        ),
        "runs",
    )


def _extended(named: DataFrame, runs: DataFrame) -> DataFrame:
    """``(id, key, start, stop, words, first_id, first_start)`` of runs taken as far as words are equal."""
    ends = {
        "own_before": ("key", "head.start", False),
        "first_before": ("head.key", "head.at", False),
        "own_after": ("key", "tail.stop", True),
        "first_after": ("tail.key", "tail.at", True),
    }
    places = None
    for key, at, after in ends.values():
        some = runs.select(F.col(key).alias("key"), F.col(at).alias("at"), F.lit(after).alias("after"))
        places = some if places is None else places.unionByName(some)
    wanted = places.distinct().groupBy("key").agg(F.collect_list(F.struct("at", "after")).alias("places"))
    around = (
        named.select("key", "text")
        .join(wanted, "key")
        .select("key", F.explode(_contexts("text", "places")).alias("c"))
        .select("key", "c.*")
    )
    contexts = materialise(around.dropDuplicates(["key", "at", "after"]), "contexts")
    found = runs
    for name, (key, at, after) in ends.items():
        side = contexts.where(F.col("after") == after).select(
            F.col("key").alias("c_key"), F.col("at").alias("c_at"), F.struct("words", "edges").alias(name)
        )
        found = found.join(side, (F.col(key) == F.col("c_key")) & (F.col(at) == F.col("c_at"))).drop("c_key", "c_at")

    def equal(one: str, other: str) -> Column:
        same = F.zip_with(f"{one}.words", f"{other}.words", lambda a, b: a.eqNullSafe(b))
        differs = F.array_position(same, False)
        return F.when(differs == 0, F.size(same)).otherwise(differs - 1).cast("int")

    def moved(name: str, by: str, else_: str) -> Column:
        return F.when(F.col(by) > 0, F.expr(f"get({name}.edges, {by} - 1)")).otherwise(F.col(else_))

    return (
        found.withColumn("before", equal("own_before", "first_before"))
        .withColumn("behind", equal("own_after", "first_after"))
        .select(
            "id",
            "key",
            moved("own_before", "before", "head.start").alias("start"),
            moved("own_after", "behind", "tail.stop").alias("stop"),
            F.expr("tail.last_word - head.first_word + before + behind").alias("words"),
            F.col("head.id").alias("first_id"),
            moved("first_before", "before", "head.at").alias("first_start"),
        )
    )


def _repeats(docs: DataFrame, id_col: str, text_col: str, least_words: int, unit_words: int) -> DataFrame:
    named = _named(docs, id_col, text_col)
    return _extended(named, _runs(named, unit_words)).where(F.col("words") >= least_words)


def repeated_units(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    least_words: int = LEAST_WORDS,
    unit_words: int = UNIT_WORDS,
) -> DataFrame:
    """The passages to remove: ``(id_col, start, stop, first_id, first_start)``.

    Lines are cut into parts at borders that depend on the words around them
    (:func:`borders`), and units of some parts, in lower case and with blanks
    normalised, are hashed, so a passage within lines has the same units wherever it
    stands. Of equal units the one in the document of the smallest id, and there the
    first, stays. Repeated units that touch are a run. Units end short of a passage's
    own ends, so up to 32 words beyond either end of a run are compared with those
    around the units that stay, and the run is taken as far as they are equal. Runs
    of ``least_words`` words or more are returned, with their offsets in the original
    text and the place of what they repeat; shorter ones, as menus, stay.

    A passage of ``least_words`` words has no unit only if it has hardly any border.
    Null and empty texts, and those under ``unit_words`` words, have no units.
    Documents without an id rank last. Rows that repeat an id and a text count as
    one document, and give one row per run; rows with the same id and another text
    are documents of their own, in order of a hash. Digests have 64 bits: a false one
    is of account only among others in a run. They are counted before they are
    shuffled; one that many documents share is a skewed join key, which the adaptive
    join splits.
    """
    found = _repeats(docs, id_col, text_col, least_words, unit_words)
    return found.select(F.col("id").alias(id_col), "start", "stop", "first_id", "first_start")


@arrow_udf(StringType())
def _without(texts: pa.Array, spans: pa.Array) -> pa.Array:
    out = []
    for text, cuts in zip(texts, spans, strict=True):
        text = text.as_py()
        if text is not None and cuts.is_valid:
            kept, at = [], 0
            for start, stop in sorted((c["start"], c["stop"]) for c in cuts.as_py()):
                kept.append(text[at:start])
                if text[stop : stop + 1].isspace() and (not text[:start] or text[start - 1].isspace()):
                    stop += 1
                at = max(at, stop)
            text = "".join([*kept, text[at:]])
        out.append(text)
    return pa.array(out, pa.string())


def remove_repeats(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    least_words: int = LEAST_WORDS,
    unit_words: int = UNIT_WORDS,
) -> DataFrame:
    """``docs`` with repeated passages, and one blank after each, cut out of the texts.

    All rows and columns stay. A text that is all repeated becomes empty; a null text
    stays null.
    """
    spans = (
        _repeats(docs, id_col, text_col, least_words, unit_words)
        .groupBy(F.col("key").alias("__cut_key"), F.col("id").alias("__cut_id"))
        .agg(F.collect_list(F.struct("start", "stop")).alias("__cuts"))
    )
    key = F.xxhash64(docs[id_col], docs[text_col])
    joined = docs.join(spans, (key == F.col("__cut_key")) & docs[id_col].eqNullSafe(F.col("__cut_id")), "left")
    cut = F.when(F.col("__cuts").isNull(), docs[text_col]).otherwise(_without(docs[text_col], F.col("__cuts")))
    return joined.withColumn(text_col, cut).select(*docs.columns)
