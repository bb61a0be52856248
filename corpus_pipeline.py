"""The training-data pipeline: documents in, packed sequences out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from changefeed.llm import copies, mixing, packing, quality, simhash, substrings
from changefeed.llm.components import connected_components
from changefeed.llm.queries import site_path, table
from changefeed.storage import materialise


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents of low quality."""
    read = {"doc_id", "text", "source", "lang"}
    names = {c: c if c in read else f"__kept_{c}" for c in docs.columns}  # none that a result has
    judged = quality.classify(docs.withColumnsRenamed(names), table(spark, sf_dir, "labels"), site_path())
    return judged.where("kept").select(*(F.col(new).alias(old) for old, new in names.items()))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near copies, the one of the smallest id.

    Documents are linked by the 64-bit fingerprints of ``simhash`` and, as these miss
    some, by the wide ones of ``copies`` whose likeness was checked. Rows of one id count
    as one document; documents without an id stay.
    """
    named = docs.where("doc_id is not null")
    narrow = simhash.near_duplicates(named).select("doc_id", "component_id")
    links = narrow.unionByName(copies.near_copies(docs)).where("doc_id <> component_id").distinct()
    groups = connected_components(materialise(links, "near-links"), "doc_id", "component_id")
    others = groups.where("node <> component").select(F.col("node").alias("doc_id"))
    single = named.dropDuplicates(["doc_id"]).join(others, "doc_id", "left_anti")
    return single.unionByName(docs.where("doc_id is null"))


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts repeated lines out of the texts and counts their characters anew."""
    cut = substrings.remove_repeats(docs)
    if "n_chars" not in docs.columns:
        return cut
    kind = docs.schema["n_chars"].dataType
    return cut.withColumn("n_chars", F.coalesce(F.length("text").cast(kind), F.col("n_chars")))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes each source's documents as often as its target weight asks for."""
    return mixing.repeat_mixed(docs)


def sequence_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of all documents, packed into sequences."""
    return packing.pack(docs)


STAGES = [
    ("quality classifier", quality_classifier),
    ("simhash near-dedup", simhash_near_dedup),
    ("substring dedup", substring_dedup),
    ("source mixing", source_mixing),
    ("packing", sequence_packing),
]

#: SQL can express neither the classifier nor the tokens.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; each but the last is written to the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
