"""The registered queries over the test tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from changefeed.llm import (
    alignment,
    language,
    licenses,
    mixing,
    neardup,
    oracle,
    packing,
    quality,
    simhash,
    substrings,
    tokenfiles,
    topk,
    urls,
    whitening,
)

# The rules that the url query applies.
URL_RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
FOLDS, HELD_OUT = 5, 0
QUERY_STEP = 50


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicts the language of all documents, learned from four of five folds."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    fold = F.crc32(F.col("doc_id").cast("string")) % FOLDS
    model = language.train(docs.where(fold != HELD_OUT))
    held = docs.select("doc_id", "text", F.coalesce(fold == HELD_OUT, F.lit(False)).alias("held_out"))
    return language.identify(held, model).drop("text")


def site_path() -> F.Column:
    """The section of a site: its documents of one language."""
    return F.concat_ws("/", "source", "lang")


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Judges all documents by text, site (source) and section of it (language)."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    judged = quality.classify(docs, labels, site_path())
    return judged.select("doc_id", "classifier", "host_rate", "path_rate", "quality", "kept")


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mixes all documents to the target weights of their sources."""
    return mixing.mix(table(spark, sf_dir, "documents"))


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Judges every page by url rules and by its aliases."""
    pages = table(spark, sf_dir, "pages")
    return urls.filter_urls(pages, urls.rule_frame(pages, URL_RULES))


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License notices in all documents."""
    return licenses.scan_licenses(table(spark, sf_dir, "documents"))


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages that repeat earlier ones, by document and offset."""
    return substrings.repeated_units(table(spark, sf_dir, "documents"))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    digits = F.lpad(F.lower(F.hex("fingerprint")), 16, "0")
    return found.select("doc_id", digits.alias("fingerprint"), "component_id")


def op8_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five highest inner products of every fiftieth vector."""
    vectors = table(spark, sf_dir, "embeddings")
    return topk.top_products(vectors, vectors.where(F.col("vec_id") % QUERY_STEP == 0))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where every piece of every document lies in the packed sequences."""
    packed = packing.pack(table(spark, sf_dir, "documents"))
    return packed.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def op10_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all vectors of equal label."""
    return neardup.near_vectors(table(spark, sf_dir, "embeddings"))


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How the tokens of two tokenizers align in every document."""
    return alignment.align_tokenizers(table(spark, sf_dir, "documents"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All vectors on the leading components of their covariance, whitened."""
    white = whitening.whiten(table(spark, sf_dir, "embeddings"))
    return white.withColumn("deviation", F.expr("try_cast(deviation AS bigint)"))


def op13_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of all documents as read back from the files they were written to."""
    read = tokenfiles.token_table(table(spark, sf_dir, "documents"))
    return read.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        f.__name__: f
        for f in (
            op1_language_id,
            op2_quality,
            op3_mixing,
            op4_url_filter,
            op5_license_scan,
            op6_substring_dedup,
            op7_simhash,
            op8_topk,
            op9_packing,
            op10_embedding_dedup,
            op11_alignment,
            op12_whitening,
            op13_token_files,
        )
    }


def oracle_sql() -> dict[str, str]:
    return oracle.oracle_sql(URL_RULES)
