from collections import defaultdict

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from changefeed.llm import copies, packing, substrings

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_in_order(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{tmp_path}/{i}")
        docs = spark.read.parquet(f"{tmp_path}/{i}")
        if i < 4:
            assert docs.columns == COLUMNS
    judged, single, cut, mixed, packed = (spark.read.parquet(f"{tmp_path}/{i}") for i in range(5))
    found = copies.near_copies(judged).collect()
    assert {r["doc_id"] for r in single.collect()} == {r["component_id"] for r in found}
    texts = {r["doc_id"]: r for r in cut.collect()}
    assert texts.keys() == {r["doc_id"] for r in single.collect()}
    found = substrings.repeated_units(single.where("text is not null")).collect()
    before = {r["doc_id"]: r["text"] for r in single.collect()}
    changed = {i for i in texts if texts[i]["text"] != before[i]}
    assert changed == {r["doc_id"] for r in found}
    assert all(r["n_chars"] == len(r["text"]) for r in texts.values())
    assert {r["text"] for r in mixed.collect()} <= {r["text"] for r in texts.values()}
    words = defaultdict(int)
    for r in packed.collect():
        words[r["doc_id"]] += r["length"]
    for r in mixed.groupBy("doc_id", "text").count().collect():
        assert words[r["doc_id"]] == r["count"] * (len(packing.encoder(None).ids(r["text"])) + 1)
    assert corpus_pipeline.run(spark, sf_dir).count() == packed.count()


@pytest.mark.parametrize("name", ["odd_docs", "no_docs"])
def test_stages_on_odd_rows(request, spark, sf_dir, name):
    docs = request.getfixturevalue(name).withColumns(
        {c: F.lit(c) for c in ("quality", "path_rate", "prefix", "rest", "of", "target", "full", "start", "bits")}
    )
    extras = [c for c in docs.columns if c not in ("text", "n_chars")]
    given = {tuple(r) for r in docs.select(extras).collect()}
    for _, stage in corpus_pipeline.STAGES[:-1]:
        found = stage(spark, docs, sf_dir)
        assert found.columns == docs.columns
        assert {tuple(r) for r in found.select(extras).collect()} <= given
        if name == "no_docs":
            assert found.isEmpty()
    assert corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).agg(F.count("*")).first()[0] >= docs.count()


def test_near_dedup_takes_the_fingerprints_of_simhash(spark, sf_dir):
    # Repeats weigh in 64-bit fingerprints, not in sets: one group by those, three by these.
    tails = ["one two three four five", "six seven eight nine ten", "red green blue white black"]
    texts = {10 + i: "lorem ipsum dolor " * 60 + tail for i, tail in enumerate(tails)} | {1: "a text of its own " + tails[0]}
    docs = spark.createDataFrame([(*row, "en", "s", 1) for row in texts.items()], "doc_id long, text string, lang string, source string, n_chars int")
    assert copies.keep_one(docs).count() == 4
    assert sorted(r["doc_id"] for r in corpus_pipeline.simhash_near_dedup(spark, docs, sf_dir).collect()) == [1, 10]
