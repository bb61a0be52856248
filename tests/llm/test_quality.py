import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from changefeed.llm import quality
from changefeed.llm.queries import op2_quality, site_path

NAMES = ["classifier", "host_rate", "path_rate", "quality", "kept"]


def test_labelled_documents(spark, sf_dir):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    found = op2_quality(spark, sf_dir).join(labels, "doc_id").collect()
    assert sum(r["kept"] == (r["quality"] >= 0.5) for r in op2_quality(spark, sf_dir).collect()) > 0
    good = [r["kept"] for r in found if r[labels.columns[1]] is not None]
    assert len(good) == len(found)


def test_accuracy_on_labels_it_has_not_seen(documents, spark, sf_dir):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    seen = labels.where("doc_id % 2 = 0")
    judged = quality.classify(documents, seen, site_path()).select("doc_id", "kept")
    held = judged.join(labels.where("doc_id % 2 = 1"), "doc_id").collect()
    right = [r["kept"] == (r["quality"] == 1) for r in held]
    assert sum(right) >= 0.95 * len(right)
    clean = [r["kept"] for r in held if r["quality"] == 1]
    assert sum(clean) >= 0.98 * len(clean)


def test_rates_shrink_to_the_level_above(spark):
    rows = [(i, "some words of a text", s, p) for i, (s, p) in enumerate([("a", "x")] * 30 + [("a", "y")] * 2 + [("b", "z")] + [(None, None)] * 3)]
    docs = spark.createDataFrame(rows, "doc_id int, text string, source string, path string")
    labels = spark.createDataFrame([(i, int(i < 30)) for i in range(33)], "doc_id int, quality int")
    got = {r["doc_id"]: r for r in quality.classify(docs, labels, F.col("path")).collect()}
    prior = 31 / 35
    assert got[0]["host_rate"] == got[31]["host_rate"]
    assert got[31]["path_rate"] < got[31]["host_rate"] < got[0]["path_rate"]
    assert got[32]["path_rate"] < prior and got[32]["path_rate"] > 0.01
    for r in got.values():
        p, q = r["classifier"], r["path_rate"]
        logit = math.log(p / (1 - p)) + math.log(q / (1 - q)) - math.log(prior / (1 - prior))
        assert math.isclose(r["quality"], 1 / (1 + math.exp(-logit)), rel_tol=1e-9)
        assert r["kept"] == (r["quality"] >= 0.5)


def test_strength_is_by_moments(spark):
    sizes, good = [10, 20, 40], [9.0, 10.0, 30.0]
    groups = spark.createDataFrame(list(zip(sizes, good, strict=True)), "n long, good double")
    prior, n = 0.7, np.array(sizes)
    spread = (n * (np.array(good) / n - prior) ** 2).sum()
    between = (spread - 3 * prior * 0.3) / n.sum()
    assert math.isclose(quality.strength(groups, prior), np.clip(prior * 0.3 / between - 1, 2, 1e4))
    assert quality.strength(groups.limit(0), prior) == quality.MOST_STRENGTH


def _by_host(spark, rows):
    """Hosts as ``strength_within`` wants them, from rows (host, path, value) in numpy."""
    hosts = []
    for host in sorted({r[0] for r in rows}):
        of = [np.array([v for h, p, v in rows if (h, p) == (host, path)]) for path in sorted({r[1] for r in rows if r[0] == host})]
        n = [len(v) for v in of]
        hosts.append((sum(n), float(sum(v.sum() for v in of)), len(of), sum(k * k for k in n),
                      float(sum(v.sum() ** 2 / len(v) for v in of)), float(sum((v * v).sum() for v in of))))
    return spark.createDataFrame(hosts, "n long, good double, paths long, sizes long, explained double, squares double")


def test_strength_of_paths_is_by_what_differs_within_hosts(spark):
    # Hosts lie far apart; their paths are alike in the first case and differ in the second.
    draw = np.random.default_rng(3)
    alike = [(h, p, float(draw.random() < (0.05 if h % 2 else 0.95))) for h in range(30) for p in range(4) for _ in range(50)]
    differ = [(h, p, float(draw.random() < (0.1 if p % 2 else 0.9))) for h in range(30) for p in range(4) for _ in range(50)]
    assert quality.strength_within(_by_host(spark, alike)) > 100
    assert quality.strength_within(_by_host(spark, differ)) == quality.LEAST_STRENGTH


def test_strength_of_paths_finds_that_of_the_model(spark):
    # Rates of paths drawn around their host's with the weight of 20 documents.
    draw, rows = np.random.default_rng(4), []
    for h in range(60):
        mean = draw.uniform(0.2, 0.8)
        for p in range(6):
            rate = draw.beta(20 * mean, 20 * (1 - mean))
            rows += [(h, p, float(draw.random() < rate)) for _ in range(40)]
    assert 12 < quality.strength_within(_by_host(spark, rows)) < 32


def test_strength_of_paths_without_any_to_compare(spark):
    alone = [(h, 0, 1.0) for h in range(5)]
    single = [(0, p, float(p % 2)) for p in range(5)]
    equal = [(0, p, 1.0) for p in range(3) for _ in range(4)]
    for rows in [alone, single, equal]:
        assert quality.strength_within(_by_host(spark, rows)) == quality.MOST_STRENGTH


def _plain_version(docs, labels, measured, model, host_strength, path_strength):
    """The rates and verdicts of the whole query in plain Python."""
    known = {}
    for doc, label in labels:
        known.setdefault(doc, []).append(label)
    known = {doc: sum(v) / len(v) for doc, v in known.items()}

    def sigmoid(x):
        return 1 / (1 + math.exp(-x))

    def odds(i):
        values = measured[i]
        total = model.bias + sum((v - m) / s * w for v, m, s, w in zip(values, model.mean, model.scale, model.weights, strict=True))
        return max(-quality.MOST_EVIDENCE, min(quality.MOST_EVIDENCE, total))

    hosts, paths = {}, {}
    for doc, _, host, path in docs:
        if measured[doc] is None:
            continue
        good = known.get(doc, sigmoid(odds(doc)))
        hosts.setdefault(host, []).append(good)
        paths.setdefault((host, path), []).append(good)
    found = {}
    for doc, _, host, path in docs:
        if measured[doc] is None:
            found[doc] = 0.0
            continue
        of, at = hosts[host], paths[host, path]
        host_rate = (sum(of) + host_strength * model.prior) / (len(of) + host_strength)
        path_rate = (sum(at) + path_strength * host_rate) / (len(at) + path_strength)
        logit = odds(doc) + math.log(path_rate / (1 - path_rate)) - math.log(model.prior / (1 - model.prior))
        found[doc] = sigmoid(logit)
    return found


def test_query_equals_a_plain_version(spark, sf_dir, monkeypatch):
    fitted = {}

    def keep(name):
        inner = getattr(quality, name)

        def run(*args, **kwargs):
            fitted[name] = inner(*args, **kwargs)
            return fitted[name]

        monkeypatch.setattr(quality, name, run)

    for name in ["fit", "strength", "strength_within"]:
        keep(name)
    got = {r["doc_id"]: r["quality"] for r in op2_quality(spark, sf_dir).collect()}
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = docs.select("doc_id", quality.features(F.col("text")).alias("m"), "source", site_path().alias("path")).collect()
    labels = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/labels.parquet").where("quality is not null").select("doc_id", "quality").collect()]
    want = _plain_version(
        [tuple(r) for r in rows], labels, {r["doc_id"]: r["m"] for r in rows},
        fitted["fit"], fitted["strength"], fitted["strength_within"],
    )
    assert got.keys() == want.keys()
    assert all(math.isclose(got[i], want[i], rel_tol=1e-6, abs_tol=1e-9) for i in got)


@pytest.mark.parametrize("labelled", [[], [(5, 1)], [(5, 1), (7, 0), (5, 0), (None, 1), (8, None)]])
def test_odd_rows(spark, odd_docs, no_docs, labelled):
    labels = spark.createDataFrame(labelled, "doc_id bigint, quality int")
    found = quality.classify(odd_docs, labels, F.concat_ws("/", "source", "lang"))
    assert found.columns == [c for c in odd_docs.columns if c not in NAMES] + NAMES
    rows = found.collect()
    assert len(rows) == odd_docs.count()
    for r in rows:
        if not (r["text"] or "").strip():
            assert r["quality"] == 0 and not r["kept"]
        else:
            assert 0 < r["quality"] < 1
    assert quality.classify(no_docs, labels, F.col("lang")).collect() == []


def test_null_paths_are_a_group(spark, odd_docs):
    labels = spark.createDataFrame([(5, 1), (7, 0)], "doc_id bigint, quality int")
    found = quality.classify(odd_docs, labels, F.col("source"))
    assert found.where("text = 'two words' and path_rate is null").isEmpty()
