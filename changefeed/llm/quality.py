"""Quality classifier with hierarchical empirical Bayes over hosts and paths."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from changefeed.llm.blocks import bounded_sample
from changefeed.storage import materialise

#: Labelled documents that the classifier is fitted on, about; never over twice as many.
FIT_ROWS = 20_000
#: Bounds of the classifier's log odds, so that no text outweighs all that is known of its site.
MOST_EVIDENCE = 6.0
LEAST_STRENGTH, MOST_STRENGTH = 2.0, 10_000.0
FEATURES = 6


def features(text: Column) -> Column:
    """What the classifier looks at, as an array of doubles; null if there is no word.

    Shares of upper-case letters, of marks that prose seldom has, of exclamation
    marks and of bars; the logarithm of the number of words, and of the share of
    different words among them.
    """
    body = F.coalesce(text, F.lit(""))
    size = F.greatest(F.length(body), F.lit(1))

    def share(pattern: str) -> Column:
        return F.regexp_count(body, F.lit(pattern)) / size

    def measured(found: Column) -> Column:
        return F.array(
            share("\\p{Lu}"),
            share("[#$%&*+<=>@^_~{}\\[\\]\\\\]"),
            share("!"),
            share("\\|"),
            F.log1p(F.size(found)),
            F.log(F.size(F.array_distinct(found)) / F.size(found)),
        ).cast("array<double>")

    found = F.filter(F.split(body, "\\s+"), lambda w: w != "")
    return F.element_at(F.transform(F.array(found), lambda w: F.when(F.size(w) > 0, measured(w))), 1)


@dataclass(frozen=True)
class Classifier:
    """Logistic regression on standardised features."""

    mean: tuple[float, ...]
    scale: tuple[float, ...]
    weights: tuple[float, ...]
    bias: float
    prior: float

    def log_odds(self, measured: Column) -> Column:
        """Log odds that a document is good, within bounds; the prior's without evidence."""
        total = F.lit(self.bias)
        for i, (mean, scale, weight) in enumerate(zip(self.mean, self.scale, self.weights, strict=True)):
            total = total + (measured[i] - mean) / scale * weight
        bounded = F.greatest(F.lit(-MOST_EVIDENCE), F.least(F.lit(MOST_EVIDENCE), total))
        return F.coalesce(bounded, F.lit(_logit(self.prior)))


def _logit(p: float) -> float:
    return float(np.log(p / (1 - p)))


def fit(rows: list[tuple[list[float], float]], rounds: int = 25, ridge: float = 1.0) -> Classifier:
    """Fits by Newton steps. With labels of one kind only, or none, the evidence is the prior."""
    y = np.array([label for _, label in rows], float)
    prior = float((y.sum() + 1) / (len(y) + 2))
    x = np.array([values for values, _ in rows], float).reshape(len(rows), FEATURES)
    if len(np.unique(y > 0.5)) < 2:
        return Classifier((0.0,) * FEATURES, (1.0,) * FEATURES, (0.0,) * FEATURES, _logit(prior), prior)
    mean, scale = x.mean(0), x.std(0) + 1e-9
    design = np.column_stack([(x - mean) / scale, np.ones(len(x))])
    weights, penalty = np.zeros(design.shape[1]), np.eye(design.shape[1]) * ridge
    penalty[-1, -1] = 1e-9
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(design @ weights, -30, 30)))
        slope = design.T @ (y - p) - penalty @ weights
        curve = (design * (p * (1 - p))[:, None]).T @ design + penalty
        weights = weights + np.linalg.solve(curve, slope)
    return Classifier(tuple(mean.tolist()), tuple(scale.tolist()), tuple(weights[:-1].tolist()), float(weights[-1]), prior)


def strength(groups: DataFrame, prior: float) -> float:
    """How many documents the prior of a group weighs, by the method of moments.

    What groups differ by beyond chance gives the spread of their true rates;
    the less they differ, the more a group is drawn to the level above.
    """
    rate = F.col("good") / F.col("n")
    row = groups.where("n > 1").agg(
        F.sum("n").alias("n"),
        F.sum(F.col("n") * (rate - prior) * (rate - prior)).alias("spread"),
        F.count(F.lit(1)).alias("groups"),
    ).first()
    if not row["n"]:
        return MOST_STRENGTH
    chance = prior * (1 - prior)
    between = (row["spread"] - row["groups"] * chance) / row["n"]
    return float(np.clip(chance / max(between, 1e-9) - 1, LEAST_STRENGTH, MOST_STRENGTH))


def strength_within(hosts: DataFrame) -> float:
    """How many documents a host's rate weighs against that of one of its paths.

    By analysis of variance: how far paths of one host differ from each other, beyond what
    the spread of documents within a path brings about. What hosts differ by plays no part.
    ``hosts`` has per host the documents ``n``, sum ``good``, number ``paths`` of paths, and
    over these the sums ``sizes`` of n squared, ``explained`` of good squared by n, and
    ``squares`` of the squares of all documents.
    """
    row = hosts.where("paths > 1").agg(
        F.sum(F.col("n") - F.col("paths")).alias("free"),
        F.sum(F.col("squares") - F.col("explained")).alias("within"),
        F.sum(F.col("explained") - F.col("good") * F.col("good") / F.col("n")).alias("between"),
        F.sum(F.col("paths") - 1).alias("degrees"),
        F.sum(F.col("n") - F.col("sizes") / F.col("n")).alias("weight"),
    ).first()
    if not row["free"]:  # no host with paths, or no path with documents, to compare
        return MOST_STRENGTH
    chance = max(row["within"], 0.0) / row["free"]
    between = (row["between"] - row["degrees"] * chance) / row["weight"]
    if between <= 1e-12:
        return MOST_STRENGTH
    return float(np.clip(chance / between, LEAST_STRENGTH, MOST_STRENGTH))


def classify(
    docs: DataFrame,
    labels: DataFrame,
    path: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    host_col: str = "source",
    label_col: str = "quality",
    fit_rows: int = FIT_ROWS,
) -> DataFrame:
    """``docs`` with ``classifier``, ``host_rate``, ``path_rate``, ``quality``, ``kept``.

    ``classifier`` is the probability that a document is good by its text alone.
    Every host has a rate, the mean over its documents (their labels where there
    are any, else ``classifier``) shrunk to the rate of all labels; every path of
    a host has one shrunk to its host's. How strongly is learned from how much
    hosts differ, and from how much paths within a host do. ``quality`` joins the two: the log odds of the text plus
    what the path's log odds add to those of all labels. Documents of 0.5 or more
    are kept.

    The classifier is fitted on about ``fit_rows`` labelled documents, chosen by hash
    of the id; rates are of all documents. Several labels of one id are
    averaged. Documents without a word have quality 0 and are not kept. Null hosts
    and null paths are groups like others. No labels: the prior is one half. Rows and
    columns of ``docs`` stay; columns that have one of the five names are replaced.
    """
    results = ["classifier", "host_rate", "path_rate", "quality", "kept"]
    scored = measure(docs, labels, path, id_col, text_col, host_col, label_col, fit_rows)
    groups, rates = scored.groups, scored.rates
    body = docs.drop(*results)
    plain = body.withColumns({"__measured": features(F.col(text_col)), "__host": F.col(host_col), "__path": path})
    joined = plain.join(
        rates,
        plain["__host"].eqNullSafe(rates["rate_host"]) & plain["__path"].eqNullSafe(rates["rate_path"]),
        "left",
    )
    evidence = groups.log_odds(F.col("__measured"))
    logit = evidence + F.log(F.col("path_rate") / (1 - F.col("path_rate"))) - F.lit(_logit(groups.prior))
    quality = F.when(F.col("__measured").isNull(), F.lit(0.0)).otherwise(1 / (1 + F.exp(-logit)))
    return joined.select(
        *body.columns,
        (1 / (1 + F.exp(-evidence))).alias("classifier"),
        "host_rate",
        "path_rate",
        quality.alias("quality"),
        (quality >= 0.5).alias("kept"),
    )


@dataclass(frozen=True)
class Measured:
    groups: Classifier
    rates: DataFrame


def measure(
    docs: DataFrame,
    labels: DataFrame,
    path: Column,
    id_col: str,
    text_col: str,
    host_col: str,
    label_col: str,
    fit_rows: int,
) -> Measured:
    """The classifier, and the rates of every host and path: ``rate_host, rate_path, ...``."""
    known = labels.groupBy(F.col(id_col).alias("label_id")).agg(F.avg(label_col).alias("label"))
    rows = docs.select(
        F.col(id_col).alias("id"),
        F.col(host_col).alias("rate_host"),
        path.alias("rate_path"),
        features(F.col(text_col)).alias("measured"),
    )
    rows = materialise(
        rows.join(known.where("label is not null"), F.col("id") == F.col("label_id"), "left").drop("label_id"),
        "measured",
    )
    labelled = rows.where("label is not null and measured is not null")
    sample = bounded_sample(labelled, F.col("id"), fit_rows).select("measured", "label")
    model = fit([(row[0], row[1]) for row in sample.collect()])
    good = F.coalesce("label", 1 / (1 + F.exp(-model.log_odds(F.col("measured")))))
    paths = materialise(
        rows.where("measured is not null")
        .groupBy("rate_host", "rate_path")
        .agg(F.count(F.lit(1)).alias("n"), F.sum(good).alias("good"), F.sum(good * good).alias("squares")),
        "paths",
    )
    hosts = paths.groupBy("rate_host").agg(
        F.sum("n").alias("n"),
        F.sum("good").alias("good"),
        F.count(F.lit(1)).alias("paths"),
        F.sum(F.col("n") * F.col("n")).alias("sizes"),
        F.sum(F.col("good") * F.col("good") / F.col("n")).alias("explained"),
        F.sum("squares").alias("squares"),
    )
    host_weight = strength(hosts, model.prior)
    path_weight = strength_within(hosts)
    host_rate = (F.col("good") + host_weight * model.prior) / (F.col("n") + host_weight)
    by_host = hosts.select(F.col("rate_host").alias("of"), host_rate.alias("host_rate"))
    path_rate = (F.col("good") + path_weight * F.col("host_rate")) / (F.col("n") + path_weight)
    rates = paths.join(by_host, F.col("rate_host").eqNullSafe(F.col("of"))).select(
        "rate_host", "rate_path", "host_rate", path_rate.alias("path_rate")
    )
    return Measured(model, materialise(rates, "rates"))
