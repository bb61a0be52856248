"""URL rules, and redirect equivalence that carries them to aliases."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from changefeed.llm.components import connected_components
from changefeed.storage import materialise

ALLOW, BLOCK = "allow", "block"
_QUOTED = "\\s*=\\s*[\"']?"
CANONICAL = f"(?i)<link\\b(?=[^>]*\\brel{_QUOTED}canonical\\b)[^>]*\\bhref{_QUOTED}([^\"'\\s>]+)"
REFRESH = f"(?i)<meta\\b(?=[^>]*\\bhttp-equiv{_QUOTED}refresh\\b)[^>]*\\burl{_QUOTED}([^\"'\\s>]+)"


def host(url: Column) -> Column:
    """What stands between the first ``://`` and the next ``/``, ``?`` or ``#``, A-Z lower-cased."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.coalesce(F.translate(F.regexp_extract(url, "(?s)^.*?://([^/?#]*)", 1), upper, lower), F.lit(""))


def path(url: Column) -> Column:
    """What follows the host, up to ``?`` or ``#``."""
    return F.coalesce(F.regexp_extract(url, "(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def alias_links(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``(url, alias)``: what a page calls its canonical address or refreshes to.

    A fragment is never sent, so an address with one is an alias of the address
    without. A target that starts with ``/`` is taken on the page's own site; one
    that is not absolute otherwise is left out.
    """
    url, html = F.col(url_col), F.col(html_col)
    site = F.regexp_extract(url, "(?s)^(.*?://[^/?#]*)", 1)
    targets = F.array(
        F.when(html.rlike("(?i)canonical"), F.regexp_extract(html, CANONICAL, 1)),
        F.when(html.rlike("(?i)http-equiv"), F.regexp_extract(html, REFRESH, 1)),
        F.when(F.contains(url, F.lit("#")), url),
    )
    named = pages.where(url.isNotNull()).select(
        url.alias("url"), site.alias("site"), F.explode(targets).alias("target")
    )
    alias = (
        F.when(F.startswith("target", F.lit("//")), F.concat(F.regexp_extract("site", "^(.*?:)//", 1), "target"))
        .when(F.startswith("target", F.lit("/")), F.concat("site", "target"))
        .otherwise(F.col("target"))
    )
    return named.select("url", F.substring_index(alias, "#", 1).alias("alias")).where(
        "alias like '%://%' and alias <> url"
    )


def rule_frame(like: DataFrame, rules: Sequence[tuple[str, str, str]]) -> DataFrame:
    """Rules ``(verdict, host, path)`` as a table."""
    return like.sparkSession.createDataFrame(
        list(rules), "rule_verdict string, rule_host string, rule_path string"
    )


def ruled(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """Adds ``host``, ``path``, ``rule`` and ``rule_verdict`` of the longest fitting rule.

    ``urls`` holds distinct ``url`` values. A host is looked up with all its
    parent domains, so the join is on equality however many rules there are. Of
    equally long rules the allowing one wins, then the first by text.
    """
    parts = urls.select("url", host(F.col("url")).alias("host"), path(F.col("url")).alias("path"))
    labels = F.split("host", "\\.")
    domains = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."),
    )
    fits = (
        parts.where("host <> ''")
        .withColumn("domain", F.explode(domains))
        .join(rules, F.col("domain") == F.col("rule_host"))
        .where(F.startswith("path", "rule_path"))
        .withColumn("rule", F.concat("rule_host", "rule_path"))
        .groupBy("url")
        .agg(
            F.min(
                F.struct((-F.length("rule")).alias("length"), "rule_verdict", "rule")
            ).alias("best")
        )
        .select("url", F.col("best.rule").alias("rule"), F.col("best.rule_verdict").alias("rule_verdict"))
    )
    return parts.join(fits, "url", "left")


def filter_urls(
    pages: DataFrame,
    rules: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
) -> DataFrame:
    """``(id_col, host, path, rule, verdict)`` for every row of ``pages``.

    A url that a rule fits has that rule's verdict. Any other gets that of its
    aliases, all urls linked to it by redirects and canonical addresses, however
    far: allowed if a rule allows one of them, else blocked if a rule blocks one,
    else allowed.

    A null url, or one without ``://``, has an empty host and path, fits no rule
    and is allowed. Null html links nothing. Repeated urls share one verdict.
    """
    links = materialise(alias_links(pages, url_col, html_col), "aliases")
    known = (
        pages.select(F.col(url_col).alias("url"))
        .unionByName(links.select(F.col("alias").alias("url")))
        .where("url is not null")
        .distinct()
    )
    judged = materialise(ruled(known, rules), "judged")
    groups = connected_components(links, "url", "alias").withColumnRenamed("node", "url")
    grouped = judged.join(groups, "url")
    spread = grouped.groupBy("component").agg(F.min("rule_verdict").alias("alias_verdict"))
    aliases = groups.join(spread, "component").select("url", "alias_verdict")
    verdict = F.coalesce("rule_verdict", "alias_verdict", F.lit(ALLOW))
    by_url = judged.join(aliases, "url", "left").select(
        F.col("url").alias("of"), "host", "path", "rule", verdict.alias("verdict")
    )
    return (
        pages.select(F.col(id_col), F.col(url_col).alias("url"))
        .join(by_url, F.col("url") == F.col("of"), "left")
        .select(
            id_col,
            F.coalesce("host", F.lit("")).alias("host"),
            F.coalesce("path", F.lit("")).alias("path"),
            "rule",
            F.coalesce("verdict", F.lit(ALLOW)).alias("verdict"),
        )
    )
