"""URL filters: rules by host and path, and verdicts from the link graph for hosts without a rule.

Trust flows from the hosts that rules allow along links, distrust from the hosts that rules block against
them (who links to a bad host is suspect): personalised PageRank over host edges, once in each direction.
A host whose distrust outweighs its trust is blocked.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskrank.llm.common import Workspace, free_shuffles

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
DAMPING = 0.85
# Scores may be off by this in all, and by this share of the mean score of a host.
TOLERANCE = 1e-6
SHARE = 1e-3
# Distrust may be this many times trust before a host is blocked.
THRESHOLD = 1.0
LINK = r"""(?i)\bhref\s*=\s*["']?\s*([^\s"'<>]+)"""


class Rule(NamedTuple):
    verdict: str  # allow or block
    host: str
    path: str


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def suffixes(host: Column) -> Column:
    """The host and all domains above it."""
    labels = F.split(host, r"\.", -1)
    return F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."),
    )


def match_rules(urls: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """(host, path, rule, rule_verdict) of the distinct (host, path) that a rule fits; the longest rule wins.

    Rules are joined on the host and the domains above it, so their number may be large; Spark broadcasts
    them only below its size threshold. Of rules with equal text, block wins.
    """
    spark = urls.sparkSession
    table = spark.createDataFrame(list(rules), "rule_verdict string, rule_host string, rule_path string")
    pairs = urls.select("host", "path").distinct().withColumn("rule_host", F.explode(suffixes(F.col("host"))))
    fits = pairs.join(table, "rule_host").where(F.startswith("path", "rule_path"))
    rule = F.concat("rule_host", "rule_path")
    best = F.max_by(F.struct(rule.alias("rule"), "rule_verdict"), F.struct(F.length(rule), "rule_verdict"))
    return fits.groupBy("host", "path").agg(best.alias("best")).select("host", "path", "best.*")


def host_edges(pages: DataFrame, url: str, html: str) -> DataFrame:
    """(src, dst, weight): how many links lead from one host to another; links within a host do not count."""
    links = pages.select(host_of(F.col(url)).alias("src"), F.explode(F.regexp_extract_all(F.col(html), F.lit(LINK), 1)).alias("link"))
    # A link without a scheme but with two slashes names a host too; all others stay on their host.
    absolute = F.when(F.startswith("link", F.lit("//")), F.concat(F.lit("http:"), "link")).otherwise(F.col("link"))
    named = links.where(F.startswith("link", F.lit("//")) | F.col("link").rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"))
    edges = named.select("src", host_of(absolute).alias("dst")).where("src <> dst and src <> '' and dst <> ''")
    return edges.groupBy("src", "dst").agg(F.count("*").cast("double").alias("weight"))


def propagate(edges: DataFrame, seeds: DataFrame, ws: Workspace, mean: float = 1.0) -> DataFrame:
    """(host, score): personalised PageRank from ``seeds`` (host, seed; summing to one) along ``edges``.

    Stops when scores are within ``TOLERANCE`` and ``SHARE`` of ``mean`` of their limits, all in all. Each round leaves at
    most ``DAMPING`` of the change before, so the number of rounds is bounded (about 140 for a million hosts);
    not to get there in time is an error. What leaves hosts without links goes back to the seeds. Shares are summed before they are shuffled by host, so a host that very
    many link to is no burden, and scores are written after each round.
    """
    out = edges.groupBy("src").agg(F.sum("weight").alias("total"))
    shares = ws.keep(edges.join(out, "src").select("src", "dst", (F.col("weight") / F.col("total")).alias("share")), "shares")
    seeds = ws.keep(seeds, "seeds")
    scores = seeds.select("host", F.col("seed").alias("score"))
    if shares.isEmpty():
        return scores
    # A change of x leaves at most x * DAMPING / (1 - DAMPING) to come; the first change is 2 at most.
    small = min(TOLERANCE, SHARE * mean) * (1 - DAMPING) / DAMPING
    for _ in range(math.ceil(math.log(small / 2, DAMPING)) + 10):
        sent = shares.join(scores, shares.src == scores.host).groupBy("dst").agg(F.sum(F.col("share") * F.col("score")).alias("got"))
        moved = sent.select(F.col("dst").alias("host"), (F.col("got") * DAMPING).alias("got"))
        kept = ws.keep(
            moved.join(seeds, "host", "full")
            .join(scores, "host", "full")
            .select("host", F.coalesce("got", F.lit(0.0)).alias("got"), F.coalesce("seed", F.lit(0.0)).alias("seed"), F.coalesce("score", F.lit(0.0)).alias("old")),
            "scores",
        )
        back = 1 - (kept.agg(F.sum("got")).first()[0] or 0.0)
        scores = kept.select("host", (F.col("got") + back * F.col("seed")).alias("score"), "old")
        change = scores.agg(F.sum(F.abs(F.col("score") - F.col("old")))).first()[0] or 0.0
        scores = scores.select("host", "score")
        if change < small:
            return scores
    raise RuntimeError(f"scores still change by {change}, over {small}")


def filter_urls(
    pages: DataFrame,
    ws: Workspace,
    rules: Sequence[Rule],
    *,
    id: str = "page_id",
    url: str = "url",
    html: str = "html",
    threshold: float = THRESHOLD,
) -> DataFrame:
    """Per row: page_id, host, path, rule, verdict, trust, distrust.

    The longest rule that fits gives the verdict. A host is a seed if rules of one verdict decide over half of its
    pages. Without a rule, a row is blocked if its host's distrust is over ``threshold`` times its trust and over as many
    times the mean score of a host. Null urls and those without ``://`` have an empty host and path, and are allowed
    unless a rule with an empty host and path fits. Repeated rows are judged each; other columns are ignored.
    """
    rows = pages.select(
        F.col(id).alias("page_id"), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path")
    )
    # One row a (host, path), and how many pages have it.
    places = ws.keep(rows.groupBy("host", "path").agg(F.count("*").alias("n")), "places")
    matched = ws.keep(match_rules(places, rules), "matched")
    hosts = ws.keep(places.where("host <> ''").groupBy("host").agg(F.sum("n").alias("pages")), "hosts")
    ruled = places.join(matched, ["host", "path"]).groupBy("host", "rule_verdict").agg(F.sum("n").alias("n"))
    seed_hosts = ws.keep(ruled.join(hosts, "host").where(F.col("n") * 2 > F.col("pages")), "seed_hosts")
    mean = 1 / max(1, hosts.count())
    totals = {r.rule_verdict: r.n for r in seed_hosts.groupBy("rule_verdict").agg(F.sum("n").alias("n")).collect()}
    edges = ws.keep(host_edges(pages, url, html), "edges")
    free_shuffles(pages.sparkSession)

    def seeds(verdict: str) -> DataFrame:
        return seed_hosts.where(F.col("rule_verdict") == verdict).select("host", (F.col("n") / totals.get(verdict, 1)).alias("seed"))

    reverse = edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "weight")
    trust = propagate(edges, seeds("allow"), ws, mean).withColumnRenamed("score", "trust")
    distrust = propagate(reverse, seeds("block"), ws, mean).withColumnRenamed("score", "distrust")
    scores = trust.join(distrust, "host", "full")
    judged = (
        places.drop("n")
        .join(matched, ["host", "path"], "left")
        .join(scores, "host", "left")
        .withColumns({c: F.coalesce(c, F.lit(0.0)) for c in ("trust", "distrust")})
        .withColumn(
            "verdict",
            F.coalesce("rule_verdict", F.when(F.col("distrust") > threshold * F.greatest("trust", F.lit(mean)), "block").otherwise("allow")),
        )
    )
    return rows.join(judged, ["host", "path"]).select("page_id", "host", "path", "rule", "verdict", "trust", "distrust")
