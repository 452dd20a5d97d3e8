"""URL filtering by a tree of path templates per host.

Rules that name a host and a path prefix decide first; the longest one wins. For every other url a
tree is grown from all urls, host by host and segment by segment. Under a node a segment stays
literal if it is frequent enough to be a section of the site; the rest are variable parts, such as
article numbers, and become one wildcard. Literal branches whose share of blocked labels cannot be
told from that of their siblings are merged into the wildcard as well. A template's purity, the
share of allowed rows among its labelled ones, is smoothed towards its host's and that towards the
whole table's; templates below ``PURITY`` are rejected. Labels come from the rules: what they allow
or block is known, and the templates carry it over to urls that no rule fits.

The tree grows level by level until no url has a segment left, or no node has the ``MIN_ROWS`` rows that a literal
branch needs; what is left of the urls is then variable. All steps are DataFrame functions over counts per distinct
url; a busy host is summed up inside each task first, and only literal branches are joined back.

Defined results: a url that is null or has no ``://`` has an empty host and path. In a template a backslash stands before
each star and backslash of a literal segment, so these are no wildcards. Repeated urls count as often as they occur.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from marquee.session import store_once

MIN_ROWS = 5
MIN_SHARE = 0.02
SIMILAR = 1.96  # standard errors between two shares that count as alike
SMOOTHING = 5.0
PURITY = 0.5


@dataclass(frozen=True)
class Rule:
    """``allow`` or ``block`` for a host with its subdomains and a path prefix, written as host/prefix."""

    verdict: str
    rule: str

    @property
    def host(self) -> str:
        return self.rule.partition("/")[0]

    @property
    def path(self) -> str:
        return self.rule[len(self.host) :]


def _lower(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_of(url: Column) -> Column:
    return F.coalesce(_lower(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def matching_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """struct<rule, verdict> of the longest rule that fits, else null. A handful of rules, tried in turn."""
    kind = "struct<rule:string,verdict:string>"
    found = F.lit(None).cast(kind)
    for r in sorted(rules, key=lambda r: len(r.rule)):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        found = F.when(fits, F.struct(F.lit(r.rule).alias("rule"), F.lit(r.verdict).alias("verdict"))).otherwise(found)
    return found


def grow_templates(urls: DataFrame) -> DataFrame:
    """(host, path, template) for the distinct urls of (host, path, allowed, blocked, n)."""
    segments = F.split(F.regexp_replace("path", "^/", ""), "/", -1)
    rows = urls.select(
        "host", "path", "allowed", "blocked", "n", segments.alias("segments"), F.col("host").alias("node"), F.lit(False).alias("done")
    ).withColumn("done", F.col("path") == "")
    level = 0
    while True:
        rows = store_once(rows, "url-nodes")
        segment = F.get("segments", F.lit(level))
        open_ = rows.where(~F.col("done")).withColumn("segment", segment)
        kids = open_.groupBy("node", "segment").agg(F.sum("n").alias("n"), F.sum("allowed").alias("a"), F.sum("blocked").alias("b"))
        kids = store_once(kids, "url-branches")
        nodes = kids.groupBy("node").agg(F.sum("n").alias("node_n"), F.sum("a").alias("node_a"), F.sum("b").alias("node_b"))
        if (nodes.agg(F.max("node_n")).first()[0] or 0) < MIN_ROWS:
            break
        frequent = (F.col("n") >= MIN_ROWS) & (F.col("n") >= MIN_SHARE * F.col("node_n"))
        labelled, others = F.col("a") + F.col("b"), F.col("node_a") + F.col("node_b") - F.col("a") - F.col("b")
        share = F.try_divide(F.col("b"), labelled)
        rest = F.try_divide(F.col("node_b") - F.col("b"), others)
        pooled = F.try_divide(F.col("node_b"), labelled + others)
        error = F.sqrt(pooled * (1 - pooled) * (1 / labelled + 1 / others))
        # Alike: no labels to tell the branch by, or shares within the error of each other.
        alike = (labelled == 0) | ((others > 0) & (F.abs(share - rest) <= SIMILAR * error))
        literal = kids.join(nodes, "node").where(frequent & ~F.coalesce(alike, F.lit(False))).select("node", "segment", F.lit(True).alias("literal"))
        moved = open_.join(literal, ["node", "segment"], "left").select(
            "host",
            "path",
            "allowed",
            "blocked",
            "n",
            "segments",
            F.concat("node", F.lit("/"), F.when(F.col("literal"), _escaped(F.col("segment"))).otherwise("*")).alias("node"),
            (F.size("segments") <= level + 1).alias("done"),
        )
        rows = rows.where("done").unionByName(moved)
        level += 1
    rest = F.repeat(F.lit("/*"), F.size("segments") - level)
    return rows.select("host", "path", "allowed", "blocked", F.when(F.col("done"), F.col("node")).otherwise(F.concat("node", rest)).alias("template"))


def _escaped(segment: Column) -> Column:
    """A literal segment, so that none looks like the wildcard."""
    return F.replace(F.replace(segment, F.lit("\\"), F.lit("\\\\")), F.lit("*"), F.lit("\\*"))


def judge_templates(grown: DataFrame) -> DataFrame:
    """(host, path, template, purity) with the smoothed purity of each template."""
    allowed, blocked = grown.agg(F.sum("allowed"), F.sum("blocked")).first()
    general = ((allowed or 0) + 1) / ((allowed or 0) + (blocked or 0) + 2)
    templates = grown.groupBy("host", "template").agg(F.sum("allowed").alias("a"), F.sum("blocked").alias("b"))
    hosts = templates.groupBy("host").agg(F.sum("a").alias("host_a"), F.sum("b").alias("host_b"))
    host_purity = (F.col("host_a") + SMOOTHING * general) / (F.col("host_a") + F.col("host_b") + SMOOTHING)
    hosts = hosts.select("host", host_purity.alias("host_purity"))
    purity = (F.col("a") + SMOOTHING * F.col("host_purity")) / (F.col("a") + F.col("b") + SMOOTHING)
    judged = templates.join(hosts, "host").select("template", purity.alias("purity"))
    return grown.join(judged, "template").select("host", "path", "template", "purity")


def filter_urls(pages: DataFrame, rules: Sequence[Rule], id_column: str = "page_id", url_column: str = "url") -> DataFrame:
    """(page_id, host, path, rule, verdict, template, purity) for every row."""
    url = F.col(url_column)
    rows = pages.select(F.col(id_column).alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path"))
    rows = rows.withColumn("match", matching_rule(F.col("host"), F.col("path"), rules))
    verdict = F.col("match.verdict")
    urls = rows.groupBy("host", "path").agg(
        F.count("*").alias("n"),
        F.count_if(F.coalesce(verdict == "allow", F.lit(False))).alias("allowed"),
        F.count_if(F.coalesce(verdict == "block", F.lit(False))).alias("blocked"),
    )
    judged = judge_templates(store_once(grow_templates(store_once(urls, "urls")), "url-templates"))
    by_method = F.when(F.col("purity") >= PURITY, "allow").otherwise("block")
    return rows.join(judged, ["host", "path"]).select(
        "page_id",
        "host",
        "path",
        F.col("match.rule").alias("rule"),
        F.coalesce(verdict, by_method).alias("verdict"),
        "template",
        "purity",
    )
