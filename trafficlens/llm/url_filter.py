"""URL filters: explicit rules, else a tree of path templates per host.

Host and path of every url are taken by string functions.  A rule (host, path)
fits its host and all subdomains if the path starts with the rule's; the longest
wins.  Urls under a rule are the labelled ones, and teach the tree what else to
reject:

* paths become segments; a segment that is variable by its form (has a digit, is
  longer than ``LONGEST_WORD``) is the wildcard ``*`` from the start;
* level by level from the root, rare siblings (fewer than ``LEAST_URLS`` urls) are
  generalised into the wildcard, and so are labelled siblings whose share of
  blocked urls does not differ from their parent's by a two-sided z test at ``Z``:
  they are merged, and their subtrees with them;
* a template's purity is its share of blocked labels, smoothed towards that of all
  labelled urls; it is rejected if it has labelled urls of its own and that reaches ``REJECT``.

The tree is built on counts per (host, masked path), so a host with any share of
all urls meets in groups after map-side combine only, and no group is gathered.
Segments below ``LEVELS`` count as one tail ``**``.  Only column functions are used.

A null url, or one without ``://``, has an empty host and path and is judged like
any other empty host.  Repeated rows each keep their row; extra columns are
dropped.  The method is native throughout.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trafficlens.session import staged

LEVELS = 4
LONGEST_WORD = 24
LEAST_URLS = 5
Z = 1.96
PRIOR = 4.0
REJECT = 0.7

Rule = tuple[str, str, str]  # host, path, verdict

_CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both empty without ``://``."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(F.substr(rest, F.char_length(host) + 1), r"^([^?#]*)", 1)
    return F.translate(host, _CAPITALS, _CAPITALS.lower()), path


def longest_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """Struct of ``rule`` and ``verdict`` of the longest rule that fits, or null."""
    found = F.lit(None).cast("struct<rule: string, verdict: string>")
    for name, start, verdict in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((host == name) | F.endswith(host, F.lit("." + name))) & F.startswith(
            path, F.lit(start)
        )
        hit = F.struct(F.lit(name + start).alias("rule"), F.lit(verdict).alias("verdict"))
        found = F.when(fits, hit).otherwise(found)
    return found


def masked_path(path: Column, levels: int = LEVELS) -> Column:
    """Segments of a path, variable ones as ``*``, what is deeper as ``**``."""
    segments = F.filter(F.split(path, "/"), lambda s: s != "")
    masked = F.transform(
        F.slice(segments, 1, levels),
        lambda s: F.when(s.rlike(r"\d") | (F.char_length(s) > LONGEST_WORD), F.lit("*")).otherwise(s),
    )
    return F.when(F.size(segments) > levels, F.concat(masked, F.array(F.lit("**")))).otherwise(masked)


def _level(nodes: DataFrame, depth: int) -> DataFrame:
    """Generalise the segments at one depth, given those above it."""
    parent = F.slice("template", 1, depth)
    at = nodes.filter(F.size("template") > depth).select(
        "host", parent.alias("above"), F.get("template", F.lit(depth)).alias("segment"), "n", "blocked", "labelled"
    )
    sums = [F.sum(c).alias(c) for c in ("n", "blocked", "labelled")]
    siblings = at.groupBy("host", "above", "segment").agg(*sums)
    parents = siblings.groupBy("host", "above").agg(
        F.sum("blocked").alias("p_blocked"), F.sum("labelled").alias("p_labelled")
    )
    share = F.try_divide(F.col("p_blocked"), F.col("p_labelled"))
    own = F.try_divide(F.col("blocked"), F.col("labelled"))
    spread = F.sqrt(F.try_divide(share * (1 - share), F.col("labelled").cast("double")))
    differs = F.abs(own - share) > Z * spread
    wild = (F.col("n") < LEAST_URLS) | ((F.col("labelled") > 0) & ~differs)
    kept = (
        siblings.join(parents, ["host", "above"])
        .filter(~wild & (F.col("segment") != "*"))
        .select("host", "above", "segment", F.lit(True).alias("kept"))
    )
    general = F.when(F.col("kept"), F.col("segment")).otherwise("*")
    rest = F.slice("template", depth + 2, LEVELS + 1)
    return (
        nodes.withColumn("above", parent)
        .withColumn("segment", F.get("template", F.lit(depth)))
        .join(kept, ["host", "above", "segment"], "left")
        .withColumn(
            "template",
            F.when(
                F.size("template") > depth, F.concat("above", F.array(general), rest)
            ).otherwise(F.col("template")),
        )
        .select("host", "masked", "template", "n", "blocked", "labelled")
    )


def templates(urls: DataFrame) -> DataFrame:
    """``host``, ``masked`` path, ``template``, its smoothed ``purity`` and if it is ``taught``.

    ``urls`` has ``host``, ``masked`` (array of segments) and ``verdict`` (allow,
    block or null).
    """
    nodes = staged(
        urls.groupBy("host", "masked").agg(
            F.count(F.lit(1)).alias("n"),
            F.count_if(F.col("verdict") == "block").alias("blocked"),
            F.count("verdict").alias("labelled"),
        ).withColumn("template", F.col("masked")),
        "paths",
    )
    for depth in range(LEVELS):
        nodes = staged(_level(nodes, depth), "paths")
    total = nodes.agg(F.sum("blocked").alias("b"), F.sum("labelled").alias("l")).first()
    base = (total["b"] or 0) / total["l"] if total["l"] else 0.0
    known = nodes.groupBy("host", "template").agg(
        ((F.sum("blocked") + PRIOR * base) / (F.sum("labelled") + PRIOR)).alias("purity"),
        (F.sum("labelled") > 0).alias("taught"),
    )
    return nodes.select("host", "masked", "template").join(known, ["host", "template"])


def judge(pages: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Per row ``page_id``, ``host``, ``path``, ``rule``, ``verdict``, ``template``, ``purity``."""
    host, path = host_and_path(F.col("url"))
    seen = pages.select("page_id", "url").select(
        "page_id", host.alias("host"), path.alias("path")
    )
    seen = staged(
        seen.withColumn("hit", longest_rule(F.col("host"), F.col("path"), rules)).select(
            "page_id",
            "host",
            "path",
            F.col("hit.rule").alias("rule"),
            F.col("hit.verdict").alias("verdict"),
            masked_path(F.col("path")).alias("masked"),
        ),
        "urls",
    )
    found = templates(seen.select("host", "masked", "verdict"))
    rejected = F.col("taught") & (F.col("purity") >= REJECT)
    by_tree = F.when(rejected, "block").otherwise("allow")
    return seen.join(found, ["host", "masked"]).select(
        "page_id",
        "host",
        "path",
        "rule",
        F.coalesce("verdict", by_tree).alias("verdict"),
        F.concat(F.lit("/"), F.array_join("template", "/")).alias("template"),
        "purity",
    )
