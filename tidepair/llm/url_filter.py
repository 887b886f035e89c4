"""URL filter: host and path rules first, then a tree of path templates per host.

1. A url is parsed to host and path.  The longest rule that fits gives the verdict
   and, at the same time, a label for the template tree.
2. Each path becomes segments in which runs of digits are one sign, and equal
   (host, segments) are counted with their labels.  From here on work is on these
   counts, not on pages.
3. Level by level, below a common (host, parent template), a segment that is rare
   among many siblings becomes a wildcard.
4. Siblings whose share of blocked labels does not differ from that of all
   siblings together (two-proportion test) are one branch; others stay alone.
5. The purity of a branch is its share of blocked labels, smoothed by that of its
   host or by ``PRIOR``, whichever is lower: rules may label one verdict only, so
   the host's share can speak for a branch but not against it.  Pages without a
   rule are blocked where the purity is above ``BLOCK_ABOVE``, which takes labels
   of the branch itself.

A hot host is counted with map-side partial sums; the joins back are plain
equi-joins, which adaptive execution can split.

Defined cases: a url that is null or has no ``://`` has empty host and path, fits
no rule, and is judged as the template of the empty host; repeated rows count
each; a branch without any label has at most purity ``PRIOR``, which allows;
columns of the pages that are named like a result are replaced.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import lower_ascii

ALLOW, BLOCK = "allow", "block"

# Fixed values of the contract.
RULES = (
    (ALLOW, "com/"),
    (BLOCK, "example.com/en/"),
    (ALLOW, "www.example.com/en/"),
    (BLOCK, "net/es/"),
    (BLOCK, "net/fr/"),
)

DEPTH = 4  # levels of the tree; the last one is all that is left of a path
CHILDREN = 16  # siblings from which rare segments become wildcards
RARE = 0.02  # share of the pages of the parent below which a segment is rare
SIMILAR = 1.96  # largest two-proportion z of branches that are merged
WEIGHT = 5.0  # labels that a prior counts for
PRIOR = 0.5
BLOCK_ABOVE = 0.5
WILD, DIGITS = "*", "#"


def parsed(pages: DataFrame) -> DataFrame:
    """``pages`` with host and path."""
    url = F.coalesce(F.col("url"), F.lit(""))
    return pages.withColumns(
        {
            "host": lower_ascii(F.regexp_extract(url, r"://([^/?#]*)", 1)),
            "path": F.regexp_extract(url, r"://[^/?#]*([^?#]*)", 1),
        }
    )


def _fits(rule: str) -> Column:
    host, slash, path = rule.partition("/")
    at_host = (F.col("host") == host) | F.col("host").endswith("." + host)
    return at_host & F.col("path").startswith(slash + path)


def with_rule(urls: DataFrame, rules=RULES) -> DataFrame:
    """Adds ``rule``, the longest that fits or null, and ``label``, its verdict."""
    longest = sorted(rules, key=lambda r: (-len(r[1]), r))
    first = F.coalesce(
        *(
            F.when(_fits(rule), F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("label")))
            for verdict, rule in longest
        )
    ) if longest else F.lit(None).cast("struct<rule:string,label:string>")
    return urls.withColumn("_rule", first).select(
        *urls.columns, F.col("_rule.rule").alias("rule"), F.col("_rule.label").alias("label")
    )


def _shape(path: Column) -> Column:
    return F.regexp_replace(path, "[0-9]+", DIGITS)


def counted_paths(labelled: DataFrame) -> DataFrame:
    """(host, shape, n, blocked, labelled), one row for each host and path shape."""
    return labelled.groupBy("host", _shape(F.col("path")).alias("shape")).agg(
        F.count("*").alias("n"),
        F.count_if(F.col("label") == BLOCK).alias("blocked"),
        F.count("label").alias("labelled"),
    )


def path_templates(counts: DataFrame) -> DataFrame:
    """``counts`` with ``template``, the path with its variable segments as wildcards."""
    parts = F.split(F.regexp_replace("shape", "^/", ""), "/", DEPTH)
    rows = materialize(
        counts.withColumn("_parts", parts).withColumn("template", F.lit("")), "url-level"
    )
    for level in range(DEPTH):
        rows = rows.withColumn("_segment", F.get("_parts", F.lit(level)))
        inner = rows.filter("_segment IS NOT NULL")
        if inner.isEmpty():
            break
        children = inner.groupBy("host", "template", "_segment").agg(F.sum("n").alias("_n"))
        parents = children.groupBy("host", "template").agg(
            F.count("*").alias("_children"), F.sum("_n").alias("_pages")
        )
        rare = (
            children.join(parents, ["host", "template"])
            .filter((F.col("_children") > CHILDREN) & (F.col("_n") < RARE * F.col("_pages")))
            .select("host", "template", "_segment", F.lit(True).alias("_rare"))
        )
        shown = F.when(F.col("_rare"), WILD).otherwise(F.col("_segment"))
        longer = F.when(F.col("_segment").isNull(), F.col("template")).otherwise(
            F.concat("template", F.lit("/"), shown)
        )
        rows = materialize(
            rows.join(rare, ["host", "template", "_segment"], "left")
            .withColumn("template", longer)
            .drop("_rare", "_segment"),
            "url-level",
        )
    return rows.drop("_parts", "_segment")


def branch_purity(templates: DataFrame) -> DataFrame:
    """(host, template, branch, purity): siblings that are alike share a branch."""
    each = (
        templates.groupBy("host", "template")
        .agg(F.sum("blocked").alias("blocked"), F.sum("labelled").alias("labelled"))
        .withColumn("_parent", F.regexp_replace("template", "/[^/]*$", ""))
    )
    total = ["blocked", "labelled"]
    siblings = each.groupBy("host", "_parent").agg(*(F.sum(c).alias(f"_all_{c}") for c in total))
    tested = each.join(siblings, ["host", "_parent"])
    pooled = F.try_divide("_all_blocked", "_all_labelled")
    share = F.try_divide("blocked", "labelled")
    spread = F.sqrt(pooled * (1 - pooled) / F.col("labelled"))
    alike = F.coalesce(F.abs(share - pooled) <= SIMILAR * spread, F.lit(True))
    branches = tested.withColumn(
        "branch", F.when(alike, F.concat("_parent", F.lit("/~"))).otherwise(F.col("template"))
    )
    sums = branches.groupBy("host", "branch").agg(*(F.sum(c).alias(f"_{c}") for c in total))
    hosts = each.groupBy("host").agg(*(F.sum(c).alias(f"_host_{c}") for c in total))

    def smoothed(name: str, prior: Column) -> Column:
        return (F.col(f"{name}_blocked") + WEIGHT * prior) / (F.col(f"{name}_labelled") + WEIGHT)

    prior = F.least(smoothed("_host", F.lit(PRIOR)), F.lit(PRIOR))
    return (
        branches.select("host", "template", "branch")
        .join(sums, ["host", "branch"])
        .join(hosts, "host")
        .select("host", "template", "branch", smoothed("", prior).alias("purity"))
    )


def judge_urls(pages: DataFrame, rules=RULES) -> DataFrame:
    """The columns of ``pages`` with host, path, rule, template, branch, purity and verdict."""
    results = ("host", "path", "rule", "template", "branch", "purity", "verdict")
    # under names of our own, as the table may use any
    kept = {c: f"_c{i}" for i, c in enumerate(pages.columns) if c not in results}
    named = pages.select(*(F.col(c).alias(n) for c, n in kept.items()), F.col("url").alias("url"))
    urls = with_rule(parsed(named), rules)
    shapes = materialize(
        path_templates(counted_paths(urls)).select(
            "host", "shape", "template", "blocked", "labelled"
        ),
        "url-shapes",
    )
    judged = shapes.select("host", "shape", "template").join(
        branch_purity(shapes), ["host", "template"]
    )
    by_method = F.when(F.col("purity") > BLOCK_ABOVE, BLOCK).otherwise(ALLOW)
    return (
        urls.withColumn("shape", _shape(F.col("path")))
        .join(judged, ["host", "shape"])
        .withColumn("verdict", F.coalesce("label", by_method))
        .select(*(F.col(n).alias(c) for c, n in kept.items()), *results)
    )
