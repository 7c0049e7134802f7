"""URL filters: fixed rules first, then a tree of path templates per host, with DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threatloom.llm.common import stage

# Fixed values of the contract: (verdict, host, path).
RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# A level with more children than this generalises those with less than this share of its pages.
MOST_CHILDREN, LEAST_SHARE = 20, 0.05
# Branches within so many standard deviations of their siblings' rate are merged.
DEVIATIONS = 1.96
# Weight of the parent's purity in that of a branch, and the purity over which a template is rejected.
PRIOR_WEIGHT, REJECT_OVER = 10.0, 0.5
# Stands for any segment; a path ends before the first character of this kind, so none can hold it.
ANY = "?"
# A path of more segments has the rest of them as its last one.
DEEPEST = 8


def _host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)
    return F.translate(host, UPPER, LOWER), path


def _ruled(host: Column, path: Column, rules) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, else nulls."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, own, start in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[1], r[2])):
        fits = ((host == own) | host.endswith("." + own)) & path.startswith(start)
        rule = F.when(fits, F.lit(own + start)).otherwise(rule)
        verdict = F.when(fits, F.lit(what)).otherwise(verdict)
    return rule, verdict


def filter_urls(pages: DataFrame, labels: DataFrame, rules=RULES) -> DataFrame:
    """(page_id, host, path, rule, verdict, template, purity) per row of ``pages`` (page_id, url).

    ``labels`` (page_id, bad) marks some pages as good (0) or bad (1); several labels of a page all count, null ones
    do not. A rule that fits decides, the longest first. Else the page's template does: digits in a path segment are
    one mark; below a level with many children, rare ones become a wildcard; at every depth, sibling branches whose bad
    share does not differ from their common share are merged into one, with all that lies below them. The purity of a
    branch is its bad share smoothed towards the purity of its parent, that of a host towards the share of all labelled
    pages; a template over REJECT_OVER is blocked. So a bad section is caught however its labels are dealt over its
    branches, and a branch with few labels of its own is judged by what surrounds it. Without labels nothing but the
    rules blocks.

    A null url, or one without ``://``, has an empty host and path. Pages are reduced to one row per host and lexical
    template before the tree is built, so a crowded host or template is a row per task in every shuffle but the last
    join, where the templates have unique keys and the crowded side can be split.
    """
    host, path = _host_and_path(F.col("url"))
    parsed = pages.select("page_id", host.alias("host"), path.alias("path"))
    shape = F.filter(F.split(F.regexp_replace("path", "[0-9]+", "#"), "/"), lambda s: s != "")
    parsed = parsed.withColumn("shape", F.array_join(shape, "/"))
    marked = labels.where("page_id IS NOT NULL AND bad IS NOT NULL").groupBy("page_id").agg(F.count("*").alias("labels"), F.sum("bad").alias("bad"))
    counted = parsed.join(marked, "page_id", "left").groupBy("host", "shape").agg(
        F.count("*").alias("pages"), F.coalesce(F.sum("labels"), F.lit(0)).alias("labels"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad")
    )
    rate = marked.agg(F.coalesce(F.sum("bad") / F.sum("labels"), F.lit(0.0))).first()[0]
    judged = _judged(_generalised(counted), rate)
    rule, verdict = _ruled(F.col("host"), F.col("path"), rules)
    method = F.when(F.col("purity") > REJECT_OVER, "block").otherwise("allow")
    return parsed.join(judged, ["host", "shape"], "left").select(
        "page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, method).alias("verdict"), "template", "purity"
    )


def _generalised(counted: DataFrame) -> DataFrame:
    """Adds ``parts``, the segments of each shape with rare children of crowded levels as wildcards."""
    segments = F.split("shape", "/")
    nodes = counted.where("shape <> ''").select(
        "host", "shape", "pages", F.posexplode(segments).alias("depth", "segment"), segments.alias("all")
    )
    nodes = nodes.withColumn("parent", F.array_join(F.expr("slice(all, 1, depth)"), "/")).drop("all")
    children = nodes.groupBy("host", "parent", "depth", "segment").agg(F.sum("pages").alias("own"))
    levels = children.groupBy("host", "parent", "depth").agg(F.count("*").alias("children"), F.sum("own").alias("whole"))
    rare = children.join(levels, ["host", "parent", "depth"]).where((F.col("children") > MOST_CHILDREN) & (F.col("own") < LEAST_SHARE * F.col("whole")))
    rare = rare.select("host", "parent", "depth", "segment", F.lit(True).alias("rare"))
    named = nodes.join(rare, ["host", "parent", "depth", "segment"], "left")
    part = F.struct("depth", F.when(F.col("rare"), ANY).otherwise(F.col("segment")).alias("name"))
    parts = named.groupBy("host", "shape").agg(F.array_sort(F.collect_list(part)).alias("parts"))
    return counted.join(parts, ["host", "shape"], "left").withColumn("parts", F.coalesce(F.col("parts.name"), F.array().cast("array<string>")))


def _judged(shapes: DataFrame, rate: float) -> DataFrame:
    """(host, shape, template, purity), the tree being merged and judged level by level from the root.

    A level is two grouped sums over the shapes, in the map tasks first, and joins with keys that are unique on one side.
    Its result is stored, so the plan of the next level does not hold it. There are as many levels as the longest path
    has segments, DEEPEST at most. The end of a path is a branch of its own, so a page and what lies below it differ.
    """
    size = F.size("parts")
    rest = F.array_join(F.slice("parts", F.lit(DEEPEST), F.greatest(size, F.lit(1))), "/")
    parts = F.when(size > DEEPEST, F.concat(F.slice("parts", 1, DEEPEST - 1), F.array(rest))).otherwise(F.col("parts"))
    tree = shapes.select("host", "shape", F.col("labels").cast("double").alias("labels"), F.col("bad").cast("double").alias("bad"), F.concat(parts, F.array(F.lit(""))).alias("parts"))
    smoothed = (F.sum("bad") + PRIOR_WEIGHT * rate) / (F.sum("labels") + PRIOR_WEIGHT)
    tree = stage(tree.join(tree.groupBy("host").agg(smoothed.alias("purity")), "host").withColumn("template", F.lit("")), "urls-tree")
    for depth in range(tree.agg(F.max(F.size("parts"))).first()[0] or 0):
        named = tree.withColumn("segment", F.get("parts", F.lit(depth)))
        own = named.where("segment IS NOT NULL").groupBy("host", "template", "purity", "segment").agg(F.sum("labels").alias("n"), F.sum("bad").alias("b"))
        around = own.where("segment <> ''").groupBy("host", "template").agg(F.sum("n").alias("all_n"), F.sum("b").alias("all_b"))
        share = F.col("all_b") / F.when(F.col("all_n") > 0, F.col("all_n"))
        off = F.abs(F.col("b") - F.col("n") * share)
        apart = F.coalesce(off > DEVIATIONS * F.sqrt(F.col("n") * share * (1 - share)), F.lit(False))
        kept = F.when(F.col("segment") == "", "").when(apart, F.col("segment")).otherwise(ANY)
        decided = own.join(around, ["host", "template"], "left").withColumn("kept", kept)
        pure = (F.sum("b") + PRIOR_WEIGHT * F.col("purity")) / (F.sum("n") + PRIOR_WEIGHT)
        pooled = decided.groupBy("host", "template", "purity", "kept").agg(pure.alias("pure")).drop("purity")
        below = decided.select("host", "template", "segment", "kept").join(pooled, ["host", "template", "kept"])
        template = F.concat("template", F.coalesce(F.concat(F.lit("/"), "kept"), F.lit("")))
        tree = named.join(below, ["host", "template", "segment"], "left").select(
            "host", "shape", "labels", "bad", "parts", F.coalesce("pure", "purity").alias("purity"), template.alias("template")
        )
        tree = stage(tree, "urls-tree")
    return tree.select("host", "shape", "template", "purity")
