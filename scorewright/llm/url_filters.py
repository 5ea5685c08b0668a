"""URL filters: rules by host and path, and a tree of path templates per host for the rest.

Paths are cut into segments, all of them. Level by level, a host's variable segments become wildcards: those
with a digit, and rare ones where a node has many children. Paths leave as soon as all below their node are one,
so there are as many levels as different paths stay together. What the rules say of a page is its label. From
the last level up, under each node, labelled branches whose share of blocked pages does not differ from that of
all labelled branches there (two-proportion test) are merged into one template; others stay apart, and so does a
branch that holds more than one template. A page without a rule is blocked if its template's smoothed share of
blocked labels reaches a bound. All of it is counted with map-side combine, so a host with a third of all pages
is a few rows after the first step.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

#: A node with more children than MANY has its rarer ones (under RARE pages) in common.
MANY, RARE = 20, 5
#: Difference of shares, in standard errors, up to which branches are merged; the smoothing; the bound.
SIMILAR, SMOOTHING, BOUND = 1.96, 2.0, 0.8


def host_of(url: Column) -> Column:
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest fitting rule (verdict, host, path); nulls where none fits."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for said, rule_host, rule_path in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == rule_host) | host.endswith(f".{rule_host}")) & path.startswith(rule_path)
        rule = F.when(fits, F.lit(rule_host + rule_path)).otherwise(rule)
        verdict = F.when(fits, F.lit(said)).otherwise(verdict)
    return rule, verdict


def _templates(nodes: DataFrame) -> tuple[DataFrame, int]:
    """(host, segments, node, template, depth, blocked, labelled): of each distinct path the node at which it leaves the tree
    and, with the segments that follow, its template; and the tree's depth. A path that ends has an empty segment next."""
    tree = nodes.withColumn("node", F.array().cast("array<string>"))
    keys, done, depth = ["host", "node"], None, 0
    while True:
        rest = F.slice("segments", depth + 1, F.greatest(F.size("segments") - depth, F.lit(0)))
        tree = tree.withColumn("rest", F.concat_ws("/", rest)).withColumn("segment", F.coalesce(F.get("segments", F.lit(depth)), F.lit("")))
        child = tree.groupBy(*keys, "segment").agg(F.sum("n").alias("pages"), F.min("rest").alias("least"), F.max("rest").alias("most"))
        wide = child.groupBy(*keys).agg(F.count("*").alias("children"), (F.min("least") != F.max("most")).alias("parted"))
        rare = (F.col("children") > MANY) & (F.col("pages") < RARE)
        child = child.join(wide, keys).select(*keys, "segment", "parted", F.when(rare, F.lit("*")).otherwise(F.col("segment")).alias("shown"))
        level = stored(tree.join(child, [*keys, "segment"]), "templates")
        leaves = level.filter(~F.col("parted")).select(
            "host", "segments", "node", F.concat("node", rest).alias("template"), F.lit(depth).alias("depth"), "blocked", "labelled"
        )
        done = leaves if done is None else done.unionAll(leaves)
        tree = level.filter("parted").select("host", "segments", "n", "blocked", "labelled", F.concat("node", F.array("shown")).alias("node"))
        if tree.isEmpty():
            return done, depth
        depth += 1


def _merged(leaves: DataFrame, depth: int) -> DataFrame:
    """(host, node, template, blocked, labelled): labelled nodes at which paths leave, with the counts of the template they are merged into."""
    parent = F.slice("node", 1, F.size("node") - 1)
    units, merging, done = None, None, None
    for d in range(depth, -1, -1):
        own = leaves.filter(F.col("depth") == d)
        begun = own.select("host", "node", "template", "blocked", "labelled", F.col("node").alias("unit"))
        merging = begun if merging is None else merging.unionAll(begun)
        if d == 0:
            break
        own = own.select("host", "node", "blocked", "labelled", F.lit(True).alias("uniform"))
        units = (own if units is None else own.unionAll(units)).withColumn("parent", parent)
        pooled = units.groupBy("host", "parent").agg(F.sum("blocked").alias("all_blocked"), F.sum("labelled").alias("all_labelled"))
        share = F.col("all_blocked") / F.col("all_labelled")
        error = F.sqrt(share * (1 - share) / F.col("labelled"))
        like = F.col("uniform") & (F.abs(F.col("blocked") / F.col("labelled") - share) <= SIMILAR * error)
        units = stored(units.join(pooled, ["host", "parent"]).select("host", "parent", "node", "blocked", "labelled", like.alias("like")), "branches")
        group = units.filter("like").groupBy("host", "parent").agg(F.sum("blocked").alias("m_blocked"), F.sum("labelled").alias("m_labelled"))
        alike = units.filter("like").join(group, ["host", "parent"]).select("host", F.col("node").alias("unit"), "parent", "m_blocked", "m_labelled")
        level = stored(merging.join(alike, ["host", "unit"], "left"), "merged")
        apart = level.filter("parent is null").select("host", "node", "template", "blocked", "labelled")
        done = apart if done is None else done.unionAll(apart)
        merging = level.filter("parent is not null").select(
            "host", "node", F.concat("parent", F.array(F.lit("~"))).alias("template"),
            F.col("m_blocked").alias("blocked"), F.col("m_labelled").alias("labelled"), F.col("parent").alias("unit"),
        )
        units = units.groupBy("host", F.col("parent").alias("node")).agg(
            F.sum("blocked").alias("blocked"), F.sum("labelled").alias("labelled"), F.min("like").alias("uniform")
        )
    merging = merging.select("host", "node", "template", "blocked", "labelled")
    return merging if done is None else done.unionAll(merging)


def judge_urls(
    pages: DataFrame, rules: list[tuple[str, str, str]], id_col: str = "page_id", url_col: str = "url"
) -> DataFrame:
    """One row per input row: page_id, host, path, rule, verdict, template, purity.

    Rules are (`allow` or `block`, host, path); the longest of host and path together wins, the later of
    equal ones. `pages` needs an id and a url; other columns are ignored, whatever their names. A null url,
    or one without `://`, has an empty host and path. Null and repeated ids keep their rows. A template
    without labels has the smoothed share of no evidence, one half, and is allowed. An empty table gives no
    rows. Every segment of a path counts; there are some jobs for each level at which different paths still
    share a node.
    """
    url = F.col(url_col).cast("string")
    rows = pages.select(F.col(id_col).alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path"))
    rule, said = rule_of(F.col("host"), F.col("path"), rules)
    rows = rows.withColumn("rule", rule).withColumn("said", said)
    # variable segments: those with a digit
    segments = F.transform(
        F.filter(F.split("path", "/"), lambda s: s != ""), lambda s: F.when(s.rlike("[0-9]"), F.lit("*")).otherwise(s)
    )
    rows = rows.withColumn("segments", segments)
    nodes = rows.groupBy("host", "segments").agg(
        F.count("*").alias("n"),
        F.sum(F.when(F.col("said") == "block", 1).otherwise(0)).alias("blocked"),
        F.count("said").alias("labelled"),
    )
    paths, depth = _templates(stored(nodes, "paths"))
    leaves = paths.groupBy("host", "node", "template", "depth").agg(F.sum("blocked").alias("blocked"), F.sum("labelled").alias("labelled"))
    merged = _merged(leaves.filter("labelled > 0"), depth).withColumnRenamed("template", "merged")
    judged = paths.select("host", "segments", "node", "template").join(merged, ["host", "node"], "left").select(
        "host", "segments",
        F.concat_ws("/", "host", F.coalesce("merged", "template")).alias("template"),
        ((F.coalesce("blocked", F.lit(0)) + SMOOTHING / 2) / (F.coalesce("labelled", F.lit(0)) + SMOOTHING)).alias("purity"),
    )
    return rows.join(judged, ["host", "segments"], "left").select(
        "page_id", "host", "path", "rule",
        F.coalesce("said", F.when(F.col("purity") >= BOUND, F.lit("block")).otherwise(F.lit("allow"))).alias("verdict"),
        "template", "purity",
    )
