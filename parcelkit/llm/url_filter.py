"""URL filters by a path-template tree (DataFrame functions only).

Listed rules decide first: a rule fits its host, all subdomains, and paths that start with its own; the longest
wins. The urls they decide are the labelled ones. All other urls are judged by a tree of path templates:

1. per host, paths are read segment by segment. A segment that does not recur, or holds few of its parent's urls, is
   variable and becomes a wildcard (``#`` if it is made of digits, else ``*``); the others stay as they are. So a
   parent has a bounded number of branches (at most 1 / ``min_share`` literals and two wildcards). A node of a single
   path is not split further (``/**``), however many segments are left;
2. at every depth, siblings whose labelled shares a two-proportion test cannot tell apart are merged: they pool their
   labels;
3. a node's share of blocked labels is smoothed towards what is known around it: the mean of its parent's share and
   of the share that the same template has over all hosts, itself smoothed towards that of its own parent. So a
   template without labels takes the evidence of its parent and of its like elsewhere;
4. a template is rejected when the smoothed share of its own node exceeds ``reject_over``.

Urls are first grouped to distinct (host, path), and every count is combined map-side, so a hot host is no hot
task; the joins are plain equi-joins that adaptive execution can split. A level of the tree is a pass over the paths
that still share a node with another path.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcelkit.llm.common import written

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: (verdict, host and path)
RULES = (("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"),
         ("block", "net/fr/"))


def with_host_path(pages: DataFrame, url_col: str = "url") -> DataFrame:
    """Adds ``host`` (A-Z lower-cased) and ``path``; both empty for a null url or one without ``://``."""
    rest = F.when(F.instr(F.col(url_col), "://") > 0, F.regexp_extract(F.col(url_col), r"(?s)^.*?://(.*)$", 1))
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1), _UPPER, _LOWER)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return pages.withColumn("host", host).withColumn("path", path)


def _rule(rules, host: Column, path: Column) -> tuple[Column, Column]:
    """The longest fitting rule and its verdict (null: none)."""
    fitting, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, text in sorted(rules, key=lambda r: len(r[1])):       # longer ones are laid over shorter ones
        name, _, tail = text.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith("/" + tail)
        fitting, verdict = F.when(fits, F.lit(text)).otherwise(fitting), F.when(fits, F.lit(kind)).otherwise(verdict)
    return fitting, verdict


def path_templates(paths: DataFrame, min_share: float = 0.02, min_urls: int = 2) -> DataFrame:
    """``paths`` (host, path, n) with ``chain``: the templates of the path's nodes, from the host's root ("") to its own.

    A segment stays literal when it holds at least ``min_share`` of its parent's urls and ``min_urls`` of them;
    else it is generalised. The tree is as deep as the paths that go on together.
    """
    parts = F.filter(F.split("path", "/"), lambda s: s != "")
    tree = paths.withColumn("_parts", parts).withColumn("chain", F.array(F.lit("")))
    done = []
    while True:
        over = F.size("_parts") < F.size("chain")                       # every segment has its place
        done.append(tree.where(over).drop("_parts"))
        tree = tree.where(~over)
        if tree.isEmpty():
            break
        tree = tree.withColumn("_node", F.element_at("chain", -1)).withColumn("_seg", F.get("_parts", F.size("chain") - 1))
        own = tree.groupBy("host", "_node", "_seg").agg(F.sum("n").alias("_own"), F.count(F.lit(1)).alias("_paths"))
        whole = own.groupBy("host", "_node").agg(F.sum("_own").alias("_all"), F.sum("_paths").alias("_every"))
        share = (F.col("_own") >= min_urls) & (F.col("_own") >= min_share * F.col("_all"))
        known = written(own.join(whole, ["host", "_node"]).select(
            "host", "_node", "_seg", share.alias("_kept"), (F.col("_every") == 1).alias("_lone")), "branches")
        wild = F.when(F.col("_seg").rlike(r"^[0-9]+([.][a-z]+)?$"), "#").otherwise("*")
        step = F.when(F.col("_lone"), "**").when(F.col("_kept"), F.col("_seg")).otherwise(wild)
        tree = tree.join(known, ["host", "_node", "_seg"]).withColumn(
            "chain", F.array_append("chain", F.concat("_node", F.lit("/"), step)))
        # a lone path ends here
        tree = tree.withColumn("_parts", F.when(F.col("_lone"), F.slice("_parts", 1, F.size("chain") - 1)).otherwise(F.col("_parts")))
        tree = written(tree.drop("_node", "_seg", "_kept", "_lone"), "tree")
    return reduce(DataFrame.unionByName, done)


def merged_branches(nodes: DataFrame, z: float = 1.96) -> DataFrame:
    """``nodes`` (host, parent, template, labelled, blocked) with ``_l``, ``_b``: the labels pooled over the siblings that
    a two-proportion test cannot tell apart.

    Siblings are ordered by their share and each is compared with the one before; those without labels stay apart.
    """
    known = nodes.where("labelled > 0").withColumn("_share", F.col("blocked") / F.col("labelled"))
    order = Window.partitionBy("host", "parent").orderBy("_share", "template")      # bounded: see path_templates
    before = known.withColumn("_b", F.lag("blocked").over(order)).withColumn("_n", F.lag("labelled").over(order))
    pooled = (F.col("blocked") + F.col("_b")) / (F.col("labelled") + F.col("_n"))
    error = F.sqrt(pooled * (1 - pooled) * (1 / F.col("labelled") + 1 / F.col("_n")))
    gap = F.abs(F.col("_share") - F.col("_b") / F.col("_n"))
    fresh = F.when(F.col("_n").isNull(), 1).when(gap > z * error, 1).otherwise(0)
    known = before.withColumn("_fresh", fresh).withColumn("_run", F.sum("_fresh").over(order))
    like = Window.partitionBy("host", "parent", "_run")
    known = known.select(*nodes.columns, F.sum("labelled").over(like).alias("_l"), F.sum("blocked").over(like).alias("_b"))
    lone = nodes.where("labelled = 0").select("*", F.col("labelled").alias("_l"), F.col("blocked").alias("_b"))
    return known.unionByName(lone)


def smoothed_shares(paths: DataFrame, prior: float = 1.0) -> DataFrame:
    """``host``, ``template``, ``rejected_share`` of the paths' own nodes. ``paths``: host, chain, labelled, blocked."""
    leaves = paths.groupBy("host", "chain").agg(F.sum("labelled").alias("labelled"), F.sum("blocked").alias("blocked"))
    leaves = written(leaves, "leaves")
    steps = leaves.select("*", F.posexplode("chain").alias("k", "template")).withColumn(
        "parent", F.when(F.col("k") > 0, F.get("chain", F.col("k") - 1)))
    nodes = steps.groupBy("host", "parent", "template").agg(F.sum("labelled").alias("labelled"), F.sum("blocked").alias("blocked"))
    nodes = written(merged_branches(written(nodes, "nodes")), "merged")
    alike = nodes.groupBy("template").agg(F.sum("labelled").alias("_gl"), F.sum("blocked").alias("_gb"))
    around = written(nodes.join(alike, "template").select("host", "template", "_l", "_b", "_gl", "_gb"), "evidence")
    chains = steps.select("host", F.element_at("chain", -1).alias("leaf"), "k", "template").join(around, ["host", "template"])
    # a group is one chain
    chains = chains.groupBy("host", "leaf").agg(F.sort_array(F.collect_list(F.struct("k", "_l", "_b", "_gl", "_gb"))).alias("way"))
    start = F.struct(F.lit(0.5).alias("everywhere"), F.lit(None).cast("double").alias("here"))

    def down(state, node):
        everywhere = (node["_gb"] + prior * state["everywhere"]) / (node["_gl"] + prior)
        around = (F.coalesce(state["here"], everywhere) + everywhere) / 2
        return F.struct(everywhere.alias("everywhere"), ((node["_b"] + prior * around) / (node["_l"] + prior)).alias("here"))

    return chains.select("host", F.col("leaf").alias("template"), F.aggregate("way", start, down)["here"].alias("rejected_share"))


def judge_urls(pages: DataFrame, rules=RULES, labels: DataFrame | None = None, reject_over: float = 0.8,
               prior: float = 1.0, min_share: float = 0.02, min_urls: int = 2, id_col: str = "page_id",
               url_col: str = "url") -> DataFrame:
    """``page_id``, ``host``, ``path``, ``rule``, ``verdict``, ``template``, ``rejected_share`` of every row.

    ``labels`` may add labelled urls (``host``, ``path``, ``blocked`` as 0 or 1) to those that the rules decide. A
    null url, or one without ``://``, has an empty host and path and is judged like any other. Null and repeated ids give
    a row each; an empty table gives none; other columns are ignored. A very long url is a path of many segments; it ends
    as ``/**`` where no other path goes with it.
    """
    rows = with_host_path(pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("_url")), "_url").drop("_url")
    rule, verdict = _rule(rules, F.col("host"), F.col("path"))
    distinct = rows.groupBy("host", "path").agg(F.count(F.lit(1)).alias("n"))
    distinct = distinct.withColumn("rule", rule).withColumn("ruled", verdict).withColumn(
        "labelled", F.when(F.col("ruled").isNotNull(), F.col("n")).otherwise(0)).withColumn(
        "blocked", F.when(F.col("ruled") == "block", F.col("n")).otherwise(0))
    if labels is not None:
        extra = labels.groupBy("host", "path").agg(F.count(F.lit(1)).alias("_l"), F.sum("blocked").alias("_k"))
        distinct = distinct.join(extra, ["host", "path"], "left").withColumn(
            "labelled", F.col("labelled") + F.coalesce("_l", F.lit(0))).withColumn(
            "blocked", F.col("blocked") + F.coalesce("_k", F.lit(0))).drop("_l", "_k")
    tree = path_templates(written(distinct, "paths"), min_share, min_urls)
    shares = written(smoothed_shares(tree, prior), "shares")
    tree = written(tree.withColumn("template", F.element_at("chain", -1)).join(shares, ["host", "template"]).select(
        "host", "path", "rule", "template", "rejected_share", F.coalesce("ruled", F.when(
            F.col("rejected_share") > reject_over, "block").otherwise("allow")).alias("verdict")), "verdicts")
    return rows.join(tree, ["host", "path"]).select("page_id", "host", "path", "rule", "verdict", "template",
                                                    "rejected_share")
