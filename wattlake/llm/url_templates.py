"""URL filters: host and path rules, then a per-host tree of path templates.

Rules come first: a rule (host, path) fits its host and all subdomains if the
URL's path starts with the rule's; the longest wins.  URLs that a rule judges
are the labels of the tree; it judges the rest.

Tree, level by level from the host and as deep as the paths go: under one node a
segment stays literal if it has more than one path and ``MIN_SHARE`` of the
node's paths, any other becomes a wildcard of its character class (``{n}``,
``{hex}``, ``{s}``, with its file extension).  Literal siblings whose followers
are alike (a test that allows for their numbers of paths) merge into one branch:
labelled ones if their block rates are in the same bucket, an unlabelled one
with the labelled ones that it is alike to if those agree, else with other
unlabelled ones.  A template is rejected if it has labels and its block share,
smoothed towards its host's (itself smoothed towards all hosts'), reaches
``REJECT``; everything else is allowed.

Shares and labels are counted in distinct paths, so a table and its copies have
the same tree.  All of it is joins and counts over one row per distinct (host,
generalised path).  As in a radix tree, a run of levels where a node has one
child only is a single step, so the rounds follow the branchings on a path and
not its depth: long shared paths, loops and their every beginning take as many
rounds as short ones.  A path alone in its node gets its remaining segments at
once.  A null URL or one without ``://``
has empty host and path and is allowed.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import col, lookup, materialize

# The rules of the contract, (verdict, host, path).
RULES = (("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
         ("block", "net", "/es/"), ("block", "net", "/fr/"))
MIN_SHARE = 0.02
# Difference of followers (total variation) that counts as alike beyond what chance makes.
ALIKE = 0.1
SMOOTHING = 5.0
REJECT = 0.9
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.char_length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def matched_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule as text, verdict) of the longest rule that fits, else nulls."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule = F.when(fits, F.lit(h + p)).otherwise(rule)
        verdict = F.when(fits, F.lit(what)).otherwise(verdict)
    return rule, verdict


def wildcard(segment: Column) -> Column:
    """The class of a segment, file extension kept."""
    extension = F.regexp_extract(segment, r"(\.[A-Za-z][A-Za-z0-9]{0,4})$", 1)
    stem = F.substring(segment, F.lit(1), F.char_length(segment) - F.char_length(extension))
    kind = (F.when(segment == "", F.lit("")).when(stem.rlike(r"^[0-9]+$"), F.lit("{n}"))
            .when(stem.rlike(r"^(?=.*[0-9])[0-9A-Fa-f-]{8,}$"), F.lit("{hex}")).otherwise(F.lit("{s}")))
    return F.concat(kind, extension)


def _generalised_path(path: Column) -> Column:
    """The path without its first slash, wildcards where digits say so at once."""
    def step(s: Column) -> Column:
        return F.when(s.rlike(r"^[0-9]+(\.[A-Za-z][A-Za-z0-9]{0,4})?$"), wildcard(s)).otherwise(s)
    return F.array_join(F.transform(F.split(F.regexp_replace(path, "^/", ""), "/"), step), "/")


def _is_class(segment: Column) -> Column:
    return segment.rlike(r"^\{(n|hex|s)\}(\.[A-Za-z][A-Za-z0-9]{0,4})?$") | (segment == "")


def _class(segment: Column) -> Column:
    """A segment, coarsely: its wildcard class, or ``-`` after the end."""
    return F.coalesce(F.when(_is_class(segment), segment).otherwise(wildcard(segment)), F.lit("-"))


def _distance(a: dict, b: dict) -> float:
    """Total variation between what follows two branches, less what chance makes of their numbers."""
    total_a, total_b = sum(a.values()), sum(b.values())
    nexts = set(a) | set(b)
    apart = sum(abs(a.get(x, 0) / total_a - b.get(x, 0) / total_b) for x in nexts) / 2
    return apart - math.sqrt((len(nexts) - 1) * (1 / total_a + 1 / total_b)) / 2


def merged(branches: list) -> list[tuple[str, str]]:
    """(segment, branch) of the literal siblings under one node that merge, largest first."""
    found = sorted(((b["to"], sum(x["n"] for x in b["nexts"]), {x["next"]: x["n"] for x in b["nexts"]},
                     b["block"], b["block"] + b["allow"]) for b in branches), key=lambda b: (-b[1], b[0]))
    groups: list[tuple] = []  # bucket of the block rate or None, followers of the first member, members

    def join(to: str, bucket: int | None, nexts: dict) -> None:
        for other, first, members in groups:
            if other == bucket and _distance(first, nexts) <= ALIKE:
                members.append(to)
                return
        groups.append((bucket, nexts, [to]))

    for to, _, nexts, block, labelled in found:
        if labelled:
            join(to, round(block / labelled * 5), nexts)
    known = list(groups)
    for to, _, nexts, _, labelled in found:
        if not labelled:
            near = sorted((_distance(g[1], nexts), i) for i, g in enumerate(known))
            near = [known[i] for x, i in near if x <= ALIKE]
            if len({g[0] for g in near}) == 1:
                near[0][2].append(to)
            else:
                join(to, None, nexts)
    return [(to, "(" + "|".join(sorted(g[2])) + ")") for g in groups if len(g[2]) > 1 for to in g[2]]


def _descend(tree: DataFrame) -> DataFrame:
    """Takes at once the levels that all of a node's paths that go so far share, if two or more do."""
    levels = tree.select("node", F.posexplode("segs").alias("level", "seg")).groupBy("node", "level").agg(
        F.min("seg").alias("low"), F.max("seg").alias("high"), F.count("*").alias("rows"))
    levels = levels.withColumn("parts", (F.col("low") != F.col("high")) | (F.col("rows") == 1))
    shared = levels.groupBy("node").agg(
        F.coalesce(F.min(F.when(F.col("parts"), F.col("level"))), F.max("level") + 1).alias("shared"),
        F.max("rows").alias("rows"))
    shared = materialize(shared.where("shared > 0"), "url-shared")
    tree = lookup(tree, shared, ["node"], "rows", F.xxhash64("node", "segs"))
    steps = F.least(F.coalesce("shared", F.lit(0)), F.size("segs"))
    tree = tree.withColumn("node", F.concat_ws("/", "node", F.when(steps > 0, F.array_join(
        F.slice("segs", F.lit(1), steps), "/"))))
    return tree.withColumn("segs", F.slice("segs", steps + 1, F.size("segs"))).drop("shared")


def _generalise(tree: DataFrame, min_share: float) -> DataFrame:
    """The next level: literal or wildcard per segment, then similar literal siblings merged."""
    tree = tree.withColumn("seg", F.get("segs", F.lit(0)))
    per = tree.groupBy("node", "seg").agg(F.sum("paths").alias("paths"), F.count("*").alias("rows"))
    per = materialize(per, "url-level")
    totals = per.groupBy("node").agg(F.sum("paths").alias("all"), F.sum("rows").alias("rows"))
    totals = materialize(totals.withColumn("alone", F.col("rows") == 1), "url-nodes")
    share = lookup(per, totals, ["node"], "rows", F.col("seg"))
    literal = ~_is_class(F.col("seg")) & (F.col("paths") > 1) & (F.col("paths") >= F.col("all") * min_share)
    named = share.withColumn("literal", literal).withColumn(
        "to", F.when(literal, F.col("seg")).otherwise(_class(F.col("seg"))))
    named = materialize(named.select("node", "seg", "rows", "to", "literal", "alone"), "url-names")
    tree = materialize(lookup(tree, named, ["node", "seg"], "rows", F.xxhash64("node", "seg")), "url-tree")

    # What follows each literal, and its labels; a node has 1 / min_share literals at most.
    siblings = tree.where("literal and not alone")
    after = (siblings.withColumn("next", _class(F.get("segs", F.lit(1))))
             .groupBy("node", "to", "next").agg(F.sum("paths").alias("n"), F.sum("block").alias("block"),
                                                F.sum("allow").alias("allow")))
    looks = after.groupBy("node", "to").agg(F.sum("block").alias("block"), F.sum("allow").alias("allow"),
                                            F.collect_list(F.struct("next", "n")).alias("nexts"))
    nodes = looks.groupBy("node").agg(F.collect_list(F.struct("to", "block", "allow", "nexts")).alias("branches"))
    branches = F.udf(lambda found: merged(found), "array<struct<to: string, branch: string>>")
    pairs = nodes.where(F.size("branches") > 1).select("node", F.explode(branches("branches")).alias("b"))
    rows = siblings.groupBy("node", "to").agg(F.count("*").alias("rows"))
    pairs = materialize(pairs.select("node", "b.to", "b.branch").join(rows, ["node", "to"]), "url-branches")
    tree = lookup(tree, pairs, ["node", "to"], "rows", F.xxhash64("node", "seg"))
    # A path alone in its node has nothing to be compared with further down.
    rest = F.transform("segs", lambda x: F.when(F.col("paths") > 1, x).otherwise(_class(x)))
    step = F.when(F.col("alone"), F.array_join(rest, "/")).when(
        F.col("literal"), F.coalesce("branch", "to")).otherwise(F.col("to"))
    return tree.withColumn("node", F.concat_ws("/", "node", step)).withColumn(
        "ended", F.col("alone") | (F.size("segs") <= 1)).withColumn(
        "segs", F.slice("segs", F.lit(2), F.size("segs"))).drop("seg", "to", "literal", "alone", "branch")


def templates(urls: DataFrame, min_share: float = MIN_SHARE, smoothing: float = SMOOTHING,
              reject: float = REJECT) -> DataFrame:
    """One row per distinct (host, generalised path): its template and the template's verdict.

    ``urls`` has host, path and label (block, allow or null; one for each host and path).
    """
    once = urls.groupBy("host", "path").agg(F.count("*").alias("n"), F.max("label").alias("label"))
    base = once.groupBy("host", _generalised_path(F.col("path")).alias("gpath")).agg(
        F.sum("n").alias("n"), F.count("*").alias("paths"), F.count_if(F.col("label") == "block").alias("block"),
        F.count_if(F.col("label") == "allow").alias("allow"))
    base = materialize(base, "url-paths")
    tree = base.withColumn("segs", F.split("gpath", "/")).withColumn("node", F.col("host"))
    ended = []
    while not ended or tree.limit(1).count():
        tree = materialize(_descend(tree), "url-descended")
        ended.append(tree.where("size(segs) = 0"))
        level = materialize(_generalise(tree.where("size(segs) > 0"), min_share), "url-levels")
        ended.append(level.where("ended").drop("ended"))
        tree = level.where("not ended").drop("ended")
    # The node names the template: host, then its levels.
    tree = materialize(reduce(DataFrame.unionByName, ended).withColumnRenamed("node", "template").drop("segs"), "url-templates")
    total = base.agg(F.sum("block").alias("block"), F.sum("allow").alias("allow"))
    overall = total.select(((F.col("block") + 1) / (F.col("block") + F.col("allow") + 2)).alias("overall"))
    hosts = base.groupBy("host").agg(F.sum("block").alias("hb"), F.sum("allow").alias("ha"))
    hosts = hosts.crossJoin(F.broadcast(overall)).select("host", (
        (F.col("hb") + smoothing * F.col("overall")) / (F.col("hb") + F.col("ha") + smoothing)).alias("host_rate"))
    per = tree.groupBy("host", "template").agg(F.sum("block").alias("block"), F.sum("allow").alias("allow"),
                                               F.count("*").alias("rows"))
    purity = (F.col("block") + smoothing * F.col("host_rate")) / (F.col("block") + F.col("allow") + smoothing)
    judged = per.join(hosts, "host").select(
        "host", "template", "rows", purity.alias("purity"), F.when(
            (F.col("block") + F.col("allow") > 0) & (purity >= reject), "block").otherwise("allow").alias("judged"))
    judged = materialize(judged, "url-verdicts")
    return lookup(tree, judged, ["host", "template"], "rows", F.xxhash64("host", "gpath")).select(
        "host", "gpath", "n", "template", "purity", "judged")


def judge(urls: DataFrame, rules=RULES, id_col: str = "page_id", url_col: str = "url",
          **tree) -> DataFrame:
    """(page_id, host, path, rule, verdict, template, purity) for every row."""
    host, path = split_url(col(url_col))
    rows = urls.select(col(id_col).alias("page_id"), host.alias("host"), path.alias("path"))
    rule, verdict = matched_rule(F.col("host"), F.col("path"), rules)
    rows = rows.withColumn("rule", rule).withColumn("label", verdict)
    found = materialize(templates(rows, **tree), "url-judged")
    rows = rows.withColumn("gpath", _generalised_path(F.col("path")))
    out = lookup(rows, found, ["host", "gpath"], "n", F.col("page_id"))
    return out.select("page_id", "host", "path", "rule", F.coalesce("label", "judged").alias("verdict"),
                      "template", "purity")
