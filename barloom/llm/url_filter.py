"""URL verdicts from rules and from a path-template tree.

Fixed rules judge the urls that they fit. Their verdicts are also the labels from which templates are
learnt for the other urls. Each host has a tree of path segments, grown level by level:

* generalise: a word keeps its name where it has a fair share of its node's urls, and any segment does whose
  labels differ significantly from those of the others of its kind; the rest, which vary, become one wildcard
  for their kind (digits, mixed, words, each with its file ending);
* merge: named siblings with enough labels whose block rates do not differ significantly (two-proportion z, from
  the merged branch as a whole and from its lowest member) become one branch. It is named after its first and
  last member and the number of those between;
* judge: the block rate of a branch is smoothed towards that of its parent, of a host towards the rate of
  all urls. A url is blocked when the smoothed rate of its template is ``block_at`` or more.

Rows are first reduced to distinct (host, path) with counts. Counts of a node are partial aggregates. Before
siblings are merged, those whose rates agree in whole percent are one bin, so a node has at most 101 however
many children it has. Levels below ``depth`` are one wildcard tail, which is part of what a template is.

Defined cases: a null url, or one without "://", has empty host and path and no rule; it is judged by the
root template of the empty host. Rows that repeat are judged alike. An empty table gives no rows. Path
levels beyond the eighth, of however long a url, are one tail. Siblings with equal rates fall into one bin. Other
columns, whatever their names, do not matter. Only ``page_id`` and ``url`` are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.llm.common import join_facts, prepared
from barloom.session import Workspace

#: Verdict, host, path.
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
TAIL = "**"


def with_parts(pages: DataFrame) -> DataFrame:
    """``pages`` with host (lower case) and path."""
    at = F.instr("url", "://")
    rest = F.when(at > 0, F.substring("url", at + 3, F.length("url"))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER)
    return pages.withColumns({"host": host, "path": F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)})


def rule_columns(rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits and its verdict, both null where none does."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for action, host, path in sorted(rules, key=lambda r: len(r[1] + r[2])):  # the longest is asked first
        fits = ((F.col("host") == host) | F.endswith(F.col("host"), F.lit("." + host))) & F.startswith(F.col("path"), F.lit(path))
        name = F.when(fits, F.lit(host + path)).otherwise(name)
        verdict = F.when(fits, F.lit(action)).otherwise(verdict)
    return name, verdict


def _kind(segment: Column) -> Column:
    stem = F.regexp_replace(segment, r"\.[A-Za-z]{1,5}$", "")
    kind = F.when(stem.rlike(r"^[0-9]+$"), F.lit("<n>")).when(stem.rlike(r"[0-9]"), F.lit("<x>")).otherwise(F.lit("<w>"))
    return F.concat(kind, F.regexp_extract(segment, r"(\.[A-Za-z]{1,5})$", 1))


def learn_templates(
    urls: DataFrame, workspace: Workspace, depth: int = 8, share: float = 0.02, least: int = 5, z: float = 1.96,
    apart: float = 4.0, strength: float = 4.0,
) -> DataFrame:
    """Of each (host, path) of ``urls`` (host, path, blocked: 1, 0 or null): its template and its smoothed block rate."""
    segments = F.filter(F.split("path", "/"), lambda s: s != "")
    cut = F.when(F.size(segments) > depth, F.concat(F.slice(segments, 1, depth), F.array(F.lit(TAIL)))).otherwise(segments)
    counted = urls.groupBy("host", "path").agg(
        F.count(F.lit(1)).alias("n"), F.count("blocked").alias("l"), F.coalesce(F.sum("blocked"), F.lit(0)).alias("b")
    )
    paths = workspace.stage(counted.withColumn("segments", cut), "paths")
    top = paths.agg(F.sum("l").alias("l"), F.sum("b").alias("b"), F.max(F.size("segments")).alias("deep")).first()
    everywhere = (top["b"] or 0) / top["l"] if top["l"] else 0.0

    def smoothed(b: Column, l: Column, prior: Column) -> Column:
        return (b + F.lit(strength) * prior) / (l + F.lit(strength))

    hosts = paths.groupBy("host").agg(F.sum("l").alias("hl"), F.sum("b").alias("hb"))
    hosts = workspace.stage(hosts.select("host", smoothed(F.col("hb"), F.col("hl"), F.lit(everywhere)).alias("rate")), "hosts")
    # The tree's tables are read from files, so adaptive execution can split a hot host in these joins.
    rows = workspace.stage(paths.join(hosts, "host").withColumn("node", F.lit("")), "level")
    for level in range(top["deep"] or 0):
        branches = workspace.stage(_branches(rows, level, share, least, z, apart, smoothed), f"branches{level}")
        segment = F.get("segments", F.lit(level))
        deeper = rows.withColumn("segment", segment)
        joined = deeper.where(segment.isNotNull()).join(
            branches.withColumnRenamed("rate", "own"), ["host", "node", "segment"]
        ).select("host", "path", "n", "l", "b", "segments", F.col("own").alias("rate"), F.concat_ws("/", "node", "token").alias("node"))
        rows = workspace.stage(deeper.where(segment.isNull()).drop("segment").select(*joined.columns).unionAll(joined), f"level{level}")
    return rows.select("host", "path", F.concat(F.lit("/"), F.ltrim(F.col("node"), F.lit("/"))).alias("template"), "rate")


def _differ(l1: Column, b1: Column, l2: Column, b2: Column, z: float) -> Column:
    """Whether two block rates differ significantly (two-proportion z); null where one has no labels."""
    pooled = F.try_divide(b1 + b2, l1 + l2)
    spread = F.sqrt(pooled * (1 - pooled) * (F.try_divide(F.lit(1), l1) + F.try_divide(F.lit(1), l2)))
    return F.abs(F.try_divide(b1, l1) - F.try_divide(b2, l2)) > F.lit(z) * spread


def _merged(bins: Column, z: float) -> Column:
    """Groups (bins, l, b) of a node's bins (bin, l, b) in order of their rates.

    A bin joins the last group unless it differs from the group as a whole or from the group's lowest bin, so
    that a chain of small steps does not run together.
    """
    lone = lambda x: F.struct(F.array(x["bin"]).alias("bins"), x["l"].alias("l"), x["b"].alias("b"), x["l"].alias("first_l"), x["b"].alias("first_b"))

    def step(groups: Column, x: Column) -> Column:
        last = F.element_at(groups, -1)
        apart = _differ(last["l"], last["b"], x["l"], x["b"], z) | _differ(last["first_l"], last["first_b"], x["l"], x["b"], z)
        grown = F.struct(
            F.concat(last["bins"], F.array(x["bin"])).alias("bins"), (last["l"] + x["l"]).alias("l"), (last["b"] + x["b"]).alias("b"),
            last["first_l"].alias("first_l"), last["first_b"].alias("first_b"),
        )
        return F.when(apart, F.concat(groups, F.array(lone(x)))).otherwise(F.concat(F.slice(groups, 1, F.size(groups) - 1), F.array(grown)))

    start = F.array(lone(F.get(bins, F.lit(0))))
    return F.aggregate(F.slice(bins, 2, F.greatest(F.size(bins), F.lit(1))), start, step)


def _branches(rows: DataFrame, level: int, share: float, least: int, z: float, apart: float, smoothed) -> DataFrame:
    """(host, node, segment) to the token that stands for the segment and the smoothed rate of that branch."""
    at = rows.withColumn("segment", F.get("segments", F.lit(level))).where(F.col("segment").isNotNull())
    children = at.groupBy("host", "node", "segment").agg(
        F.sum("n").alias("n"), F.sum("l").alias("l"), F.sum("b").alias("b"), F.first("rate").alias("prior")
    )
    children = children.withColumn("kind", _kind(F.col("segment")))
    kinds = children.groupBy("host", "node", "kind").agg(F.sum("n").alias("kn"), F.sum("l").alias("kl"), F.sum("b").alias("kb"))
    kinds = kinds.withColumn("total", F.sum("kn").over(Window.partitionBy("host", "node"))).drop("kn")
    children = join_facts(children, kinds, ["host", "node", "kind"], F.col("segment"))
    sure = F.col("l") >= least
    common = F.col("kind").startswith("<w>") & (F.col("n") >= F.greatest(F.lit(least), F.col("total") * share))
    rest_l, rest_b = F.col("kl") - F.col("l"), F.col("kb") - F.col("b")
    special = sure & (rest_l >= least) & _differ(F.col("l"), F.col("b"), rest_l, rest_b, apart)
    named = (F.col("segment") == TAIL) | common | F.coalesce(special, F.lit(False))
    # Named children with labels are binned by their rate in percent, so that a node has at most 101 bins to merge.
    percent = F.when(sure, F.round(F.try_divide(100 * F.col("b"), F.col("l"))).cast("int"))
    tokens = children.withColumn("named", named).select(
        "host", "node", "segment", "n", "l", "b", "prior",
        F.when(~F.col("named"), F.col("kind")).when(percent.isNull(), F.col("segment")).alias("alone"),
        F.when(F.col("named"), percent).alias("bin"),
    )
    sums = [F.sum("l").alias("l"), F.sum("b").alias("b"), F.first("prior").alias("prior")]
    binned = tokens.where(F.col("alone").isNull()).groupBy("host", "node", "bin").agg(
        *sums, F.min("segment").alias("low"), F.max("segment").alias("high"), F.count(F.lit(1)).alias("names")
    )
    merged = binned.groupBy("host", "node").agg(
        F.first("prior").alias("prior"), F.array_sort(F.collect_list(F.struct("bin", "l", "b", "low", "high", "names"))).alias("all")
    )
    group = F.explode(_merged(F.col("all"), z)).alias("group")
    merged = merged.select("host", "node", "prior", "all", group).withColumn("all", F.filter("all", lambda x: F.array_contains("group.bins", x["bin"])))
    low, high = F.array_min(F.col("all.low")), F.array_max(F.col("all.high"))
    names = F.aggregate("all.names", F.lit(0).cast("long"), lambda x, y: x + y)
    token = F.when(names == 1, low).when(names == 2, F.concat_ws("|", low, high)).otherwise(F.concat(low, F.lit("|+"), names - 2, F.lit("|"), high))
    rate = smoothed(F.col("group.b"), F.col("group.l"), F.col("prior"))
    by_bin = merged.select("host", "node", token.alias("token"), rate.alias("rate"), F.explode("group.bins").alias("bin"))
    alone = tokens.where(F.col("alone").isNotNull())
    judged = alone.groupBy("host", "node", "alone").agg(*sums)
    by_name = judged.select("host", "node", "alone", F.col("alone").alias("token"), smoothed(F.col("b"), F.col("l"), F.col("prior")).alias("rate"))
    out = ["host", "node", "segment", "token", "rate"]
    return (
        join_facts(alone, by_name, ["host", "node", "alone"], F.col("segment")).select(*out)
        .unionAll(join_facts(tokens.where(F.col("alone").isNull()), by_bin, ["host", "node", "bin"], F.col("segment")).select(*out))
    )


def judge(pages: DataFrame, workspace: Workspace, rules=RULES, block_at: float = 0.7, **options) -> DataFrame:
    """page_id, host, path, rule, template, block_rate and verdict of every page."""
    prepared(pages.sparkSession)
    rule, ruled = rule_columns(rules)
    parts = with_parts(pages.select("page_id", "url")).withColumns({"rule": rule, "ruled": ruled}).drop("url")
    rows = workspace.stage(parts, "urls")
    blocked = (F.col("ruled") == "block").cast("long")
    templates = learn_templates(rows.select("host", "path", blocked.alias("blocked")), workspace, **options)
    verdict = F.coalesce(F.col("ruled"), F.when(F.col("rate") >= block_at, F.lit("block")).otherwise(F.lit("allow")))
    return rows.join(templates, ["host", "path"]).select(
        "page_id", "host", "path", "rule", "template", F.col("rate").alias("block_rate"), verdict.alias("verdict")
    )


def hidden_verdicts(pages: DataFrame, workspace: Workspace, rules=RULES, block_at: float = 0.7, parts: int = 2, **options) -> DataFrame:
    """How templates judge urls whose rule they did not see: ruled (its verdict), learnt (the template's), urls.

    The labels of one of ``parts`` of the ruled (host, path) pairs, dealt by hash, are hidden while learning.
    """
    prepared(pages.sparkSession)
    _, ruled = rule_columns(rules)
    hidden = F.pmod(F.crc32(F.concat_ws(" ", "host", "path")), F.lit(parts)) == 0
    rows = workspace.stage(with_parts(pages.select("url")).select("host", "path", ruled.alias("ruled"), hidden.alias("hidden")), "hidden")
    label = F.when(~F.col("hidden"), (F.col("ruled") == "block").cast("long"))
    templates = learn_templates(rows.select("host", "path", label.alias("blocked")), workspace, **options)
    asked = rows.where(F.col("hidden") & F.col("ruled").isNotNull()).join(templates, ["host", "path"])
    learnt = F.when(F.col("rate") >= block_at, F.lit("block")).otherwise(F.lit("allow"))
    return asked.groupBy("ruled", learnt.alias("learnt")).agg(F.count(F.lit(1)).alias("urls"))
