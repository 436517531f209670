"""URL filter: rules by host and path, and trust along the link graph.

A rule (verdict, host, path) fits its host and all subdomains where the url's
path starts with the rule's; the longest fitting rule decides. Urls without
one are judged by their host. Hosts whose pages under rules are mostly allowed
are trusted seeds, those mostly blocked are blocked seeds, weighted by their
pages under rules (pages without a rule say nothing about their host).
Personalised PageRank carries trust along links to the hosts they link to, and
distrust against the links, to the hosts that link to them. A host is blocked
if its distrust outweighs its trust by ``ratio``.

Host edges come from the pages' absolute links, and join a host with the host
of its name without the first label (www.a.b and a.b) where both are known.
Ranks are tables of hosts, cut to the shared folder every round; equal links
are summed before they are shuffled, and sums are combined before, so that a
host with a third of all links is dealt out.

Cases: a null url or one without ``://`` has empty host and path, no rule and
the verdict of an unknown host, allow. Null html has no links; a tag that does not
end ends at the next one. Rows that repeat are judged each; their links count
as often. Hosts that no seed reaches are allowed.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from .common import cut

# The rules asked for.
RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/")]
URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
LINK = r"""(?is)<[a-z][^<>]*?\s(?:href|src|action)\s*=\s*["']?\s*(?:https?:)?//([^/?#"'\s>]+)"""
CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    url = F.coalesce(url.cast("string"), F.lit(""))
    host = F.translate(F.regexp_extract(url, URL, 1), CAPITALS, SMALL)
    return host, F.regexp_extract(url, URL, 2)


def rule_of(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """The longest fitting rule and its verdict, or nulls."""
    rule = verdict = F.lit(None).cast("string")
    for kind, h, p in sorted(rules, key=lambda r: (len(r[1] + r[2]), r)):
        fits = ((host == h) | F.endswith(host, F.lit("." + h))) & F.startswith(path, F.lit(p))
        rule, verdict = F.when(fits, F.lit(h + p)).otherwise(rule), F.when(fits, F.lit(kind)).otherwise(verdict)
    return rule, verdict


def host_edges(pages: DataFrame) -> DataFrame:
    """``src, dst, w``: links between different hosts, summed."""
    links = pages.select("host", F.explode(F.regexp_extract_all(F.coalesce(F.col("html").cast("string"), F.lit("")), F.lit(LINK), F.lit(1))).alias("dst"))
    links = links.select(F.col("host").alias("src"), F.translate("dst", CAPITALS, SMALL).alias("dst")).where("src <> '' and src <> dst")
    links = links.groupBy("src", "dst").agg(F.count("*").cast("double").alias("w"))
    hosts = pages.select("host").where("host <> ''").distinct()
    up = hosts.select(F.col("host").alias("src"), F.regexp_replace("host", r"^[^.]*\.", "").alias("dst")).where("src <> dst")
    up = up.join(hosts.select(F.col("host").alias("dst")), "dst", "left_semi").select("src", "dst", F.lit(1.0).alias("w"))
    return links.union(up).union(up.select("dst", "src", "w")).groupBy("src", "dst").agg(F.sum("w").alias("w"))


def propagate(edges: DataFrame, seeds: DataFrame, damping: float = 0.85, enough: float = 1e-7) -> DataFrame:
    """Personalised PageRank ``kind, host, rank`` along ``edges(kind, src,
    dst, share)`` from ``seeds(kind, host, seed)``, whose seeds sum to 1 for
    each kind. Mass without a way on returns to the seeds.

    Since all that does not flow on starts at the seeds again, the ranks are in
    proportion to what one start brings in all its steps, ``seed + d P seed +
    (d P)^2 seed + ..``. A round adds one step, one join; it goes on until what
    is still to come, at most the last step times d / (1 - d), is below
    ``enough`` (some 100 rounds at most, fewer where links end)."""
    step = cut(seeds.select("kind", "host", F.col("seed").alias("rank")))
    steps = [step]
    while True:
        flow = step.join(edges, (step["host"] == edges["src"]) & (step["kind"] == edges["kind"]))
        flow = flow.select(step["kind"], F.col("dst").alias("host"), (F.col("rank") * F.col("share") * damping).alias("rank"))
        left = Observation()
        step = cut(flow.groupBy("kind", "host").agg(F.sum("rank").alias("rank")).observe(left, F.sum("rank").alias("mass")))
        steps.append(step)
        ended = (left.get.get("mass") or 0.0) * damping / (1 - damping) < enough
        if ended or len(steps) > 16:
            steps = [cut(reduce(DataFrame.unionByName, steps).groupBy("kind", "host").agg(F.sum("rank").alias("rank")))]
        if ended:
            break
    total = steps[0].groupBy("kind").agg(F.sum("rank").alias("total"))  # a row for each kind
    return steps[0].join(F.broadcast(total), "kind").select("kind", "host", (F.col("rank") / F.col("total")).alias("rank"))


def judge(pages: DataFrame, rules: list[tuple[str, str, str]] | None = None, ratio: float = 1.0) -> DataFrame:
    """``page_id, host, path, rule, verdict, trust, distrust`` for each row of
    ``pages(page_id, url, html)``. Trust and distrust are ranks of the host."""
    rules = RULES if rules is None else rules
    host, path = host_and_path(F.col("url"))
    src = pages.select("page_id", host.alias("host"), path.alias("path"), "html")
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    ruled = src.select("page_id", "host", "path", rule.alias("rule"), verdict.alias("verdict"))

    share = ruled.where("host <> ''").groupBy("host").agg(
        F.avg((F.col("verdict") == "allow").cast("double")).alias("t"), F.avg((F.col("verdict") == "block").cast("double")).alias("d"),
        F.count("verdict").alias("n"))
    pair = F.explode(F.array(F.struct(F.lit("trust").alias("kind"), F.col("t").alias("v")), F.struct(F.lit("distrust").alias("kind"), F.col("d").alias("v"))))
    seeds = share.where("n > 0").select("host", (F.col("n").cast("double")).alias("n"), pair.alias("p")).where("p.v > 0.5")
    seeds = cut(seeds.select(F.col("p.kind").alias("kind"), "host", F.col("n").alias("w")))
    total = seeds.groupBy("kind").agg(F.sum("w").alias("total"))  # two rows
    seeds = cut(seeds.join(F.broadcast(total), "kind").select("kind", "host", (F.col("w") / F.col("total")).alias("seed")))

    links = cut(host_edges(src.select("host", "html")))
    both = links.select(F.lit("trust").alias("kind"), "src", "dst", "w").union(links.select(F.lit("distrust"), "dst", "src", "w"))
    out = both.groupBy("kind", "src").agg(F.sum("w").alias("out"))
    edges = cut(both.join(out, ["kind", "src"]).select("kind", "src", "dst", (F.col("w") / F.col("out")).alias("share")))
    rank = propagate(edges, seeds)
    by_host = cut(rank.groupBy("host").agg(F.sum(F.when(F.col("kind") == "trust", F.col("rank"))).alias("trust"),
                                           F.sum(F.when(F.col("kind") == "distrust", F.col("rank"))).alias("distrust")))
    out = ruled.join(by_host, "host", "left").withColumns({k: F.coalesce(k, F.lit(0.0)) for k in ("trust", "distrust")})
    method = F.when((F.col("distrust") > 0) & (F.col("distrust") >= ratio * F.col("trust")), F.lit("block")).otherwise(F.lit("allow"))
    return out.select("page_id", "host", "path", "rule", F.coalesce("verdict", method).alias("verdict"), "trust", "distrust")
