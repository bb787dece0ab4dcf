"""URL filters: host and path rules, and trust passed along links for what no rule covers.

Trust starts at hosts with pages that rules allow, each by its share of such pages, and follows links; distrust
starts at hosts with blocked pages, by their share, and follows links backwards, from a page to those that point
to it. Both are personalised PageRanks over distinct host edges. A page without a rule is blocked if its host's distrust
exceeds its trust.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, stored

#: (rule, verdict); host up to the first slash, then the beginning of the path.
RULES = (("com/en/", "block"), ("example.com/en/7", "allow"), ("net/de/", "allow"), ("example.net/de/8", "block"), ("org/es/", "block"))
DAMPING, CLOSE = 0.85, 1e-6


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for a null url or one without `://`."""
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), r"^[^?#]*", 0)
    return ascii_lower(host), path


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest fitting rule and its verdict, null if none fits."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for text, said in sorted(rules, key=lambda r: (len(r[0]), r[0])):
        of, _, begin = text.partition("/")
        fits = ((host == of) | host.endswith("." + of)) & path.startswith("/" + begin)
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(said)).otherwise(verdict)
    return rule, verdict


def host_edges(pages: DataFrame) -> DataFrame:
    """Distinct links (src, dst) between different hosts from pages(host, html)."""
    links = pages.select(F.col("host").alias("src"), F.explode(F.regexp_extract_all("html", F.lit(r"""(?i)href\s*=\s*["']?((?:[a-z][a-z0-9+.-]*:)?//[^"'\s>]*)"""), F.lit(1))).alias("link"))
    full = F.when(F.col("link").startswith("//"), F.concat(F.lit("http:"), F.col("link"))).otherwise(F.col("link"))
    return links.select("src", host_and_path(full)[0].alias("dst")).where("src <> '' and dst <> '' and src <> dst").distinct()


def spread(edges: DataFrame, seeds: DataFrame, close: float = CLOSE) -> DataFrame:
    """(host, rank): PageRank with restarts at seeds(host, weight), along edges(src, dst); what dead ends hold restarts.

    Restarts are in proportion to the weights, which are positive; seeds without that column count alike.

    Ends when ranks move by less than `close` in all, which is a bound of close * DAMPING / (1 - DAMPING) on what is left; each round
    shrinks the movement by DAMPING at least, so log(close / 2) / log(DAMPING) rounds are the most. Ranks of no mass are left out.
    """
    weight = F.col("weight") if "weight" in seeds.columns else F.lit(1.0)
    total = seeds.agg(F.sum(weight)).first()[0] or 0.0
    start = seeds.select("host", (weight / F.lit(total or 1.0)).alias("share"))
    out = stored(edges.join(edges.groupBy("src").agg(F.count("*").alias("degree")), "src"), "edges")
    rank = stored(start.select("host", F.col("share").alias("rank")), "rank")
    change = 2.0 if total else 0.0
    while change >= close:
        moved = rank.join(out, rank.host == out.src).groupBy("dst").agg(F.sum(DAMPING * F.col("rank") / F.col("degree")).alias("got"))
        passed = moved.agg(F.sum("got")).first()[0] or 0.0
        new = start.select("host", (F.col("share") * (1.0 - passed)).alias("x")).union(moved.select("dst", "got")).groupBy("host").agg(F.sum("x").alias("rank"))
        new = stored(new, "rank")
        change = new.alias("n").join(rank.alias("o"), "host", "full").agg(F.sum(F.abs(F.coalesce("n.rank", F.lit(0.0)) - F.coalesce("o.rank", F.lit(0.0))))).first()[0] or 0.0
        rank = new
    return rank


def judged(pages: DataFrame, rules=RULES) -> DataFrame:
    """page_id, host, path, rule, verdict for each row of pages(page_id, url, html).

    Host: after the first `://` up to `/`, `?`, `#` or the end, A-Z lower-cased; path: then up to `?`, `#` or the
    end. A rule fits its host and all subdomains if the path starts with the rule's; the longest wins. Pages
    without a host and without a rule are allowed; texts and html of any length are read whole. Repeated rows and null ids are judged like any; null html has no links.
    """
    host, path = host_and_path(F.col("url"))
    rows = pages.select("page_id", "html", host.alias("host"), path.alias("path"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    edges = stored(host_edges(rows.select("host", "html")), "links")
    rows = rows.select("page_id", "host", "path", rule.alias("rule"), verdict.alias("said"))
    hosts = rows.where("host <> ''").groupBy("host").agg(F.count("*").alias("n"), F.count_if(F.col("said") == "allow").alias("allowed"), F.count_if(F.col("said") == "block").alias("blocked"))
    hosts = stored(hosts, "hosts")
    trust = spread(edges, hosts.where("allowed > 0").select("host", (F.col("allowed") / F.col("n")).alias("weight")))
    distrust = spread(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst")), hosts.where("blocked > 0").select("host", (F.col("blocked") / F.col("n")).alias("weight")))
    scores = trust.withColumnRenamed("rank", "trust").join(distrust.withColumnRenamed("rank", "distrust"), "host", "full").select("host", F.coalesce("trust", F.lit(0.0)).alias("trust"), F.coalesce("distrust", F.lit(0.0)).alias("distrust"))
    worse = scores.where("distrust > trust").select(F.col("host").alias("bad"))
    out = rows.join(worse, rows.host == worse.bad, "left")
    return out.select("page_id", "host", "path", "rule", F.coalesce("said", F.when(F.col("bad").isNotNull(), "block").otherwise("allow")).alias("verdict"))


def op2_url_filter(spark, sf_dir):
    """The verdict on every page.

    In the test tables all links are relative, so no link joins two hosts and a host's rank is its own share of allowed or
    blocked pages; linked tables are tested against brute force.
    """
    return judged(spark.read.parquet(f"{sf_dir}/pages.parquet"))
