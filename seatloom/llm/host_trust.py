"""Verdicts on urls: rules first, then trust and distrust spread over the link graph of hosts (operator 12).

1. A url's host and path are cut out; of the rules that fit them the longest decides. Rules are literals of the plan.
2. Hosts are nodes. A host points to the hosts that its pages' anchors name (weight: its pages that do), and, as one site's
   hosts answer for each other, to the host that its own name without its first label gives, and back, if both are known
   (weight 1). Links are counted by pair of hosts before they are shuffled further, so no host's number of pages matters.
3. Personalised PageRank: trust starts at hosts with allowed pages and follows links; distrust starts at hosts with blocked
   pages and goes against them, from a page to those who point to it. Both start in proportion to the judged pages. A step
   keeps the start's part (1 - DAMPING) and hands on the rest by weight; what a host without links has is lost. STEPS steps
   are made, so walks of up to STEPS links count.
4. A url without a rule is blocked if its host's distrust is more than its trust, else allowed.

Amounts are whole numbers, SCALE in all, and every share is rounded down: sums come out the same in whatever order
machines add them, and in SQL.

Defined cases: a null url, or one without "://", has an empty host and path, fits no rule, is no node and is allowed. Ties go
to allow. Without judged pages all trust is 0. Repeated rows count each. Null html has no links. Relative links stay on
their host and are no edges. An empty table gives no rows. Extra columns are not read, whatever their names.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seatloom.llm.common import cut, fields, small_side


class Rule(NamedTuple):
    verdict: str
    host: str
    path: str


# The rules.
RULES = (Rule("allow", "com", "/"), Rule("block", "example.com", "/en/"), Rule("allow", "www.example.com", "/en/"), Rule("block", "net", "/es/"), Rule("block", "net", "/fr/"))
SCALE, DAMPING, STEPS = 10**12, 85, 16
#: After so many steps what was reached is written, so that a lost machine costs no more than these.
WRITTEN = 4
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: The host of an anchor's absolute link.
ANCHOR = r"""(?is)<a\b[^>]*?\bhref[\x20\x09-\x0D]*=[\x20\x09-\x0D]*["']?(?:[a-z][a-z0-9+.-]*:)?//([^/?#"'>\x20\x09-\x0D]*)"""


def with_host(pages: DataFrame) -> DataFrame:
    """pages (page_id, url, html) with host and path."""
    rest = F.coalesce(F.get(F.split(F.col("url").cast("string"), "://", 2), F.lit(1)), F.lit(""))
    rows = fields(pages, "page_id", "url", "html").withColumn("rest", rest)
    rows = rows.withColumn("host", F.regexp_extract("rest", "^([^/?#]*)", 1))
    path = F.regexp_extract(F.substring(F.col("rest"), F.length("host") + 1, F.length("rest")), "^([^?#]*)", 1)
    return rows.select("page_id", F.translate("host", UPPER, LOWER).alias("host"), path.alias("path"), "html")


def fitting(rules: tuple[Rule, ...]) -> Column:
    """(verdict, rule) of the longest rule that fits host and path; null if none does."""
    longest_first = sorted(set(rules), key=lambda r: (-len(r.host + r.path), -len(r.host), r))
    host, found = F.col("host"), F.lit(None).cast("struct<verdict:string,rule:string>")
    for r in reversed(longest_first):
        fits = ((host == r.host) | host.endswith("." + r.host)) & F.col("path").startswith(r.path)
        found = F.when(fits, F.struct(F.lit(r.verdict).alias("verdict"), F.lit(r.host + r.path).alias("rule"))).otherwise(found)
    return found


def host_links(pages: DataFrame) -> DataFrame:
    """(src, dst, weight) from pages (host, html): anchors by pair of hosts, and hosts of one site."""
    targets = F.transform(F.regexp_extract_all("html", F.lit(ANCHOR), F.lit(1)), lambda h: F.translate(h, UPPER, LOWER))
    targets = F.array_distinct(F.filter(targets, lambda h: (h != "") & (h != F.col("host"))))
    anchors = pages.where("host <> ''").select(F.col("host").alias("src"), F.explode(targets).alias("dst"))
    anchors = cut(anchors.groupBy("src", "dst").agg(F.count("*").alias("weight")))
    hosts = pages.select("host").union(anchors.select("dst")).where("host <> ''").distinct()
    # the name without its first label, of hosts that have one
    inside = hosts.where(F.instr("host", ".") > 0).select("host", F.expr("substring(host, instr(host, '.') + 1)").alias("site"))
    site = inside.join(hosts.withColumnRenamed("host", "known"), F.col("site") == F.col("known")).select(F.col("host").alias("src"), F.col("site").alias("dst"))
    site = site.union(site.select("dst", "src")).withColumn("weight", F.lit(1).cast("long"))
    return anchors.union(site).groupBy("src", "dst").agg(F.sum("weight").alias("weight"))


def spread(seeds: DataFrame, links: DataFrame, steps: int = STEPS) -> DataFrame:
    """(host, trust, distrust) from seeds (host, allowed, blocked: pages) over links; hosts that nothing reaches are missing."""
    total = seeds.agg(F.sum(F.col("allowed") + F.col("blocked"))).first()[0]
    if not total:
        return seeds.sparkSession.createDataFrame([], "host string, trust long, distrust long")
    kinds = F.explode(F.array(F.struct(F.lit(0).alias("kind"), F.col("allowed").alias("pages")), F.struct(F.lit(1).alias("kind"), F.col("blocked").alias("pages"))))
    start = seeds.select("host", kinds.alias("s")).select("host", "s.kind", F.col("s.pages").alias("pages")).where("pages > 0")
    start = cut(start.select("kind", "host", F.expr(f"CAST(pages AS DECIMAL(18,0)) * CAST({SCALE} AS DECIMAL(18,0)) DIV CAST({total} AS DECIMAL(18,0))").alias("amount")))
    both = links.select(F.lit(0).alias("kind"), "src", "dst", "weight").union(links.select(F.lit(1), "dst", "src", "weight"))
    out = both.groupBy("kind", "src").agg(F.sum("weight").alias("all"))
    both = cut(both.join(out, ["kind", "src"]).withColumnRenamed("src", "host"))
    back = start.select("kind", "host", F.expr(f"amount * {100 - DAMPING} DIV 100").alias("amount"))
    now = start
    for k in range(steps):
        share = F.expr(f"CAST(amount AS DECIMAL(18,0)) * CAST(weight * {DAMPING} AS DECIMAL(18,0)) DIV CAST(all * 100 AS DECIMAL(18,0))")
        moved = now.join(both, ["kind", "host"]).select("kind", F.col("dst").alias("host"), share.alias("amount"))
        now = moved.union(back).groupBy("kind", "host").agg(F.sum("amount").alias("amount"))
        if k % WRITTEN == WRITTEN - 1:
            now = cut(now)
    of = lambda kind: F.sum(F.when(F.col("kind") == kind, F.col("amount")).otherwise(0))
    return now.groupBy("host").agg(of(0).alias("trust"), of(1).alias("distrust"))


def judge(pages: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """page_id, host, path, rule (host and path of the longest that fits, else null), verdict (allow or block), and the host's
    trust and distrust. A row for each page."""
    rows = with_host(pages)
    judged = rows.withColumn("r", fitting(rules))
    seeds = cut(judged.where("r is not null").groupBy("host").agg(F.count_if(F.col("r.verdict") == "allow").alias("allowed"), F.count_if(F.col("r.verdict") == "block").alias("blocked")))
    known = cut(spread(seeds, host_links(rows.select("host", "html")))).select(F.col("host").alias("_host"), "trust", "distrust")
    out = judged.join(small_side(known), F.col("host") == F.col("_host"), "left")
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    own = F.when(F.col("distrust") > F.col("trust"), "block").otherwise("allow")
    return out.select("page_id", "host", "path", F.col("r.rule").alias("rule"), F.coalesce("r.verdict", own).alias("verdict"), zero("trust"), zero("distrust"))
