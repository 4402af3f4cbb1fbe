"""URL verdicts: rules of host and path, and for the rest trust and distrust spread over the links between hosts.

Pages that a rule allows are seeds of trust, pages that a rule blocks are seeds of
distrust. Trust flows along links (personalised PageRank from the trusted hosts),
distrust against them (the same from the blocked hosts over reversed links: who
links to blocked hosts is suspect). A host whose share of distrust in both
exceeds ``threshold`` percent is blocked for all its pages without a rule.

PageRank is computed as the sum of what walks of 0, 1, 2, ... ``rounds`` links
carry from the seeds, each link weakening it to ``damping`` percent; the constant
factor 1 - damping is left out on both sides. Masses are whole numbers, one
seeding page being ``UNIT``, and shares are rounded down, so results do not depend
on the order of sums; a round that carries nothing on ends the work early.

Links are the ``href`` of ``a`` tags with a host of their own (``//host`` or
``scheme://host``), outside comments, scripts and styles; a tag is read up to the
first ``<`` or ``>``. A host counts once a page; links of a host to itself carry
nothing.

Defined results: a null url or one without ``://`` has empty host and path, fits
no rule and is allowed, as is every host that neither kind of mass reaches; a null
or empty html has no links; repeated rows count each, a null page_id is returned
as it is; a url without a path fits no rule, since every rule's path begins with
``/``; ports and user names belong to the host; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from florametrics.llm.common import lowered, saved

UNIT = 1_000_000
HOST = r"(?s)^.*?://([^/?#]*)"
PATH = r"(?s)^.*?://[^/?#]*([^?#]*)"
#: Unclosed comments, scripts and styles reach to the end.
HIDDEN = r"(?is)<!--.*?(?:-->|\z)|<script\b.*?(?:</script|\z)|<style\b.*?(?:</style|\z)"
LINK = r"""(?i)<a\s(?:[^<>]*?\s)?href\s*=\s*["']?\s*(?:[a-z][a-z0-9+.-]*:)?//([^/?#\s"'<>]+)"""


def host_of(url: Column) -> Column:
    return lowered(F.coalesce(F.regexp_extract(url, HOST, 1), F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, PATH, 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: list[tuple[str, str]]) -> Column:
    """Struct (rule, action) of the longest of (action, rule) that fits, else null; of equal rules the blocking one.

    A rule ``host/path`` fits its host and all subdomains where the path starts with its own.
    Rules are a list in the plan: every url is held against each.
    """
    cases = []
    for action, rule in sorted(rules, key=lambda r: (-len(r[1]), r[1], r[0] != "block")):
        of, slash, rest = rule.partition("/")
        of = of.lower()
        fits = ((host == of) | F.endswith(host, F.lit("." + of))) & F.startswith(path, F.lit("/" + rest if slash else ""))
        cases.append(F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(action).alias("action"))))
    empty = F.lit(None).cast("struct<rule:string,action:string>")
    return F.coalesce(*cases, empty)


def host_links(pages: DataFrame) -> DataFrame:
    """(source, target, weight): how many pages of a host link to another."""
    found = F.array_distinct(F.transform(F.regexp_extract_all(F.regexp_replace("html", HIDDEN, " "), F.lit(LINK), 1), lowered))
    links = pages.where(F.col("html").contains("//")).select(host_of(F.col("url")).alias("source"), F.explode(found).alias("target"))
    return links.where((F.col("source") != "") & (F.col("source") != F.col("target"))).groupBy("source", "target").agg(
        F.count("*").alias("weight"))


def spread(seeds: DataFrame, links: DataFrame, rounds: int = 20, damping: int = 85) -> DataFrame:
    """(side, host, mass): ``seeds`` (same columns) and all that walks carry on from them, side 0 along links, side 1 against them.

    Arcs are written once; a round joins the last round's masses with them and adds
    up per host, combining before the shuffle. A host with very many links is split by
    the adaptive skew join.
    """
    links = saved(links, "links")
    arcs = links.select(F.lit(0).alias("side"), F.col("source").alias("host"), F.col("target").alias("to"), "weight").unionAll(
        links.select(F.lit(1), "target", "source", "weight"))
    whole = arcs.groupBy("side", "host").agg(F.sum("weight").alias("whole"))
    arcs = saved(arcs.join(whole, ["side", "host"]), "arcs")
    part = F.expr(f"(CAST(mass AS DECIMAL(19, 0)) * CAST(weight * {damping} AS DECIMAL(19, 0))) div CAST(whole * 100 AS DECIMAL(19, 0))")
    front = saved(seeds, "front")
    every = front
    for _ in range(rounds):
        front = saved(
            front.join(arcs, ["side", "host"]).select("side", F.col("to").alias("host"), part.alias("mass"))
            .groupBy("side", "host").agg(F.sum("mass").alias("mass")).where(F.col("mass") > 0), "front")
        if front.isEmpty():
            break
        every = every.unionAll(front)
    return every.groupBy("side", "host").agg(F.sum("mass").alias("mass"))


def verdicts(
    pages: DataFrame, rules: list[tuple[str, str]], rounds: int = 20, damping: int = 85, threshold: int = 50,
) -> DataFrame:
    """(page_id, host, path, rule, verdict, trust, distrust) per row of ``pages`` (page_id, url, html); ``rules``: (action, host/path)."""
    judged = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path")).withColumn(
        "by", rule_of(F.col("host"), F.col("path"), rules))
    counts = judged.where(F.col("by").isNotNull()).groupBy((F.col("by.action") == "block").cast("int").alias("side"), "host").agg(
        (F.count("*") * UNIT).alias("mass"))
    hosts = spread(counts, host_links(pages.select("url", "html")), rounds, damping).groupBy("host").agg(
        *[F.coalesce(F.sum(F.when(F.col("side") == side, F.col("mass"))), F.lit(0)).alias(name) for side, name in ((0, "trust"), (1, "distrust"))])
    big = F.col("distrust").cast("decimal(20,0)")
    hosts = hosts.select("host", "trust", "distrust", (big * 100 > (big + F.col("trust")) * threshold).alias("bad"))
    return judged.join(saved(hosts, "hosts"), "host", "left").select(
        "page_id", "host", "path", "by.rule",
        F.coalesce("by.action", F.when(F.col("bad"), "block"), F.lit("allow")).alias("verdict"),
        F.coalesce("trust", F.lit(0)).alias("trust"), F.coalesce("distrust", F.lit(0)).alias("distrust"))
