"""Order-dependent operators, top rows and sorts."""

from __future__ import annotations

from pyspark.sql import functions as F

from florametrics.operators import ordered as O
from florametrics.operators import ranking as K
from florametrics_queries.bindings import COUNTS, HITS, TAX, counts, hits, table, tax
from florametrics_queries.registry import query, unit_sql

_GAPS = "e AS (SELECT event_id, ts, user_id, CASE WHEN event_id % 7 = 0 THEN value END AS v, CASE WHEN event_id % 11 = 3 THEN event_type END AS t FROM events)"


def _gaps(spark, sf):
    return table(spark, sf, "events").select(
        "event_id", "ts", "user_id", F.when(F.col("event_id") % 7 == 0, F.col("value")).alias("v"),
        F.when(F.col("event_id") % 11 == 3, F.col("event_type")).alias("t"))


@query("fill_down_group", f"""
WITH {_GAPS} SELECT event_id, last_value(v IGNORE NULLS) OVER w AS v, last_value(t IGNORE NULLS) OVER w AS t FROM e
WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)""")
def _(spark, sf):
    return O.fill_down(_gaps(spark, sf), ["v", "t"], ["ts", "event_id"], by=["user_id"]).select("event_id", "v", "t")


@query("fill_down_global", f"""
WITH {_GAPS} SELECT event_id, last_value(v IGNORE NULLS) OVER w AS v, last_value(t IGNORE NULLS) OVER w AS t FROM e
WINDOW w AS (ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)""")
def _(spark, sf):
    return O.fill_down(_gaps(spark, sf), ["v", "t"], ["ts", "event_id"]).select("event_id", "v", "t")


@query("stack_positions", f"""
WITH {COUNTS}, {TAX}, s AS (SELECT sample, Phylum, CAST(sum(numseqs) AS DOUBLE) AS n FROM counts JOIN tax USING (taxon) GROUP BY 1, 2),
c AS (SELECT *, sum(n) OVER (PARTITION BY sample ORDER BY Phylum ROWS UNBOUNDED PRECEDING) AS cum FROM s)
SELECT sample, Phylum, n, cum AS cum_pct, cum - n / 2 AS y_text FROM c""")
def _(spark, sf):
    s = counts(spark, sf).join(tax(spark, sf), "taxon").groupBy("sample", "Phylum").agg(F.sum("numseqs").cast("double").alias("n"))
    return O.stack_positions(s, ["sample"], ["Phylum"], "n")


@query("order_levels", f"""
WITH {TAX} SELECT Phylum, Genus, row_number() OVER (ORDER BY Phylum NULLS LAST, Genus NULLS LAST) AS level
FROM (SELECT DISTINCT Phylum, Genus FROM tax)""")
def _(spark, sf):
    return O.order_levels(tax(spark, sf), ["Phylum", "Genus"])


@query("member_index_cycled", """
SELECT p_partkey, p_brand, (row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) - 1) % 3 + 1 AS shade FROM part""")
def _(spark, sf):
    return O.member_index(table(spark, sf, "part").select("p_partkey", "p_brand"), ["p_brand"], ["p_partkey"], "shade", cycle=3)


@query("relative_to_longest", """
WITH m AS (SELECT l_orderkey, arg_max(l_quantity, l_extendedprice) AS ref FROM lineitem GROUP BY l_orderkey)
SELECT l.l_orderkey, l_partkey, l_extendedprice, l_quantity / ref AS depth FROM lineitem l JOIN m USING (l_orderkey)""")
def _(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_extendedprice", "l_quantity")
    out = O.relative_to_max(li, ["l_orderkey"], of="l_quantity", by="l_extendedprice", out="depth")
    return out.drop("l_quantity")


@query("top1_with_ties", """
SELECT l_orderkey, l_partkey, l_quantity FROM (SELECT *, rank() OVER (PARTITION BY l_orderkey ORDER BY l_quantity DESC) AS r FROM lineitem) WHERE r = 1""")
def _(spark, sf):
    return K.top_n(table(spark, sf, "lineitem"), ["l_orderkey"], "l_quantity", 1).select("l_orderkey", "l_partkey", "l_quantity")


@query("top5_with_ties", """
SELECT l_suppkey, l_orderkey, l_partkey, l_quantity FROM
 (SELECT *, rank() OVER (PARTITION BY l_suppkey ORDER BY l_quantity DESC) AS r FROM lineitem) WHERE r <= 5""")
def _(spark, sf):
    return K.top_n(table(spark, sf, "lineitem"), ["l_suppkey"], "l_quantity", 5).select(
        "l_suppkey", "l_orderkey", "l_partkey", "l_quantity")


_NULLED = "h AS (SELECT qseqid, sseqid, bitscore, CASE WHEN slen % 5 <> 0 THEN pident END AS pident, evalue FROM hits)"


@query("cascade_top1", f"""
WITH {HITS}, {_NULLED}, r AS (SELECT *, rank() OVER (PARTITION BY qseqid ORDER BY bitscore DESC NULLS LAST, pident DESC NULLS LAST, evalue NULLS LAST) AS k FROM h)
SELECT qseqid, sseqid, bitscore, pident, evalue FROM r WHERE k = 1 AND pident IS NOT NULL AND bitscore IS NOT NULL AND evalue IS NOT NULL""")
def _(spark, sf):
    h = hits(spark, sf).withColumn("pident", F.when(F.col("slen") % 5 != 0, F.col("pident")))
    top = K.cascade_top(h, ["qseqid"], [("bitscore", "desc"), ("pident", "desc"), ("evalue", "asc")])
    return top.select("qseqid", "sseqid", "bitscore", "pident", "evalue")


@query("weighted_pick", f"""
WITH d AS (SELECT l_orderkey, l_partkey, l_quantity, count(*) AS copies FROM lineitem GROUP BY ALL)
SELECT l_orderkey, l_partkey, l_quantity FROM d WHERE l_quantity > 0
QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY ln({unit_sql(7, "l_orderkey", "l_partkey", "l_quantity")}) / (l_quantity * copies) DESC) = 1""")
def _(spark, sf):
    """A random pick that the seed and the rows fix."""
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    return K.weighted_pick(li, ["l_orderkey"], "l_quantity", seed=7)


@query("heaviest_pick", """
SELECT l_orderkey, l_partkey, l_quantity FROM (SELECT l_orderkey, l_partkey, l_quantity,
  row_number() OVER (PARTITION BY l_orderkey ORDER BY l_quantity DESC, l_partkey) AS r FROM lineitem) WHERE r = 1""")
def _(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    return K.weighted_pick(li, ["l_orderkey"], "l_quantity", mode="deterministic", name="l_partkey")


@query("first_three_padded", """
WITH r AS (SELECT l_orderkey, 'P' || l_partkey AS p, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS r FROM lineitem)
SELECT l_orderkey, coalesce(max(p) FILTER (WHERE r = 1), 'NA') AS hit1, coalesce(max(p) FILTER (WHERE r = 2), 'NA') AS hit2,
  coalesce(max(p) FILTER (WHERE r = 3), 'NA') AS hit3 FROM r GROUP BY l_orderkey""")
def _(spark, sf):
    li = table(spark, sf, "lineitem").withColumn("p", F.concat(F.lit("P"), "l_partkey"))
    return K.first_n_padded(li, ["l_orderkey"], ["l_linenumber", "l_partkey", "l_suppkey"], "p", 3)


@query("sort_missing_last", f"""
WITH {TAX} SELECT taxon, Genus, Species FROM tax ORDER BY Genus DESC NULLS LAST, Species NULLS LAST, taxon""")
def _(spark, sf):
    out = K.sort_na_last(tax(spark, sf), [("Genus", "desc"), ("Species", "asc"), ("taxon", "asc")])
    return out.select("taxon", "Genus", "Species")


@query("latest_input", f"""
WITH {HITS} SELECT qseqid, sseqid FROM hits WHERE filename = (SELECT max(filename) FROM hits)""")
def _(spark, sf):
    return K.latest_input(hits(spark, sf)).select("qseqid", "sseqid")


@query("labels_by_mean", """
WITH m AS (SELECT l_suppkey, avg(l_quantity) AS mean FROM lineitem GROUP BY l_suppkey)
SELECT l_suppkey, mean, row_number() OVER (ORDER BY mean, l_suppkey) AS position FROM m""")
def _(spark, sf):
    return K.order_by_mean(table(spark, sf, "lineitem"), "l_suppkey", "l_quantity")
