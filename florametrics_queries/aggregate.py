"""Group aggregates."""

from __future__ import annotations

from pyspark.sql import functions as F

from florametrics.operators import aggregates as A
from florametrics_queries.bindings import (
    COUNTS, SAMPLES, STAGES, counts, rounded, samples, stages, table,
)
from florametrics_queries.registry import query


@query("count_by_group", "SELECT l_suppkey, l_returnflag, count(*) AS n FROM lineitem GROUP BY ALL")
def _(spark, sf):
    return A.count_by(table(spark, sf, "lineitem"), ["l_suppkey", "l_returnflag"])


@query("weighted_count", "SELECT l_partkey, sum(l_quantity) AS mapped FROM lineitem GROUP BY l_partkey")
def _(spark, sf):
    return A.count_by(table(spark, sf, "lineitem"), ["l_partkey"], "mapped", wt="l_quantity")


@query("sum_by_group", "SELECT l_suppkey, round(sum(l_extendedprice), 2) AS total FROM lineitem GROUP BY l_suppkey")
def _(spark, sf):
    return rounded(A.sum_by(table(spark, sf, "lineitem"), ["l_suppkey"], "l_extendedprice", "total"), 2)


@query("run_totals", f"""
WITH {SAMPLES}, t AS (SELECT CAST(sum(reads_in) AS BIGINT) AS total_reads, CAST(sum(reads_out) AS BIGINT) AS kept_reads,
  count(DISTINCT sample) AS n_samples FROM samples)
SELECT *, round(CAST(kept_reads AS DOUBLE) / total_reads * 100, 2) AS kept_pct FROM t""")
def _(spark, sf):
    return A.run_totals(samples(spark, sf), "reads_in", "reads_out", "sample")


@query("describe_lengths", """
SELECT o_custkey, CASE WHEN count(v) = count(*) THEN avg(v) END AS mean, CASE WHEN count(v) = count(*) THEN max(v) END AS max,
  count(*) AS n, CASE WHEN count(v) = count(*) THEN CAST(sum(v) AS BIGINT) END AS total,
  CASE WHEN count(v) = count(*) THEN median(v) END AS median
FROM (SELECT o_custkey, CASE WHEN o_orderpriority <> '1-URGENT' OR o_custkey % 3 = 0 THEN CAST(floor(o_totalprice) AS BIGINT) END AS v FROM orders)
GROUP BY o_custkey""")
def _(spark, sf):
    # Two thirds of the groups may hold missing values; their statistics are missing.
    o = table(spark, sf, "orders").withColumn("v", F.when(
        (F.col("o_orderpriority") != "1-URGENT") | (F.col("o_custkey") % 3 == 0), F.floor("o_totalprice").cast("long")))
    return A.describe_by(o, ["o_custkey"], "v")


@query("nx_lengths", """
WITH o AS (SELECT o_custkey, CAST(floor(o_totalprice) AS BIGINT) AS len FROM orders),
c AS (SELECT *, sum(len) OVER (PARTITION BY o_custkey ORDER BY len DESC ROWS UNBOUNDED PRECEDING) AS cum,
             sum(len) OVER (PARTITION BY o_custkey) AS total FROM o)
SELECT o_custkey, max(len) FILTER (WHERE cum >= total * 0.5) AS n50 FROM c GROUP BY o_custkey""")
def _(spark, sf):
    o = table(spark, sf, "orders").withColumn("len", F.floor("o_totalprice").cast("long"))
    return A.nx_by(o, ["o_custkey"], "len")


@query("n90_by_sample", """
WITH c AS (SELECT l_suppkey, l_quantity AS len,
  sum(l_quantity) OVER (PARTITION BY l_suppkey ORDER BY l_quantity DESC ROWS UNBOUNDED PRECEDING) AS cum,
  sum(l_quantity) OVER (PARTITION BY l_suppkey) AS total FROM lineitem)
SELECT l_suppkey, max(len) FILTER (WHERE cum >= total * CAST(0.9 AS DOUBLE)) AS n90 FROM c GROUP BY l_suppkey""")
def _(spark, sf):
    return A.nx_by(table(spark, sf, "lineitem"), ["l_suppkey"], "l_quantity", 0.9, "n90")


@query("distinct_rows", "SELECT DISTINCT p_type, p_brand FROM part")
def _(spark, sf):
    return A.distinct_rows(table(spark, sf, "part").select("p_type", "p_brand"))


@query("dedup_first", """
SELECT user_id, event_type, event_id, value FROM
 (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS r FROM events) WHERE r = 1""")
def _(spark, sf):
    first = A.first_by(table(spark, sf, "events"), ["user_id", "event_type"], ["ts", "event_id"])
    return first.select("user_id", "event_type", "event_id", "value")


@query("collapse_in_order", """
SELECT conv_id, string_agg(role || ':' || length(text), ';' ORDER BY turn) AS turns FROM conversations GROUP BY conv_id""")
def _(spark, sf):
    c = table(spark, sf, "conversations").withColumn("v", F.concat_ws(":", "role", F.length("text")))
    return A.collapse_by(c, ["conv_id"], "v", ["turn"], ";", out="turns")


@query("single_value_check", """
SELECT l_suppkey, min(l_linestatus) AS l_linestatus, min(l_suppkey % 7) AS grp, count(DISTINCT l_linestatus) > 1 AS ambiguous
FROM lineitem GROUP BY l_suppkey""")
def _(spark, sf):
    li = table(spark, sf, "lineitem").withColumn("grp", F.col("l_suppkey") % 7)
    return A.single_by(li, ["l_suppkey"], ["l_linestatus", "grp"])


@query("count_true_with_missing", """
SELECT o_custkey, CASE WHEN count(v) = count(*) THEN count(*) FILTER (WHERE v = 'F') END AS n_true
FROM (SELECT o_custkey, CASE WHEN o_orderkey % 20 <> 0 THEN o_orderstatus END AS v FROM orders) GROUP BY o_custkey""")
def _(spark, sf):
    o = table(spark, sf, "orders").withColumn("v", F.when(F.col("o_orderkey") % 20 != 0, F.col("o_orderstatus")))
    return A.count_true(o, ["o_custkey"], F.col("v") == "F")


@query("margin_sums_by_taxon", f"WITH {COUNTS} SELECT taxon, CAST(sum(numseqs) AS BIGINT) AS total FROM counts GROUP BY taxon")
def _(spark, sf):
    return A.margin_sums(counts(spark, sf), "taxon")


_BOX = """
WITH v AS ({values}), q AS (SELECT {key} AS k, quantile_cont(x, 0.25) AS q1, quantile_cont(x, 0.5) AS median, quantile_cont(x, 0.75) AS q3 FROM v GROUP BY 1),
f AS (SELECT v.*, q.q1, q.median, q.q3, x >= q1 - (q3 - q1) * 1.5 AND x <= q3 + (q3 - q1) * 1.5 AS inside FROM v JOIN q ON v.{key} = q.k)
"""


@query("box_stats", _BOX.format(values="SELECT o_orderpriority, o_totalprice AS x FROM orders", key="o_orderpriority") + """
SELECT o_orderpriority, round(max(q1), 4) AS q1, round(max(median), 4) AS median, round(max(q3), 4) AS q3,
  min(x) FILTER (WHERE inside) AS lower, max(x) FILTER (WHERE inside) AS upper, count(*) FILTER (WHERE NOT inside) AS n_outliers, count(*) AS n
FROM f GROUP BY o_orderpriority""")
def _(spark, sf):
    return rounded(A.box_stats(table(spark, sf, "orders"), ["o_orderpriority"], "o_totalprice"), 4, "q1", "median", "q3")


@query("box_stats_log_scale", _BOX.format(
    values="SELECT l_suppkey, log10(l_extendedprice) AS x FROM lineitem WHERE l_extendedprice > 0", key="l_suppkey") + """
SELECT l_suppkey, round(max(q1), 6) AS q1, round(max(median), 6) AS median, round(max(q3), 6) AS q3,
  round(min(x) FILTER (WHERE inside), 6) AS lower, round(max(x) FILTER (WHERE inside), 6) AS upper,
  count(*) FILTER (WHERE NOT inside) AS n_outliers, count(*) AS n FROM f GROUP BY l_suppkey""")
def _(spark, sf):
    return rounded(A.box_stats(table(spark, sf, "lineitem"), ["l_suppkey"], "l_extendedprice", log10=True), 6)


@query("box_outliers", _BOX.format(values="SELECT user_id, event_id, value AS x FROM events", key="user_id") + """
SELECT event_id, user_id, x AS value FROM f WHERE NOT inside""")
def _(spark, sf):
    return A.box_outliers(table(spark, sf, "events").select("event_id", "user_id", "value"), ["user_id"], "value")


@query("log_histogram", """
WITH v AS (SELECT o_orderstatus, log10(o_totalprice) AS x FROM orders WHERE o_totalprice > 0),
s AS (SELECT min(x) AS lo, max(x) AS hi FROM v)
SELECT o_orderstatus, CAST(least(floor((x - lo) / (hi - lo) * 120), 119) AS BIGINT) AS bin, count(*) AS n FROM v, s GROUP BY 1, 2""")
def _(spark, sf):
    return A.log_histogram(table(spark, sf, "orders"), ["o_orderstatus"], "o_totalprice")


@query("group_count_on_rows", """
SELECT event_id, count(*) OVER (PARTITION BY user_id, event_type) AS n FROM events""")
def _(spark, sf):
    return A.add_count(table(spark, sf, "events"), ["user_id", "event_type"]).select("event_id", "n")


@query("share_of_group", f"""
WITH {STAGES} SELECT seq_id, countType, count, count / sum(count) OVER (PARTITION BY seq_id) AS share FROM stages""")
def _(spark, sf):
    return A.add_share(stages(spark, sf), ["seq_id"], "count")
