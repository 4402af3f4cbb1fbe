"""Projections, filters, reshapes and unions."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from florametrics.functions import blank_to_null
from florametrics.operators import columns as C
from florametrics.operators import reshape as R
from florametrics.operators import setops as U
from florametrics_queries.bindings import (
    COUNTS, SAMPLES, STAGES, TAX, counts, samples, stages, table, tax,
)
from florametrics_queries.registry import query


@query("project_columns", "SELECT c_mktsegment, c_custkey, c_nationkey, c_acctbal FROM customer")
def _(spark, sf):
    return C.project(table(spark, sf, "customer"), keep=["c_*"], drop=["c_name"], first=["c_mktsegment"])


@query("select_any_columns", "SELECT p_partkey, p_name FROM part")
def _(spark, sf):
    return C.select_any(table(spark, sf, "part"), ["p_partkey", "not_there", "p_name"])


@query("rename_columns", """
SELECT o_orderkey AS orderkey, o_custkey AS custkey, o_orderstatus AS orderstatus, o_totalprice AS totalprice,
       o_orderpriority AS priority FROM orders""")
def _(spark, sf):
    short = C.rename(table(spark, sf, "orders").drop("o_orderdate"), lambda c: c.removeprefix("o_"))
    return C.rename(short, {"orderpriority": "priority"})


@query("derive_columns", """
SELECT l_orderkey, l_partkey, round(l_extendedprice * (1 - l_discount), 4) AS net,
       upper(l_returnflag) || '-' || upper(l_linestatus) AS state FROM lineitem""")
def _(spark, sf):
    li = C.derive_each(table(spark, sf, "lineitem"), ["l_returnflag", "l_linestatus"], F.upper)
    return C.derive(
        li, only=True, l_orderkey=F.col("l_orderkey"), l_partkey=F.col("l_partkey"),
        net=F.round(F.col("l_extendedprice") * (1 - F.col("l_discount")), 4),
        state=F.concat_ws("-", "l_returnflag", "l_linestatus"),
    )


@query("where_all_true", """
SELECT l_orderkey, l_partkey, l_quantity FROM lineitem
WHERE l_discount >= 0.03 AND l_tax < 0.06 AND l_quantity > 10""")
def _(spark, sf):
    kept = C.where_all(table(spark, sf, "lineitem"), F.col("l_discount") >= 0.03, F.col("l_tax") < 0.06,
                       F.col("l_quantity") > 10)
    return kept.select("l_orderkey", "l_partkey", "l_quantity")


@query("where_matches_negated", f"""
WITH {TAX} SELECT taxon, Species FROM tax WHERE Species IS NULL OR NOT regexp_matches(Species, '^(red|old)')""")
def _(spark, sf):
    return C.where_matches(tax(spark, sf), "Species", "^(red|old)", negate=True).select("taxon", "Species")


@query("where_not_in_keeps_null", f"""
WITH {TAX} SELECT taxon, Genus FROM tax WHERE Genus IS NULL OR Genus NOT IN ('bolt', 'gear')""")
def _(spark, sf):
    return C.where_in(tax(spark, sf), "Genus", ["bolt", "gear"], negate=True).select("taxon", "Genus")


@query("require_rank_columns", f"WITH {TAX} SELECT Phylum, count(*) AS n FROM tax GROUP BY Phylum")
def _(spark, sf):
    checked = C.require_columns(tax(spark, sf), ["Kingdom", "Phylum", "Genus"])
    return checked.groupBy("Phylum").agg(F.count(F.lit(1)).alias("n"))


@query("ensure_missing_columns", """
SELECT s_suppkey, s_name, CAST(NULL AS DOUBLE) AS depth, CAST(NULL AS VARCHAR) AS circular FROM supplier""")
def _(spark, sf):
    want = T.StructType.fromDDL("s_name string, depth double, circular string")
    return C.ensure_columns(table(spark, sf, "supplier").select("s_suppkey", "s_name"), want)


@query("dictionary_lookup", """
SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'flyeLong' WHEN 'P' THEN 'noTrim' END AS kind FROM orders""")
def _(spark, sf):
    out = C.lookup(table(spark, sf, "orders"), "o_orderstatus", {"F": "flyeLong", "P": "noTrim"}, "kind")
    return out.select("o_orderkey", "kind")


@query("correct_values", """
SELECT p_partkey, CASE p_brand WHEN 'Brand#1' THEN 'Brand#01' WHEN 'Brand#2' THEN 'Brand#02' ELSE p_brand END AS p_brand
FROM part""")
def _(spark, sf):
    out = C.correct(table(spark, sf, "part"), "p_brand", {"Brand#1": "Brand#01", "Brand#2": "Brand#02"})
    return out.select("p_partkey", "p_brand")


@query("recode_to_levels", f"""
WITH {STAGES}, r AS (SELECT seq_id, count, CASE countType WHEN 'raw pair' THEN 'raw' WHEN 'final pair' THEN 'final' END AS stage
FROM stages) SELECT seq_id, stage, count, CASE stage WHEN 'raw' THEN 1 ELSE 2 END AS level FROM r WHERE stage IS NOT NULL""")
def _(spark, sf):
    out = C.recode_levels(stages(spark, sf).withColumnRenamed("countType", "stage"), "stage",
                          {"raw pair": "raw", "final pair": "final"}, ordinal="level")
    return out.select("seq_id", "stage", "count", "level")


@query("orient_by_strand", """
SELECT l_orderkey, l_partkey, CASE WHEN l_linestatus = 'F' THEN l_suppkey ELSE l_partkey END AS sstart,
       CASE WHEN l_linestatus = 'F' THEN l_partkey ELSE l_suppkey END AS send FROM lineitem""")
def _(spark, sf):
    li = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_partkey", F.col("l_partkey").alias("sstart"), F.col("l_suppkey").alias("send"),
        F.when(F.col("l_linestatus") == "F", "minus").otherwise("plus").alias("sstrand"))
    return C.orient(li, "sstart", "send", "sstrand").drop("sstrand")


@query("pivot_stage", f"""
WITH {STAGES} SELECT seq_id, max(CASE WHEN countType = 'raw pair' THEN count END) AS raw,
       max(CASE WHEN countType = 'final pair' THEN count END) AS final FROM stages GROUP BY seq_id""")
def _(spark, sf):
    wide = R.widen(stages(spark, sf), ["seq_id"], "countType", "count", ["raw pair", "final pair"])
    return C.rename(wide, {"raw pair": "raw", "final pair": "final"})


@query("unpivot_stage", f"""
WITH {SAMPLES} SELECT sample, 'reads_in' AS stage, CAST(reads_in AS VARCHAR) AS value FROM samples
UNION ALL SELECT sample, 'reads_out', CAST(reads_out AS VARCHAR) FROM samples
UNION ALL SELECT sample, 'libraryname', libraryname FROM samples""")
def _(spark, sf):
    return R.lengthen(samples(spark, sf), ["sample"], ["reads_in", "reads_out", "libraryname"], "stage", "value", "string")


@query("explode_list_keep_null", f"""
WITH {TAX} SELECT taxon, unnest(coalesce(string_split(Species, ' '), [NULL])) AS word FROM tax""")
def _(spark, sf):
    return R.explode_list(tax(spark, sf), "Species", " ", out="word").select("taxon", "word")


@query("unnest_structs", """
WITH d AS (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents),
     k AS (SELECT doc_id, CASE WHEN len(l) > 1 THEN l ELSE [] END AS l FROM d)
SELECT doc_id, CAST(i AS INTEGER) AS place, CASE WHEN i IS NOT NULL THEN CAST(length(l[i + 1]) AS INTEGER) END AS size
FROM (SELECT doc_id, l, unnest(CASE WHEN len(l) = 0 THEN [NULL] ELSE range(len(l)) END) AS i FROM k)""")
def _(spark, sf):
    lines = F.split("text", "\n")
    listed = F.transform(lines, lambda x, i: F.struct(i.alias("place"), F.length(x).alias("size")))
    # One-line documents hold an empty list and are kept.
    nested = table(spark, sf, "documents").select(
        "doc_id", F.when(F.size(lines) > 1, listed).otherwise(F.filter(listed, lambda x: F.lit(False))).alias("lines"))
    return R.unnest(nested, "lines", keep_empty=True)


@query("unnest_lists_in_step", """
SELECT p_partkey, unnest(string_split(p_name, ' ')) AS word, unnest(generate_series(1, len(string_split(p_name, ' ')))) AS place
FROM part""")
def _(spark, sf):
    words = F.split("p_name", " ")
    nested = table(spark, sf, "part").select(
        "p_partkey", words.alias("word"), F.sequence(F.lit(1).cast("long"), F.size(words).cast("long")).alias("place"))
    return R.unnest_zip(nested, ["word", "place"])


@query("separate_parts", """
SELECT c_custkey, split_part(c_name, '#', 1) AS kind, TRY_CAST(split_part(c_name, '#', 2) AS INTEGER) AS number,
       CAST(NULL AS VARCHAR) AS rest FROM customer""")
def _(spark, sf):
    out = R.separate(table(spark, sf, "customer"), "c_name", ["kind", "number", "rest"], {"number": "int"})
    return out.select("c_custkey", "kind", "number", "rest")


@query("melt_abundance", f"""
WITH {COUNTS}, {TAX}, {SAMPLES}, t AS (SELECT sample, sum(numseqs) AS total FROM counts WHERE numseqs > 0 GROUP BY sample)
SELECT c.sample, c.taxon, c.numseqs, c.numseqs / t.total AS pctseqs, x.Phylum, s.grp
FROM counts c JOIN t USING (sample) LEFT JOIN tax x ON c.taxon = x.taxon LEFT JOIN samples s ON c.sample = s.sample
WHERE c.numseqs > 0""")
def _(spark, sf):
    out = R.melt_abundance(counts(spark, sf), tax(spark, sf), samples(spark, sf))
    return out.select("sample", "taxon", "numseqs", "pctseqs", "Phylum", "grp")


@query("wide_counts", f"""
WITH {COUNTS}, {TAX}, k AS (SELECT sample, Kingdom, numseqs FROM counts JOIN tax USING (taxon))
SELECT sample, CAST(coalesce(sum(numseqs) FILTER (WHERE Kingdom = 'ECONOMY'), 0) AS BIGINT) AS "ECONOMY",
       CAST(coalesce(sum(numseqs) FILTER (WHERE Kingdom = 'PROMO'), 0) AS BIGINT) AS "PROMO",
       CAST(coalesce(sum(numseqs) FILTER (WHERE Kingdom = 'SMALL'), 0) AS BIGINT) AS "SMALL",
       CAST(coalesce(sum(numseqs) FILTER (WHERE Kingdom IS NULL OR Kingdom NOT IN ('ECONOMY', 'PROMO', 'SMALL')), 0) AS BIGINT) AS "other"
FROM k GROUP BY sample""")
def _(spark, sf):
    by_kingdom = counts(spark, sf).join(tax(spark, sf), "taxon").select("sample", F.col("Kingdom").alias("taxon"), "numseqs")
    return R.wide_counts(by_kingdom, ["ECONOMY", "PROMO", "SMALL"])


@query("union_fill_missing", """
SELECT c_name AS name, c_acctbal AS bal, c_mktsegment AS segment, NULL AS nation FROM customer
UNION ALL SELECT s_name, s_acctbal, NULL, s_nationkey FROM supplier""")
def _(spark, sf):
    a = table(spark, sf, "customer").selectExpr("c_name name", "c_acctbal bal", "c_mktsegment segment")
    b = table(spark, sf, "supplier").selectExpr("s_name name", "s_acctbal bal", "s_nationkey nation")
    return U.union_fill(a, b)


@query("union_same_schema", """
SELECT c_name AS name, c_acctbal AS bal FROM customer UNION ALL SELECT s_name, s_acctbal FROM supplier""")
def _(spark, sf):
    a = table(spark, sf, "customer").selectExpr("c_name name", "c_acctbal bal")
    return U.union_same(a, table(spark, sf, "supplier").selectExpr("s_acctbal bal", "s_name name"))


@query("union_distinct_column", """
SELECT c_nationkey AS nation FROM customer UNION SELECT s_nationkey FROM supplier""")
def _(spark, sf):
    return U.union_distinct(table(spark, sf, "customer").selectExpr("c_nationkey nation"),
                            table(spark, sf, "supplier").selectExpr("s_nationkey nation"), "nation")


@query("branch_and_union", """
SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN o_totalprice END AS done,
       CASE WHEN o_orderstatus <> 'F' THEN o_totalprice END AS pending FROM orders""")
def _(spark, sf):
    o = table(spark, sf, "orders")
    return U.branch_union(
        o, F.col("o_orderstatus") == "F",
        lambda d: d.select("o_orderkey", F.col("o_totalprice").alias("done")),
        lambda d: d.select("o_orderkey", F.col("o_totalprice").alias("pending")),
    )


@query("blank_as_missing", """
SELECT l_orderkey, l_partkey, nullif(CASE l_returnflag WHEN 'N' THEN '' ELSE l_returnflag END, '') AS flag FROM lineitem""")
def _(spark, sf):
    li = table(spark, sf, "lineitem").withColumn(
        "flag", F.when(F.col("l_returnflag") == "N", "").otherwise(F.col("l_returnflag")))
    return li.select("l_orderkey", "l_partkey", blank_to_null("flag").alias("flag"))
