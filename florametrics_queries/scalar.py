"""Scalar functions on whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from florametrics import functions as fn
from florametrics_queries.bindings import HITS, TAX, hits, table, tax
from florametrics_queries.registry import query


@query("regex_replace", "SELECT page_id, regexp_replace(url, '^https?://|[?#].*$', '', 'g') AS place FROM pages")
def _(spark, sf):
    return table(spark, sf, "pages").select("page_id", fn.sub("url", "^https?://|[?#].*$", "").alias("place"))


@query("regex_extract_first", """
SELECT page_id, CASE WHEN regexp_matches(url, 'page=[0-9]+') THEN regexp_extract(url, 'page=[0-9]+') END AS page FROM pages""")
def _(spark, sf):
    return table(spark, sf, "pages").select("page_id", fn.extract("url", "page=[0-9]+").alias("page"))


@query("regex_extract_all", """
SELECT doc_id, array_to_string(regexp_extract_all(text, '[A-Z][a-z]+'), '_') AS words FROM documents""")
def _(spark, sf):
    return table(spark, sf, "documents").select("doc_id", fn.extract_all("text", "[A-Z][a-z]+").alias("words"))


@query("sample_from_path", f"""
WITH {HITS} SELECT DISTINCT filename, regexp_replace(string_split(filename, '/')[-1], '\\.R[12]\\..+$', '') AS seq_id FROM hits""")
def _(spark, sf):
    h = hits(spark, sf)
    return h.select("filename", fn.sample_from_path("filename", r"\.R[12]\..+$").alias("seq_id")).distinct()


@query("taxid_number", """
SELECT p_partkey, CASE WHEN p_size % 4 <> 0 THEN p_partkey + 100 END::INTEGER AS taxid FROM part""")
def _(spark, sf):
    part = table(spark, sf, "part")
    text = F.when(F.col("p_size") % 4 != 0, F.concat("p_name", F.lit(" (taxid "), F.col("p_partkey") + 100, F.lit(")")))
    return part.select("p_partkey", fn.taxid(F.coalesce(text, F.col("p_name"))).alias("taxid"))


@query("last_part", "SELECT page_id, string_split(url, '/')[-1] AS tail FROM pages")
def _(spark, sf):
    return table(spark, sf, "pages").select("page_id", fn.last_part("url", "/").alias("tail"))


@query("path_component", """
SELECT page_id, string_split(url, '/')[3] AS host, string_split(url, '/')[-2] AS folder,
       CASE WHEN len(string_split(url, '/')) >= 9 THEN string_split(url, '/')[9] END AS deep FROM pages""")
def _(spark, sf):
    return table(spark, sf, "pages").select(
        "page_id", fn.path_part("url", 3).alias("host"), fn.path_part("url", -2).alias("folder"),
        fn.path_part("url", 9).alias("deep"))


@query("pool_name", """
SELECT s_suppkey, CASE WHEN s_nationkey % 2 = 0
  THEN 'MMF.16S.' || s_nationkey || '_MMF.16S.' || s_suppkey || '_SamLight' ELSE 'SM' || s_nationkey || '_SM' || s_suppkey END AS pool
FROM supplier""")
def _(spark, sf):
    s = table(spark, sf, "supplier")
    a, b, tail = F.col("s_nationkey"), F.col("s_suppkey"), F.lit(".finalPhy_rdp.rds")
    family = F.concat(F.lit("/x/MMF.16S."), a, F.lit("_MMF.16S."), b, F.lit("_SamLight"), tail)
    plain = F.concat(F.lit("/x/SM"), a, F.lit("_SM"), b, tail)
    return s.select("s_suppkey", fn.pool_id(F.when(a % 2 == 0, family).otherwise(plain)).alias("pool"))


@query("subject_identifier", """
SELECT c_custkey, CASE WHEN c_nationkey % 2 = 0 THEN 'HT-' || lpad(CAST(c_custkey % 900 AS VARCHAR), 3, '0') || '.05'
  ELSE 'D' || c_custkey || '002' END AS id FROM customer""")
def _(spark, sf):
    c = table(spark, sf, "customer")
    subject = F.format_string("200101-HT-%03d-05", F.col("c_custkey") % 900)
    donor = F.concat(F.lit("200101-Donor-D"), "c_custkey", F.lit(".2"))
    return c.select("c_custkey", fn.subject_id(F.when(F.col("c_nationkey") % 2 == 0, subject).otherwise(donor)).alias("id"))


@query("padded_identifier", """
SELECT c_custkey, c_mktsegment || '-' || CASE WHEN c_nationkey = 3 THEN ' NA'
  WHEN c_custkey < 1000 THEN lpad(CAST(c_custkey AS VARCHAR), 3, '0') ELSE CAST(c_custkey AS VARCHAR) END
  || '.' || lpad(CAST(c_nationkey AS VARCHAR), 2, '0') AS id FROM customer""")
def _(spark, sf):
    c = table(spark, sf, "customer")
    n = F.when(F.col("c_nationkey") != 3, F.col("c_custkey"))
    return c.select("c_custkey", fn.padded_id("c_mktsegment", n, "c_nationkey").alias("id"))


@query("conditional_values", f"""
WITH {TAX} SELECT taxon, CASE WHEN Genus IS NULL THEN NULL WHEN Genus = 'bolt' THEN 'yes' ELSE 'no' END AS two_way,
  CASE WHEN Genus = 'bolt' THEN 'a' WHEN Species LIKE 'red%' THEN 'b' ELSE 'c' END AS many_way FROM tax""")
def _(spark, sf):
    t = tax(spark, sf)
    return t.select(
        "taxon", fn.if_else_na(F.col("Genus") == "bolt", F.lit("yes"), F.lit("no")).alias("two_way"),
        fn.case((F.col("Genus") == "bolt", "a"), (F.col("Species").startswith("red"), "b"), default="c").alias("many_way"))


@query("missing_to_label", f"""
WITH {TAX} SELECT taxon, coalesce(Genus, 'unclassified') AS genus, CASE WHEN Family = 'F0' THEN 'unclassified' ELSE Family END AS family
FROM tax""")
def _(spark, sf):
    t = tax(spark, sf).withColumn("Family", F.when(F.col("Family") == "F0", "").otherwise(F.col("Family")))
    return t.select("taxon", fn.null_to("Genus", "unclassified").alias("genus"),
                    fn.blank_to("Family", "unclassified").alias("family"))


@query("lenient_date", """
SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE strftime(o_orderdate, '%Y-%m-%d') END AS day FROM orders""")
def _(spark, sf):
    o = table(spark, sf, "orders")
    text = (F.when(F.col("o_orderstatus") == "P", "no date").when(F.col("o_orderstatus") == "O", F.date_format("o_orderdate", "yyyy/MM/dd"))
            .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")))
    return o.select("o_orderkey", fn.lenient_date(text).cast("string").alias("day"))


@query("lenient_number", """
SELECT event_id, TRY_CAST(regexp_extract(props, '[0-9]+') AS INTEGER) AS k, CASE WHEN event_type <> 'view' THEN value END AS value
FROM events""")
def _(spark, sf):
    e = table(spark, sf, "events")
    text = F.when(F.col("event_type") == "view", F.lit("n/a")).otherwise(F.concat(F.lit(" "), F.col("value").cast("string")))
    return e.select("event_id", fn.lenient_number(fn.extract("props", "[0-9]+"), "int").alias("k"),
                    fn.lenient_number(text).alias("value"))


@query("paste_with_missing", f"""
WITH {TAX} SELECT taxon, concat_ws('-', Phylum, Class, "Order", Family, coalesce(Genus, 'NA')) AS lineage FROM tax""")
def _(spark, sf):
    return tax(spark, sf).select("taxon", fn.paste("Phylum", "Class", "Order", "Family", "Genus", sep="-").alias("lineage"))


@query("change_case", """
SELECT p_partkey, lower(p_type) AS low, upper(p_type[1]) || lower(p_type[2:]) AS title FROM part""")
def _(spark, sf):
    return table(spark, sf, "part").select("p_partkey", F.lower("p_type").alias("low"), fn.title("p_type").alias("title"))


@query("ratios", f"""
WITH {HITS} SELECT qseqid, sseqid, CASE WHEN length - 1 <> 0 THEN CAST(qlen AS DOUBLE) / CAST(length - 1 AS DOUBLE) * 1000000.0 END AS cpm
FROM hits""")
def _(spark, sf):
    h = hits(spark, sf)
    return h.select("qseqid", "sseqid", fn.ratio("qlen", F.col("length") - 1, 1e6).alias("cpm"))
