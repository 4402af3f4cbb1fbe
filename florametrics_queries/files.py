"""Readers and writers: tables are rendered in a tool's file layout, read back and summarised.

Spark names part files itself, so here the sample comes from the folder
(``sample=...``); names taken from files are covered by the tests.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from florametrics.functions import path_part, sub, taxid
from florametrics.plans import genomes as G
from florametrics.sources import readers as R
from florametrics.sources import sinks as S
from florametrics.session import scratch_path
from florametrics_queries.bindings import COUNTS, counts, table
from florametrics_queries.registry import query


def _tsv(df, spark, name, header=False, by=None, sep="\t") -> str:
    """Write a table as delimited text, one folder per value of ``by``; returns the pattern that reads it."""
    path = scratch_path(spark, name)
    # Each folder's rows meet first: a task would else leave a file of its own in every folder it has rows of.
    writer = (S.dealt_by(df, by) if by else df).write.option("quote", "")
    (writer.partitionBy(by) if by else writer).csv(path, sep=sep, header=header)
    return f"{path}/*" if by else path


def _folder(level: int = -2):
    """Value of the ``key=value`` folder."""
    return sub(path_part("filename", level), "^[^=]*=", "")


@query("read_many_files", """
SELECT l_returnflag AS flag, count(*) AS n, sum(l_quantity) AS quantity FROM lineitem GROUP BY 1""")
def _(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_quantity", "l_returnflag")
    path = _tsv(li, spark, "many", by="l_returnflag")
    df = R.read_many(spark, path, "csv", "l_orderkey long, l_quantity double", sep="\t")
    return df.groupBy(_folder().alias("flag")).agg(F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("quantity"))


@query("skip_small_files", "SELECT l_orderkey, l_partkey FROM lineitem")
def _(spark, sf):
    """A one-line file beside the table's own files is under the size limit and is not read."""
    path = scratch_path(spark, "sizes")
    table(spark, sf, "lineitem").select("l_orderkey", "l_partkey").write.csv(path, sep="\t")
    spark.range(1).selectExpr("7", "7").write.mode("append").csv(path, sep="\t")
    rows = R.read_many(spark, path, "csv", "l_orderkey long, l_partkey long", min_bytes=10, sep="\t")
    return rows.select("l_orderkey", "l_partkey")


@query("read_classified_reads", """
SELECT CAST(l_suppkey AS VARCHAR) AS seq_id, l_returnflag AS uc, 'x (taxid ' || l_partkey || ')' AS taxon, CAST(l_partkey AS INTEGER) AS taxid, count(*) AS n FROM lineitem GROUP BY ALL""")
def _(spark, sf):
    li = table(spark, sf, "lineitem").selectExpr(
        "l_returnflag uc", "concat('r', l_orderkey) read", "concat('x (taxid ', l_partkey, ')') taxon", "concat(l_linenumber, '|', l_linenumber) length", "'0:1' m", "l_suppkey")
    reads = R.read_kraken_reads(spark, _tsv(li, spark, "reads", by="l_suppkey"))
    return reads.groupBy(_folder().alias("seq_id"), "uc", "taxon", taxid("taxon").alias("taxid")).agg(F.count(F.lit(1)).alias("n"))


@query("read_classified_contigs", """
SELECT 'c' || l_orderkey AS contig, 'x (taxid ' || l_partkey || ')' AS taxon, CAST(l_quantity AS BIGINT) AS length, 'biobank' AS cohort FROM lineitem""")
def _(spark, sf):
    li = table(spark, sf, "lineitem").selectExpr(
        "'C' uc", "concat('c', l_orderkey) contig", "concat('x (taxid ', l_partkey, ')') taxon", "cast(l_quantity as bigint) length", "'0:1' m")
    return R.read_kraken_contigs(spark, _tsv(li, spark, "contigs"), cohort="biobank").select("contig", "taxon", "length", "cohort")


@query("read_abundance_reports", f"""
WITH {COUNTS} SELECT regexp_replace(sample, 'S', '') AS seq_id, count(*) AS taxa, CAST(sum(numseqs) AS BIGINT) AS reads FROM counts GROUP BY sample""")
def _(spark, sf):
    report = counts(spark, sf).selectExpr("taxon name", "1L taxonomy_id", "'S' taxonomy_lvl", "numseqs a", "0L b", "numseqs new_est_reads", "0.5D f", "sample")
    df = R.read_bracken(spark, _tsv(report, spark, "bracken", header=True, by="sample"))
    return df.groupBy(sub(_folder(), "S", "").alias("seq_id")).agg(F.count("name").alias("taxa"), F.sum("new_est_reads").alias("reads"))


@query("read_profiles", """
SELECT p_brand AS clade_name, CAST(p_partkey AS VARCHAR) AS taxid, p_retailprice AS relative_abundance FROM part""")
def _(spark, sf):
    """A part file of comment lines and a header lies beside the rows; neither is returned."""
    head = ["#mpa", "#command", "#reads", "#sample", "#note", "clade_name\tclade_taxid\trelative_abundance\tcoverage\treads"]
    path = scratch_path(spark, "profiles")
    spark.range(1).select(F.explode(F.array(*[F.lit(h) for h in head])).alias("value")).write.text(path)
    rows = table(spark, sf, "part").select(F.concat_ws("\t", "p_brand", F.concat_ws("|", F.lit("1"), F.lit("2"), "p_partkey"), "p_retailprice", F.lit("c"), F.lit("9")))
    rows.write.mode("append").text(path)
    return R.read_metaphlan(spark, path).select("clade_name", "taxid", "relative_abundance")


@query("read_annotations", """
SELECT 'g' || p_partkey AS query_name, 'ko:' || p_size || ',ko:' || p_size + 1 AS "KEGG_ko", p_type AS description FROM part""")
def _(spark, sf):
    cells = [F.concat(F.lit("g"), "p_partkey"), F.lit("o"), F.lit("1e-5"), F.lit("90.5"), *[F.lit("-")] * 4,
             F.concat(F.lit("ko:"), "p_size", F.lit(",ko:"), F.col("p_size") + 1), *[F.lit("-")] * 12, F.concat("p_type", F.lit(" # note"))]
    path = scratch_path(spark, "annotations")
    table(spark, sf, "part").select(F.concat_ws("\t", *cells)).write.text(path)
    spark.range(1).select(F.lit("# emapper comment")).write.mode("append").text(path)
    df = R.read_emapper(spark, path, cut_at_hash=True)
    return df.select("query_name", "KEGG_ko", F.trim("eggNOG_description").alias("description"))


@query("read_protein_alignments", """
SELECT 'R' || l_orderkey AS qseqid, 'P' || l_partkey AS sseqid, round(l_discount, 2) AS pident, l_quantity AS bitscore, l_partkey % 50 + 1 AS slen FROM lineitem""")
def _(spark, sf):
    li = table(spark, sf, "lineitem").selectExpr(
        "concat('R', l_orderkey)", "concat('P', l_partkey)", "l_discount", "l_linenumber", "0 a", "0 b", "1 c", "2 d", "3 e", "4 f", "l_tax", "l_quantity", "9 g", "l_partkey % 50 + 1")
    return R.read_diamond(spark, _tsv(li, spark, "alignments")).select("qseqid", "sseqid", "pident", "bitscore", "slen")


@query("read_nucleotide_alignments", """
SELECT 'R' || l_orderkey AS qaccver, 'P' || l_partkey AS saccver, l_quantity AS score, l_suppkey AS qlen FROM lineitem""")
def _(spark, sf):
    li = table(spark, sf, "lineitem").selectExpr(
        "concat('R', l_orderkey)", "concat('P', l_partkey)", "l_discount", "l_linenumber", "0 a", "0 b", "1 c", "2 d", "3 e", "4 f", "l_tax", "l_quantity", "l_quantity", "l_suppkey")
    return R.read_blastn(spark, _tsv(li, spark, "blastn"), ncols=14).select("qaccver", "saccver", "score", "qlen")


@query("read_assembly_metrics", """
SELECT 'A' || s_suppkey AS "Assembly", CAST(s_nationkey AS VARCHAR) AS "N50", CAST(s_suppkey AS VARCHAR) AS contigs FROM supplier""")
def _(spark, sf):
    s = table(spark, sf, "supplier").selectExpr("concat('A', s_suppkey) Assembly", "s_nationkey N50", "s_suppkey contigs", "s_nationkey % 3 iso")
    path = scratch_path(spark, "quast")
    s.write.partitionBy("iso").csv(path, sep="\t", header=True)
    return R.read_quast(spark, path, name_glob="*.csv").select("Assembly", "N50", "contigs")


@query("fasta_records", """
SELECT 'D' || doc_id || ' ' || lang AS seq_name, regexp_replace(text, '\\s', '', 'g') AS sequence FROM documents""")
def _(spark, sf):
    """Documents as wrapped FASTA records."""
    docs = table(spark, sf, "documents")
    records = docs.select(F.concat(F.lit("D"), "doc_id", F.lit(" "), "lang").alias("seq_name"), F.col("text").alias("sequence"))
    path = scratch_path(spark, "fasta")
    S.write_fasta(records, path)
    return R.read_fasta(spark, path).select("seq_name", "sequence")


@query("read_gene_tables", """
SELECT 'TAG_' || p_partkey AS locus_tag, CASE WHEN p_size % 3 = 0 THEN 'CDS' ELSE 'tRNA' END AS ftype, p_name AS product FROM part WHERE p_size % 5 <> 0""")
def _(spark, sf):
    genes = table(spark, sf, "part").selectExpr(
        "concat('TAG_', p_partkey) locus_tag", "case when p_size % 5 = 0 then 'gene' when p_size % 3 = 0 then 'CDS' else 'tRNA' end ftype", "p_size length_bp", "p_brand gene",
        "'' EC_number", "'' COG", "p_name product")
    df = G.gene_annotations(R.read_gene_table(spark, _tsv(genes, spark, "genes", header=True)))
    return df.select("locus_tag", "ftype", "product")


@query("read_gff_features", """
SELECT 'c' || l_orderkey AS seqid, l_partkey AS start, l_partkey + l_suppkey AS "end", 'TAG ' || l_suppkey || ';+' AS locus_tag, CASE WHEN l_linenumber > 3 THEN 'x' || l_linenumber END AS product FROM lineitem""")
def _(spark, sf):
    li = table(spark, sf, "lineitem")
    attributes = F.concat(F.lit("locus_tag=TAG%20"), "l_suppkey", F.lit("%3B+"), F.when(F.col("l_linenumber") > 3, F.concat(F.lit(";product=x"), "l_linenumber")).otherwise(""))
    lines = li.select(F.concat_ws("\t", F.concat(F.lit("c"), "l_orderkey"), F.lit("src"), F.lit("CDS"), "l_partkey", F.col("l_partkey") + F.col("l_suppkey"), F.lit("."), F.lit("+"), F.lit("0"), attributes))
    path = scratch_path(spark, "gff")
    lines.write.option("compression", "gzip").text(path)
    spark.createDataFrame([("##gff-version 3",), ("##FASTA",), (">c1",), ("ACGT",)], "value string").write.mode("append").text(path)
    return G.feature_locations(R.read_gff(spark, path)).select("seqid", "start", "end", "locus_tag", "product")


@query("json_props", "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def _(spark, sf):
    return table(spark, sf, "events").select("event_id", F.from_json("props", "k long")["k"].alias("k"))


@query("assembly_summary", """
SELECT '##./I' || o_custkey || '/A' || o_orderkey AS path, 'c' || l_linenumber || '_' || l_partkey AS contig, CAST(floor(l_extendedprice) AS DOUBLE) AS length, l_quantity AS depth,
  CASE WHEN l_linestatus = 'F' THEN 'circular=true' END AS circular FROM lineitem JOIN orders ON l_orderkey = o_orderkey""")
def _(spark, sf):
    """Orders as ``##path`` blocks with a line per contig; of two summaries, each written in parts, the newer counts."""
    li = table(spark, sf, "lineitem").join(table(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    line = F.concat(F.lit(">c"), "l_linenumber", F.lit("_"), "l_partkey", F.lit(" length="), F.floor("l_extendedprice"), F.lit(" depth="), "l_quantity", F.lit("x"),
                    F.when(F.col("l_linestatus") == "F", " circular=true").otherwise(""))
    head = F.concat(F.lit("##./I"), "o_custkey", F.lit("/A"), "l_orderkey")
    blocks = li.select(head.alias("head"), line.alias("line")).groupBy("head").agg(F.array_sort(F.collect_list("line")).alias("lines"))
    text = blocks.select(F.concat("head", F.lit("\n"), F.array_join("lines", "\n")).alias("value"))
    path = scratch_path(spark, "summary")
    text.select(F.replace("value", F.lit("length="), F.lit("length=9")).alias("value")).write.text(f"{path}/summary-2023")
    text.write.text(f"{path}/summary-2024")
    return R.read_assembly_summary(spark, f"{path}/*", folder=True).select("path", "contig", "length", "depth", "circular")


@query("read_sequence_index", "SELECT 'c' || l_orderkey AS name, CAST(l_quantity AS BIGINT) AS length FROM lineitem")
def _(spark, sf):
    li = table(spark, sf, "lineitem").selectExpr("concat('c', l_orderkey, '_pilon')", "cast(l_quantity as bigint)", "1", "60", "61")
    return R.read_fai(spark, _tsv(li, spark, "fai"), strip_polish=True).select("name", "length")


@query("read_tool_reports", """
SELECT CAST(s_nationkey AS VARCHAR) AS isolate, s_name AS "Name", s_acctbal AS "Completeness", s_suppkey AS "Genome_Size" FROM supplier""")
def _(spark, sf):
    s = table(spark, sf, "supplier").selectExpr("s_name Name", "s_acctbal Completeness", "0.5D Contamination", "'m' a", "'11' b", "0.9D c", "5L d", "1.5D e", "s_suppkey Genome_Size", "0.4D f", "9L g", "'' h", "s_nationkey iso")
    df = R.read_report(spark, _tsv(s, spark, "reports", header=True, by="iso"), "genome_quality")
    return df.select(sub("isolate", "iso=", "").alias("isolate"), "Name", "Completeness", "Genome_Size")


@query("read_trim_log", """
SELECT 'U' || user_id || '_x.log' AS logfn, event_type || ' pair1' AS handlerfoo, floor(value) AS count FROM events""")
def _(spark, sf):
    lines = table(spark, sf, "events").select(F.concat_ws(": ", F.concat(F.lit("U"), "user_id", F.lit("_x.log")), F.lit("10"), F.lit("20"), F.lit("30"), F.lit("READ COUNT"),
                                                          F.concat("event_type", F.lit(" pair1")), F.lit("reads"), F.floor("value").cast("double")))
    path = scratch_path(spark, "trim")
    lines.write.text(path)
    return R.read_trim_log(spark, path).select("logfn", "handlerfoo", "count")


@query("read_clinical_export", """
SELECT 'st' || o_custkey AS record_id, CASE WHEN o_orderkey % 3 = 0 THEN 'M' || o_custkey ELSE '' END AS mrn, o_orderstatus AS sample_type FROM orders""")
def _(spark, sf):
    o = table(spark, sf, "orders").selectExpr("concat('st', o_custkey) record_id", "if(o_orderkey % 3 = 0, concat('M', o_custkey), '') mrn", "'s' sample_id", "'2020-01-01' d", "o_orderstatus sample_type")
    path = scratch_path(spark, "clinical")
    o.write.csv(path, header=True, emptyValue="")
    df = R.read_clinical(spark, path, "*.csv", "record_id string, mrn string, sample_id string, date_collected string, sample_type string")
    return df.select("record_id", "mrn", "sample_type")


@query("read_table_with_filter", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F'")
def _(spark, sf):
    table(spark, sf, "orders").createOrReplaceTempView("florametrics_orders")
    return R.read_table(spark, "florametrics_orders", "o_orderstatus = 'F'").select("o_orderkey", "o_totalprice")


@query("append_to_table", "SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY 1")
def _(spark, sf):
    path, o = scratch_path(spark, "appended"), table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    S.append_table(o.filter("o_orderstatus = 'F'"), path)
    S.append_table(o.filter("o_orderstatus <> 'F'"), path)
    return spark.read.parquet(path).groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))


@query("overwrite_table", "SELECT o_orderkey, o_orderstatus FROM orders")
def _(spark, sf):
    path, o = scratch_path(spark, "replaced"), table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    S.overwrite_table(o.withColumn("o_orderstatus", F.lower("o_orderstatus")), path)
    S.overwrite_table(o, path)
    return spark.read.parquet(path)


@query("append_or_snapshot", "SELECT o_orderkey, 'table' AS kind FROM orders UNION ALL SELECT c_custkey, 'snapshot' FROM customer")
def _(spark, sf):
    path = scratch_path(spark, "conditional")
    o = table(spark, sf, "orders").selectExpr("o_orderkey", "'table' kind")
    c = table(spark, sf, "customer").selectExpr("c_custkey o_orderkey", "'snapshot' kind")
    S.append_or_snapshot(o, f"{path}/table", f"{path}/a", load=True)
    S.append_or_snapshot(c, f"{path}/table", f"{path}/b", load=False)
    return S.restore(spark, f"{path}/table").unionByName(S.restore(spark, f"{path}/b"))


@query("conform_to_target", "SELECT p_brand, p_partkey, p_type FROM part")
def _(spark, sf):
    return S.conform(table(spark, sf, "part"), ["p_brand", "p_partkey", "p_type"])


@query("snapshot_and_restore", f"WITH {COUNTS} SELECT * FROM counts")
def _(spark, sf):
    path = scratch_path(spark, "snapshot")
    S.snapshot(counts(spark, sf), path)
    return S.restore(spark, path)


@query("snapshot_per_input", "SELECT l_shipmonth AS month, count(*) AS n FROM (SELECT month(l_shipdate) AS l_shipmonth FROM lineitem) GROUP BY 1")
def _(spark, sf):
    path = scratch_path(spark, "per-input")
    S.snapshot(table(spark, sf, "lineitem").select("l_orderkey", F.month("l_shipdate").alias("filename")), path, partition_by=["filename"])
    back = S.restore(spark, path, "l_orderkey long, filename int")
    return back.groupBy(F.col("filename").cast("long").alias("month")).agg(F.count(F.lit(1)).alias("n"))


@query("csv_roundtrip", "SELECT c_custkey, c_name, c_acctbal FROM customer")
def _(spark, sf):
    path = scratch_path(spark, "csv")
    S.write_csv(table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal"), path)
    return spark.read.schema("c_custkey long, c_name string, c_acctbal double").csv(path, header=True)


@query("gene_sequences", """
SELECT 'TAG_' || p_partkey AS locus_tag, upper(p_name[1:3]) || lower(p_brand) AS nuc_sequence, CASE WHEN p_size % 2 = 0 THEN p_type END AS prot_sequence, p_brand AS product FROM part""")
def _(spark, sf):
    """Nucleotide and protein records of one folder; a nucleotide record is split over two lines."""
    path = scratch_path(spark, "sequences")
    part = table(spark, sf, "part").withColumn("h", F.concat(F.lit("TAG_"), "p_partkey", F.lit(" "), "p_brand"))
    S.write_fasta(part.select(F.col("h").alias("seq_name"), F.concat(F.upper(F.col("p_name").substr(1, 3)), F.lit("\n"), F.lower("p_brand")).alias("sequence")), f"{path}/ffn")
    protein = F.concat(F.when(F.col("p_size") % 2 == 0, "TAG_").otherwise("OLD_"), "p_partkey", F.lit(" "), "p_brand")
    S.write_fasta(part.select(protein.alias("seq_name"), F.col("p_type").alias("sequence")), f"{path}/faa")
    nuc, prot = (R.read_fasta(spark, f"{path}/{k}", ordered=True).withColumn("filename", F.lit(f"iso.{k}")) for k in ("ffn", "faa"))
    return G.gene_sequences(nuc, prot).select("locus_tag", "nuc_sequence", "prot_sequence", "product")
