"""Whole analyses: targeted genes, taxonomy, read quality, assemblies, clinical identifiers."""

from __future__ import annotations

from pyspark.sql import functions as F

from florametrics.functions import padded_id
from florametrics.operators.aggregates import box_stats
from florametrics.plans import assembly as AS
from florametrics.plans import clinical as CL
from florametrics.plans import quality as Q
from florametrics.plans import targeted as TG
from florametrics.plans import taxonomy as TX
from florametrics.sources.readers import FILE_ORDER
from florametrics_queries.bindings import (
    CONTIGS, COUNTS, HITS, SAMPLES, STAGES, TAX, contigs, counts, hits, rounded, samples, stages, table, tax,
)
from florametrics_queries.registry import query, unit_sql

# ---- targeted genes -------------------------------------------------------------------------

IDENT, ECUT = 0.03, 0.06
_BEST = f"""
{HITS}, f AS (SELECT * FROM hits WHERE pident >= {IDENT} AND evalue < {ECUT} AND length > qlen * CAST(0.8 AS DOUBLE) / 3),
r AS (SELECT *, rank() OVER (PARTITION BY qseqid ORDER BY bitscore DESC, pident DESC, evalue) AS k FROM f),
t AS (SELECT *, count(*) OVER (PARTITION BY qseqid, sseqid) AS swt FROM r WHERE k = 1),
p AS (SELECT *, row_number() OVER (PARTITION BY qseqid ORDER BY swt DESC, sseqid, filename, length, qlen, slen) AS o FROM t),
best AS (SELECT filename, qseqid, sseqid, pident, bitscore, evalue, slen, swt FROM p WHERE o = 1)"""
_GENES = _BEST + """,
genes AS (SELECT regexp_replace(string_split(filename, '/')[-1], '\\.R[12].[a-zA-Z_]+.dmnd', '') AS seq_id,
  string_split(filename, '/')[-2] AS dbsource, sseqid, slen, count(*) AS mappedReads FROM best GROUP BY ALL)"""
_TOTALS = "totals AS (SELECT concat('S', l_suppkey) AS seq_id, CAST(count(*) AS DOUBLE) AS total FROM lineitem GROUP BY 1)"


def best_hits(spark, sf):
    return TG.best_hit(hits(spark, sf), ["qseqid"], IDENT, ECUT, mode="deterministic")


def gene_table(spark, sf):
    return TG.gene_counts(best_hits(spark, sf))


def read_totals(spark, sf):
    li = table(spark, sf, "lineitem").select(F.concat(F.lit("S"), "l_suppkey").alias("seq_id"))
    return li.groupBy("seq_id").agg(F.count(F.lit(1)).cast("double").alias("total"))


@query("best_hit", f"WITH {_BEST} SELECT qseqid, sseqid, pident, bitscore, evalue, slen, swt FROM best")
def _(spark, sf):
    return best_hits(spark, sf).select("qseqid", "sseqid", "pident", "bitscore", "evalue", "slen", "swt")


@query("best_hit_random", f"""
WITH {_BEST}, s AS (SELECT qseqid, sseqid, count(*) AS swt FROM r WHERE k = 1 GROUP BY ALL)
SELECT qseqid, sseqid, swt FROM s
QUALIFY row_number() OVER (PARTITION BY qseqid ORDER BY ln({unit_sql(11, "qseqid", "sseqid")}) / (swt * swt) DESC) = 1""")
def _(spark, sf):
    """The weighted random choice among tied subjects."""
    return TG.best_hit(hits(spark, sf), ["qseqid"], IDENT, ECUT, seed=11).select("qseqid", "sseqid", "swt")


@query("targeted_counts", f"WITH {_GENES} SELECT * FROM genes")
def _(spark, sf):
    return gene_table(spark, sf)


@query("cpm_rpkm", f"""
WITH {_GENES}, {_TOTALS} SELECT seq_id, sseqid, mappedReads, CAST(mappedReads AS DOUBLE) / total * 1000000.0 AS cpm,
  CAST(mappedReads AS DOUBLE) / ((CAST(slen AS DOUBLE) / 1000) * total) * 1000000.0 AS rpkm, slen
FROM genes LEFT JOIN totals USING (seq_id)""")
def _(spark, sf):
    return TG.normalise_counts(gene_table(spark, sf), read_totals(spark, sf))


@query("ko_explode", """
WITH e AS (SELECT 'S' || doc_id || '_R1.' AS sample, lang AS query_name, CASE WHEN lang <> 'de' THEN regexp_replace(text, '\\s+', ',', 'g') END AS ko FROM documents WHERE source IS NOT NULL)
SELECT regexp_replace(sample, '_R1\\.$', '') AS seq_id, query_name, unnest(coalesce(string_split(ko, ','), [NULL])) AS ko_id FROM e""")
def _(spark, sf):
    annotated = table(spark, sf, "documents").select(
        F.concat(F.lit("S"), "doc_id", F.lit("_R1.")).alias("sample"), F.col("lang").alias("query_name"),
        F.when(F.col("lang") != "de", F.regexp_replace("text", r"\s+", ",")).alias("KEGG_ko"))
    # Samples without a source are not on the list of known ones.
    known = table(spark, sf, "documents").selectExpr("concat(if(source is null, 'X', 'S'), doc_id) seq_id")
    return TG.expand_ko(annotated, known).select("seq_id", "query_name", "ko_id")


_BLAST = """b AS (SELECT 'R' || l_orderkey AS qaccver, l_partkey AS staxid, 100 - l_discount * 200 AS pident, l_quantity AS bitscore,
  CAST(l_linenumber AS BIGINT) AS qstart, CAST(l_linenumber * 10 + l_suppkey % 7 AS BIGINT) AS qend, CAST(60 AS BIGINT) AS qlen,
  l_partkey AS sstart, l_partkey + 100 AS send, CASE WHEN l_linestatus = 'F' THEN 'minus' ELSE 'plus' END AS sstrand FROM lineitem)"""


def blast(spark, sf):
    return table(spark, sf, "lineitem").selectExpr(
        "concat('R', l_orderkey) qaccver", "l_partkey staxid", "100 - l_discount * 200 pident", "l_quantity bitscore",
        "cast(l_linenumber as bigint) qstart", "cast(l_linenumber * 10 + l_suppkey % 7 as bigint) qend",
        "cast(60 as bigint) qlen", "l_partkey sstart", "l_partkey + 100 send",
        "case when l_linestatus = 'F' then 'minus' else 'plus' end sstrand")


@query("normalised_hits", f"""
WITH {_BLAST}, q AS (SELECT *, CAST(qend - qstart + 1 AS DOUBLE) / CAST(qlen AS DOUBLE) * 100.0 AS qcov FROM b)
SELECT qaccver, staxid, qcov, CASE sstrand WHEN 'minus' THEN send ELSE sstart END AS sstart,
  CASE sstrand WHEN 'minus' THEN sstart ELSE send END AS send FROM q WHERE pident > 85 AND qcov > 85""")
def _(spark, sf):
    return TG.filter_hits(blast(spark, sf)).select("qaccver", "staxid", "qcov", "sstart", "send")


@query("top5_hits", f"""
WITH {_BLAST}, r AS (SELECT *, rank() OVER (PARTITION BY qaccver ORDER BY bitscore DESC) AS k FROM b)
SELECT qaccver, staxid, bitscore, p_brand AS species, o_orderstatus AS isolate
FROM r LEFT JOIN part ON staxid = p_partkey LEFT JOIN orders ON qaccver = 'R' || o_orderkey WHERE k <= 5""")
def _(spark, sf):
    lineage = table(spark, sf, "part").selectExpr("p_partkey tax_id", "p_brand species")
    isolates = table(spark, sf, "orders").selectExpr("concat('R', o_orderkey) locus_tag", "o_orderstatus isolate")
    out = TG.top_hits(blast(spark, sf), lineage, isolates)
    return out.select("qaccver", "staxid", "bitscore", "species", "isolate")


@query("top3_report", """
WITH h AS (SELECT 'R' || l_orderkey AS query, l_linenumber AS ordinal, 'P' || l_partkey AS d, l_quantity AS i FROM lineitem),
g AS (SELECT *, row_number() OVER (PARTITION BY query ORDER BY ordinal, d) AS r FROM h WHERE i / 40 > 0.5 AND i / 45 > 0.4)
SELECT h.query, coalesce(max(g.d) FILTER (WHERE r = 1), 'NA') AS hit1, coalesce(max(g.d) FILTER (WHERE r = 2), 'NA') AS hit2,
  coalesce(max(g.d) FILTER (WHERE r = 3), 'NA') AS hit3 FROM (SELECT DISTINCT query FROM h) h LEFT JOIN g USING (query) GROUP BY 1""")
def _(spark, sf):
    hsps = table(spark, sf, "lineitem").selectExpr(
        "concat('R', l_orderkey) query", "l_linenumber ordinal", "concat('P', l_partkey) hit_description",
        "l_quantity ident_num", "40 hit_span", "45 query_span")
    return TG.top_report(hsps, 3, 0.5, 0.4)


# ---- taxonomy -------------------------------------------------------------------------------

_READS = """r AS (SELECT '/k/S' || l_suppkey || '.standard.txt' AS filename, CASE l_linestatus WHEN 'O' THEN 'C' ELSE 'U' END AS uc,
  p_name || ' (taxid ' || p_partkey || ')' AS taxon, p_partkey, p_type || '-' || l_linenumber AS read, p_type AS genome
  FROM lineitem JOIN part ON l_partkey = p_partkey)"""


def classified_reads(spark, sf):
    return table(spark, sf, "lineitem").join(table(spark, sf, "part"), F.col("l_partkey") == F.col("p_partkey")).selectExpr(
        "concat('/k/S', l_suppkey, '.standard.txt') filename", "case l_linestatus when 'O' then 'C' else 'U' end uc",
        "concat(p_name, ' (taxid ', p_partkey, ')') taxon", "concat(p_type, '-', l_linenumber) read")


@query("taxon_counts", f"""
WITH {_READS} SELECT regexp_replace(string_split(filename, '/')[-1], '\\.standard\\.txt', '') AS seq_id, uc, taxon,
  CAST(p_partkey AS INTEGER) AS taxid, count(*) AS numseqs, string_split(filename, '/')[-1] AS filename FROM r GROUP BY r.filename, uc, taxon, p_partkey""")
def _(spark, sf):
    return TX.taxon_counts(classified_reads(spark, sf))


@query("taxon_counts_by_genome", f"""
WITH {_READS} SELECT regexp_replace(string_split(filename, '/')[-1], '\\.standard\\.txt', '') AS seq_id, uc, taxon,
  CAST(p_partkey AS INTEGER) AS taxid, count(*) AS numseqs, string_split(filename, '/')[-1] AS filename
FROM r GROUP BY r.filename, genome, uc, taxon, p_partkey""")
def _(spark, sf):
    return TX.taxon_counts(classified_reads(spark, sf), by_genome=True)


_DUMP = """d AS (SELECT CAST(CASE WHEN p_partkey % 10 = 0 THEN -p_partkey ELSE p_partkey END AS INTEGER) AS tax_id, p_type AS kingdom, p_brand AS phylum, CASE WHEN p_size % 3 <> 0 THEN 'C' || p_size % 3 ELSE '' END AS class,
  'O' || p_size % 4 AS "order", 'F' || p_size % 5 AS family, CASE WHEN p_size % 7 <> 0 THEN split_part(p_name, ' ', 2) ELSE '' END AS genus,
  p_name AS species FROM part)"""


@query("taxon_abundance", f"""
WITH {_DUMP}, j AS (SELECT 'S' || l_suppkey AS seq_id, d.*, l_quantity AS len FROM lineitem LEFT JOIN d ON l_partkey = d.tax_id),
g AS (SELECT seq_id, kingdom, phylum, class, "order", family, genus, species, sum(len) AS len FROM j GROUP BY ALL),
s AS (SELECT *, sum(len) OVER (PARTITION BY seq_id) AS tot FROM g),
u AS (SELECT seq_id, kingdom AS "Kingdom", phylum AS "Phylum", CASE class WHEN '' THEN 'unclassified' ELSE class END AS "Class", "order" AS "Order",
  family AS "Family", CASE genus WHEN '' THEN 'unclassified' ELSE genus END AS genus_label, species AS "Species", len, tot, len / tot AS pct FROM s)
SELECT seq_id, "Kingdom", "Phylum", "Class", "Order", "Family", "Species", genus_label,
  coalesce("Phylum", 'NA') || '-' || coalesce("Class", 'NA') || '-' || coalesce("Order", 'NA') || '-' || coalesce("Family", 'NA') || '-' || coalesce(genus_label, 'NA') AS "Genus",
  pct AS pctseqs, sum(len) OVER w / tot AS cum_pct, (sum(len) OVER w - len / 2) / tot AS y_text,
  CASE WHEN pct >= 0.1 THEN CASE WHEN genus_label = 'unclassified' THEN genus_label ELSE replace("Species", ' ', chr(10)) END ELSE '' END AS tax_label
FROM u WINDOW w AS (PARTITION BY seq_id ORDER BY "Kingdom" NULLS LAST, "Phylum" NULLS LAST, "Class" NULLS LAST, "Order" NULLS LAST, "Family" NULLS LAST, genus_label NULLS LAST, "Species" NULLS LAST ROWS UNBOUNDED PRECEDING)""")
def _(spark, sf):
    contig = table(spark, sf, "lineitem").selectExpr(
        "concat('S', l_suppkey) seq_id", "concat('x (taxid ', l_partkey, ')') taxon", "l_quantity length")
    dump = table(spark, sf, "part").selectExpr(
        "cast(if(p_partkey % 10 = 0, -p_partkey, p_partkey) as int) tax_id", "p_type kingdom", "p_brand phylum",
        "case when p_size % 3 <> 0 then concat('C', p_size % 3) else '' end class", "concat('O', p_size % 4) `order`",
        "concat('F', p_size % 5) family", "case when p_size % 7 <> 0 then split_part(p_name, ' ', 2) else '' end genus",
        "p_name species")
    return TX.contig_abundance(contig, dump)


def _profile_sql(ranks: str, keys: str, label: str) -> str:
    order = ", ".join(f"{r} NULLS LAST" for r in ranks.split(", "))
    return f"""
WITH {COUNTS}, {TAX}, {SAMPLES}, t AS (SELECT sample, CAST(sum(numseqs) AS DOUBLE) AS tot FROM counts WHERE numseqs > 0 GROUP BY 1),
m AS (SELECT c.sample, s.grp, c.numseqs, t.tot, x.Kingdom, x.Phylum, x.Class, x."Order", x.Family,
  CASE WHEN x.Genus IS NULL THEN {{genus}} ELSE x.Genus END AS Genus, coalesce(x.Species, 'unclassified') AS Species
  FROM counts c JOIN t USING (sample) LEFT JOIN tax x ON c.taxon = x.taxon LEFT JOIN samples s ON c.sample = s.sample),
g AS (SELECT {keys}, {ranks}, tot, CAST(sum(numseqs) AS DOUBLE) AS n FROM m GROUP BY ALL)
SELECT {keys}, {ranks}, n / tot AS pctseqs, sum(n) OVER w / tot AS cum_pct, (sum(n) OVER w - n / 2) / tot AS y_text,
  CASE WHEN n / tot >= 0.005 THEN {label} ELSE '' END AS tax_label, CAST(tot AS BIGINT) AS total
FROM g WINDOW w AS (PARTITION BY {keys} ORDER BY {order} ROWS UNBOUNDED PRECEDING)"""


@query("abundance_profile_genus", _profile_sql(
    'Kingdom, Phylum, Class, "Order", Family, Genus', "sample", "CASE WHEN Genus LIKE '%unclassified%' THEN 'unclassified' ELSE Genus END"
).format(genus="x.Family || chr(10) || 'unclassified'"))
def _(spark, sf):
    return TX.abundance_profile(counts(spark, sf), tax(spark, sf), level="Genus", label="plain", label_from=0.005)


@query("abundance_profile_species_by_group", _profile_sql(
    'Kingdom, Phylum, Class, "Order", Family, Genus, Species', "sample, grp", "Genus").format(genus="'unclassified'"))
def _(spark, sf):
    return TX.abundance_profile(counts(spark, sf), tax(spark, sf), samples(spark, sf), "Species", group="grp", label_from=0.005)


def taxonomy_hits(spark, sf):
    return table(spark, sf, "lineitem").join(table(spark, sf, "part"), F.col("l_partkey") == F.col("p_partkey")).selectExpr(
        "concat('T', l_orderkey) qaccver", "l_discount bitscore", "l_tax pident", "cast(l_linenumber as bigint) qstart",
        "cast(l_linenumber + l_suppkey % 3 as bigint) qend", "cast(4 as bigint) qlen", "l_quantity evalue",
        "p_type kingdom", "p_brand phylum", "p_type class", "p_type `order`", "p_type family", "p_type genus", "p_name species")


_ASSIGN = """h AS (SELECT 'T' || l_orderkey AS qaccver, l_discount AS bitscore, l_tax AS pident, CAST(l_suppkey % 3 AS DOUBLE) / 4 AS span, l_quantity AS evalue, p_name AS species
  FROM lineitem JOIN part ON l_partkey = p_partkey),
r AS (SELECT *, rank() OVER (PARTITION BY qaccver ORDER BY bitscore DESC, pident DESC, span DESC, evalue) AS k FROM h),
n AS (SELECT qaccver, species, bitscore, pident, evalue, count(*) AS spwt FROM r WHERE k = 1 GROUP BY ALL),
a AS (SELECT *, row_number() OVER (PARTITION BY qaccver ORDER BY spwt DESC, species) AS o FROM n)"""


@query("assign_taxonomy", f"""WITH {_ASSIGN} SELECT qaccver, species AS "Species", bitscore, pident, evalue, spwt FROM a WHERE o = 1""")
def _(spark, sf):
    out = TX.assign_taxonomy(taxonomy_hits(spark, sf), mode="deterministic")
    return out.select("qaccver", "Species", "bitscore", "pident", "evalue", "spwt")


@query("replace_taxonomy", f"""
WITH {_ASSIGN}, {COUNTS} SELECT sample, sum(numseqs)::BIGINT AS kept FROM counts WHERE taxon IN (SELECT qaccver FROM a) GROUP BY sample""")
def _(spark, sf):
    kept, _tax = TX.replace_tax(counts(spark, sf), TX.assign_taxonomy(taxonomy_hits(spark, sf), mode="deterministic"))
    return kept.groupBy("sample").agg(F.sum("numseqs").alias("kept"))


_CLASSES = {"Genus": {"bolt": "g1", "gear": "g2"}, "Family": {"F1": "f1", "F2": "f1"}, "Class": {"C2": "c2"}, "Phylum": {"Brand#1": "p1", "Brand#11": "p1"}}


@query("classify_hierarchy", f"""
WITH {TAX}, d AS (SELECT DISTINCT Kingdom, Phylum, Class, "Order", Family, Genus FROM tax),
c AS (SELECT *, CASE WHEN Genus LIKE '%bolt' THEN 'g1' WHEN Genus LIKE '%gear' THEN 'g2' WHEN Family IN ('F1', 'F2') THEN 'f1'
  WHEN Class = 'C2' THEN 'c2' WHEN Phylum IN ('Brand#1', 'Brand#11') THEN 'p1' ELSE 'gray' END AS kind FROM d)
SELECT Kingdom, Phylum, Class, "Order", Family, Genus, kind, (row_number() OVER (PARTITION BY kind ORDER BY Kingdom NULLS LAST, Phylum NULLS LAST,
  Class NULLS LAST, "Order" NULLS LAST, Family NULLS LAST, Genus NULLS LAST) - 1) % 3 + 1 AS shade FROM c""")
def _(spark, sf):
    return TX.classify_taxa(tax(spark, sf), _CLASSES)


@query("category_members", """
WITH k AS (SELECT DISTINCT p_type AS rank1, p_brand AS rank2 FROM part),
c AS (SELECT *, CASE WHEN rank1 IN ('ECONOMY', 'PROMO') THEN rank1 ELSE 'other' END AS category FROM k)
SELECT rank1, rank2, category, CASE rank1 WHEN 'ECONOMY' THEN 'c1' WHEN 'PROMO' THEN 'c2' END AS color,
  count(*) OVER (PARTITION BY category) AS n_members, row_number() OVER (PARTITION BY category ORDER BY rank1, rank2) AS member FROM c""")
def _(spark, sf):
    kegg = table(spark, sf, "part").selectExpr("p_type rank1", "p_brand rank2")
    return TX.classify_functions(kegg, {"ECONOMY": "c1", "PROMO": "c2"}, 2)


# ---- read and library quality ---------------------------------------------------------------

_LOG = """g AS (SELECT 'U' || user_id || '_x.log' AS logfn, event_type || CASE WHEN event_id % 2 = 0 THEN ' pair1' ELSE ' pair2' END AS handlerfoo,
  CAST(floor(value / 50) AS DOUBLE) AS count, CAST(event_id AS VARCHAR) AS description, event_id FROM events)"""


def trim_log(spark, sf):
    return table(spark, sf, "events").selectExpr(
        "concat('U', user_id, '_x.log') logfn", "concat(event_type, case when event_id % 2 = 0 then ' pair1' else ' pair2' end) handlerfoo",
        "cast(floor(value / 50) as double) count", "cast(event_id as string) description", "event_id")


@query("trim_stats", f"""
WITH {_LOG}, r AS (SELECT split_part(logfn, '_', 1) AS seq_id, regexp_replace(handlerfoo, 'pair[12]', 'pair') AS countType, count, description, event_id FROM g)
SELECT seq_id, countType, count, arg_min(description, event_id) AS description FROM r GROUP BY 1, 2, 3""")
def _(spark, sf):
    return Q.trim_stats(trim_log(spark, sf), order=["event_id"])


@query("trim_stats_compat", f"""
WITH {_LOG}, r AS (SELECT split_part(logfn, '_', 1) AS seq_id, regexp_replace(handlerfoo, 'pair[12]', 'pair') AS countType, count, description, event_id FROM g)
SELECT arg_min(seq_id, event_id) AS seq_id, countType, count, arg_min(description, event_id) AS description FROM r GROUP BY 2, 3""")
def _(spark, sf):
    return Q.trim_stats(trim_log(spark, sf), compat=True, order=["event_id"])


_WIDE = f"""{STAGES}, w AS (SELECT seq_id AS "ID", max(count) FILTER (WHERE countType = 'raw pair') AS raw, max(count) FILTER (WHERE countType = 'trimmed pair') AS trimmed,
  max(count) FILTER (WHERE countType = 'final pair') AS final FROM stages WHERE countType NOT LIKE '%mouse%' GROUP BY 1)"""


@query("survival", f"""
WITH {_WIDE} SELECT "ID", 'Trimmed' AS type, (raw - trimmed) / raw AS perc FROM w UNION ALL
SELECT "ID", 'Host', (trimmed - final) / raw FROM w UNION ALL SELECT "ID", 'Clean', final / raw FROM w""")
def _(spark, sf):
    return Q.read_survival(stages(spark, sf), F.col("seq_id"))


@query("survival_counts", f"""
WITH {_WIDE} SELECT "ID", 'raw' AS "readType", raw AS cnt, 1e6 AS low_line, 5e6 AS high_line FROM w UNION ALL SELECT "ID", 'final', final, 1e6, 5e6 FROM w""")
def _(spark, sf):
    return Q.read_counts(stages(spark, sf), F.col("seq_id"))


@query("stage_summary", f"""
WITH {_WIDE} SELECT avg(final) AS final_mean, median(final) AS final_median, avg(raw) AS raw_mean, median(raw) AS raw_median FROM w""")
def _(spark, sf):
    return Q.run_summary(stages(spark, sf))


_LIBRARY = f"""{COUNTS}, {SAMPLES}, a AS (SELECT sample, sum(numseqs)::BIGINT AS after FROM counts GROUP BY 1),
q AS (SELECT s.sample AS samplename, libraryname, reads_in, reads_out, after, CAST(after AS DOUBLE) / reads_in * 100.0 AS high, CAST(reads_out AS DOUBLE) / reads_in * 100.0 AS filt,
  CAST(regexp_extract(libraryname, '[0-9]+') AS DOUBLE) AS liborder FROM samples s LEFT JOIN a ON s.sample = a.sample)"""


def quality_table(spark, sf):
    return Q.library_quality(counts(spark, sf), samples(spark, sf).withColumnRenamed("sample", "samplename"))


@query("library_quality", f"""
WITH {_LIBRARY} SELECT samplename, libraryname, reads_in, liborder, 'highQualSurvPerc' AS percentage, high AS value FROM q
UNION ALL SELECT samplename, libraryname, reads_in, liborder, 'filterSurPerc', filt FROM q""")
def _(spark, sf):
    return Q.library_quality_long(quality_table(spark, sf))


@query("library_sizes", f"""
WITH {SAMPLES} SELECT libraryname, count(*) AS "sampleN", CAST(regexp_extract(libraryname, '[0-9]+') AS DOUBLE) AS liborder FROM samples GROUP BY ALL""")
def _(spark, sf):
    return Q.library_sizes(samples(spark, sf))


@query("library_box", f"""
WITH {_LIBRARY}, b AS (SELECT libraryname, quantile_cont(filt, 0.25) AS q1, quantile_cont(filt, 0.5) AS m, quantile_cont(filt, 0.75) AS q3 FROM q GROUP BY 1),
f AS (SELECT q.libraryname, filt AS x, q1, m, q3, filt >= q1 - (q3 - q1) * 1.5 AND filt <= q3 + (q3 - q1) * 1.5 AS inside FROM q JOIN b USING (libraryname))
SELECT libraryname, round(max(q1), 6) AS q1, round(max(m), 6) AS median, round(max(q3), 6) AS q3, round(min(x) FILTER (WHERE inside), 6) AS lower,
  round(max(x) FILTER (WHERE inside), 6) AS upper, count(*) FILTER (WHERE NOT inside) AS n_outliers, count(*) AS n FROM f GROUP BY 1""")
def _(spark, sf):
    return rounded(box_stats(quality_table(spark, sf), ["libraryname"], "filterSurPerc"), 6)


@query("assembly_metrics_long", """
WITH m AS (SELECT 'DFI-' || c_custkey AS seq_id, c_acctbal, c_nationkey FROM customer WHERE c_custkey % 3 <> 0)
SELECT seq_id, 'N50' AS stat, CAST(c_nationkey AS VARCHAR) AS value FROM m UNION ALL SELECT seq_id, 'contigs', CAST(c_nationkey + 1 AS VARCHAR) FROM m""")
def _(spark, sf):
    quast = table(spark, sf, "customer").selectExpr(
        "concat(case when c_custkey % 3 <> 0 then 'DFI_' else 'xx_' end, c_custkey, '.spades.contigs') Assembly",
        "c_nationkey N50", "c_nationkey + 1 contigs")
    return Q.metrics_long(quast)


# ---- assemblies -----------------------------------------------------------------------------

_TYPED = f"""{CONTIGS}, ty AS (SELECT isolate, path, contig, length, depth, CASE WHEN path LIKE '%hybridAssemblyTrim%' THEN 'moretrimmed' WHEN path LIKE '%hybridAssembly%' THEN 'noTrim' ELSE 'flyeLong' END AS type,
  CASE WHEN circular LIKE '%true%' THEN 'Yes' ELSE 'No' END AS circ FROM contigs),
typed AS (SELECT isolate, path, contig, length, depth, type, CASE WHEN type <> 'flyeLong' THEN circ END AS circular, 'No' AS guppy FROM ty)"""
_FLYE = """flye AS (SELECT DISTINCT CASE WHEN type = 'flyeLong' AND length % 10 <> 0 THEN contig ELSE 'old_' || contig END AS contig, isolate, 'flyeLong' AS type, 2 * max(length) AS length, CASE WHEN max(length) % 2 = 0 THEN 'Yes' ELSE 'No' END AS circular, 0.5 AS depth
  FROM typed GROUP BY 1, 2)"""
_POLISHED = """polished AS (SELECT CASE WHEN length % 7 = 0 THEN contig ELSE 'old_' || contig END AS contig, isolate, max(length) + 1 AS pilon_length, 'pilon/' || isolate AS pilon_path FROM typed GROUP BY 1, 2)"""
_GENOME = """cls AS (SELECT CASE WHEN c_custkey % 4 = 0 THEN 'J' ELSE 'I' END || c_custkey AS isolate, unnest(CASE WHEN length(CAST(c_custkey AS VARCHAR)) % 2 = 1 THEN ['flye', 'hybrid', 'hybridTrim', 'pilon'] ELSE ['flye', 'hybrid', 'hybridTrim'] END) AS user_genome,
  c_mktsegment AS classification, 'ref' || c_nationkey AS fastani_reference FROM customer),
genome AS (SELECT user_genome, isolate, CASE user_genome WHEN 'flye' THEN 'flyeLong' WHEN 'pilon' THEN 'flyeLong' WHEN 'hybrid' THEN 'noTrim' ELSE 'moretrimmed' END AS type, classification, fastani_reference FROM cls),
quality AS (SELECT 'I' || c_custkey AS isolate, 'hybrid' AS name, 'noTrim' AS type, CAST(c_nationkey AS DOUBLE) AS completeness FROM customer)"""
_MERGED = f"""{_TYPED}, {_FLYE}, {_POLISHED}, {_GENOME},
u AS (SELECT isolate, path, contig, length, depth, type, circular, guppy FROM typed WHERE type <> 'flyeLong' UNION ALL
  SELECT t.isolate, t.path, t.contig, f.length, f.depth, t.type, f.circular, t.guppy FROM typed t LEFT JOIN flye f ON t.contig = f.contig AND t.isolate = f.isolate WHERE t.type = 'flyeLong'),
j AS (SELECT u.*, p.pilon_length, p.pilon_path, g.user_genome, g.classification, g.fastani_reference, q.completeness AS "Completeness" FROM u LEFT JOIN polished p ON u.contig = p.contig AND u.isolate = p.isolate
  LEFT JOIN genome g ON u.isolate = g.isolate AND u.type = g.type LEFT JOIN quality q ON q.isolate = g.isolate AND q.name = g.user_genome AND q.type = g.type),
k AS (SELECT isolate, count(*) AS n_type FROM (SELECT DISTINCT isolate, type, user_genome FROM j) GROUP BY 1),
merged AS (SELECT j.* FROM j JOIN k USING (isolate) WHERE n_type = 1 OR user_genome <> 'flye')"""
_VERDICT = _MERGED + """,
pl AS (SELECT *, CASE WHEN pilon_path IS NULL THEN length ELSE pilon_length END AS int_length, coalesce(pilon_path, path) AS int_path FROM merged),
v AS (SELECT int_path, count(*) AS "nContigs", CASE WHEN count(int_length) = count(*) THEN CAST(sum(int_length) AS BIGINT) END AS "totalLength",
  CASE WHEN count(circular) = count(*) THEN count(*) FILTER (WHERE circular = 'Yes') END AS "nCircular", min(isolate) AS isolate, min(type) AS type,
  min("Completeness") AS "Completeness", count(DISTINCT type) > 1 AS mixed FROM pl GROUP BY 1),
verdict AS (SELECT *, CASE WHEN "nCircular" >= 1 AND "nContigs" <= 5 THEN 'Yes' WHEN "nCircular" >= 1 AND "nContigs" - "nCircular" <= 2 AND "nContigs" < 8 THEN 'Yes' ELSE 'No' END AS "goodAssembly" FROM v)"""


def typed_contigs(spark, sf):
    return AS.assembly_contigs(contigs(spark, sf).drop("isolate"))


def merged_contigs(spark, sf):
    typed = typed_contigs(spark, sf)
    # Contigs the other tables don't know have another name there.
    other_name = F.concat(F.lit("old_"), "contig").alias("contig")
    flye = typed.groupBy(F.when(F.expr("type = 'flyeLong' and length % 10 <> 0"), F.col("contig")).otherwise(other_name).alias("contig"), "isolate").agg(F.max("length").alias("m"))
    flye = flye.selectExpr("contig", "isolate", "'flyeLong' type", "2 * m length", "case when m % 2 = 0 then 'Yes' else 'No' end circular", "0.5d depth")
    polished = typed.groupBy(F.when(F.expr("length % 7 = 0"), F.col("contig")).otherwise(other_name).alias("contig"), "isolate").agg((F.max("length") + 1).alias("pilon_length"))
    polished = polished.withColumn("pilon_path", F.concat(F.lit("pilon/"), "isolate"))
    customer = table(spark, sf, "customer")
    classes = customer.selectExpr(
        "concat(if(c_custkey % 4 = 0, 'J', 'I'), c_custkey) isolate",
        "explode(if(length(c_custkey) % 2 = 1, array('flye', 'hybrid', 'hybridTrim', 'pilon'), array('flye', 'hybrid', 'hybridTrim'))) user_genome",
        "c_mktsegment classification", "concat('ref', c_nationkey) fastani_reference")
    quality = customer.selectExpr(
        "concat('I', c_custkey) isolate", "'hybrid' Name", "cast(c_nationkey as double) Completeness", "0d Contamination",
        "0L Genome_Size", "0d GC_Content", "0L Total_Coding_Sequences")
    return AS.merge_assemblies(typed, flye, polished, AS.genome_types(classes, "user_genome"), AS.genome_types(quality, "Name"))


@query("assembly_contigs", f"""WITH {_TYPED} SELECT isolate, path, contig, length, type, circular, guppy FROM typed""")
def _(spark, sf):
    return typed_contigs(spark, sf).select("isolate", "path", "contig", "length", "type", "circular", "guppy")


@query("assembly_merge", f"""WITH {_MERGED} SELECT isolate, path, contig, CAST(length AS BIGINT) AS length, type, circular, CAST(pilon_length AS BIGINT) AS pilon_length, pilon_path, user_genome, classification, "Completeness" FROM merged""")
def _(spark, sf):
    return merged_contigs(spark, sf).select("isolate", "path", "contig", "length", "type", "circular", "pilon_length", "pilon_path",
                                            "user_genome", "classification", "Completeness")


@query("assembly_verdict", f"""WITH {_VERDICT} SELECT int_path, "nContigs", "totalLength", "nCircular", isolate, type, "goodAssembly" FROM verdict""")
def _(spark, sf):
    out = AS.assembly_verdict(merged_contigs(spark, sf))
    return out.select("int_path", "nContigs", "totalLength", "nCircular", "isolate", "type", "goodAssembly")


@query("good_isolates", f"""WITH {_VERDICT} SELECT DISTINCT isolate FROM verdict WHERE "goodAssembly" = 'Yes' AND isolate IS NOT NULL""")
def _(spark, sf):
    return AS.good_isolates(AS.assembly_verdict(merged_contigs(spark, sf)))


_STATS = """stats AS (SELECT isolate, median(length) AS median, avg(length) AS mean, max(length) AS max, count(*) AS n, CAST(sum(length) AS BIGINT) AS total,
  max(length) FILTER (WHERE cum >= tot * 0.5) AS "N50" FROM (SELECT *, sum(length) OVER (PARTITION BY isolate ORDER BY length DESC ROWS UNBOUNDED PRECEDING) AS cum,
  sum(length) OVER (PARTITION BY isolate) AS tot FROM contigs) GROUP BY isolate)"""


def long_lengths(spark, sf):
    return contigs(spark, sf).select("isolate", "length")


@query("length_stats", f"WITH {CONTIGS}, {_STATS} SELECT *, 'Nanopore' AS \"seqType\" FROM stats")
def _(spark, sf):
    return AS.length_stats(long_lengths(spark, sf), ["isolate"], "Nanopore")


@query("length_stats_absent", f"""
WITH {CONTIGS} SELECT DISTINCT isolate, 'Illumina' AS "seqType", CAST(NULL AS VARCHAR) AS type, CAST(NULL AS BIGINT) AS n FROM contigs""")
def _(spark, sf):
    return AS.empty_stats(long_lengths(spark, sf), "Illumina").select("isolate", "seqType", "type", "n")


@query("relative_depth", f"""
WITH {CONTIGS}, m AS (SELECT isolate, arg_max(depth, (length, contig, depth)) AS ref FROM contigs GROUP BY 1)
SELECT contig, length, CASE WHEN path LIKE '%Trim%' THEN 'Yes' ELSE 'No' END AS circular, isolate, 'flyeLong' AS type, depth / ref AS depth FROM contigs JOIN m USING (isolate)""")
def _(spark, sf):
    info = contigs(spark, sf).selectExpr("contig seq_name", "length", "depth cov", "if(path like '%Trim%', 'Y', 'N') circ", "isolate")
    return AS.relative_depth(info)


@query("isolate_report", f"""
WITH {_VERDICT}, {_STATS}, m AS (SELECT 'I' || o_custkey AS isolate, CAST(count(*) AS DOUBLE) AS number_of_reads FROM orders GROUP BY 1)
SELECT int_path AS path, v.isolate, "goodAssembly", number_of_reads, s.n AS nano_n, s."N50" AS "nano_N50", x.n AS illu_n_contig
FROM verdict v LEFT JOIN m ON v.isolate = m.isolate LEFT JOIN stats s ON v.isolate = s.isolate
LEFT JOIN (SELECT isolate, type, count(*) AS n FROM typed GROUP BY 1, 2) x ON v.isolate = x.isolate AND v.type = x.type""")
def _(spark, sf):
    verdict = AS.assembly_verdict(merged_contigs(spark, sf))
    report = table(spark, sf, "orders").groupBy(F.concat(F.lit("I"), "o_custkey").alias("isolate")).agg(F.count(F.lit(1)).cast("string").alias("dataset"))
    metrics = AS.read_metrics(report.withColumn("Metrics", F.lit("number_of_reads")))
    nano = AS.length_stats(long_lengths(spark, sf), ["isolate"], "Nanopore")
    illu = AS.length_stats(typed_contigs(spark, sf), ["isolate", "type"], "Illumina")
    out = AS.isolate_report(verdict, metrics, nano, illu)
    return out.select("path", "isolate", "goodAssembly", "number_of_reads", "nano_n", "nano_N50", "illu_n_contig")


@query("length_histogram", f"""
WITH {CONTIGS}, l AS (SELECT 'Nanopore' AS "seqType", isolate, length FROM contigs UNION ALL SELECT 'Illumina', isolate, length + 1 FROM contigs),
v AS (SELECT "seqType", isolate, CASE WHEN isolate IN (SELECT isolate FROM contigs WHERE depth = 50) THEN 'Good' ELSE 'Nah' END AS "goodAssembly", log10(length) AS x FROM l WHERE length > 0),
s AS (SELECT isolate, min(x) AS lo, max(x) AS hi FROM v GROUP BY 1)
SELECT "seqType", isolate, "goodAssembly", CAST(coalesce(least(floor((x - lo) / nullif(hi - lo, 0) * 120), 119), 0) AS BIGINT) AS bin, count(*) AS n
FROM v JOIN s USING (isolate) GROUP BY 1, 2, 3, 4""")
def _(spark, sf):
    lengths = long_lengths(spark, sf)
    good = contigs(spark, sf).filter("depth = 50").select("isolate")
    return AS.length_histogram(lengths, lengths.withColumn("length", F.col("length") + 1), good)


# ---- clinical -------------------------------------------------------------------------------

def _pad(text: str, width: int = 3) -> str:
    return f"lpad({text}, CAST(greatest({width}, length({text})) AS INTEGER), '0')"



def clinical_exports(spark, sf):
    """Four cohort exports cut from the orders table; the order key stands for the file position."""
    o = table(spark, sf, "orders").withColumns({
        "subj": F.col("o_custkey"), FILE_ORDER: F.col("o_orderkey"),
        "mrn": F.when(F.col("o_orderkey") % 3 == 0, F.concat(F.lit("M"), F.col("o_custkey"))).otherwise(""),
        "sid": F.when(F.col("o_orderkey") % 5 != 0, F.concat_ws(".", F.lit("LT"), F.col("o_custkey"), F.col("o_orderkey"))).otherwise(""),
        "day": F.when(F.col("o_orderstatus") == "P", "bad date").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")),
    })
    study = F.concat(F.lit("st"), "subj")
    blank = F.when(F.col("o_orderkey") % 4 == 0, study).otherwise("")
    kind = F.col("o_orderpriority").substr(1, 1)
    lt = o.filter(kind == "1").select(F.concat(study, F.lit(",1")).alias("record_id"), "mrn", F.col("sid").alias("sample_id"),
                                      F.col("day").alias("date_collected"), F.lit("Stool").alias("sample_type"), FILE_ORDER)
    events = o.filter(kind == "2").select(F.concat(study, F.lit(",2")).alias("record_id"), "mrn", F.col("day").alias("event_date"),
                                          F.when(F.col("o_orderstatus") == "F", "Liver Transplant").otherwise("Visit").alias("event_description"), FILE_ORDER)
    micu = o.filter(kind == "3").select(blank.alias("studyid"), "mrn", F.col("sid").alias("sampleid"), F.col("day").alias("stool"), FILE_ORDER)
    ht = o.filter(kind == "4").select(blank.alias("study_id"), "mrn", F.col("sid").alias("sample_id"), F.col("day").alias("ohtdate"),
                                      F.col("day").alias("date_collected"), FILE_ORDER)
    ld = o.filter(kind == "5").select(blank.alias("subject_id"), "mrn", F.col("sid").alias("sample_id"), F.col("day").alias("collection_date"),
                                      F.col("o_orderstatus").alias("sample_type"), FILE_ORDER)
    return lt, events, micu, ht, ld


def _harmonised(across: bool) -> str:
    def fill(col, order="k", by=""):
        part = f"PARTITION BY {by} " if by and not across else ""
        return f"last_value({col} IGNORE NULLS) OVER ({part}ORDER BY {order} ROWS UNBOUNDED PRECEDING)"

    lt_order = "study NULLS LAST, mrn NULLS LAST, k" if across else "mrn NULLS LAST, k"
    return f"""
x AS (SELECT o_orderkey AS k, o_orderstatus AS st, 'st' || o_custkey AS study, CASE WHEN o_orderkey % 4 = 0 THEN 'st' || o_custkey END AS sometimes,
  CASE WHEN o_orderkey % 3 = 0 THEN 'M' || o_custkey END AS mrn, CASE WHEN o_orderkey % 5 <> 0 THEN 'LT.' || o_custkey || '.' || o_orderkey END AS sid,
  o_custkey AS subj, CASE WHEN o_orderstatus <> 'P' THEN CAST(o_orderdate AS DATE) END AS day, o_orderpriority[1] AS kind FROM orders),
lt AS (SELECT study AS studyid, {fill('mrn', lt_order, 'study')} AS mrn, sid, day FROM x WHERE kind = '1'),
ev AS (SELECT study AS studyid, {fill('mrn', 'k', 'study')} AS mrn, day AS date_transplant, st FROM x WHERE kind = '2'),
ev2 AS (SELECT DISTINCT studyid, mrn, date_transplant FROM ev WHERE st = 'F'),
l AS (SELECT coalesce(lt.studyid, ev2.studyid) AS studyid, coalesce(lt.mrn, ev2.mrn) AS mrn, sid, day, date_transplant, CASE WHEN lt.studyid IS NOT NULL THEN 'Stool' END AS sampletype, 'LiverTransplant' AS db
  FROM (SELECT * FROM lt WHERE sid IS NOT NULL) lt FULL JOIN ev2 ON lt.studyid IS NOT DISTINCT FROM ev2.studyid AND lt.mrn IS NOT DISTINCT FROM ev2.mrn),
s AS (SELECT *, last_value(sometimes IGNORE NULLS) OVER (PARTITION BY kind ORDER BY k ROWS UNBOUNDED PRECEDING) AS studyid FROM x WHERE kind IN ('3', '4', '5')),
f AS (SELECT kind, studyid, sid, day, st, last_value(mrn IGNORE NULLS) OVER w AS mrn, last_value(day IGNORE NULLS) OVER w AS tday FROM s
  WINDOW w AS (PARTITION BY kind{'' if across else ', studyid'} ORDER BY k ROWS UNBOUNDED PRECEDING)),
a AS (SELECT studyid, mrn, sid, day, date_transplant, sampletype, db FROM l
  UNION ALL SELECT studyid, mrn, sid, day, NULL, 'Stool', 'MICU' FROM f WHERE kind = '3'
  UNION ALL SELECT studyid, mrn, sid, day, tday, 'Stool', 'HeartTransplant' FROM f WHERE kind = '4' AND sid IS NOT NULL
  UNION ALL SELECT studyid, mrn, sid, day, NULL, CASE WHEN st = '1' THEN 'Stool' ELSE 'Other' END, 'LiverDisease' FROM f WHERE kind = '5' AND sid IS NOT NULL),
clin AS (SELECT studyid, mrn, coalesce(sid, CASE WHEN db = 'MICU' THEN '' END) AS sampleid, CAST(day AS VARCHAR) AS date_collected, CAST(date_transplant AS VARCHAR) AS date_transplant, sampletype, db,
  CASE WHEN sid IS NOT NULL THEN 'LT-' || {_pad("split_part(sid, '.', 2)")} || '.' || {_pad("split_part(sid, '.', 3)", 2)}
    WHEN db = 'MICU' THEN '- NA.NA' ELSE 'NA- NA.NA' END AS "ID" FROM a)"""


_CLIN_COLS = ["studyid", "mrn", "sampleid", "date_collected", "date_transplant", "sampletype", "db", "ID"]


def harmonised(spark, sf, across=False):
    out = CL.harmonise_clinical(*clinical_exports(spark, sf), across=across)
    return out.withColumns({c: F.col(c).cast("string") for c in ("date_collected", "date_transplant")}).select(*_CLIN_COLS)


@query("harmonise_clinical", f"WITH {_harmonised(False)} SELECT * FROM clin")
def _(spark, sf):
    return harmonised(spark, sf)


@query("harmonise_clinical_across_subjects", f"WITH {_harmonised(True)} SELECT * FROM clin")
def _(spark, sf):
    return harmonised(spark, sf, across=True)


@query("subject_lookup", """
SELECT DISTINCT '200101-UC-' || lpad(CAST(o_custkey % 900 AS VARCHAR), 3, '0') || '.07' AS seq_id, 'UC-' || lpad(CAST(o_custkey % 900 AS VARCHAR), 3, '0') || '.07' AS "ID" FROM orders""")
def _(spark, sf):
    stats = table(spark, sf, "orders").select(F.format_string("200101-UC-%03d.07", F.col("o_custkey") % 900).alias("seq_id"))
    return CL.subject_lookup(stats)


@query("harmonise_ids", """
SELECT c_custkey, 'UC-' || CASE WHEN c_custkey < 1000 THEN lpad(CAST(c_custkey AS VARCHAR), 3, '0') ELSE CAST(c_custkey AS VARCHAR) END || '.' || lpad(CAST(c_nationkey AS VARCHAR), 2, '0') AS id FROM customer""")
def _(spark, sf):
    return table(spark, sf, "customer").select("c_custkey", padded_id(F.lit("UC"), "c_custkey", "c_nationkey").alias("id"))


_KEY = {k: f"'UC-' || {_pad(f'CAST({k} AS VARCHAR)')} || '.05'" for k in ("s_suppkey", "c_custkey", "s_suppkey // 2")}
_AMPLICON = f"""
s AS (SELECT 'P' || s_suppkey || '_UC.' || {_pad("CAST(s_suppkey // 2 AS VARCHAR)")} || '.05' AS m, s_acctbal AS r, {_KEY["s_suppkey // 2"]} AS id FROM supplier WHERE s_nationkey < 20),
a AS (SELECT m, id FROM (SELECT *, rank() OVER (PARTITION BY id ORDER BY r DESC) AS k FROM s) WHERE k = 1)"""
_METABOLITES = f"""
b AS (SELECT DISTINCT mid, id FROM (SELECT 'UC_' || {_pad("CAST(c_custkey AS VARCHAR)")} || '_05ab' AS mid, {_KEY["c_custkey"]} AS id FROM customer
  UNION ALL SELECT 'U_C_003_05', 'UC-003.05' FROM supplier UNION ALL SELECT 'UC _' || {_pad("CAST(s_suppkey AS VARCHAR)")} || '_05', {_KEY["s_suppkey"]} FROM supplier))"""


def _padded(key: str) -> str:
    return f"lpad({key}, greatest(3, length(cast({key} as string))), '0')"


def _amplicon(spark, sf):
    return table(spark, sf, "supplier").selectExpr(
        f"concat('P', s_suppkey, if(s_nationkey < 20, '_UC.', '_CC.'), {_padded('s_suppkey div 2')}, '.05') MiSeq_id",
        "1L reads_in", "s_acctbal reads_out")


def _metabolites(spark, sf):
    bile = table(spark, sf, "customer").selectExpr(f"concat('UC_', {_padded('c_custkey')}, '_05ab') metabolomicsID")
    scfa = table(spark, sf, "supplier").selectExpr(
        f"explode(array('U_C_003_05', concat('UC _', {_padded('s_suppkey')}, '_05'))) metabolomicsID")
    return bile, scfa


@query("amplicon_lookup", f"""WITH {_AMPLICON} SELECT m AS "MiSeq_id", id AS "ID" FROM a""")
def _(spark, sf):
    return CL.amplicon_lookup(_amplicon(spark, sf))


@query("metabolite_lookup", f"""WITH {_METABOLITES} SELECT mid AS "metabolomicsID", id AS "ID" FROM b""")
def _(spark, sf):
    return CL.metabolite_lookup(*_metabolites(spark, sf))


@query("cross_lookup", f"""
WITH c AS (SELECT CASE WHEN c_custkey > 5 THEN {_KEY["c_custkey"]} ELSE 'LT-' || c_custkey END AS id, c_custkey, lower(c_mktsegment) AS sampletype FROM customer),
g AS (SELECT 's' || s_suppkey AS g, {_KEY["s_suppkey"]} AS id FROM supplier), {_AMPLICON}, {_METABOLITES},
j1 AS (SELECT coalesce(c.id, g.id) AS id, c_custkey, sampletype, g FROM c FULL JOIN g ON c.id = g.id),
j2 AS (SELECT coalesce(a.id, j1.id) AS id, m, c_custkey, sampletype, g FROM a FULL JOIN j1 ON a.id = j1.id)
SELECT coalesce(j2.id, b.id) AS "ID", m AS "MiSeq_id", c_custkey, sampletype, g AS "shotgunSeq_id", mid AS "metabolomicsID" FROM j2 FULL JOIN b ON j2.id = b.id""")
def _(spark, sf):
    clinical = table(spark, sf, "customer").selectExpr(
        f"if(c_custkey > 5, concat('UC-', {_padded('c_custkey')}, '.05'), concat('LT-', c_custkey)) ID", "c_custkey", "c_mktsegment sampletype")
    shotgun = table(spark, sf, "supplier").selectExpr("concat('s', s_suppkey) seq_id", f"concat('UC-', {_padded('s_suppkey')}, '.05') ID")
    return CL.cross_lookup(clinical, shotgun, _amplicon(spark, sf), *_metabolites(spark, sf))
