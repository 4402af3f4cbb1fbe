"""Loads of a run into the warehouse, written, read back and checked."""

from __future__ import annotations

from pyspark.sql import functions as F

from florametrics.plans import loads as L
from florametrics.plans import taxonomy as TX
from florametrics.session import scratch_path
from florametrics.sources import readers as R
from florametrics.sources import sinks as S
from florametrics_queries.bindings import table
from florametrics_queries.registry import query

# Every second nation's suppliers are on the lookup table under the library's name, the others under an older one.
_LIBRARIES = "l AS (SELECT CASE WHEN s_nationkey % 2 = 0 THEN 'S' ELSE 'old' END || s_suppkey AS seq_id FROM supplier)"


def lookup(spark, sf):
    return table(spark, sf, "supplier").selectExpr("concat(if(s_nationkey % 2 = 0, 'S', 'old'), s_suppkey) seq_id")


@query("load_read_level", f"""
WITH {_LIBRARIES}, r AS (SELECT 'S' || l_suppkey AS seq_id, l_linestatus AS uc, 'x (taxid ' || l_partkey || ')' AS taxon, l_partkey AS taxid FROM lineitem)
SELECT seq_id, uc, taxon, CAST(taxid AS INTEGER) AS taxid, count(*) AS numseqs, seq_id || '_R1.standard.txt' AS filename FROM r WHERE seq_id IN (SELECT seq_id FROM l) GROUP BY 1, 2, 3, 4""")
def _(spark, sf):
    reads = table(spark, sf, "lineitem").selectExpr(
        "concat('/run/S', l_suppkey, '_R1.standard.txt') filename", "l_linestatus uc", "concat('x (taxid ', l_partkey, ')') taxon",
        "concat('R', l_orderkey, '-', l_linenumber) read")
    return L.read_level_load(TX.taxon_counts(reads), lookup(spark, sf))


@query("load_abundance", f"""
WITH {_LIBRARIES}, b AS (SELECT 'S' || l_suppkey AS seq_id, l_partkey AS taxid, l_quantity AS reads, CASE WHEN l_returnflag = 'R' THEN l_tax END AS share FROM lineitem)
SELECT * FROM b WHERE seq_id IN (SELECT seq_id FROM l)""")
def _(spark, sf):
    """Two runs; only one of them has the share column."""
    li = table(spark, sf, "lineitem").selectExpr("concat('S', l_suppkey, '_R1') seq_id", "l_partkey taxonomy_id", "l_quantity reads", "l_tax share", "l_returnflag run")
    first, second = li.filter("run = 'R'").drop("run"), li.filter("run <> 'R'").drop("run", "share")
    return L.abundance_load(lookup(spark, sf), first, second)


@query("load_profiles", f"""
WITH {_LIBRARIES} SELECT 'S' || l_suppkey AS seq_id, CASE WHEN l_linenumber <> 1 THEN CAST(l_partkey AS DOUBLE) END AS taxid, l_discount AS relative_abundance
FROM lineitem WHERE 'S' || l_suppkey IN (SELECT seq_id FROM l)""")
def _(spark, sf):
    """The last part of a lineage is a number but for unnamed taxa."""
    profiles = table(spark, sf, "lineitem").selectExpr(
        "concat('S', l_suppkey, '_R1') seq_id", "if(l_linenumber <> 1, cast(l_partkey as string), 'unknown') taxid", "l_discount relative_abundance")
    return L.profile_load(lookup(spark, sf), profiles)


@query("load_run_tables", f"""
WITH {_LIBRARIES}, r AS (SELECT DISTINCT 'S' || l_suppkey AS seq_id, l_linestatus, l_partkey FROM lineitem WHERE 'S' || l_suppkey IN (SELECT seq_id FROM l))
SELECT 'reads' AS kind, seq_id, count(*) AS n FROM r GROUP BY 2
UNION ALL SELECT 'contigs', 'I' || o_custkey, count(*) FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 2""")
def _(spark, sf):
    """Read level and contigs through the warehouse; a table without rows becomes a snapshot."""
    path = scratch_path(spark, "warehouse")
    reads = table(spark, sf, "lineitem").selectExpr(
        "concat('/run/S', l_suppkey, '_R1.standard.txt') filename", "l_linestatus uc", "concat('x (taxid ', l_partkey, ')') taxon", "'r' read")
    li = table(spark, sf, "lineitem").join(table(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    contigs = li.selectExpr("concat('c', l_linenumber) contig", "concat('x (taxid ', l_partkey, ')') taxon", "l_quantity length",
                            "concat('I', o_custkey) seq_id", "'old' note")
    known = lookup(spark, sf)
    done = L.load_run({
        "reads": L.read_level_load(TX.taxon_counts(reads), known),
        "contigs": L.contig_load(contigs, ["seq_id", "contig", "taxon", "length"]),
        "none": known.filter("seq_id is null"),
    }, path, f"{path}-kept")
    back = [L.rows_per_library(S.restore(spark, f"{path}/{name}")).select(F.lit(name).alias("kind"), "seq_id", "n")
            for name, appended in done.items() if appended]
    left = L.rows_per_library(S.restore(spark, f"{path}-kept/none")).select(F.lit("none").alias("kind"), "seq_id", "n")
    return back[0].unionByName(back[1]).unionByName(left)


@query("read_alignment_lineages", """
SELECT 'R' || l_orderkey AS qaccver, l_quantity AS bitscore, 'G' || l_partkey || ', x' AS genus FROM lineitem""")
def _(spark, sf):
    """Alignments with their lineage as quoted CSV, the columns in an order of their own."""
    li = table(spark, sf, "lineitem").selectExpr(
        "concat('G', l_partkey, ', x') genus", "l_quantity bitscore", "l_linestatus other", "concat('R', l_orderkey) qaccver")
    path = scratch_path(spark, "lineages")
    S.write_csv(li, path)
    return R.read_blast_taxonomy(spark, path).select("qaccver", "bitscore", "genus")
