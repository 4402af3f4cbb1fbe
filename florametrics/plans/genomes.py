"""Isolate genomes: gene prevalence, annotation loads, marker genes, CRISPR regions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from florametrics.functions import case, extract, matches, member, paste, sub
from florametrics.operators.aggregates import collapse_by, count_by, first_by, sum_by
from florametrics.operators.joins import join_back, left_join_ns, natural_left, semi_ns
from florametrics.operators.reshape import unnest
from florametrics.sources.readers import isolate_from_folder, isolate_from_run, read_fasta, read_gene_table, read_gff

# Products that name no gene, locus tags.
UNNAMED_PRODUCTS = ["hypothetical protein", "putative protein"]
LOCUS_TAG = r"^[A-Z]+\_[0-9]+"


def gene_types(genes: DataFrame, isolates: DataFrame, unnamed=UNNAMED_PRODUCTS) -> DataFrame:
    """Genes per isolate with how many isolates carry them: all (Core), one (Unique) or some (Shared)."""
    chosen = isolates.select("seq_id").distinct()
    n_chosen = chosen.agg(F.count(F.lit(1)).alias("__total"))
    named = semi_ns(genes, chosen, "seq_id").filter(member("product", unnamed, negate=True))
    per_isolate = count_by(named, ["seq_id", "product"], "isoPdtCnt")
    totals = sum_by(per_isolate, ["seq_id"], "isoPdtCnt", "totalGenes")
    prevalence = join_back(count_by(per_isolate, ["product"], "pdtCnt"), n_chosen, [])
    prevalence = prevalence.withColumn("gene_type", case(
        (F.col("pdtCnt") == F.col("__total"), "Core"), (F.col("pdtCnt") == 1, "Unique"), default="Shared",
    )).drop("__total")
    return join_back(join_back(per_isolate, totals, ["seq_id"]), prevalence, ["product"])


def gene_annotations(table: DataFrame) -> DataFrame:
    """Annotation rows other than the bare gene, with the isolate of their folder."""
    return table.filter(F.col("ftype") != "gene").withColumn("seq_id", isolate_from_folder())


def feature_locations(gff: DataFrame) -> DataFrame:
    return gff.filter(F.col("type") != "gene").withColumn("seq_id", isolate_from_folder())


def _sequences(fasta: DataFrame, out: str, suffix: str) -> DataFrame:
    # Records repeating a header in one file are one sequence, joined in file order.
    whole = collapse_by(fasta, ["filename", "seq_name"], "sequence", ["file_order"], out=out)
    return whole.select(
        F.concat(F.lit(">"), F.col("seq_name")).alias("seq_name"), out,
        extract("seq_name", LOCUS_TAG).alias("locus_tag"),
        sub("seq_name", LOCUS_TAG + " ", "").alias("product"),
        sub("filename", suffix, "").alias("filename"),
    )


def gene_sequences(nucleotides: DataFrame, proteins: DataFrame) -> DataFrame:
    """Nucleotide records with their protein, first record per locus tag."""
    joined = natural_left(
        _sequences(nucleotides, "nuc_sequence", ".ffn"), _sequences(proteins, "prot_sequence", ".faa")
    )
    return first_by(joined, ["locus_tag"], ["filename", "seq_name"])


def genome_tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The annotation, sequence and location tables of a folder with one subfolder per isolate."""
    sequences = gene_sequences(
        read_fasta(spark, f"{folder}/*/*.ffn", ordered=True), read_fasta(spark, f"{folder}/*/*.faa", ordered=True)
    )
    return {
        "annotations": gene_annotations(read_gene_table(spark, f"{folder}/*/*.tsv")),
        "sequences": sequences.drop("filename"),
        "locations": feature_locations(read_gff(spark, f"{folder}/*/*gff")),
    }


def extract_16s(annotations: DataFrame, sequences: DataFrame, product: str = "16S riboso") -> DataFrame:
    """Sequences of the ribosomal marker genes, ready for a FASTA writer."""
    genes = annotations.filter(matches("product", product))
    found = left_join_ns(genes, sequences.drop("product"), "locus_tag")
    return found.select("seq_id", "locus_tag", "seq_name", F.col("nuc_sequence").alias("sequence"))


def fasta_lines(found: DataFrame) -> DataFrame:
    return found.select(paste("seq_name", "sequence", sep="\n").alias("fasta"))


def crispr_regions(documents: DataFrame) -> DataFrame:
    """One row per region: Cas systems are kept when absent, sequences without arrays are not."""
    seqs = documents.select(F.explode("Sequences").alias("s"), isolate_from_run().alias("isolate"), "filename")
    flat = seqs.select("isolate", "filename", F.col("s.Id").alias("contig"), F.col("s.Cas").alias("Cas"),
                       F.col("s.Crisprs").alias("Crisprs"))
    cas = unnest(flat, "Cas", keep_empty=True, prefix="cas").drop("casGenes")
    arrays = unnest(cas, "Crisprs", prefix="crispr")
    regions = unnest(arrays, "crisprRegions", prefix="region")
    return regions.select(
        "isolate", "contig", "casStart", "casEnd", "casType", "crisprName", "crisprStart", "crisprEnd", "crisprAT",
        "regionStart", "regionEnd", "regionAT", "regionType", "regionSequence", "filename",
    )
