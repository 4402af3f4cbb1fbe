"""Alignment hits: best hit per read, gene abundance, annotation expansion, hit reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from florametrics.functions import file_name, path_part, ratio, sub
from florametrics.operators.aggregates import count_by
from florametrics.operators.columns import orient, project, where_all
from florametrics.operators.joins import left_join_ns, semi_ns
from florametrics.operators.ranking import best_weighted, first_n_padded, top_n
from florametrics.operators.reshape import explode_list


def best_hit(hits: DataFrame, keys=("filename", "qseqid"), ident: float = 80, ecut: float = 1e-5,
             qlen_p: float = 0.8, seed: int = 0, mode: str = "random", subject: str = "sseqid") -> DataFrame:
    """Best passing hit per read: highest score, then identity, then lowest e-value, then a weighted pick."""
    passing = where_all(
        hits, F.col("pident") >= ident, F.col("evalue") < ecut, F.col("length") > F.col("qlen") * qlen_p / 3
    )
    return best_weighted(
        passing, keys, [("bitscore", "desc"), ("pident", "desc"), ("evalue", "asc")], subject, seed=seed, mode=mode
    )


def gene_counts(best: DataFrame, source_part: int = -2) -> DataFrame:
    """Reads per (sample, source, gene), both mates of a sample together."""
    named = best.select(
        sub(file_name("filename"), r"\.R[12].[a-zA-Z_]+.dmnd", "").alias("seq_id"),
        path_part("filename", source_part).alias("dbsource"), "sseqid", "slen",
    )
    return count_by(named, ["seq_id", "dbsource", "sseqid", "slen"], "mappedReads")


def normalise_counts(counts: DataFrame, totals: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """Counts per million and per kilobase-million with the sample's total reads."""
    out = left_join_ns(counts, totals, "seq_id")
    if known is not None:
        out = semi_ns(out, known, "seq_id")
    return out.select(
        "seq_id", "sseqid", "mappedReads",
        ratio("mappedReads", "total", 1e6).alias("cpm"),
        ratio("mappedReads", (F.col("slen") / 1000) * F.col("total"), 1e6).alias("rpkm"),
        "slen",
    )


def expand_ko(annotations: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """One row per functional identifier of an annotated gene; genes without one stay."""
    out = annotations.withColumn("seq_id", sub("sample", r"_R1\.$", "")).drop("sample")
    if known is not None:
        out = semi_ns(out, known, "seq_id")
    out = explode_list(out, "KEGG_ko", ",", out="ko_id")
    return project(out, first=["seq_id", "ko_id", "query_name", "KEGG*"])


def normalise_hits(hits: DataFrame) -> DataFrame:
    """Query coverage in percent, and subject coordinates on the plus strand."""
    covered = hits.withColumn("qcov", ratio(F.col("qend") - F.col("qstart") + 1, "qlen", 100))
    return orient(covered, "sstart", "send", "sstrand")


def filter_hits(hits: DataFrame, ident: float = 85, cov: float = 85) -> DataFrame:
    return where_all(normalise_hits(hits), F.col("pident") > ident, F.col("qcov") > cov)


def top_hits(hits: DataFrame, tax: DataFrame, isolates: DataFrame, n: int = 5) -> DataFrame:
    """The ``n`` best-scoring hits per query (ties stay) with lineage and isolate."""
    best = top_n(normalise_hits(hits), ["qaccver"], "bitscore", n)
    return left_join_ns(left_join_ns(best, tax, [("staxid", "tax_id")]), isolates, [("qaccver", "locus_tag")])


def top_report(hsps: DataFrame, n: int = 3, ident: float = 0.85, cov: float = 0.8) -> DataFrame:
    """One row per query with its first ``n`` good hits, padded with ``NA``."""
    good = where_all(
        hsps, ratio("ident_num", "hit_span") > ident, ratio("ident_num", "query_span") > cov
    )
    report = first_n_padded(good, ["query"], ["ordinal", "hit_description"], "hit_description", n)
    out = left_join_ns(hsps.select("query").distinct(), report, "query")
    return out.fillna("NA", subset=[f"hit{i}" for i in range(1, n + 1)])
