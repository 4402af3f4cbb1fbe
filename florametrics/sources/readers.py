"""Readers for the tabular, text and nested outputs of sequencing tools.

One multi-path scan per input kind: Spark lists the files, splits them and
keeps the origin in ``filename``. Schemas are explicit. ``file_order`` gives the
position of a row in its file where an operator depends on it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from florametrics.functions import extract, file_name, last_part, lenient_number, path_part, sample_from_path, sub

# Column names and order of the tools' own formats.
KRAKEN_READ = "uc string, read string, taxon string, length string, LCAmap string"
KRAKEN_CONTIG = "uc string, contig string, taxon string, length long, LCAmap string"
BRACKEN = (
    "name string, taxonomy_id long, taxonomy_lvl string, kraken_assigned_reads long, added_reads long, "
    "new_est_reads long, fraction_total_reads double"
)
METAPHLAN = (
    "clade_name string, clade_taxid string, relative_abundance double, coverage string, "
    "estimated_number_of_reads_from_the_clade string"
)
EMAPPER = (
    "query_name string, seed_eggNOG_ortholog string, seed_ortholog_evalue double, seed_ortholog_score double, "
    "best_tax_level string, Preferred_name string, GOs string, EC string, KEGG_ko string, KEGG_Pathway string, "
    "KEGG_Module string, KEGG_Reaction string, KEGG_rclass string, BRITE string, KEGG_TC string, CAZy string, "
    "BiGG_Reaction string, taxonomic_scope string, eggNOG_OGs string, best_eggNOG_OG string, "
    "COG_functional_category string, eggNOG_description string"
)
DIAMOND = (
    "qseqid string, sseqid string, pident double, length long, mismatch long, gapopen long, qstart long, "
    "qend long, sstart long, send long, evalue double, bitscore double, qlen long, slen long"
)
BLASTN = (
    "qaccver string, saccver string, pident double, length long, mismatch long, gapopen long, qstart long, "
    "qend long, sstart long, send long, evalue double, bitscore double, score double, qlen long, qcovus double, "
    "sstrand string, slen long, staxid long"
)
BLAST_TAX = (
    "qaccver string, bitscore double, pident double, qstart long, qend long, qlen long, evalue double, "
    "kingdom string, phylum string, class string, order string, family string, genus string, species string"
)
GENE_TABLE = (
    "locus_tag string, ftype string, length_bp long, gene string, EC_number string, COG string, product string"
)
GFF_FIXED = ["seqid", "source", "type", "start", "end", "score", "strand", "phase"]
GFF_WANTED = ["locus_tag", "product", "note", "db_xref", "gene", "eC_number", "ID", "Name"]
TRIM_FIELDS = ["logfn", "time1", "time2", "time3", "readfoo", "handlerfoo", "description", "count"]
REPORTS = {
    "long_read_metrics": "Metrics string, dataset string",
    "assembly_info": (
        "seq_name string, length long, cov double, circ string, `repeat` string, mult string, "
        "alt_group string, graph_path string"
    ),
    "genome_class": (
        "user_genome string, classification string, fastani_reference string, fastani_reference_radius double, "
        "fastani_taxonomy string, fastani_ani double, fastani_af double, closest_placement_reference string, "
        "closest_placement_radius string, closest_placement_taxonomy string, closest_placement_ani string, "
        "closest_placement_af string, pplacer_taxonomy string, classification_method string, note string, "
        "other_related_references string, msa_percent string, translation_table string, red_value string, "
        "warnings string"
    ),
    "genome_quality": (
        "Name string, Completeness double, Contamination double, Completeness_Model_Used string, "
        "Translation_Table_Used string, Coding_Density double, Contig_N50 long, Average_Gene_Length double, "
        "Genome_Size long, GC_Content double, Total_Coding_Sequences long, Additional_Notes string"
    ),
}
SPAN = "Start: long, End: long"
CRISPR = (
    "Date string, Version string, Command string, Sequences array<struct<Id: string, Name: string, "
    f"Description: string, Length: long, AT: double, Cas: array<struct<{SPAN}, Type: string, "
    "Genes: array<struct<Sub_type: string, Start: long, End: long, Orientation: string>>>>, "
    f"Crisprs: array<struct<Name: string, {SPAN}, DR_Consensus: string, Evidence_Level: long, AT: double, "
    f"Regions: array<struct<{SPAN}, AT: double, Type: string, Sequence: string>>>>>>"
)

FILE_ORDER = "file_order"


def decoded(path: Column) -> Column:
    """Scan paths are URIs; give blanks and other escaped characters back."""
    return F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))


def file_order() -> Column:
    """Sortable position in the input: file, split, row within the split."""
    return F.struct(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )


def read_many(spark: SparkSession, paths, fmt: str, schema=None, *, recursive: bool = False,
              name_glob: str | None = None, min_bytes: int | None = None, ordered: bool = False,
              **options) -> DataFrame:
    """Scan many files at once. Files under ``min_bytes`` are skipped before they are opened."""
    reader = spark.read.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    if name_glob:
        reader = reader.option("pathGlobFilter", name_glob)
    df = reader.load(paths)
    extra = [decoded(F.col("_metadata.file_path")).alias("filename")]
    if ordered:
        extra.append(file_order().alias(FILE_ORDER))
    if min_bytes is not None:
        df = df.filter(F.col("_metadata.file_size") >= min_bytes)
    return df.select("*", *extra)


def _tsv(spark, paths, schema, header=False, **opts) -> DataFrame:
    return read_many(spark, paths, "csv", schema, sep="\t", header=header, quote="", **opts)


def _headed(spark, paths, schema: str, sep: str = "\t", quote: str = "", ordered: bool = False, extra: bool = False, **opts) -> DataFrame:
    """Delimited files with a header, bound by column name.

    Files are grouped by their header line, of which there are as many as there
    are layouts; each layout is one scan with its own column order. Names are
    compared without case and surrounding blanks. A column that a file lacks is
    NULL, and one that the schema does not name is left out unless ``extra``; a
    header that names no column of the schema is an error, not a table of NULLs.
    """
    fields = T.StructType.fromDDL(schema)
    known = {f.name.lower(): f.name for f in fields}
    scan = {k: v for k, v in opts.items() if k in ("recursive", "name_glob", "min_bytes")}
    lines = read_many(spark, paths, "text", ordered=True, **scan).where(F.col(f"{FILE_ORDER}.block") == 0)
    heads = lines.groupBy(F.col(f"{FILE_ORDER}.file").alias("file")).agg(F.min_by("value", FILE_ORDER).alias("head"))
    layouts = [r["head"] for r in heads.select("head").distinct().orderBy("head").collect()]
    parts = []
    for head in layouts or [sep.join(fields.names)]:
        names = [n.strip().strip(quote or None) if quote else n.strip() for n in head.lstrip("\ufeff").split(sep)]
        names = [known.get(n.lower(), n) for n in names]
        if not set(names) & set(fields.names):
            raise ValueError(f"the header {head!r} names none of the columns {fields.names}")
        # A repeated name keeps its first column.
        seen = [n if n not in names[:i] else f"__{i}" for i, n in enumerate(names)]
        text = T.StructType([T.StructField(n or f"__{i}", T.StringType()) for i, n in enumerate(seen)])
        df = read_many(spark, paths, "csv", text, sep=sep, header=True, quote=quote, ordered=ordered, **opts)
        if len(layouts) > 1:
            own = [r["file"] for r in heads.where(F.col("head") == head).select("file").collect()]
            df = df.where(F.col("_metadata.file_path").isin(own))
        cells = [(F.col(f"`{f.name}`") if f.name in seen else F.lit(None)).try_cast(f.dataType).alias(f.name) for f in fields]
        more = [F.col(f"`{n}`") for n in text.names if extra and n not in fields.names and not n.startswith("__")]
        parts.append(df.select(*cells, *more, "filename", *([FILE_ORDER] if ordered else [])))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    return out


def read_kraken_reads(spark, paths, **opts) -> DataFrame:
    """Read-level classification, no header."""
    return _tsv(spark, paths, KRAKEN_READ, **opts)


def read_kraken_contigs(spark, paths, cohort: str | None = None, **opts) -> DataFrame:
    """Contig classification: contig, taxon, length and the sample of the file."""
    df = _tsv(spark, paths, KRAKEN_CONTIG, **opts).select("contig", "taxon", "length", "filename")
    df = df.withColumn("seq_id", sample_from_path("filename", r"\.standard\.txt"))
    return df.withColumn("cohort", F.lit(cohort)) if cohort else df


def read_bracken(spark, paths, **opts) -> DataFrame:
    """Abundance reports with header; the sample is the name before ``_report_<level>.txt``."""
    df = _headed(spark, paths, BRACKEN, **opts)
    return df.withColumn("seq_id", sample_from_path("filename", "_report_[A-Za-z]+.txt"))


def read_metaphlan(spark, paths, **opts) -> DataFrame:
    """Profiles behind five comment lines and a header; ``taxid`` is the last part of the lineage."""
    df = _tsv(spark, paths, METAPHLAN, comment="#", **opts).filter(F.col("clade_name") != "clade_name")
    return df.withColumns({
        "seq_id": sample_from_path("filename", "_R1_metagenome.txt|_metagenome.txt"),
        "taxid": last_part("clade_taxid", "|"),
    })


def read_emapper(spark, paths, recursive: bool = False, pattern: str = "emapper.annotations$",
                 cut_at_hash: bool = False, **opts) -> DataFrame:
    """22-column annotations. Comment lines go; ``cut_at_hash`` also cuts a line at any later ``#``."""
    if cut_at_hash:
        fields = T.StructType.fromDDL(EMAPPER).fields
        lines = read_many(spark, paths, "text", recursive=recursive, **opts)
        parts = F.split(F.regexp_replace("value", "#.*$", ""), "\t")
        df = lines.filter(F.trim(F.regexp_replace("value", "#.*$", "")) != "").select(
            *[F.nullif(F.try_element_at(parts, F.lit(i + 1)), F.lit("")).try_cast(f.dataType).alias(f.name)
              for i, f in enumerate(fields)],
            "filename",
        )
    else:
        df = _tsv(spark, paths, EMAPPER, comment="#", recursive=recursive, **opts)
    return df.withColumn("sample", sample_from_path("filename", pattern))


def read_diamond(spark, paths, **opts) -> DataFrame:
    """14-column protein alignments; near-empty files are skipped by default."""
    return _tsv(spark, paths, DIAMOND, **{"min_bytes": 2, **opts})


def read_blastn(spark, paths, ncols: int = 18, **opts) -> DataFrame:
    """Tabular nucleotide alignments with the first ``ncols`` of the known columns."""
    fields = T.StructType.fromDDL(BLASTN).fields[:ncols]
    return _tsv(spark, paths, T.StructType(fields), **opts)


def read_blast_taxonomy(spark, paths, **opts) -> DataFrame:
    """Alignment hits already joined to their lineage, CSV with header."""
    return _headed(spark, paths, BLAST_TAX, sep=",", quote='"', **opts)


def read_quast(spark, paths, **opts) -> DataFrame:
    """Assembly metrics, one row per assembly; the metric columns come from the header, as text."""
    opts = {"recursive": True, "name_glob": "transposed_report.tsv", **opts}
    return _tsv(spark, paths, None, header=True, **opts)


def read_gene_table(spark, paths, **opts) -> DataFrame:
    return _headed(spark, paths, GENE_TABLE, **opts)


def read_fasta(spark, paths, **opts) -> DataFrame:
    """One row per record: header without ``>`` and the joined sequence lines.

    The record separator makes each record one row, so large files still split.
    """
    df = read_many(spark, paths, "text", lineSep="\n>", **opts)
    record = F.regexp_replace("value", "^>", "")
    name = F.regexp_replace(F.substring_index(record, "\n", 1), "\r$", "")
    body = F.when(F.instr(record, "\n") > 0, F.regexp_replace(record, r"^[^\n]*\n", "")).otherwise("")
    out = df.withColumn("seq_name", name).withColumn("sequence", F.regexp_replace(body, r"\s", ""))
    return out.drop("value").filter(F.col("seq_name") != "")


def read_gff(spark, paths, wanted=None, **opts) -> DataFrame:
    """GFF3 features, plain or gzip; directives and a trailing sequence part are left out."""
    lines = read_many(spark, paths, "text", **opts)
    parts = F.split("value", "\t")
    df = lines.filter(~F.col("value").startswith("#")).filter(F.size(parts) == 9)
    pairs = F.transform(F.split(F.element_at(parts, 9), ";"), lambda x: F.split(F.trim(x), "=", 2))
    pairs = F.filter(pairs, lambda x: (F.size(x) == 2) & (F.element_at(x, 1) != ""))

    def values(name: str) -> Column:
        """All values of an attribute, joined by commas; escapes that are none stay as they are."""
        own = F.transform(F.filter("__attr", lambda x: F.element_at(x, 1) == name), lambda x: F.element_at(x, 2))
        readable = F.transform(own, lambda v: F.coalesce(F.try_url_decode(F.replace(v, F.lit("+"), F.lit("%2B"))), v))
        return F.when(F.size(own) > 0, F.array_join(readable, ","))

    cast = {"start": "long", "end": "long"}
    fixed = [
        F.nullif(F.element_at(parts, i + 1), F.lit(".")).try_cast(cast.get(n, "string")).alias(n)
        for i, n in enumerate(GFF_FIXED)
    ]
    made = [values(n).alias(n) for n in (wanted or GFF_WANTED)]
    rest = [c for c in df.columns if c != "value"]
    return df.select(*fixed, pairs.alias("__attr"), *rest).select(*GFF_FIXED, *made, *rest)


def read_crispr_json(spark, paths, min_bytes: int = 4500, one_per_line: bool = False, **opts) -> DataFrame:
    """One row per isolate document; small files hold no result.

    Documents gathered into large files, ``one_per_line``, can be split.
    """
    return read_many(spark, paths, "json", CRISPR, multiLine=not one_per_line, min_bytes=min_bytes, **opts)


def newest_name(spark, paths, folder: bool = False, recursive: bool = False, name_glob: str | None = None) -> str | None:
    """The last file by name, or the last ``folder`` that holds files. Files are listed, not read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower())
    files = (reader.option("pathGlobFilter", name_glob) if name_glob else reader).load(paths)
    name = F.col("_metadata.file_path")
    name = F.regexp_replace(name, "[^/]*$", "") if folder else name
    return files.agg(F.max_by(name, decoded(name))).first()[0]


def read_assembly_summary(spark, paths, newest_only: bool = True, folder: bool = False, **opts) -> DataFrame:
    """Contig lines of a sectioned summary, each with the ``##`` path that heads its block.

    Of several summaries the newest by name counts; a summary written in parts is a ``folder``.
    """
    df = read_many(spark, paths, "text", lineSep="\n##", **opts)
    if newest_only:
        newest = newest_name(spark, paths, folder, **{k: v for k, v in opts.items() if k in ("recursive", "name_glob")})
        at = F.col("_metadata.file_path")
        df = df.where(at.startswith(F.lit(newest)) if folder else at == F.lit(newest))
    block = F.regexp_replace("value", "^##", "")
    lines = df.select(
        F.concat(F.lit("##"), F.substring_index(block, "\n", 1)).alias("path"),
        F.explode(F.slice(F.split(block, "\n"), 2, F.lit(2147483647))).alias("line"), "filename",
    ).filter(F.trim("line") != "")
    parts = F.split("line", " ")

    def part(i):
        return F.try_element_at(parts, F.lit(i))

    return lines.select(
        "path",
        F.replace(part(1), F.lit(">"), F.lit("")).alias("contig"),
        lenient_number(sub(part(2), "length=", "")).alias("length"),
        lenient_number(sub(part(3), "depth=|x", "")).alias("depth"),
        part(4).alias("circular"), "filename",
    )


def read_fai(spark, paths, strip_polish: bool = False, **opts) -> DataFrame:
    """Sequence index: name and length."""
    df = _tsv(spark, paths, "name string, length long, offset long, linebases long, linewidth long", **opts)
    name = sub("name", "_pilon", "") if strip_polish else F.col("name")
    return df.select(name.alias("name"), *[c for c in df.columns if c not in ("name", "offset", "linebases", "linewidth")])


def read_report(spark, paths, kind: str, isolate_part: int = -2, **opts) -> DataFrame:
    """Headed tool reports with the isolate taken from a path component."""
    df = _headed(spark, paths, REPORTS[kind], **opts)
    return df.withColumn("isolate", path_part("filename", isolate_part))


def read_trim_log(spark, paths, sep: str = ":", **opts) -> DataFrame:
    """Log lines of eight delimited fields."""
    lines = read_many(spark, paths, "text", **opts)
    parts = F.split("value", sep)
    made = [F.trim(F.try_element_at(parts, F.lit(i + 1))).alias(n) for i, n in enumerate(TRIM_FIELDS)]
    rest = [c for c in lines.columns if c != "value"]
    return lines.select(*made, *rest).withColumn("count", lenient_number("count"))


def read_clinical(spark, folder, pattern: str, schema: str, **opts) -> DataFrame:
    """CSV exports found by name. Blank cells are empty text, ``NA`` is missing; rows keep their file order."""
    fields = T.StructType.fromDDL(schema)
    df = _headed(spark, folder, schema, sep=",", quote='"', name_glob=pattern, ordered=True, **opts)
    texts = {f.name: F.nullif(F.coalesce(F.col(f.name), F.lit("")), F.lit("NA"))
             for f in fields if f.dataType == T.StringType()}
    return df.withColumns(texts)


def read_table(spark, name: str, filter: str | None = None, options: dict | None = None) -> DataFrame:
    """Warehouse table or JDBC source; the filter is pushed to the source where it can be."""
    df = spark.read.format("jdbc").options(dbtable=name, **options).load() if options else spark.table(name)
    return df.filter(filter) if filter else df


def isolate_from_folder(path: str | Column = "filename") -> Column:
    """Folder that holds the file."""
    return path_part(path, -2)


def isolate_from_run(path: str | Column = "filename") -> Column:
    # Fixed value: run-style isolate names.
    return extract(path, "ST[0-9]+_[0-9]+")


__all__ = [n for n in dir() if n.startswith(("read_", "isolate_from"))] + ["FILE_ORDER", "decoded", "file_order", "file_name"]
