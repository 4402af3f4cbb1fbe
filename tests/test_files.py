"""Readers on files in the tools' own layouts, and writers."""

import gzip
import json

import pytest
from pyspark.sql import functions as F

from florametrics.operators.reshape import lengthen, widen
from florametrics.plans import assembly as AS
from florametrics.plans import clinical as CL
from florametrics.plans import genomes as G
from florametrics.plans import quality as Q
from florametrics.plans import targeted as TG
from florametrics.plans import taxonomy as TX
from florametrics.sources import readers as R
from florametrics.sources import sinks as S


def put(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)
    return str(path)


def test_classified_reads_and_contigs(spark, tmp_path, rows):
    put(tmp_path / "S1.standard.txt", "C\tg1-7\tEscherichia (taxid 561)\t150|150\t561:9\nC\tg1-8\tEscherichia (taxid 561)\t150|150\t561:9\nU\tg2-1\tnone\t99\t0:1\n")
    reads = R.read_kraken_reads(spark, f"{tmp_path}/*.standard.txt")
    assert rows(TX.taxon_counts(reads), "seq_id", "uc", "taxid", "numseqs", "filename") == [
        ("S1", "C", 561, 2, "S1.standard.txt"), ("S1", "U", None, 1, "S1.standard.txt")]
    put(tmp_path / "c" / "I9.standard.txt", "C\tcontig 1\tE (taxid 5)\t1200\t5:1\n")
    assert rows(R.read_kraken_contigs(spark, f"{tmp_path}/c", cohort="biobank"), "contig", "taxon", "length", "seq_id", "cohort") == [
        ("contig 1", "E (taxid 5)", 1200, "I9", "biobank")]


def test_abundance_reports_and_profiles(spark, tmp_path, rows):
    put(tmp_path / "b" / "S1_R1_report_genus.txt", "name\ttaxonomy_id\ttaxonomy_lvl\tk\ta\tn\tf\nE. coli\t562\tG\t5\t1\t6\t0.5\n")
    assert rows(R.read_bracken(spark, f"{tmp_path}/b"), "name", "taxonomy_id", "taxonomy_lvl", "seq_id") == [("E. coli", 562, "G", "S1_R1")]
    put(tmp_path / "m" / "S2_R1_metagenome.txt", "#a\n#b\n#c\n#d\n#e\nclade_name\tclade_taxid\tr\tc\te\nk__B|p__F\t2|1239\t98.5\t-\t7\n")
    assert rows(R.read_metaphlan(spark, f"{tmp_path}/m"), "clade_name", "taxid", "relative_abundance", "seq_id") == [
        ("k__B|p__F", "1239", 98.5, "S2")]


def test_annotations_and_hash_in_text(spark, tmp_path, rows):
    cells = ["g1", "o", "1e-9", "50"] + ["-"] * 4 + ["ko:K1,ko:K2"] + ["-"] * 12 + ["uses #3 site"]
    path = put(tmp_path / "S1_R1.emapper.annotations", "# head\n" + "\t".join(cells) + "\n")
    assert rows(R.read_emapper(spark, path), "KEGG_ko", "eggNOG_description", "sample") == [("ko:K1,ko:K2", "uses #3 site", "S1_R1.")]
    assert rows(R.read_emapper(spark, path, cut_at_hash=True), "eggNOG_description") == [("uses ",)]
    known = spark.createDataFrame([("S1",)], "seq_id string")
    assert rows(TG.expand_ko(R.read_emapper(spark, path), known), "seq_id", "ko_id") == [("S1", "ko:K1"), ("S1", "ko:K2")]


def test_alignments_to_gene_abundance(spark, tmp_path, rows):
    line = "r{0}\t{1}\t{2}\t100\t0\t0\t1\t100\t1\t100\t1e-20\t{3}\t150\t500\n"
    put(tmp_path / "vf" / "S1.R1.vf.dmnd", line.format(1, "gA", 99, 90) + line.format(1, "gB", 95, 90) + line.format(2, "gA", 70, 99) + line.format(3, "gA", 88, 60))
    put(tmp_path / "vf" / "S1.R2.vf.dmnd", line.format(4, "gA", 90, 50))
    put(tmp_path / "vf" / "S2.R1.vf.dmnd", "\n")
    best = TG.best_hit(R.read_diamond(spark, f"{tmp_path}/vf/*.dmnd"))
    counts = TG.gene_counts(best)
    assert rows(counts) == [("S1", "vf", "gA", 500, 3)]
    totals = spark.createDataFrame([("S1", 6e6)], "seq_id string, total double")
    assert rows(TG.normalise_counts(counts, totals), "cpm", "rpkm") == [(0.5, 1.0)]
    assert R.read_diamond(spark, f"{tmp_path}/vf/*.dmnd", min_bytes=10_000).count() == 0


def test_nucleotide_alignments_with_fewer_columns(spark, tmp_path, rows):
    path = put(tmp_path / "a.tsv", "q1\ts1\t99.0\t80\t0\t0\t1\t95\t900\t810\t1e-9\t150\t160\t100\t95\tminus\n")
    df = R.read_blastn(spark, path, ncols=16)
    assert len(df.columns) == 17
    assert rows(TG.filter_hits(df), "qcov", "sstart", "send") == [(95.0, 810, 900)]


def test_fasta_edge_records(spark, tmp_path, rows):
    text = ">A_1 prod > one\nACGT\nAC\n>A_2 two\nGG\n>A_1 prod > one\nTT\n>A_3 empty\n"
    put(tmp_path / "iso1" / "x.ffn", text)
    put(tmp_path / "iso1" / "x.faa", ">A_1 prod > one\nMK\n")
    nuc, prot = (R.read_fasta(spark, f"{tmp_path}/*/*.{k}", ordered=True) for k in ("ffn", "faa"))
    assert rows(nuc, "seq_name", "sequence")[0] == ("A_1 prod > one", "ACGTAC")
    assert nuc.count() == 4
    assert rows(G.gene_sequences(nuc, prot), "locus_tag", "nuc_sequence", "prot_sequence", "product") == [
        ("A_1", "ACGTACTT", "MK", "prod > one"), ("A_2", "GG", None, "two"), ("A_3", "", None, "empty")]


def test_genome_folder(spark, tmp_path, rows):
    put(tmp_path / "iso1" / "x.tsv", "locus_tag\tftype\tlength_bp\tgene\tEC_number\tCOG\tproduct\nA_1\tgene\t9\t\t\t\t\nA_1\trRNA\t9\t\t\t\t16S ribosomal RNA\n")
    put(tmp_path / "iso1" / "x.ffn", ">A_1 16S ribosomal RNA\nACGT\n")
    put(tmp_path / "iso1" / "x.faa", ">A_9 other\nM\n")
    put(tmp_path / "iso1" / "x.gff", "##gff-version 3\nc1\tp\tgene\t1\t9\t.\t+\t.\tID=g\nc1\tp\trRNA\t1\t9\t.\t-\t0\tlocus_tag=A_1;product=a%2Cb+c\n##FASTA\n>c1\nACGT\n")
    tables = G.genome_tables(spark, str(tmp_path))
    assert rows(tables["annotations"], "seq_id", "locus_tag") == [("iso1", "A_1")]
    assert rows(tables["locations"], "seq_id", "start", "end", "strand", "locus_tag", "product", "score") == [
        ("iso1", 1, 9, "-", "A_1", "a,b+c", None)]
    found = G.extract_16s(tables["annotations"], tables["sequences"])
    S.write_fasta(found, f"{tmp_path}/out")
    assert rows(R.read_fasta(spark, f"{tmp_path}/out"), "seq_name", "sequence") == [("A_1 16S ribosomal RNA", "ACGT")]


def test_gzipped_gff(spark, tmp_path, rows):
    with gzip.open(tmp_path / "a.gff.gz", "wt") as f:
        f.write("#x\nc\ts\tCDS\t3\t7\t.\t+\t0\tgene=abc\n")
    assert rows(R.read_gff(spark, f"{tmp_path}/*.gz"), "type", "gene", "locus_tag") == [("CDS", "abc", None)]


def test_crispr_documents(spark, tmp_path, rows):
    region = {"Start": 1, "End": 2, "AT": 0.5, "Type": "DR", "Sequence": "AC"}
    array = {"Name": "c1", "Start": 10, "End": 20, "AT": 0.4, "Regions": [region, region]}
    seqs = [{"Id": "s1", "Cas": [], "Crisprs": [array]}, {"Id": "s2", "Cas": [{"Start": 5, "End": 6, "Type": "I"}], "Crisprs": []},
            {"Id": "s3", "Cas": [{"Start": 7, "End": 8, "Type": "II"}], "Crisprs": [array]}]
    doc = json.dumps({"Date": "d" * 5000, "Version": "1", "Command": "x", "Sequences": seqs})
    put(tmp_path / "run_ST12_3" / "result.json", doc)
    put(tmp_path / "run_ST12_4" / "result.json", json.dumps({"Sequences": seqs}))
    out = G.crispr_regions(R.read_crispr_json(spark, f"{tmp_path}/*/result.json"))
    assert rows(out, "isolate", "contig", "casType", "crisprStart", "regionSequence") == 2 * [("ST12_3", "s1", None, 10, "AC")] + 2 * [
        ("ST12_3", "s3", "II", 10, "AC")]


def test_assembly_summary_takes_the_newest_file(spark, tmp_path, rows):
    put(tmp_path / "summary1.txt", "##./old/flye\n>c1 length=5 depth=1x circular=true\n")
    put(tmp_path / "summary2.txt", "##./iso1/flye/a\n>c1 length=500 depth=1.5x circular=true\n>c2 length=9 depth=2x\n##./iso1/hybridAssembly/guppy_fastq\n>k length=7 depth=1x circular=true\n")
    df = AS.assembly_contigs(R.read_assembly_summary(spark, f"{tmp_path}/summary*txt"))
    assert rows(df, "contig", "length", "depth", "circular", "isolate", "type", "guppy") == [
        ("c1", 500.0, 1.5, None, "iso1", "flyeLong", "No"), ("c2", 9.0, 2.0, None, "iso1", "flyeLong", "No"),
        ("k", 7.0, 1.0, "Yes", "iso1", "noTrim", "Yes")]


def test_indexes_and_reports(spark, tmp_path, rows):
    put(tmp_path / "iso1" / "a.fai", "c1_pilon\t900\t5\t60\t61\n")
    assert rows(R.read_fai(spark, f"{tmp_path}/*/a.fai", strip_polish=True), "name", "length") == [("c1", 900)]
    put(tmp_path / "iso1" / "NanoStat.output", "Metrics\tdataset\nnumber_of_reads\t12.0\nmean_qual\tn/a\nactive_channels\t5\n")
    metrics = AS.read_metrics(R.read_report(spark, f"{tmp_path}/*/NanoStat.output", "long_read_metrics"))
    assert rows(metrics, "isolate", "number_of_reads", "mean_qual") == [("iso1", 12.0, None)]
    put(tmp_path / "q" / "transposed_report.tsv", "Assembly\t# contigs\tN50\nDFI_1_spades.contigs\t5\t100\nother\t1\t1\n")
    assert rows(Q.metrics_long(R.read_quast(spark, f"{tmp_path}/q"))) == [("DFI-1", "# contigs", "5"), ("DFI-1", "N50", "100")]


def test_trim_log(spark, tmp_path, rows):
    line = "d/200101-S{0}/x_{1}.log: 10: 20: 30: READ COUNT: {2}: reads: {3}\n"
    put(tmp_path / "t.txt", "".join([line.format(1, 1, "raw pair1", 100.0), line.format(1, 1, "raw pair2", 100.0), line.format(1, 1, "trimmed pair1", 80.0),
                                     line.format(1, 1, "final pair1", 60.0), line.format(2, 1, "raw pair1", 100.0)]))
    log = R.read_trim_log(spark, str(tmp_path / "t.txt"), ordered=True)
    assert Q.trim_stats(log).count() == 4
    assert Q.trim_stats(log, compat=True).count() == 3
    perc = Q.read_survival(Q.trim_stats(log))
    assert rows(perc.filter("ID = 'S1'"), "type", "perc") == [("Clean", 0.6), ("Host", 0.2), ("Trimmed", 0.2)]
    summary = Q.run_summary(Q.trim_stats(log)).first()
    assert (summary.raw_mean, summary.raw_median, summary.final_mean) == (100.0, 100.0, None)


def test_clinical_exports(spark, tmp_path, rows):
    put(tmp_path / "x-StoolSampleIDs_DATA.csv", "record_id,mrn,sample_id,date_collected,sample_type\n\"a,1\",M1,LT.1.2,2024-01-02,Stool\n\"a,2\",,LT 1.3,bad,Stool\n\"b,1\",,LT.2.1,2024-01-05,Stool\n\"b,2\",,,2024-01-05,\n")
    put(tmp_path / "x-EventTable_DATA.csv", "record_id,mrn,event_date,event_description\na,M1,2023-12-01,Liver Transplant\na,,2023-12-02,Visit\n")
    put(tmp_path / "x-MICU_DATA.csv", "studyid,mrn,sampleid,stool\nm1,M5,MICU.001.01,2024-02-01\n,,MICU.001.02,2024-02-03\n,,MICU.001.03,\n")
    put(tmp_path / "x-HT_DATA.csv", "study_id,mrn,sample_id,ohtdate,date_collected\nh1,M7,,2024-03-01,\n,,HT.1.1,no date,2024-03-04\nh2,M8,HT.2.1,,2024-03-05\n")
    put(tmp_path / "x-LD_DATA.csv", "subject_id,mrn,sample_id,collection_date,sample_type\nl1,M9,LD.1.1,2024-04-01,1\n,,LD.1.2,,2\n")

    def read(kind, schema):
        return R.read_clinical(spark, str(tmp_path), f"*{kind}*", schema)

    tables = (read("StoolSample", CL.LT_SAMPLES), read("EventTable", CL.LT_EVENTS), read("MICU", CL.MICU), read("HT_", CL.HT), read("LD_", CL.LD))
    out = CL.harmonise_clinical(*tables)
    got = rows(out.withColumn("dt", F.col("date_transplant").cast("string")), "db", "ID", "mrn", "studyid", "dt", "sampletype")
    assert set(got) == {
        ("HeartTransplant", "HT-001.01", "M7", "h1", "2024-03-01", "Stool"),
        ("HeartTransplant", "HT-002.01", "M8", "h2", None, "Stool"),
        ("LiverDisease", "LD-001.01", "M9", "l1", None, "Stool"), ("LiverDisease", "LD-001.02", "M9", "l1", None, "Other"),
        ("LiverTransplant", "LT-001.02", "M1", "a", "2023-12-01", "Stool"),
        ("LiverTransplant", "LT1-003.NA", "M1", "a", "2023-12-01", "Stool"),
        ("LiverTransplant", "LT-002.01", None, "b", None, "Stool"),
        ("MICU", "MICU-001.01", "M5", "m1", None, "Stool"), ("MICU", "MICU-001.02", "M5", "m1", None, "Stool"),
    }
    assert len(got) == 9
    across = CL.harmonise_clinical(*tables, across=True)
    assert rows(across.filter("ID in ('LT-002.01', 'HT-002.01')"), "mrn", "date_transplant") != []
    assert across.filter("ID = 'LT-002.01'").first().mrn == "M1"
    assert str(across.filter("ID = 'HT-002.01'").first().date_transplant) == "2024-03-01"


def test_tables(spark, tmp_path, rows):
    df = spark.createDataFrame([(1, "x")], "a int, b string")
    S.overwrite_table(df, "kept")
    S.append_table(df, "kept")
    assert R.read_table(spark, "kept", "a = 1").count() == 2
    assert not S.append_or_snapshot(df.filter("a > 5"), "kept", f"{tmp_path}/snap", load=True)
    assert S.restore(spark, f"{tmp_path}/snap").count() == 0
    assert S.append_or_snapshot(df, "kept", f"{tmp_path}/snap2", load=True)
    assert spark.table("kept").count() == 3
    assert S.conform(df, ["b", "a"]).columns == ["b", "a"]
    with pytest.raises(ValueError):
        S.conform(df, ["b", "z"])


def test_pivot_and_back(spark, rows):
    df = spark.createDataFrame([("a", "x", 1), ("a", "y", 2), ("b", "x", 3), ("b", "y", 4)], "id string, k string, v int")
    assert rows(lengthen(widen(df, ["id"], "k", "v", ["x", "y"]), ["id"], ["x", "y"], "k", "v")) == rows(df)
