"""Headered files are bound by name, and odd cells never fail a job."""

import pytest

from florametrics.functions.numbers import lenient_date
from florametrics.operators.reshape import wide_counts
from florametrics.sources import readers as R
from florametrics.sources import sinks as S


def put(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)


def test_layouts_by_name(spark, tmp_path, rows):
    put(tmp_path / "run/a/quality_report.tsv", "Name\tContamination\tmore\tCompleteness\nx\t1.5\tm\t99.0\n")
    put(tmp_path / "run/b/quality_report.tsv", "Completeness\tName\tContamination\n80\ty\tbad\n")
    df = R.read_report(spark, f"{tmp_path}/run/*/quality_report.tsv", "genome_quality")
    assert rows(df, "Name", "Completeness", "Contamination", "isolate") == [("x", 99.0, 1.5, "a"), ("y", 80.0, None, "b")]


def test_names_without_case_and_foreign_headers(spark, tmp_path, rows):
    put(tmp_path / "run/a/quality_report.tsv", "name\t COMPLETENESS \nx\t99.0\n")
    df = R.read_report(spark, f"{tmp_path}/run/*/quality_report.tsv", "genome_quality")
    assert rows(df, "Name", "Completeness", "Contamination") == [("x", 99.0, None)]
    put(tmp_path / "run/b/quality_report.tsv", "one\ttwo\n1\t2\n")
    with pytest.raises(ValueError, match="names none"):
        R.read_report(spark, f"{tmp_path}/run/*/quality_report.tsv", "genome_quality")


def test_clinical_extra_column(spark, tmp_path, rows):
    put(tmp_path / "e.csv", 'record_id,event,"mrn",sample_id\n1,"first, visit",77,S1\n2,,,NA\n')
    df = R.read_clinical(spark, str(tmp_path), "e.csv", "record_id string, mrn string, sample_id string")
    assert rows(df, "record_id", "mrn", "sample_id") == [("1", "77", "S1"), ("2", "", None)]


def test_gff_attributes(spark, tmp_path, rows):
    line = "c\tt\tCDS\t1\t9\t.\t+\t0\t"
    put(tmp_path / "g.gff", f"{line}ID=a;note=x;note=y\n{line}ID=b;;product=50% id=entity%2C z\n")
    got = R.read_gff(spark, str(tmp_path / "g.gff"), wanted=["ID", "note", "product"])
    assert rows(got, "ID", "note", "product") == [("a", "x,y", None), ("b", None, "50% id=entity%2C z")]


def test_dates_with_time(spark, rows):
    df = spark.createDataFrame([("2021-03-01 10:00",), ("2021-3-1",), ("2021/12/31",), ("20210301",), ("2021-13-01",), (None,)], "d string")
    assert [str(r[0]) for r in df.select(lenient_date("d")).collect()] == ["2021-03-01", "2021-03-01", "2021-12-31", "None", "None", "None"]


def test_fasta_round_trip(spark, tmp_path, rows):
    df = spark.createDataFrame([("a", "AC\n>GT"), ("b\nb", "A C")], "seq_name string, sequence string")
    S.write_fasta(df, str(tmp_path / "f"))
    assert rows(R.read_fasta(spark, str(tmp_path / "f")), "seq_name", "sequence") == [("a", "AC>GT"), ("b b", "AC")]


def test_wide_counts_keep_the_rest(spark, rows):
    df = spark.createDataFrame([("s", "a", 1), ("s", "zz", 9), ("s", None, 2)], "sample string, taxon string, numseqs long")
    assert rows(wide_counts(df, ["a"]), "sample", "a", "other") == [("s", 1, 11)]


def test_wide_counts_refuse_a_taxon_named_like_the_rest(spark):
    df = spark.createDataFrame([("s", "other", 2), ("s", "zz", 9)], "sample string, taxon string, numseqs long")
    with pytest.raises(ValueError):
        wide_counts(df, ["other"])
    assert wide_counts(df, ["other"], rest="unlisted").first().asDict() == {"sample": "s", "other": 2, "unlisted": 9}
