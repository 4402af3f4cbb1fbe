"""Loads of a run, the newest summary, and count matrices as text."""

import csv

from florametrics.operators.reshape import wide_lines
from florametrics.plans import loads as L
from florametrics.plans import requestors as RQ
from florametrics.sources import readers as R
from florametrics.sources import sinks as S


def test_loads_keep_known_libraries_and_their_columns(spark, rows):
    lookup = spark.createDataFrame([("S1",), ("S2",), ("S2",)], "seq_id string")
    reads = spark.createDataFrame([("C", "S_R11", "x", 5, 2, "f", 0), ("C", "S9_R1", "x", 5, 1, "f", 0)],
                                  "uc string, seq_id string, taxon string, taxid int, numseqs long, filename string, more int")
    out = L.read_level_load(reads, lookup)
    assert out.columns == ["seq_id", "uc", "taxon", "taxid", "numseqs", "filename"]
    assert rows(out, "seq_id", "numseqs") == [("S1", 2)]
    a = spark.createDataFrame([("n", 562, "S1_R1"), ("n", 562, "S1_R1x")], "name string, taxonomy_id int, seq_id string")
    b = spark.createDataFrame([("m", "S2", 0.5)], "name string, seq_id string, share double")
    both = L.abundance_load(lookup, a, b)
    assert both.columns == ["seq_id", "name", "taxid", "share"]
    assert rows(both) == [("S1", "n", 562, None), ("S2", "m", None, 0.5)]
    p = spark.createDataFrame([("562", "S2_R1"), ("", "S1"), ("t", None)], "taxid string, seq_id string")
    assert rows(L.profile_load(lookup, p)) == [("S1", None), ("S2", 562.0)]
    assert rows(L.profile_load(lookup.unionByName(lookup.selectExpr("null seq_id")), p), "seq_id") == [(None,), ("S1",), ("S2",)]
    assert rows(L.rows_per_library(both)) == [("S1", 1), ("S2", 1)]


def test_load_run_appends_what_has_rows(spark, tmp_path, rows):
    one, none = spark.range(3).selectExpr("id", "id * 2 n"), spark.range(0)
    targets = (f"{tmp_path}/w", f"{tmp_path}/k")
    assert L.load_run({"a": L.contig_load(one, ["n", "id"]), "b": none}, *targets) == {"a": True, "b": False}
    assert L.load_run({"a": one.select("n", "id")}, *targets) == {"a": True}
    assert S.restore(spark, f"{targets[0]}/a").count() == 6 and S.restore(spark, f"{targets[1]}/b").count() == 0
    assert L.load_run({"a": one}, *targets, load=False) == {"a": False}
    assert S.restore(spark, f"{targets[1]}/a").count() == 3


def test_newest_summary_is_listed_not_read(spark, tmp_path, rows):
    (tmp_path / "summary 2023.txt").write_text("##./I1/old\n>c1 length=5 depth=2x\n")
    (tmp_path / "summary 2024.txt").write_text("##./I1/a\n>c1 length=7 depth=2x circular=true\n>c2 length=8 depth=1x\n##./I2/b\n>c1 length=9 depth=3x\n")
    out = R.read_assembly_summary(spark, f"{tmp_path}/*.txt")
    assert rows(out, "path", "contig", "length") == [("##./I1/a", "c1", 7.0), ("##./I1/a", "c2", 8.0), ("##./I2/b", "c1", 9.0)]
    assert R.read_assembly_summary(spark, f"{tmp_path}/*.txt", newest_only=False).count() == 4
    for run in ("r1", "r2"):
        for part in "xy":
            (tmp_path / run).mkdir(exist_ok=True)
            (tmp_path / run / f"{part}.txt").write_text(f"##./{run}/{part}\n>c length=1 depth=1x\n")
    assert rows(R.read_assembly_summary(spark, f"{tmp_path}/r*", folder=True), "path") == [("##./r2/x",), ("##./r2/y",)]


def test_wide_lines(spark, rows):
    data = [("A", "s1", "t2", 3), ("A", "s1", "t2", 4), ("A", "s2", "t,1", 5), ("A", "s3", "t9", 0), ("A", "s4", None, 2),
            ("A", None, "t5", 2), ("B", "s5", "t9", None), (None, 's"6', "other", 1)]
    out = wide_lines(spark.createDataFrame(data, "lab string, sample string, taxon string, numseqs long"), "lab")
    assert rows(out) == sorted([
        (None, False, "sampleID,other"), (None, True, '"s""6",1'), ("A", False, 'sampleID,"t,1",t2'), ("A", True, "s1,0,7"),
        ("A", True, "s2,5,0"), ("A", True, "s3,0,0"), ("A", True, "s4,0,0"), ("B", True, "s5"),
    ], key=lambda t: tuple((x is not None, str(x)) for x in t))


def test_wide_files_of_many_taxa(spark, tmp_path):
    """20,000 taxa in one matrix; every file starts with the header, folders have a file per so many rows."""
    counts = spark.sql("SELECT concat('s', lpad(id div 8000, 2, '0')) sample, concat('t', lpad((id * 7919) % 20000, 5, '0')) taxon, id % 9 numseqs FROM range(96000)")
    samples = spark.sql("SELECT concat('s', lpad(id, 2, '0')) sample, if(id < 11, 'Lab 1', null) request_by FROM range(20)")
    tax = spark.sql("SELECT concat('t', lpad(id, 5, '0')) taxon, id % 3 Phylum FROM range(20000)")
    seqs = tax.selectExpr("taxon", "'ACGT' sequence")
    RQ.export_by(counts, {"rdp": tax, "blast": tax.filter("Phylum = 1")}, samples, seqs, f"{tmp_path}/x", rows_per_file=5)
    files = sorted((tmp_path / "x" / "wide" / "request_by=Lab1").glob("part=*/*.txt"))
    assert 2 <= len(files) <= 3
    expected = {}
    for r in counts.collect():
        if r.sample < "s11" and r.numseqs:
            expected[r.sample, r.taxon] = expected.get((r.sample, r.taxon), 0) + r.numseqs
    got, names = {}, None
    for f in files:
        head, *lines = csv.reader(f.open())
        assert names in (None, head) and head[0] == "sampleID"
        names = head
        for line in lines:
            got |= {(line[0], t): int(n) for t, n in zip(head[1:], line[1:], strict=True) if n != "0"}
    assert got == expected and set(names[1:]) == {t for _, t in expected}
    assert spark.read.csv(f"{tmp_path}/x/tax_blast", header=True).count() == sum(int(t[1:]) % 3 == 1 for t in names[1:])


def test_folders_have_few_files(spark, tmp_path):
    df = spark.sql("SELECT if(id % 10 = 0, 'small', 'large') lab, id FROM range(0, 10000, 1, 16)")
    S.write_csv(S.dealt_by(df, "lab", 3000), f"{tmp_path}/d", partition_by=["lab"])
    assert len(list((tmp_path / "d" / "lab=small").glob("*.csv"))) == 1
    assert 1 <= len(list((tmp_path / "d" / "lab=large").glob("*.csv"))) <= 3
    assert spark.read.csv(f"{tmp_path}/d", header=True).count() == 10000
