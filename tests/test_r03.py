"""Bounds of memory, shuffles and files: what grows with the input, and what must not."""

import numpy as np
import pandas as pd

from florametrics.operators import pairwise as P


def test_a_pair_tile_passes_on_a_row_per_id_not_per_pair():
    """Forty ids that all meet are 780 pairs: 39 rows leave the tile, however many keys they share."""
    rows = pd.DataFrame([(f"s{i:02}", k, 0) for k in "ab" for i in range(40)], columns=["id", "key", "block"])
    got = P._count_tile((1, 0, 0, 0), rows)
    assert len(got) == 39 and sum(map(len, got.id_b)) == 780
    assert all((np.asarray(n) == 2).all() and (np.asarray(b) > a).all() for a, b, n in zip(got.id_a, got.id_b, got.n))


def test_a_pair_tile_without_pairs_is_empty():
    rows = pd.DataFrame([("s1", "a", 0), ("s2", "b", 0)], columns=["id", "key", "block"])
    assert len(P._count_tile((1, 0, 0, 0), rows)) == 0


def test_draws_are_counted_where_they_are_made(spark):
    """Three samples of 50,000 reads: no more rows than taxa leave the draws, whole or in parts of a large sample."""
    from florametrics.plans import diversity as D
    df = spark.createDataFrame([(s, t, 5_000) for s in "abc" for t in "0123456789"], "sample string, taxon string, numseqs long")
    for replace in (True, False):
        plan = D.rarefy(df, replace=replace, seed=1)
        assert plan.count() == 30 and plan.agg({"numseqs": "sum"}).first()[0] == 150_000
        assert "pos" not in plan._jdf.queryExecution().optimizedPlan().toString()


def test_parts_of_a_stack_share_its_draws():
    import pyarrow as pa
    from florametrics.plans.diversity import _draw

    def drawn(parts):
        names = ["sample", "taxon", "numseqs", "start", "total", "key", "first", "last"]
        batch = pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*parts)], names=names)
        return {t: n for b in _draw(False)([batch]) for t, n in zip(b["taxon"].to_pylist(), b["numseqs"].to_pylist())}

    whole = drawn([("s", ["a", "b", "c", "d"], [500, 1, 300, 199], 0, 1000, 77, 0, 400)])
    parts = drawn([("s", ["a", "b"], [500, 1], 0, 1000, 77, 0, 400), ("s", ["c", "d"], [300, 199], 501, 1000, 77, 0, 400)])
    assert whole == parts and sum(whole.values()) == 400


def test_bit_table_comes_in_pieces(spark):
    """The table of a full set of words, whose driver saw a row per word before, is the one made in numpy."""
    from pyspark.sql import functions as F
    from florametrics.llm.common import bit_table
    from florametrics.llm.words import may_hold
    from unittest import mock

    ids = spark.range(0, 60_000, 1, 3).select(F.xxhash64("id").alias("id"))
    values = np.array([r.id for r in ids.collect()], np.int64).view(np.uint64)
    with mock.patch("pyspark.sql.DataFrame.toPandas", side_effect=AssertionError("a row per word came to the driver")):
        for bits in (10, 24):
            got = bit_table(ids, bits)
            assert len(got) == 1 << (bits - 6) and may_hold(got, values).all()
            others = (np.arange(1, 50_001, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
            assert bits < 20 or may_hold(got, others).mean() < 0.1
        assert not bit_table(ids.limit(0), 12).any()


def test_a_folder_per_sample_has_one_file(spark):
    """Rows of 40 samples in 16 partitions: a folder per sample with one file, not one for each task that holds its rows."""
    from pathlib import Path
    from florametrics_queries.files import _tsv

    df = spark.sql("SELECT id v, id % 40 s FROM range(0, 4000, 1, 16)")
    folder = Path(_tsv(df, spark, "folders", by="s").removesuffix("/*").removeprefix("file:"))
    assert [len(list(d.glob("*.csv"))) for d in folder.glob("s=*")] == [1] * 40


def test_wide_matrix_files_are_cut_by_bytes_and_compressed(spark, tmp_path):
    """300 samples of 2,000 taxa, a row is 4,000 bytes of zeros: several files by their width, a fraction of the bytes, the same lines."""
    import gzip
    from florametrics.operators.reshape import wide_lines
    from florametrics.sources import sinks as S

    counts = spark.sql("SELECT concat('s', id % 300) sample, concat('t', id) taxon, 1 numseqs, 'x' lab FROM range(2000)")
    lines = wide_lines(counts, "lab")
    S.write_lines(lines, f"{tmp_path}/wide", "lab", bytes_per_file=1_000_000, compression="gzip")
    files = list((tmp_path / "wide" / "lab=x").glob("part=*/*.txt.gz"))
    assert len(files) >= 3 and sum(f.stat().st_size for f in files) < 300 * 4_000 / 10
    read = [gzip.open(f, "rt").read().splitlines() for f in files]
    want = {r.is_row: set() for r in lines.select("is_row").distinct().collect()}
    for r in lines.collect():
        want[r.is_row].add(r.line)
    assert {r[0] for r in read} == want[False] and {x for r in read for x in r[1:]} == want[True]
    assert sum(len(r) - 1 for r in read) == 300
