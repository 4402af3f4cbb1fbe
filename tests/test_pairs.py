"""Pairs of samples: touched pairs only, exact counts whatever the tiling."""

import subprocess
import sys
from collections import Counter
from itertools import combinations

import numpy as np
import pytest

from florametrics.operators import pairwise as P


def brute(rows):
    by_key = {}
    for s, k in set(rows):
        if s is not None and k is not None:
            by_key.setdefault(k, set()).add(s)
    return Counter(p for held in by_key.values() for p in combinations(sorted(held), 2))


def frame(spark, rows):
    return spark.createDataFrame(rows, "s string, k string")


def shared(df):
    return {(r.id_a, r.id_b): r.n_shared for r in df.collect()}


def testmeetings_are_those_of_a_nested_loop():
    rng = np.random.default_rng(1)
    a, b = np.sort(rng.integers(0, 7, 40)), np.sort(rng.integers(2, 9, 30))
    want = {(i, j) for i in range(40) for j in range(30) if a[i] == b[j]}
    for at_once in (1, 5, 64, 10_000):
        got = [(int(x), int(y)) for i, j in P.meetings(a, b, 9, at_once) for x, y in zip(i, j)]
        assert len(got) == len(want) and set(got) == want
    assert list(P.meetings(a[:0], b, 9)) == []


@pytest.mark.parametrize("tiling", [{}, {"block_size": 4}, {"tile_pairs": 10}, {"block_size": 3, "tile_pairs": 5}])
def test_pairs_within_equals_brute_force(spark, tiling):
    rng = np.random.default_rng(2)
    rows = [(f"s{a}", f"k{b}") for a, b in zip(rng.integers(0, 40, 300), rng.integers(0, 60, 300))]
    rows += [(f"s{i}", "hot") for i in range(0, 40, 2)] + [(None, "hot"), ("s1", None), ("alone", "only"), rows[0]]
    assert shared(P.pairs_within(frame(spark, rows), "s", "k", **tiling)) == brute(rows)


def test_pairs_of_an_empty_table_and_of_none_that_meet(spark):
    assert shared(P.pairs_within(frame(spark, []), "s", "k")) == {}
    assert shared(P.pairs_within(frame(spark, [("a", "x"), ("b", "y"), ("a", "x")]), "s", "k")) == {}


def test_no_row_for_pairs_that_share_nothing(spark):
    """20,000 samples in twos: 10,000 pairs come out of the tiles, not 200 million."""
    df = spark.sql("SELECT concat('s', id) s, concat('k', id div 2) k FROM range(20000)")
    got = P.pairs_within(df, "s", "k")
    assert got.count() == 10_000 and got.agg({"n_shared": "max"}).first()[0] == 1


def test_shared_min_of_whole_numbers_does_not_depend_on_tiling(spark):
    rng = np.random.default_rng(3)
    cells = {(int(a), int(b)): float(v) for a, b, v in zip(rng.integers(0, 25, 400), rng.integers(0, 50, 400), rng.integers(1, 10**9, 400))}
    df = spark.createDataFrame([(f"s{a:02}", f"k{b}", v) for (a, b), v in cells.items()], "s string, k string, x double")
    want = {(f"s{a:02}", f"s{b:02}"): sum(min(v, cells[b, k]) for (c, k), v in cells.items() if c == a and (b, k) in cells)
            for a, b in combinations(sorted({a for a, _ in cells}), 2)}
    for tiling in ({}, {"block_size": 4}, {"tile_rows": 60}, {"block_size": 5, "tile_rows": 40}):
        got = {(r.id_a, r.id_b): r.shared for r in P.shared_min(df, "s", "k", "x", **tiling).collect()}
        assert got == want


def test_tiles_run_where_the_package_is_missing(spark, tmp_path):
    """A pickled task loads in a Python that cannot import the library."""
    from pyspark import cloudpickle
    from florametrics.session import ship
    for task in (P._add_tile, P._count_tile):
        ship(task)
        path = tmp_path / task.__name__
        path.write_bytes(cloudpickle.dumps(task))
        code = f"import sys; sys.path = [p for p in sys.path if p and 'repo' not in p]; from pyspark import cloudpickle; print(cloudpickle.loads(open({str(path)!r}, 'rb').read()).__name__)"
        assert subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, env={"PATH": ""}).stdout.strip() == task.__name__
