"""Tiles of samples: values travel as arrays, keys with many meetings are rectangles."""

import numpy as np
import pyarrow as pa
import pytest

from florametrics.operators import pairwise as P


def tile(cells, block, piece=0):
    """Rows of a tile: the sample's total, then its values as arrays."""
    ids = sorted({s for s, _, _ in cells})
    rows = [(s, sum(x for t, _, x in cells if t == s), [], []) for s in ids]
    rows += [(s, None, [k for t, k, _ in cells if t == s], [x for t, _, x in cells if t == s]) for s in ids]
    table = pa.table({
        "id": [r[0] for r in rows], "total": pa.array([r[1] for r in rows], pa.float64()), "codes": pa.array([r[2] for r in rows], pa.list_(pa.int64())),
        "xs": pa.array([r[3] for r in rows], pa.list_(pa.float64())), "block": [block[r[0]] for r in rows]})
    out = P._add_tile((pa.scalar(min(block.values())), pa.scalar(max(block.values())), pa.scalar(piece)), table)
    return {(r["id_a"], r["id_b"]): (r["shared"], r["total_a"], r["total_b"]) for r in out.to_pylist()}


@pytest.mark.parametrize("blocks", [1, 2])
@pytest.mark.parametrize("repeated", [False, True])
@pytest.mark.parametrize("rectangle", [1, 30, 10**9])
def test_tile_equals_brute_force(monkeypatch, blocks, repeated, rectangle):
    monkeypatch.setattr(P, "RECTANGLE", rectangle)
    rng = np.random.default_rng(4)
    held = {(int(a), int(b)) for a, b in zip(rng.integers(0, 12, 90), rng.integers(0, 9, 90))} | {(i, 50) for i in range(12)}
    cells = [(f"s{a:02}", b, float(rng.integers(1, 50))) for a, b in sorted(held)]
    if repeated:
        cells += [("s03", 50, 7.0), ("s04", 50, 2.0)]
    block = {f"s{i:02}": i % blocks for i in range(12)}
    total = {s: sum(x for t, _, x in cells if t == s) for s in block}
    want = {(a, b): (sum(min(x, y) for s, k, x in cells for t, m, y in cells if s == a and t == b and k == m), total[a], total[b])
            for a in block for b in block if a < b and (blocks == 1 or block[a] != block[b])}
    assert tile(cells, block) == want
    # A later slice passes on only what it adds.
    assert tile(cells, block, piece=1).keys() == {k for k, v in want.items() if v[0]}


def test_values_are_no_rows_on_their_way_to_the_tiles(spark):
    df = spark.sql("SELECT concat('s', id % 40) s, concat('k', id div 40) k, 1 + id % 5 x FROM range(4000)")
    out = P.shared_min(df, "s", "k", "x", block_size=10)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "FlatMapGroupsInArrow" in plan and "collect_list" in plan
    assert out.count() == 40 * 39 / 2
    assert out.filter("total_a <= 0 or total_b <= 0").count() == 0


def test_no_sample_and_a_single_one(spark):
    df = spark.createDataFrame([("a", "k", 1.0)], "s string, k string, x double")
    assert P.shared_min(df, "s", "k", "x").count() == 0
    assert P.shared_min(df.limit(0), "s", "k", "x").count() == 0


def test_a_large_sample_travels_in_several_rows(spark, monkeypatch):
    monkeypatch.setattr(P, "CELLS", 10)
    df = spark.sql("SELECT concat('s', id % 2) s, concat('k', id div 2) k, 1.0 x FROM range(400)")
    assert [tuple(r) for r in P.shared_min(df, "s", "k", "x").collect()] == [("s0", "s1", 200.0, 200.0, 200.0)]
