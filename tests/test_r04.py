"""Blocks of samples meet without being copied once for every other block."""

from florametrics.operators import pairwise as P


def test_blocks_are_not_copied_for_each_other_block(spark):
    df = spark.sql("SELECT concat('s', id % 40) s, concat('k', id div 40 % 30) k, sum(1 + id % 5) x FROM range(4000) GROUP BY 1, 2")
    whole = {(r.id_a, r.id_b): (r.shared, r.total_a, r.total_b) for r in P.shared_min(df, "s", "k", "x").collect()}
    out = P.shared_min(df, "s", "k", "x", block_size=4)
    plan = out._jdf.queryExecution().executedPlan().toString()
    # Neither a list of the other blocks to be laid out, nor a shuffle behind it.
    assert "sequence(0" not in plan and "CartesianProduct" in plan
    got = out.collect()
    assert len(got) == len(whole) == 40 * 39 / 2
    assert {(r.id_a, r.id_b): (r.shared, r.total_a, r.total_b) for r in got} == whole
