"""Splitting, tiling and picking give the same rows as the direct definition, also for hot groups."""

import math
import random
from collections import Counter
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from florametrics.operators import aggregates as A
from florametrics.operators import ordered as O
from florametrics.operators import pairwise as P
from florametrics.operators import ranking as K
from florametrics.plans import diversity as D
from florametrics.plans import targeted as TG
from florametrics_queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def hot(spark):
    """A third of the rows in one group, another group within one range, values mostly missing."""
    rng = random.Random(5)
    rows = []
    for i in range(3000):
        g = "hot" if i % 3 == 0 else None if i % 30 == 1 else f"g{rng.randrange(200)}"
        rows.append((g, i, float(rng.randrange(50)) if rng.random() < 0.05 else None, rng.randrange(1, 9)))
    return spark.createDataFrame(rows, "g string, i int, v double, w int").repartition(7).cache()


@pytest.mark.parametrize("by", [[], ["g"]])
def test_fill_down_split_equals_window(hot, rows, by):
    assert rows(O.fill_down(hot, ["v"], ["i"], by)) == rows(O.fill_down(hot, ["v"], ["i"], by, split=False))


def test_fill_down_is_idempotent(hot, rows):
    once = O.fill_down(hot, ["v"], ["i"])
    assert rows(O.fill_down(once, ["v"], ["i"])) == rows(once)


@pytest.mark.parametrize("by", [[], ["g"]])
def test_running_sum_split_equals_window(hot, rows, by):
    assert rows(O.running_sum(hot, "w", "c", ["i"], by)) == rows(O.running_sum(hot, "w", "c", ["i"], by, split=False))


def test_running_sum_skips_missing(hot, rows):
    assert rows(O.running_sum(hot, "v", "c", ["i"], ["g"])) == rows(O.running_sum(hot, "v", "c", ["i"], ["g"], split=False))


def test_quantiles_equal_percentile(hot):
    x = hot.withColumn("x", F.col("i") * F.col("w") - 500.0)
    want = {r.g: (r.a, r.b) for r in x.groupBy("g").agg(F.percentile("x", F.lit(0.25)).alias("a"), F.median("x").alias("b")).collect()}
    got = {r.g: (r.a, r.b) for r in A.quantiles_by(x, ["g"], "x", {"a": 0.25, "b": 0.5}).collect()}
    assert got.keys() == want.keys()
    for g in want:
        assert got[g] == pytest.approx(want[g])


def test_nx_lies_between_extremes(hot):
    n = A.nx_by(hot, ["g"], "w").alias("n").join(hot.groupBy("g").agg(F.min("w").alias("lo"), F.max("w").alias("hi")), "g")
    assert n.filter("n50 < lo or n50 > hi").count() == 0


def test_shares_sum_to_one(hot):
    s = A.add_share(hot, ["g"], "w").groupBy("g").agg(F.sum("share").alias("s"))
    assert s.filter(F.abs(F.col("s") - 1) > 1e-9).count() == 0


def brute_pairs(data):
    out = {}
    for a, b in combinations(sorted(data), 2):
        m = sum(min(x, data[b].get(k, 0)) for k, x in data[a].items())
        out[a, b] = 1 - 2 * m / (sum(data[a].values()) + sum(data[b].values()))
    return out


@pytest.mark.parametrize("tiling", [{}, {"block_size": 3, "tile_rows": 10}, {"block_size": 100, "tile_rows": 40}])
def test_bray_curtis_tiles_equal_brute_force(spark, tiling):
    rng = random.Random(2)
    data = {f"s{i}": {f"t{t}": rng.randrange(1, 30) for t in rng.sample(range(40), 8)} for i in range(12)}
    data["lonely"] = {"own": 5}
    df = spark.createDataFrame([(s, t, n) for s, row in data.items() for t, n in row.items()], "sample string, taxon string, numseqs int")
    got = {(r.id_a, r.id_b): r.distance for r in D.bray_curtis(df, **tiling).collect()}
    want = brute_pairs(data)
    assert got.keys() == want.keys()
    assert all(got[k] == pytest.approx(want[k]) for k in want)
    assert all(0 <= d <= 1 for d in got.values())


def test_tile_layout_bounds_memory_and_fills_the_cluster():
    rows, hot = 10**10, 10**10 // 3
    blocks, slices = P._layout(rows, 50_000, hot, 1000, 1024, 4_000_000)
    assert blocks >= 49 and (rows / blocks + hot) / slices <= 4_000_000
    blocks, slices = P._layout(10**6, 10, 10**5, 100, 1024, 4_000_000)
    assert blocks * (blocks + 1) / 2 * slices >= 100 or blocks == 10


def test_unifrac_on_a_deep_tree(spark):
    # A chain of 40 inner nodes with a leaf at each.
    edges = [(f"n{i}", f"n{i - 1}", 1.0) for i in range(1, 41)] + [(f"l{i}", f"n{i}", 0.5) for i in range(1, 41)]
    parent = {c: (p, l) for c, p, l in edges}
    held = {"a": ["l3", "l40"], "b": ["l10"], "c": ["l3"], "d": ["l1", "l2"]}

    def branches(leaves):
        out = set()
        for node in leaves:
            while node in parent:
                out.add(node)
                node = parent[node][0]
        return out

    counts = spark.createDataFrame([(s, t, 1) for s, ts in held.items() for t in ts], "sample string, taxon string, numseqs int")
    tree = spark.createDataFrame(edges, "child string, parent string, length double")
    got = {(r.id_a, r.id_b): r.distance for r in D.unifrac(counts, tree).collect()}
    for a, b in combinations(sorted(held), 2):
        x, y = branches(held[a]), branches(held[b])
        size = lambda s: sum(parent[n][1] for n in s)
        assert got[a, b] == pytest.approx(size(x ^ y) / size(x | y))


def test_branches_of_a_long_chain_and_of_a_cycle(spark):
    counts = spark.createDataFrame([("s", "n1000", 1), ("t", "n3", 1)], "sample string, taxon string, numseqs int")
    edges = [(f"n{i}", f"n{i - 1}", 1.0) for i in range(1, 1001)]
    tree = spark.createDataFrame(edges, "child string, parent string, length double")
    got = {r["sample"]: r.n for r in D.branches_of_samples(counts, tree).groupBy("sample").agg(F.count("*").alias("n")).collect()}
    assert got == {"s": 1000, "t": 3}
    ring = spark.createDataFrame([("n3", "a", 1.0), ("a", "b", 1.0), ("b", "c", 1.0), ("c", "a", 1.0)], tree.schema)
    with pytest.raises(ValueError, match="cycle above"):
        D.branches_of_samples(counts, ring)
    assert D.branches_of_samples(counts, tree.limit(0)).count() == 0


@pytest.mark.parametrize("n", [8, 120])
def test_pcoa_equals_direct_solution(spark, n):
    rng = np.random.default_rng(3)
    points = rng.normal(size=(n, 3)) * [5, 2, 0.5]
    dist = np.abs(points[:, None] - points[None]).sum(-1)  # not Euclidean: negative eigenvalues occur
    ids = [f"p{i:03d}" for i in range(n)]
    df = spark.createDataFrame([(ids[i], ids[j], float(dist[i, j])) for i in range(n) for j in range(i + 1, n)],
                               "id_a string, id_b string, distance double")
    coordinates, axes = D.pcoa(df, 2)
    j = np.eye(n) - 1 / n
    b = -0.5 * j @ dist**2 @ j
    values, vectors = np.linalg.eigh(b)
    top = values.argsort()[::-1][:2]
    assert [r.eigenvalue for r in axes.orderBy("axis").collect()] == pytest.approx(values[top], rel=1e-6)
    assert [r.share for r in axes.orderBy("axis").collect()] == pytest.approx(values[top] / np.trace(b), rel=1e-6)
    got = np.array([[r.axis1, r.axis2] for r in coordinates.orderBy("id").collect()])
    want = vectors[:, top] * np.sqrt(values[top])
    for k in range(2):
        assert np.allclose(np.abs(got[:, k]), np.abs(want[:, k]), atol=1e-5)


@pytest.mark.parametrize("replace", [True, False])
def test_rarefied_samples_have_equal_depth(spark, replace):
    rng = random.Random(1)
    data = [(f"s{i}", f"t{t}", rng.randrange(1, 400)) for i in range(6) for t in range(i + 2)]
    df = spark.createDataFrame(data, "sample string, taxon string, numseqs int")
    depth = min(Counter({s: sum(n for x, _, n in data if x == s) for s, _, _ in data}).values())
    r = D.rarefy(df, replace=replace, seed=9)
    assert {x.n for x in r.groupBy("sample").agg(F.sum("numseqs").alias("n")).collect()} == {depth}
    if not replace:
        over = r.withColumnRenamed("numseqs", "k").join(df, ["sample", "taxon"]).filter("k > numseqs")
        assert over.count() == 0
    again = D.rarefy(df.repartition(5), replace=replace, seed=9)
    assert sorted(map(tuple, r.collect())) == sorted(map(tuple, again.collect()))


@pytest.mark.parametrize("replace", [True, False])
def test_rarefied_shares_follow_counts(spark, replace):
    df = spark.createDataFrame([("s", "a", 250_000), ("s", "b", 150_000), ("s", "c", 1), ("s", "d", 99_999)],
                               "sample string, taxon string, numseqs int")
    got = {r.taxon: r.numseqs for r in D.rarefy(df, depth=20_000, replace=replace, seed=4).collect()}
    assert got["a"] == pytest.approx(10_000, rel=0.05) and got["b"] == pytest.approx(6_000, rel=0.05)


def test_weighted_pick_frequencies(spark):
    # Subject A ties twice, B once: A wins in four of five groups.
    n = 4000
    df = spark.range(n).select(F.col("id").alias("g"), F.explode(F.array(*map(F.lit, ["A", "A", "B"]))).alias("s"))
    share = K.weighted_pick(A.add_count(df, ["g", "s"], "w"), ["g"], "w", seed=1).filter("s = 'A'").count() / n
    assert share == pytest.approx(0.8, abs=3 * math.sqrt(0.16 / n) + 0.005)
    hits = df.selectExpr("cast(g as string) qseqid", "s sseqid", "99d pident", "1e-9 evalue", "90d bitscore", "50L length", "30L qlen", "9L slen")
    best = TG.best_hit(hits, ["qseqid"], seed=2)
    assert best.count() == n
    assert best.filter("sseqid = 'A'").count() / n == pytest.approx(0.8, abs=3 * math.sqrt(0.16 / n) + 0.005)


def test_pick_does_not_depend_on_partitioning(hot, rows):
    a = K.weighted_pick(hot.select("g", "i", "w"), ["g"], "w", seed=3)
    b = K.weighted_pick(hot.select("g", "i", "w").repartition(3), ["g"], "w", seed=3)
    assert rows(a) == rows(b)


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["cpm_rpkm", "taxon_abundance", "cascade_top1", "top5_hits", "gene_types", "assembly_verdict", "nx_lengths"])
def test_plans_stay_in_the_jvm(spark, name):
    plan = plan_of(QUERIES[name](spark, SF))
    assert "Python" not in plan and "Pandas" not in plan
    assert "CartesianProduct" not in plan
    # One task gets no rows: only the sample that cuts the ranges, two millionths of them.
    alone = [below for line, below in zip(plan.split("\n"), plan.split("\n")[1:]) if "Exchange SinglePartition, ENSURE_REQUIREMENTS" in line]
    assert all("partial_collect_set(__at" in below for below in alone) or name == "gene_types"


def test_flagship_reads_only_its_columns(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", 2000)
    plan = plan_of(QUERIES["cpm_rpkm"](spark, SF))
    assert "PushedFilters: [" in plan and "GreaterThanOrEqual(l_discount" in plan
    assert "l_shipdate" not in plan
