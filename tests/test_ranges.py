"""Ranges, order statistics in bounded ranges, ordered operators and joins of groups: same rows however they are cut, plans that stay small."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from florametrics.operators import aggregates as A
from florametrics.operators import joins as J
from florametrics.operators import ordered as O
from florametrics.operators.ranges import RANGE, with_range
from florametrics_queries import QUERIES
from tests.plans import final_plan, shuffles

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def hot(spark):
    """A third of the rows in one group, ties in the order, missing groups, values and order."""
    rng = random.Random(6)
    rows = []
    for i in range(4000):
        g = "hot" if i % 3 == 0 else None if i % 30 == 1 else f"g{rng.randrange(150)}"
        rows.append((g, None if i % 400 == 7 else i // 4, float(rng.randrange(50)) if rng.random() < 0.05 else None, rng.randrange(1, 9), i))
    return spark.createDataFrame(rows, "g string, i int, v double, w int, id int").repartition(7).cache()


def test_ranges_follow_the_order_and_are_bounded(spark):
    """A million values in [0, 0.001], one value with as many rows again: counted per value, no range exceeds four times the wanted size."""
    df = spark.range(1_000_000).select((F.col("id") / 1e9).alias("v"), F.lit(1).alias("n")).unionAll(
        spark.range(1).select(F.lit(0.0005000001), F.lit(1_000_000)))
    cut = with_range(df, F.struct("v"), 20_000).groupBy(RANGE).agg(F.count("*").alias("rows"), F.min("v").alias("lo"), F.max("v").alias("hi"))
    found = cut.orderBy(RANGE).collect()
    assert 25 <= len(found) <= 100 and max(r.rows for r in found) <= 80_000
    assert all(a.hi < b.lo for a, b in zip(found, found[1:]))
    assert [r[RANGE] for r in with_range(df.limit(0), F.struct("v")).collect()] == []


def test_ranges_do_not_depend_on_partitioning(hot, rows):
    a, b = (with_range(x, F.struct("g", "i"), 100).select("id", RANGE) for x in (hot, hot.repartition(3)))
    assert rows(a) == rows(b) and a.select(RANGE).distinct().count() > 10


@pytest.mark.parametrize("by", [[], ["g"]])
@pytest.mark.parametrize("range_rows", [60, 4_000_000])
def test_ordered_operators_are_alike_for_any_ranges(hot, rows, by, range_rows):
    assert rows(O.fill_down(hot, ["v"], ["i"], by, range_rows=range_rows)) == rows(O.fill_down(hot, ["v"], ["i"], by, split=False))
    assert rows(O.running_sum(hot, "w", "c", ["i"], by, range_rows=range_rows)) == rows(O.running_sum(hot, "w", "c", ["i"], by, split=False))
    assert rows(O.running_sum(hot, "v", "c", ["i"], by, range_rows=range_rows)) == rows(O.running_sum(hot, "v", "c", ["i"], by, split=False))


@pytest.mark.parametrize("range_rows", [80, 4_000_000])
def test_fills_in_levels_equal_fills_in_turn(spark, rows, range_rows):
    """The inner groups are named by a column that the first fill completes, and come back after others."""
    rng = random.Random(9)
    data = [(rng.choice(["a", "b"]), rng.choice([None, None, "s1", "s2", "s3"]), rng.choice([None] * 9 + ["m1", "m2"]), i) for i in range(1500)]
    df = spark.createDataFrame(data, "db string, subject string, mrn string, i int")
    want = O.fill_down(O.fill_down(df, ["subject"], ["i"], ["db"], split=False), ["mrn"], ["i"], ["db", "subject"], split=False)
    got = O.fill_down_levels(df, [(["subject"], ["db"]), (["mrn"], ["db", "subject"])], ["i"], range_rows)
    assert got.columns == df.columns and rows(got) == rows(want)
    with pytest.raises(ValueError):
        O.fill_down_levels(df, [(["subject"], ["db"]), (["mrn"], ["subject"])], ["i"])


def test_ordered_operators_run_nothing_while_planned(spark, hot):
    tracker = spark.sparkContext.statusTracker()
    hot.count()
    before = tracker.getJobIdsForGroup(None)
    out = O.fill_down(O.running_sum(hot, "w", "c", ["i"]), ["v"], ["i"], ["g"])
    assert tracker.getJobIdsForGroup(None) == before
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "LogicalRDD" not in plan
    events = QUERIES["fill_down_group"](spark, SF)
    events.collect()
    # One shuffle of the rows; picks, range ends and what they hand on have a row a range or less.
    assert shuffles(final_plan(events)) <= 4


def percentile(values, p):
    values = sorted(values)
    at = (len(values) - 1) * p
    low = int(at)
    return values[low] + (values[min(low + 1, len(values) - 1)] - values[low]) * (at - low)


@pytest.mark.parametrize("range_rows", [40, 4_000_000])
def test_group_statistics_equal_brute_force(spark, range_rows):
    rng = random.Random(3)
    data = [(rng.choice(["hot", "hot", "b", None]), rng.choice([rng.randrange(10**9, 10**9 + 400), 5, rng.randrange(3000)])) for _ in range(5000)]
    data += [("lone", 7), ("zero", 0), ("zero", 0)] + [("gaps", v) for v in (None, 3, 4)] + [("none", None)] * 2
    df = spark.createDataFrame(data, "g string, v long")
    groups = defaultdict(list)
    for g, v in data:
        groups[g].append(v)
    stats = {r.g: r for r in A.describe_by(df, ["g"], "v", "n50", range_rows).collect()}
    assert stats.keys() == groups.keys()
    quartiles = {r.g: r for r in A.quantiles_by(df, ["g"], "v", {"a": 0.25, "b": 0.9}, range_rows).collect()}
    n90 = {r.g: r.x for r in A.nx_by(df, ["g"], "v", 0.9, "x", range_rows).collect()}
    boxes = {r.g: r for r in A.box_stats(df, ["g"], "v", range_rows=range_rows).collect()}
    assert quartiles.keys() == n90.keys() == boxes.keys() == groups.keys() - {"none"}
    for g, values in groups.items():
        there = sorted(v for v in values if v is not None)
        r, whole = stats[g], None not in values
        assert r.n == len(values) and r.total == (sum(values) if whole else None) and r.max == (max(values) if whole else None)
        assert r.mean == (pytest.approx(sum(values) / len(values)) if whole else None)
        assert r.median == (percentile(there, 0.5) if whole else None)
        if not there:
            assert r.n50 is None
            continue

        def nx(share):
            total = 0
            for v in reversed(there):
                total += v
                if total >= sum(there) * share:
                    return v
        assert (r.n50, n90[g]) == (nx(0.5), nx(0.9))
        assert (quartiles[g].a, quartiles[g].b) == pytest.approx((percentile(there, 0.25), percentile(there, 0.9)))
        q1, q3 = percentile(there, 0.25), percentile(there, 0.75)
        inside = [v for v in there if q1 - 1.5 * (q3 - q1) <= v <= q3 + 1.5 * (q3 - q1)]
        b = boxes[g]
        assert (b.q1, b.q3, b.lower, b.upper, b.n_outliers, b.n) == (
            pytest.approx(q1), pytest.approx(q3), min(inside), max(inside), len(there) - len(inside), len(there))


def test_statistics_share_their_shuffles(spark):
    for name, most in (("length_stats", 6), ("nx_lengths", 6), ("isolate_report", 24), ("cross_lookup", 12), ("gene_types", 8)):
        df = QUERIES[name](spark, SF)
        df.collect()
        assert shuffles(final_plan(df)) <= most, name


def test_groups_of_missing_keys_are_joined_where_they_lie(spark, rows):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    hot = spark.range(3000).select(F.when(F.col("id") % 7 != 0, F.col("id") % 50).alias("g"), (F.col("id") % 9).alias("w"))
    try:
        a = J.keyed(hot, ["g"]).groupBy(J.KEY).agg(F.sum("w").alias("w"))
        b = J.keyed(hot.filter("w > 3"), ["g"]).groupBy(J.KEY).agg(F.count("*").alias("n"))
        out = J.unkeyed(J.join_groups(a, b), ["g"])
        got = rows(out)
        assert shuffles(final_plan(out)) == 2 and any(g is None and n for g, _, n in got)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    want = hot.groupBy("g").agg(F.sum("w").alias("w"), F.nullif(F.count_if(F.col("w") > 3), F.lit(0)).alias("n"))
    assert got == rows(want)


def test_a_dominant_key_of_detail_rows_is_split(spark):
    """Half the rows have no key: their join with the group's value is read in several pieces."""
    conf = {"autoBroadcastJoinThreshold": "-1", "adaptive.skewJoin.skewedPartitionThresholdInBytes": "100k",
            "adaptive.advisoryPartitionSizeInBytes": "50k", "adaptive.coalescePartitions.enabled": "false", "shuffle.partitions": "40"}
    old = {k: spark.conf.get(f"spark.sql.{k}", None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(f"spark.sql.{k}", v)
    try:
        detail = spark.range(400_000, numPartitions=20).select(
            F.when(F.col("id") % 2 == 0, F.col("id") % 500).alias("g"), F.sha2(F.col("id").cast("string"), 256).alias("x"))
        out = A.add_count(detail, ["g"]).groupBy("n").agg(F.count("*").alias("rows"), F.max("x"))
        assert {(r.n, r.rows) for r in out.collect()} == {(200_000, 200_000), (800, 200_000)}
        assert "skew=true" in final_plan(out)
    finally:
        for k, v in old.items():
            spark.conf.unset(f"spark.sql.{k}") if v is None else spark.conf.set(f"spark.sql.{k}", v)


def test_full_join_of_many_frames(spark, rows):
    """Repeated and missing keys on every side, keys that only one frame holds."""
    rng = random.Random(1)
    sides = [[(rng.choice([None, *"abcdefghij"[i:i + 6]]), rng.choice([None, 1, 2]), f"{n}{j}") for j in range(12)] for i, n in enumerate("xyzu")]
    frames = [spark.createDataFrame(side, f"k string, m int, {n} string") for side, n in zip(sides, "xyzu")]
    keys = {r[:2] for side in sides for r in side}
    want = []
    for key in keys:
        parts = [[r[2] for r in side if r[:2] == key] or [None] for side in sides]
        want += [(*key, a, b, c, d) for a in parts[0] for b in parts[1] for c in parts[2] for d in parts[3]]
    got = J.full_join_all(frames, ["k", "m"])
    assert got.columns == ["k", "m", *"xyzu"]
    assert rows(got) == sorted(want, key=lambda t: tuple((x is not None, str(x)) for x in t))
    assert rows(J.full_join_all([frames[0], frames[1].limit(0)], ["k", "m"]), "x") == sorted((r[2],) for r in sides[0])
    renamed = J.full_join_ns(frames[0], frames[1].withColumnsRenamed({"k": "kk", "y": "x"}), [("k", "kk"), "m"])
    assert renamed.columns == ["k", "m", "x_x", "x_y"] and renamed.count() == J.full_join_all(frames[:2], ["k", "m"]).count()


@pytest.mark.parametrize("total", [1, 2, 3, 5, 17, 1000, 99_999])
def test_places_without_replacement_are_a_permutation(spark, total):
    """Totals that are no rectangle included: every place once, and not in the draws' order."""
    from florametrics.plans.diversity import _places
    out = spark.range(total).select(F.col("id"), _places(False)("id", F.lit(total), F.lit(123_456_789)).alias("pos")).collect()
    assert sorted(r.pos for r in out) == list(range(total))
    if total >= 1000:
        moved = sum(abs(r.pos - r.id) for r in out) / total / total
        assert 0.25 < moved < 0.42  # a third for places that have nothing to do with the number
