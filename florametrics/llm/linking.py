"""Groups of linked rows from shared keys, without listing the pairs of a group.

A key's rows are compared with a few leaders of the key, so a group of n rows
gives O(n) pairs. The links found are joined to components. Only rows of a key
that are then still in different components can hide a link, and only those
meet each other directly: nothing is capped or left out.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from florametrics.llm.common import bit_table, met_twice, saved, ship_modules, sifted

#: Rows of a key up to which those still apart meet in a join; beyond, they meet in blocks of this many. The links are the same.
BLOCK = 256
#: The same limit where blocks confirm links themselves.
FEW = 32
#: Size of the bit table of keys that occur more than once.
KEY_BITS = 26


def components(links: DataFrame, name: str = "components") -> DataFrame:
    """(id, component): the smallest id reachable, for every id in (a, b) links but those that are their own.

    Alternates large-star and small-star steps, each an aggregate and a join, until nothing changes.
    """
    edges = saved(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), name)
    mark = lambda e: tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
    before = mark(edges)
    while before[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        # Every node keeps its own edge to the least node around it.
        large = large.unionByName(least.where("u <> m").select("u", F.col("m").alias("v"))).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.where("u > v").unionByName(small.where("u < v").select(F.col("v").alias("u"), F.col("u").alias("v")))
        edges = saved(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), name)
        after = mark(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component"))


def _near(x: np.ndarray, y: np.ndarray, most: int) -> np.ndarray:
    """Which bitmaps of ``x`` differ from which of ``y`` in at most ``most`` bits."""
    out = np.zeros((len(x), len(y)), bool)
    for i, row in enumerate(x):
        out[i] = np.bitwise_count(y ^ row).sum(1) <= most
    return out


def forest(links: np.ndarray, label_a: np.ndarray, label_b: np.ndarray):
    """Links (row, column) that connect what all true cells of ``links`` connect; equal labels are connected already."""
    label = np.concatenate([label_a, label_b])
    kept = []
    for i in np.flatnonzero(links.any(1)):
        at = np.flatnonzero(links[i])
        others, first = np.unique(label[len(label_a) + at], return_index=True)
        new = others != label[i]
        kept += [(i, j) for j in at[first[new]]]
        label[np.isin(label, others)] = label[i]
    return np.array(kept, np.int64).reshape(-1, 2)


def _block_task(most: int, alike: Callable | None = None):
    """Pairs of a block (or of two blocks) of a key that are in different components and whose bitmaps are near.

    With ``alike`` these are confirmed here, and only a spanning forest of the links goes on.
    """
    def task(key, pdf):
        _, low, high = key
        own, ids, c = pdf.own.to_numpy(), pdf.id.to_numpy(np.int64), pdf.c.to_numpy(np.int64)
        x = np.frombuffer(b"".join(pdf.bits), np.uint8).reshape(len(pdf), -1)
        a, b = np.flatnonzero(own == low), np.flatnonzero(own == high)
        hit = _near(x[a], x[b], most) & (c[a][:, None] != c[b][None, :])
        if low == high:
            hit = np.triu(hit, 1)
        if alike is None:
            i, j = np.nonzero(hit)
        else:
            # Rows without a near one need no set.
            in_a, in_b = np.flatnonzero(hit.any(1)), np.flatnonzero(hit.any(0))
            if len(in_a):
                text = [t.encode() for t in pdf.text]
                near = hit[np.ix_(in_a, in_b)]
                hit[np.ix_(in_a, in_b)] = near & alike([text[k] for k in a[in_a]], [text[k] for k in b[in_b]], near)
            i, j = forest(hit, c[a], c[b]).T
        first, second = ids[a[i]], ids[b[j]]
        return pd.DataFrame({"a": np.minimum(first, second), "b": np.maximum(first, second)})
    return task


def link(rows: DataFrame, verify: Callable[[DataFrame], DataFrame], bits: DataFrame, most: int, near: Callable | None = None,
         scatter: bool = True, members: Callable[[DataFrame], DataFrame] | None = None, alike: Callable | None = None,
         few: int = BLOCK) -> DataFrame:
    """(id, component) of all ids linked to others; ``rows`` holds (key, id) and, with ``near``, tag; ids once per key.

    ``scatter`` takes each key's leaders by a hash of the id; without it the least and largest id lead, which
    does where ids are hashes. Either way keys with the same rows have the same leaders, so a group that shares
    many keys meets a few leaders in all of them, not two for every key.

    ``bits`` (id, bits binary) has a bitmap of each id; pairs whose bitmaps differ in more than ``most`` bits are no links.
    It serves where many rows of a key are still apart: they are then compared in blocks within tasks.

    There, ``alike(texts, texts, near)`` confirms links if it is given, on the (id, text) rows ``members(ids)`` finds, and
    a block passes on no more links than it has rows; else candidates go to ``verify``. Keys of up to ``few`` rows
    need no blocks.

    ``verify`` turns candidate pairs (a, b), a < b, into links; ``near(tag, tag)`` is a cheap test that comes before it.
    """
    ship_modules()
    held = ["id", "tag"] if near else ["id"]
    near = near or (lambda a, b: F.lit(True))
    # Most keys have one row: only packed hashes of the keys are shuffled to find the others.
    rows = sifted(rows, "key", bit_table(met_twice(rows, "key"), KEY_BITS, hashed=True))
    own = F.struct(F.xxhash64("id").alias("order"), *held) if scatter else F.struct(*held)
    same = Window.partitionBy("key")
    rows = rows.select("key", *held, F.count("*").over(same).alias("n"), F.min(own).over(same).alias("p"), F.max(own).over(same).alias("q")).where("n > 1")
    # Leaders' tags serve here and no further; the two rows of a key that are not near need no place.
    leads = [F.when((F.col("id") != F.col(f"{x}.id")) & ((F.col("n") > 2) | (F.col("id") != F.col("p.id"))) & (
        near(F.col("tag"), F.col(f"{x}.tag")) if "tag" in held else F.lit(True)), F.col(f"{x}.id")) for x in "pq"]
    rows = rows.select("key", "n", *held, (F.col("id") == F.col("p.id")).alias("leads"), F.array_compact(F.array(*leads)).alias("led_by"))
    rows = saved(rows.where((F.col("n") > 2) | (F.size("led_by") > 0)), "met")

    def named(as_: str):
        return [F.col(c).alias(f"{as_}_{c}") for c in held]

    def ordered(df: DataFrame) -> DataFrame:
        """Distinct pairs, the smaller id first."""
        return df.select(F.least("a_id", "b_id").alias("a"), F.greatest("a_id", "b_id").alias("b")).where("a < b").distinct()

    many = rows.where("n > 2")
    first = saved(ordered(rows.select(F.col("id").alias("a_id"), F.explode("led_by").alias("b_id"))), "pairs")
    links = saved(verify(first), "links")
    found = components(links)
    # Keys whose rows are in several components: there, rows outside the first leader's component meet all others.
    placed = many.select("key", "n", *held, "leads").join(found.toDF("id", "c"), "id", "left").withColumn("c", F.coalesce("c", "id"))
    placed = placed.withColumn("main", F.max(F.when(F.col("leads"), F.col("c"))).over(same)).drop("leads")
    inside = saved(placed.withColumn("torn", F.max(F.col("c") != F.col("main")).over(same)).where("torn").drop("torn"), "torn")
    outside = inside.where((F.col("c") != F.col("main")) & (F.col("n") <= few)).select("key", *named("a"), F.col("c").alias("ca"), F.col("main").alias("m"))
    other = inside.select("key", *named("b"), F.col("c").alias("cb"))
    meet = (F.col("ca") != F.col("cb")) & ((F.col("cb") == F.col("m")) | (F.col("a_id") < F.col("b_id")))
    if "tag" in held:
        meet = meet & near(F.col("a_tag"), F.col("b_tag"))
    rest = ordered(outside.join(other, "key").where(meet))
    large = inside.where(F.col("n") > few)
    confirmed = None
    if alike and not large.isEmpty():
        large = large.join(members(large.select("id").distinct()), "id")
    large = large.join(bits, "id").withColumn("blocks", F.ceil(F.col("n") / BLOCK).cast("int"))
    large = large.withColumn("own", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")).withColumn(
        "with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    # A fixed number of parts: the work of a block grows with the square of its rows, which adaptive execution cannot foresee.
    parts = int(large.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    large = large.withColumn("low", F.least("own", "with")).withColumn("high", F.greatest("own", "with")).repartition(parts, "key", "low", "high")
    met = large.groupBy("key", "low", "high")
    if not alike:
        rest = rest.unionByName(met.applyInPandas(_block_task(most), "a long, b long").distinct())
    elif "text" in large.columns:
        confirmed = saved(met.applyInPandas(_block_task(most, alike), "a long, b long").distinct(), "links")
    rest = saved(rest.join(first, ["a", "b"], "left_anti"), "rest")
    more = confirmed if rest.isEmpty() else saved(verify(rest), "links")
    if more is None:
        return found
    more = more.unionByName(confirmed) if confirmed is not None and confirmed is not more else more
    if more.isEmpty():
        return found
    # Components take the place of the links they were made from.
    return components(more.unionByName(found.select(F.col("id").alias("a"), F.col("component").alias("b"))))
