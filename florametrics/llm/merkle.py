"""Merkle manifest of a table: trees of hashes in van Emde Boas order, proofs and their verification.

A group's leaves, in order, are cut into aligned subtrees of up to ``LEVELS``
levels below their root. A subtree is one row: all its digests in one byte string
in van Emde Boas order, the upper half of its levels first, then the subtrees
below, each split again at half its height. An address follows from depth and
place alone (``address``), so the same arithmetic writes a subtree and finds
siblings, whatever the sizes of memory below it. The roots of the subtrees are
the leaves of the next table of subtrees, until a group has one root; the groups'
roots are the leaves of one more tree.

Proofs go the other way: each subtree gets the siblings above its root from the
subtree above it, and only completes them; a task holds one subtree and its rows.

Defined results: null columns are hashed as ``-``; rows are placed by (null or
lowest first) doc_id, rows of one doc_id by their leaf, equal rows count each;
a single leaf is its group's root, a single group's root is the root; an empty
table gives no rows. Of a documents table only the five hashed columns are read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from florametrics.llm.common import saved, ship_modules

FAN, BITS = 8, 3
LEVELS = 4
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
PATH = "array<string>"


def size(levels: int) -> int:
    """Nodes of a complete tree of so many levels."""
    return (FAN ** levels - 1) // (FAN - 1)


def address(levels: int, depth: int, index: np.ndarray) -> np.ndarray:
    """Places in a van Emde Boas layout of ``levels`` levels of the nodes ``index`` at ``depth`` (0: root)."""
    if levels == 1:
        return np.zeros(len(index), np.int64)
    top = levels // 2
    if depth < top:
        return address(top, depth, index)
    low, below = levels - top, FAN ** (depth - top)
    return size(top) + index // below * size(low) + address(low, depth - top, index % below)


def height(n: int) -> int:
    """Levels below the root of a subtree of a group of ``n`` leaves."""
    h = 0
    while h < LEVELS and FAN ** h < n:
        h += 1
    return h


class Subtree:
    """Digests of one aligned subtree; nodes past the last leaf are absent (zero)."""

    def __init__(self, h: int, n_leaves: int, nodes: bytes | None = None):
        self.h, self.counts = h, [-(-n_leaves // FAN ** (h - d)) for d in range(h + 1)]
        self.at = [address(h + 1, d, np.arange(c)) for d, c in enumerate(self.counts)]
        self.nodes = np.zeros((size(h + 1), 32), np.uint8) if nodes is None else np.frombuffer(nodes, np.uint8).reshape(-1, 32)

    def texts(self, depth: int) -> list[str]:
        """Hex digests of a depth, left to right."""
        data = self.nodes[self.at[depth]].tobytes().hex()
        return [data[i:i + 64] for i in range(0, len(data), 64)]

    def build(self, leaves: list[bytes]) -> bytes:
        self.nodes[self.at[self.h]] = np.frombuffer(b"".join(leaves), np.uint8).reshape(-1, 32)
        for d in range(self.h, 0, -1):
            below = self.texts(d)
            above = [hashlib.sha256("".join(below[i:i + FAN]).encode()).digest() for i in range(0, len(below), FAN)]
            self.nodes[self.at[d - 1]] = np.frombuffer(b"".join(above), np.uint8).reshape(-1, 32)
        return self.nodes.tobytes()

    def paths(self) -> list[list[str]]:
        """For each leaf, from the leaf up, the digests before its node in its run, then those after it."""
        steps = []
        for d in range(self.h, 0, -1):
            own = self.texts(d)
            runs = [own[i:i + FAN] for i in range(0, len(own), FAN)]
            steps.append([("".join(r[:i]), "".join(r[i + 1:])) for r in runs for i in range(len(r))])
        return [[part for k, step in enumerate(steps) for part in step[leaf // FAN ** k]] for leaf in range(self.counts[-1])]


def fold(digest: str, path: list[str]) -> str:
    """The root that a leaf and the siblings on its way lead to."""
    for before, after in zip(path[::2], path[1::2]):
        digest = hashlib.sha256((before + digest + after).encode()).hexdigest()
    return digest


def _subtree(row) -> Subtree:
    """A row of a table of subtrees; only a group's last subtree may have fewer leaves."""
    n, h = int(row.n), height(int(row.n))
    return Subtree(h, min(FAN ** h, n - int(row.block) * FAN ** h), row.nodes)


def _block(pos: str) -> Column:
    """Which subtree of its group a leaf is in."""
    return F.shiftright(pos, BITS * LEVELS)


def place(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` with ``pos``, the place in its group ``grp`` by ``order`` from 0, and ``n``, the group's rows.

    The rows are sorted by ranges and written; what stands before a range comes from
    a table with one row per range and group.
    """
    dealt = rows.withColumn("tie", F.monotonically_increasing_id()).repartitionByRange("grp", *order, "tie")
    dealt = saved(dealt.sortWithinPartitions("grp", *order, "tie").drop("tie").withColumns(
        {"part": F.spark_partition_id(), "at": F.monotonically_increasing_id()}), "sorted")
    group = Window.partitionBy("grp")
    starts = dealt.groupBy("part", "grp").agg(F.min("at").alias("first"), F.count("*").alias("rows")).select(
        "part", "grp", "first", F.sum("rows").over(group).alias("n"),
        (F.sum("rows").over(group.orderBy("part").rowsBetween(Window.unboundedPreceding, 0)) - F.col("rows")).alias("earlier"))
    return dealt.join(saved(starts, "starts"), ["part", "grp"]).withColumn("pos", F.col("at") - F.col("first") + F.col("earlier")).drop(
        "part", "at", "first", "earlier")


def _build_task(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values("pos")
    n, block = int(pdf.n.iloc[0]), int(pdf.block.iloc[0])
    tree = Subtree(height(n), len(pdf))
    nodes = tree.build(list(pdf.leaf))
    return pd.DataFrame({"grp": pdf.grp.iloc[:1], "block": block, "n": n, "nodes": [nodes], "root": [tree.nodes[0].tobytes()]})


def build(leaves: DataFrame) -> list[DataFrame]:
    """Tables of subtrees, lowest first, of ``leaves`` (grp, pos, n, leaf); the last has one row, the group's root, per group.

    A table: grp, block (the subtree's place), n (the group's leaves on this
    level), nodes (digests in van Emde Boas order), root.
    """
    ship_modules()
    tables, most = [], leaves.agg(F.max("n")).first()[0]
    while most is not None and (most > 1 or not tables):
        grouped = leaves.select("grp", "pos", "n", "leaf", _block("pos").alias("block")).groupBy("grp", "block")
        tables.append(saved(grouped.applyInPandas(_build_task, "grp string, block long, n long, nodes binary, root binary"), "subtrees"))
        leaves = tables[-1].select(
            "grp", F.col("block").alias("pos"),
            (F.shiftright(F.col("n") - 1, BITS * LEVELS) + 1).alias("n"),
            F.col("root").alias("leaf"))
        most = -(-most // FAN ** LEVELS)
    return tables


def _descend_task(pdf: pd.DataFrame) -> pd.DataFrame:
    row = pdf.iloc[0]
    tree, above = _subtree(row), list(row.path)
    paths = [own + above for own in tree.paths()]
    return pd.DataFrame({
        "grp": row.grp, "block": np.arange(len(paths)) + int(row.block) * FAN ** LEVELS, "path": paths, "subroot": row.subroot, "root": row.root,
        "leaf": [bytes.fromhex(t) for t in tree.texts(tree.h)]})


def descend(tables: list[DataFrame], above: DataFrame) -> DataFrame:
    """The lowest subtrees of ``tables`` with the siblings above their root, given those above each group's (grp, path, subroot, root)."""
    ship_modules()
    known = above.withColumn("block", F.lit(0).cast("long"))
    for i in range(len(tables) - 1, 0, -1):
        here = tables[i].select("grp", "block", "n", "nodes").join(known, ["grp", "block"])
        known = saved(here.groupBy("grp", "block").applyInPandas(
            _descend_task, f"grp string, block long, path {PATH}, subroot string, root string, leaf binary"), "paths").drop("leaf")
    return tables[0].select("grp", "block", "n", "nodes").join(known, ["grp", "block"])


def _verify_task(rows: pd.DataFrame, trees: pd.DataFrame) -> pd.DataFrame:
    rows, row = rows.sort_values("pos"), trees.iloc[0]
    tree, above = _subtree(row), list(row.path)
    rest = "".join(above).encode()
    leaves = tree.texts(tree.h)
    proofs, folded = [], []
    for leaf, claim, own in zip(leaves, rows.claim, tree.paths()):
        proofs.append(hashlib.sha256("".join(own).encode() + rest).hexdigest())
        folded.append(fold(claim.hex() if isinstance(claim, bytes) else leaf, own + above))
    return pd.DataFrame({
        "doc_id": rows.doc_id.to_numpy(), "leaf": leaves, "subroot": row.subroot, "root": row.root, "proof_sha256": proofs, "folded_root": folded,
        "verified": [f == row.root for f in folded]})


def leaf_hash(**values: Column) -> Column:
    """sha256 (bytes) of the values in COLUMNS' order, each with its length in bytes; a null is ``-``."""
    parts = [F.coalesce(F.concat(F.octet_length(v).cast("string"), F.lit(":"), v), F.lit("-"))
             for v in (values[c].cast("string") for c in COLUMNS)]
    return F.unhex(F.sha2(F.concat(*parts), 256))


def manifest(docs: DataFrame, tampered: Column, tamper: Column) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) per row of a documents table.

    Each ``lang`` is a tree by ascending doc_id, their roots (null first, then by
    bytes) make one more. Where ``tampered`` holds, the text held against the manifest
    is ``tamper``, else the original.
    """
    ship_modules()
    own = {c: F.col(c) for c in COLUMNS}
    # Written first: finding the ranges reads the rows once more, and should not hash texts again.
    rows = saved(docs.select(
        F.coalesce(F.concat(F.lit("="), F.col("lang").cast("string")), F.lit("")).alias("grp"), F.col("doc_id").cast("long").alias("doc_id"),
        leaf_hash(**own).alias("leaf"), F.when(tampered, leaf_hash(**own | {"text": tamper})).alias("claim")), "leaves")
    placed = place(rows, ["doc_id", "leaf"])
    groups = build(placed)
    out = "doc_id string, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    if not groups:
        return docs.sparkSession.createDataFrame([], out.replace("doc_id string", "doc_id long"))
    # The groups' roots, in the order in which they are the leaves of the last tree.
    listed = place(groups[-1].select(F.lit("").alias("grp"), F.col("grp").alias("lang"), F.col("root").alias("leaf")), ["lang"])
    top = build(listed)
    root = top[-1].select("grp", F.array().cast(PATH).alias("path"), F.lit("").alias("subroot"), F.lower(F.hex("root")).alias("root"))
    lowest = descend(top, root)
    ways = saved(lowest.groupBy("grp", "block").applyInPandas(
        _descend_task, f"grp string, block long, path {PATH}, subroot string, root string, leaf binary"), "ways")
    above = ways.select(F.col("block").alias("pos"), "path", F.lower(F.hex("leaf")).alias("subroot"), "root").join(
        listed.select("pos", F.col("lang").alias("grp")), "pos").drop("pos")
    trees = descend(groups, above)
    # Ids as text: pandas would turn whole numbers beside a null into doubles.
    found = (
        placed.select("grp", _block("pos").alias("block"), "pos", F.col("doc_id").cast("string").alias("doc_id"), "claim").groupBy("grp", "block")
        .cogroup(trees.groupBy("grp", "block")).applyInPandas(_verify_task, out))
    return found.withColumn("doc_id", F.col("doc_id").cast("long"))
