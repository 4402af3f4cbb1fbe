"""Exact top-k by inner product with M-trees.

Vectors are whole numbers, ``floor(scale * x)``. One more component,
``sqrt(M^2 - |x|^2)`` with M the longest vector of a block, turns the largest
inner product into the smallest Euclidean distance, which is a metric. Vectors
are dealt to blocks of bounded size; a block is an M-tree kept as a table of
pages (nodes): routing objects with covering radii and their distance to the
parent's object, and leaves with ids and parent distances. A search takes the
node of least lower bound first and leaves out entries whose stored distances
already show, by the triangle inequality, that they are too far.
"""

from __future__ import annotations

import heapq
import pickle

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from florametrics.llm.common import saved, ship_modules

PAGE, FAN = 512, 64
BLOCK, QUERIES = 16_384, 512
FOUND = "query_id long, vec_id long, score long"


def whole_vectors(vectors: DataFrame, scale: int = 256) -> DataFrame:
    """(vec_id, v array<long>): floor(scale * x) as double; ids or vectors that are null or hold null, NaN or infinity left out; repeated rows once."""
    sound = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) != float("inf")))
    return (
        vectors.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & F.coalesce(sound, F.lit(False)))
        .select(F.col("vec_id").cast("long").alias("vec_id"),
                F.transform("embedding", lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("long")).alias("v"))
        .dropDuplicates(["vec_id", "v"]))


def _split(x: np.ndarray, rows: np.ndarray, rng) -> list[tuple[int, np.ndarray]]:
    """(object, rows nearest to it) for up to FAN objects; equal vectors are cut by number."""
    objects = rng.choice(rows, min(FAN, -(-2 * len(rows) // PAGE)), replace=False)
    near = np.stack([np.linalg.norm(x[rows] - x[o], axis=1) for o in objects], 1).argmin(1)
    groups = [(int(o), rows[near == i]) for i, o in enumerate(objects) if (near == i).any()]
    if len(groups) > 1:
        return groups
    return [(int(part[0]), part) for part in np.array_split(rows, -(-len(rows) // PAGE))]


def build(ids: np.ndarray, v: np.ndarray) -> list[dict]:
    """Pages of the M-tree over the rows; page 0 is the root."""
    squares = (v * v).sum(1)
    top = float(squares.max())
    x = np.hstack([v, np.sqrt(np.maximum(top - squares, 0))[:, None]])
    rng = np.random.default_rng(len(ids))
    pages: list[dict] = []

    def page(rows: np.ndarray, parent: np.ndarray | None) -> int:
        at = len(pages)
        pages.append({})
        away = lambda of: np.zeros(len(of)) if parent is None else np.linalg.norm(x[of] - parent, axis=1)
        if len(rows) <= PAGE:
            pages[at] = {"leaf": True, "ids": ids[rows], "v": v[rows], "parent": away(rows)}
            return at
        groups = _split(x, rows, rng)
        objects = np.array([o for o, _ in groups])
        radius = np.array([np.linalg.norm(x[r] - x[o], axis=1).max() for o, r in groups])
        children = [page(r, x[o]) for o, r in groups]
        pages[at] = {"leaf": False, "x": x[objects], "radius": radius, "parent": away(objects), "children": children}
        return at

    page(np.arange(len(ids)), None)
    pages[0]["top"] = top
    return pages


def search(pages: list[dict], query_id: int, q: np.ndarray, k: int) -> tuple[list[tuple[int, int]], int]:
    """The k best (score, -vec_id) but for the query's own id, largest first, and the number of vectors looked at."""
    square, top = float(q @ q), pages[0]["top"]
    far = np.append(q, 0.0)
    slack = 1e-6 * (1 + square + top) ** 0.5
    best: list[tuple[int, int]] = []
    limit, looked = np.inf, 0
    todo = [(0.0, 0, None)]
    while todo:
        low, at, up = heapq.heappop(todo)
        if low > limit:
            break
        node = pages[at]
        near = np.arange(len(node["parent"]))
        if up is not None and limit < np.inf:
            reach = 0 if node["leaf"] else node["radius"]
            near = np.flatnonzero(np.abs(up - node["parent"]) - reach <= limit)
        if not len(near):
            continue
        looked += len(near)
        if node["leaf"]:
            scores = node["v"][near] @ q
            if len(best) == k:  # only those that can enter
                enter = scores >= best[0][0]
                near, scores = near[enter], scores[enter]
            for score, vec in zip(scores.tolist(), node["ids"][near].tolist()):
                if vec == query_id:
                    continue
                entry = (int(score), -vec)
                if len(best) < k:
                    heapq.heappush(best, entry)
                elif entry > best[0]:
                    heapq.heapreplace(best, entry)
            if len(best) == k:
                limit = max(square + top - 2 * best[0][0], 0.0) ** 0.5 + slack
        else:
            d = np.linalg.norm(node["x"][near] - far, axis=1)
            low = np.maximum(d - node["radius"][near], 0)
            for i in np.flatnonzero(low <= limit):
                heapq.heappush(todo, (float(low[i]), node["children"][near[i]], float(d[i])))
    return sorted(best, reverse=True), looked


def _matrix(values) -> np.ndarray:
    v = np.stack([np.asarray(x, dtype=np.int64) for x in values])
    # Doubles hold these sums exactly; vectors too long for that keep whole numbers of any size.
    return v.astype(np.float64) if int(np.abs(v).max(initial=0)) ** 2 * v.shape[1] < 2**50 else v.astype(object).astype(np.longdouble)


def _build_task(key, pdf):
    pdf = pdf.sort_values("vec_id")
    pages = build(pdf.vec_id.to_numpy(np.int64), _matrix(pdf.v))
    return pd.DataFrame({"dims": key[0], "block": key[1], "page": range(len(pages)), "node": [pickle.dumps(p, 5) for p in pages]})


def _search_task(k: int):
    def task(key, pages, queries):
        if not len(pages) or not len(queries):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype("int64")
        nodes = [pickle.loads(n) for n in pages.sort_values("page").node]
        out = []
        for vec_id, q in zip(queries.vec_id, _matrix(queries.v)):
            out += [(vec_id, -negative, score) for score, negative in search(nodes, vec_id, q, k)[0]]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"]).astype("int64")
    return task


def index(vectors: DataFrame, block: int = BLOCK) -> DataFrame:
    """Pages (dims, block, page, node) of M-trees over all vectors, at most about ``block`` vectors a tree, dealt by hash of the id."""
    ship_modules()
    sized = vectors.withColumn("dims", F.size("v"))
    blocks = -(-max(1, vectors.count()) // block)
    dealt = sized.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int"))
    return dealt.groupBy("dims", "block").applyInPandas(_build_task, "dims int, block int, page int, node binary")


def top_k(pages: DataFrame, queries: DataFrame, k: int = 5, query_block: int = QUERIES) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's ``k`` largest inner products among vectors of as many components.

    Ties go to the smaller vec_id; rows with the query's own id are not
    candidates; fewer candidates give fewer rows; no vectors or queries, no rows.
    Every block of queries meets every block of vectors once.
    """
    ship_modules()
    lots = -(-max(1, queries.count()) // query_block)
    asked = queries.select("vec_id", "v", F.size("v").alias("dims"), F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(lots)).cast("int").alias("lot"))
    trees = pages.select("dims", "block").distinct().toDF("dims", "block")
    asked = asked.toDF("vec_id", "v", "dims", "lot").join(trees, "dims")
    held = pages.withColumn("lot", F.explode(F.sequence(F.lit(0), F.lit(lots - 1))))
    keys = ["dims", "block", "lot"]
    found = held.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInPandas(_search_task(k), FOUND)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.distinct().withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def exact_top_k(vectors: DataFrame, is_query, scale: int = 256, k: int = 5) -> DataFrame:
    """Index all of ``vectors`` (vec_id, embedding) and search it with those rows for which ``is_query`` holds."""
    whole = saved(whole_vectors(vectors.select("vec_id", "embedding"), scale), "vectors")
    return top_k(saved(index(whole), "pages"), whole.where(is_query), k)
