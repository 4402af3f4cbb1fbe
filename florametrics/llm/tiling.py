"""Benchmark decontamination by greedy string tiling.

Seeds, ``least`` words in a row, are joined between documents and test items; a
pair whose seeds could cover enough of the item is tiled: the longest match of
words not yet marked, found by running Karp-Rabin hashes of ``least`` words and
their runs along diagonals, is marked again and again. The share of the item's
words under tiles decides, so an item is found in whatever order its passages
come.

Words are compared in lower case and without marks.

Defined results: null or wordless texts and items match nothing; items of fewer
than ``least`` words must occur whole; equal items count each; a repeated
doc_id is contaminated if one of its rows is; an empty table gives no rows, an
empty benchmark no contamination.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from florametrics.llm.common import bit_table, saved, ship_modules, texts
from florametrics.llm.words import may_hold, shingles, word_hashes

FILTER_BITS = 24
#: Share of an item's words under tiles from which a document holds the item.
THRESHOLD = 0.6
MARKS = re.compile(r"[\W_]+")


def plain(text: str) -> bytes:
    """Lower case, runs of marks and white space as one blank."""
    return MARKS.sub(" ", text.lower()).encode()


def tiles(item: np.ndarray, text: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """Greedy tiles (place in item, place in text, length) of two arrays of word hashes; ties go to the earlier place in the item, then in the text."""
    free_item, free_text = np.ones(len(item), bool), np.ones(len(text), bool)
    found = []
    least = min(least, len(item))
    if not least or len(text) < least:
        return found
    of_item, of_text = shingles(item, least), shingles(text, least)
    order = np.argsort(of_item, kind="stable")
    low, high = np.searchsorted(of_item[order], of_text), np.searchsorted(of_item[order], of_text, side="right")
    times = high - low
    j = np.repeat(np.arange(len(of_text)), times)
    i = order[np.arange(len(j)) - np.repeat(np.cumsum(times) - times, times) + np.repeat(low, times)]
    while len(i):
        # A seed is open while no word of it is marked.
        open_item = np.convolve(free_item, np.ones(least, int), "valid") == least
        open_text = np.convolve(free_text, np.ones(least, int), "valid") == least
        still = open_item[i] & open_text[j]
        i, j = i[still], j[still]
        if not len(i):
            break
        run = np.lexsort((i, j - i))
        i, j = i[run], j[run]
        new = np.concatenate([[True], (np.diff(j - i) != 0) | (np.diff(i) != 1)])
        start = np.flatnonzero(new)
        length = np.diff(np.concatenate([start, [len(i)]])) + least - 1
        best = length.max()
        top = start[length == best]
        for at in top[np.lexsort((j[top], i[top]))]:
            a, b = i[at], j[at]
            if free_item[a:a + best].all() and free_text[b:b + best].all():
                free_item[a:a + best] = free_text[b:b + best] = False
                found.append((int(a), int(b), int(best)))
    return found


def _item_task(least: int):
    def task(frames):
        for pdf in frames:
            hashes, edges = word_hashes([plain(t) for t in pdf.text])
            for key, a, b in zip(pdf.item_id, edges, edges[1:]):
                if b > a:
                    grams = shingles(hashes[a:b], least).view(np.int64)
                    yield pd.DataFrame({"item_id": key, "n_words": int(b - a), "words": [hashes[a:b].tobytes()], "grams": [grams]})
    return task


def _seed_task(table: np.ndarray, sizes: list[int]):
    """Documents that may hold a seed, with their word hashes and those seeds."""
    def task(frames):
        for pdf in frames:
            out = []
            for k in range(0, len(pdf), 64):
                part = pdf.iloc[k:k + 64]
                hashes, edges = word_hashes([plain(t) for t in part.text])
                for doc_id, a, b in zip(part.doc_id, edges, edges[1:]):
                    own = [g[may_hold(table, g)] for n in sizes if b - a >= n for g in [shingles(hashes[a:b], n)]]
                    own = np.unique(np.concatenate(own)) if own else np.zeros(0, np.uint64)
                    if len(own):
                        out.append((doc_id, hashes[a:b].tobytes(), own.view(np.int64)))
            yield pd.DataFrame(out, columns=["doc_id", "text", "grams"])
    return task


def _tile_task(least: int):
    def task(frames):
        for pdf in frames:
            covered = [
                sum(t[2] for t in tiles(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), least)) for x, y in zip(pdf.words, pdf.text)]
            yield pd.DataFrame({"doc_id": pdf.doc_id, "item_id": pdf.item_id, "coverage": np.array(covered, float) / pdf.n_words.to_numpy(float)})
    return task


def coverages(docs: DataFrame, benchmark: DataFrame, least: int = 5, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, item_id, coverage) of pairs whose seeds could cover ``threshold`` of the item."""
    ship_modules()
    items = saved(benchmark.where(F.col("item_id").isNotNull()).select(
        F.col("item_id").cast("long").alias("item_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
        .mapInPandas(_item_task(least), "item_id long, n_words long, words binary, grams array<long>"), "items")
    items = items.withColumn("item", F.xxhash64("item_id", "words"))
    grams = items.select("item", "n_words", F.explode("grams").alias("id")).groupBy("item", "n_words", "id").agg(F.count("*").alias("times"))
    sizes = [r["n"] for r in items.select(F.least("n_words", F.lit(least)).cast("int").alias("n")).distinct().collect()]
    hits = saved(texts(docs).mapInPandas(_seed_task(bit_table(grams, FILTER_BITS), sorted(sizes)), "doc_id long, text binary, grams array<long>")
                 .withColumn("row", F.monotonically_increasing_id()), "hits")
    seeds = hits.select("row", F.explode("grams").alias("id"))
    wanted = (seeds.join(grams, "id").groupBy("row", "item").agg(F.sum("times").alias("seeds"), F.first("n_words").alias("n"))
              # A seed covers ``least`` words at most.
              .where(F.col("seeds") * F.least("n", F.lit(least)) >= F.col("n") * threshold).select("row", "item"))
    pairs = wanted.join(hits.select("row", "doc_id", "text"), "row").join(items.select("item", "item_id", "n_words", "words").dropDuplicates(["item"]), "item")
    return pairs.mapInPandas(_tile_task(least), "doc_id long, item_id long, coverage double")


def contamination(docs: DataFrame, benchmark: DataFrame, least: int = 5, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, n_items, item_id, coverage, contaminated) per document row: items covered enough, and the one covered most."""
    found = coverages(docs, benchmark, least, threshold).where(F.col("coverage") >= threshold).groupBy("doc_id").agg(
        F.count_distinct("item_id").alias("n_items"), F.max(F.struct("coverage", (-F.col("item_id")).alias("less"))).alias("best"))
    every = docs.where(F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id"))
    return every.join(found, "doc_id", "left").select(
        "doc_id", F.coalesce("n_items", F.lit(0)).alias("n_items"), (-F.col("best.less")).alias("item_id"),
        F.coalesce("best.coverage", F.lit(0.0)).alias("coverage"), F.col("best").isNotNull().alias("contaminated"))
