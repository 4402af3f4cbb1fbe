"""Ranked lexical search: the best documents of every item by an integer BM25, each distinct bag of words scored once.

A document is reduced to its bag: how often it holds each word of the items'
vocabulary, and ``m``, its length against the mean. Documents of equal bag and m
are one class whatever else they hold; a hash of both deals bags to tasks, and
grouping by the bag itself keeps bags apart that only share the hash. Classes are
scored against the items through the items' inverted index, the best are
expanded to their members by ascending doc_id.

An item's best ``k`` documents are in its best ``k`` classes by (score, smallest
doc_id), and among the ``k`` smallest members of each: every class or member
before them gives a document that goes before. So neither cut loses a row.

Items are dealt by hash into blocks of about ``POSTINGS`` words; a block's index is
what the driver and a task hold at a time, and documents are read once a block.

Defined results: null or wordless texts and items match nothing and count in no
statistic; rows of one item_id are one item; rows of one doc_id are documents of
their own; rows without an id take no part; a word that all documents hold may
weigh 0, and scores of 0 are no results; empty tables give no rows.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from florametrics.llm.common import saved, ship_modules, texts

POSTINGS = 200_000
#: Scores held at a time: rows of a lot times items of a block.
CELLS, PAIRS = 2_000_000, 4_000_000
#: ASCII other than letters and digits parts words; A-Z become a-z.
FOLDED = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in range(256)).lower()


def words(text: str) -> list[bytes]:
    return text.encode("utf-8", "replace").translate(FOLDED).split()


def _items_task(frames):
    for pdf in frames:
        for item_id, text in zip(pdf.item_id, pdf.text):
            held = Counter(words(text))
            yield pd.DataFrame({"item_id": item_id, "term": list(held), "times": np.fromiter(held.values(), np.int64, len(held))})


def item_terms(items: DataFrame) -> DataFrame:
    """(item_id, term, times) of the items' words."""
    ship_modules()
    rows = items.where(F.col("item_id").isNotNull()).select(
        F.col("item_id").cast("long").alias("item_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return rows.mapInPandas(_items_task, "item_id long, term binary, times long").groupBy("item_id", "term").agg(F.sum("times").alias("times"))


class Index:
    """Inverted index of a block of items."""

    def __init__(self, rows: pd.DataFrame):
        terms, place = np.unique(rows.term.to_numpy(object), return_inverse=True)
        self.items, item = np.unique(rows.item_id.to_numpy(np.int64), return_inverse=True)
        order = np.argsort(place, kind="stable")
        self.vocabulary = {t: i for i, t in enumerate(terms)}
        self.item, self.times = item[order], rows.times.to_numpy(np.int64)[order]
        self.edges = np.concatenate([[0], np.cumsum(np.bincount(place, minlength=len(terms)))])


def _bag_task(shared):
    def task(frames):
        vocabulary = shared.value.vocabulary
        for pdf in frames:
            out = []
            for doc_id, text in zip(pdf.doc_id, pdf.text):
                held = Counter(words(text))
                if held:
                    own = sorted((vocabulary[t], n) for t, n in held.items() if t in vocabulary)
                    out.append((doc_id, held.total(), np.array(own, np.int32).T.tobytes()))
            yield pd.DataFrame(out, columns=["doc_id", "n", "bag"])
    return task


def _bag(data: bytes) -> np.ndarray:
    """Two rows: words, and how often each occurs."""
    return np.frombuffer(data, np.int32).reshape(2, -1)


def _frequency_task(size: int):
    def task(frames):
        held = np.zeros(size, np.int64)
        for pdf in frames:
            for i in range(0, len(pdf), 1000):
                bags = [_bag(b)[0] for b in pdf.bag.iloc[i:i + 1000]]
                member = np.repeat(pdf.members.iloc[i:i + 1000].to_numpy(np.int64), [len(b) for b in bags])
                np.add.at(held, np.concatenate(bags), member)
        some = np.flatnonzero(held)
        yield pd.DataFrame({"term": some, "df": held[some]})
    return task


def scores(bags: list[bytes], m: np.ndarray, weight: np.ndarray, index: Index) -> np.ndarray:
    """Scores (bags x items), in whole numbers."""
    out = np.zeros(len(bags) * len(index.items), np.int64)
    pairs = [_bag(b) for b in bags]
    row = np.repeat(np.arange(len(bags)), [p.shape[1] for p in pairs])
    term, tf = np.concatenate(pairs, axis=1).astype(np.int64)
    gain = weight[term] * (1_000_000_000 * tf // (1000 * tf + 8 * m[row]))
    n = index.edges[term + 1] - index.edges[term]
    for cut in np.split(np.arange(len(term)), np.flatnonzero(np.diff(np.cumsum(n) // PAIRS)) + 1):
        k = n[cut]
        posting = np.repeat(index.edges[term[cut]] - np.cumsum(k) + k, k) + np.arange(k.sum())
        np.add.at(out, np.repeat(row[cut], k) * len(index.items) + index.item[posting], np.repeat(gain[cut], k) * index.times[posting])
    return out.reshape(len(bags), -1)


def _best(found: pd.DataFrame, k: int) -> pd.DataFrame:
    found = found.sort_values(["item", "score", "first_id"], ascending=[True, False, True], kind="stable")
    return found[found.groupby("item").cumcount() < k]


def _score_task(shared, k: int):
    def task(frames):
        weight, index = shared.value
        best = pd.DataFrame({"item": np.zeros(0, np.int64), "score": np.zeros(0, np.int64), "first_id": np.zeros(0, np.int64), "h": np.zeros(0, np.int64),
                             "m": np.zeros(0, np.int64), "bag": np.zeros(0, object)})
        lot = max(1, CELLS // len(index.items))
        for pdf in frames:
            for i in range(0, len(pdf), lot):
                part = pdf.iloc[i:i + lot].reset_index(drop=True)
                score = scores(list(part.bag), part.m.to_numpy(np.int64), weight, index)
                # Ties with the k-th score stay until smaller ids decide.
                least = np.partition(score, len(score) - k, axis=0)[len(score) - k] if len(score) > k else 0
                row, item = np.nonzero((score >= least) & (score > 0))
                more = part.iloc[row].assign(item=item, score=score[row, item])
                best = _best(pd.concat([best, more[list(best.columns)]]), k)
        yield best.assign(item=index.items[best.item.to_numpy(np.int64)])
    return task


def _ranked(rows: DataFrame, keys: list[str], order: list, k: int, out: str) -> DataFrame:
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return rows.withColumn(out, place).where(F.col(out) <= k)


def _search_block(docs: DataFrame, index: Index, k: int) -> DataFrame:
    spark = docs.sparkSession
    bags = saved(texts(docs).mapInPandas(_bag_task(spark.sparkContext.broadcast(index)), "doc_id long, n long, bag binary"), "bags")
    n_docs, n_words = bags.agg(F.count("*"), F.sum("n")).first()
    if not n_docs:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    m = F.expr(f"25 + (75L * n * {n_docs}L) div {n_words}L")
    members = bags.where(F.length("bag") > 0).select("doc_id", m.alias("m"), "bag").withColumn("h", F.xxhash64("bag", "m"))
    classes = saved(members.groupBy("h", "m", "bag").agg(F.min("doc_id").alias("first_id"), F.count("*").alias("members")), "classes")
    counted = classes.select("bag", "members").mapInPandas(_frequency_task(len(index.vocabulary)), "term long, df long")
    held = counted.groupBy("term").agg(F.sum("df").alias("df")).withColumn(
        "weight", F.floor(F.lit(1000.0) * F.ln(F.lit(2.0 * n_docs + 2) / (F.col("df") * 2 + 1).cast("double")))).toPandas()
    weight = np.zeros(len(index.vocabulary), np.int64)
    weight[held.term.to_numpy(np.int64)] = held.weight.to_numpy(np.int64)
    near = classes.select("h", "m", "bag", "first_id").mapInPandas(
        _score_task(spark.sparkContext.broadcast((weight, index)), k), "item long, score long, first_id long, h long, m long, bag binary")
    best = saved(_ranked(near, ["item"], [F.desc("score"), "first_id", "h"], k, "place"), "best")
    # At most k classes an item of a block of bounded size: only their hashes are broadcast.
    wanted = members.join(F.broadcast(best.select("h").distinct()), "h", "left_semi")
    least = _ranked(wanted, ["h", "m", "bag"], ["doc_id"], k, "place").drop("place")
    found = best.select(F.col("item").alias("item_id"), "score", "h", "m", "bag").join(least, ["h", "m", "bag"])
    return _ranked(found.select("item_id", "doc_id", "score"), ["item_id"], [F.desc("score"), "doc_id"], k, "rank").select(
        "item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` documents of highest score above 0 per item, equal scores by ascending doc_id."""
    ship_modules()
    terms = saved(item_terms(items), "terms")
    blocks = max(1, math.ceil(terms.count() / POSTINGS))
    found = None
    for block in range(blocks):
        own = terms.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == block).toPandas()
        if len(own):
            part = _search_block(docs, Index(own), k)
            found = part if found is None else found.unionAll(part)
    return found if found is not None else docs.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
