"""Near-duplicate documents: MinHash bands, odd sketches, exact confirmation.

A document is the set of its distinct word shingles. One hash per shingle, dealt
to bins, gives a MinHash sample per bin (empty bins borrow from another). Equal
bands of samples make candidates; an odd sketch, the parity bitmap of all
samples, estimates a candidate's similarity from the number of bits that differ,
precisely where similarity is high. What the estimate can't exclude is confirmed
on the full sets. Documents with the same set are one row until the end.

Defined results: texts without a word (null too) have no shingle and stand alone;
texts of fewer words than a shingle have their whole sequence as the one
shingle; a repeated doc_id is an own row of the same id; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from florametrics.llm.common import only_of, saved, ship_modules, texts
from florametrics.llm.linking import FEW, link
from florametrics.llm.words import mix, shingles, word_hashes
from florametrics.operators.pairwise import meetings
from florametrics.session import ship

SAMPLES, BANDS, BITS = 256, 32, 1024


@lru_cache(maxsize=1)
def _lenders() -> np.ndarray:
    """For each bin, the order in which it asks the others for a sample."""
    rng = np.random.default_rng(5)
    return np.stack([rng.permutation(SAMPLES) for _ in range(SAMPLES)])


def samples(hashes: np.ndarray) -> np.ndarray:
    """MinHash samples of a sorted array of distinct 64-bit hashes: the least of each bin, borrowed where a bin is empty."""
    bins = (hashes >> np.uint64(56)).astype(np.int64)
    first = np.searchsorted(bins, np.arange(SAMPLES))
    full = (first < len(bins)) & (bins[np.minimum(first, len(bins) - 1)] == np.arange(SAMPLES))
    if not full.all():
        order = _lenders()[~full]
        first[~full] = first[order[np.arange(len(order)), full[order].argmax(1)]]
    return hashes[first]


def odd_sketch(sample: np.ndarray) -> bytes:
    """Parity of how many (bin, sample) pairs fall on each bit."""
    at = mix(sample * np.uint64(0xD6E8FEB86659FD93) + np.arange(SAMPLES, dtype=np.uint64)) >> np.uint64(54)
    return np.packbits(np.bincount(at.astype(np.int64), minlength=BITS).astype(np.uint8) & 1).tobytes()


def similarity(differing: np.ndarray) -> np.ndarray:
    """Estimated Jaccard similarity from the number of differing bits of two odd sketches."""
    return 1 + BITS / (4 * SAMPLES) * np.log(np.maximum(1 - 2 * differing / BITS, 1e-9))


def _sets(texts_: list[bytes], words: int):
    """Sorted distinct shingle hashes of each text."""
    for i in range(0, len(texts_), 64):
        hashes, edges = word_hashes(texts_[i:i + 64])
        for a, b in zip(edges, edges[1:]):
            yield np.unique(shingles(hashes[a:b], words))


def _sketch_task(words: int):
    def task(frames):
        for pdf in frames:
            out = []
            for doc_id, own in zip(pdf.doc_id, _sets([t.encode() for t in pdf.text], words)):
                if not len(own):
                    out.append((doc_id, 0, None, None, None))
                    continue
                sample = samples(own)
                bands = mix(sample.reshape(BANDS, -1) + np.arange(BANDS, dtype=np.uint64)[:, None])
                bands = mix(np.bitwise_xor.reduce(mix(bands * np.arange(1, 2 * bands.shape[1], 2, dtype=np.uint64)), axis=1))
                out.append((doc_id, len(own), hashlib.blake2b(own.tobytes(), digest_size=16).digest(), odd_sketch(sample), bands.view(np.int64)))
            yield pd.DataFrame(out, columns=["doc_id", "n_shingles", "same", "sketch", "bands"])
    return task


def _confirm_task(words: int, percent: int):
    def task(frames):
        for pdf in frames:
            good = [
                100 * (both := len(np.intersect1d(x, y, assume_unique=True))) >= percent * (len(x) + len(y) - both)
                for x, y in zip(_sets([t.encode() for t in pdf.text_a], words), _sets([t.encode() for t in pdf.text_b], words))]
            yield pdf.loc[good, ["a", "b"]]
    return task


def _alike(words: int, percent: int):
    """Confirmation of two lists of texts against each other on their full sets, counted by shared shingle."""
    def alike(left: list[bytes], right: list[bytes], near: np.ndarray) -> np.ndarray:
        a, b = list(_sets(left, words)), list(_sets(right, words))
        size_a, size_b = np.array([len(s) for s in a]), np.array([len(s) for s in b])
        names, code = np.unique(np.concatenate(a + b), return_inverse=True)
        row = np.repeat(np.arange(len(a) + len(b)), np.concatenate([size_a, size_b]))
        order = np.argsort(code, kind="stable")
        code, row = code[order], row[order]
        of_a = row < len(a)
        row_a, row_b = row[of_a], row[~of_a] - len(a)
        both = np.zeros(len(a) * len(b), np.int64)
        for i, j in meetings(code[of_a], code[~of_a], len(names), 1_000_000):
            both += np.bincount(row_a[i] * len(b) + row_b[j], minlength=len(both))
        both = both.reshape(len(a), len(b))
        return 100 * both >= percent * (size_a[:, None] + size_b[None, :] - both)
    return alike


def _estimate_task(least: float):
    def task(frames):
        for pdf in frames:
            if len(pdf):
                x = np.frombuffer(b"".join(pdf.sketch_a), np.uint8) ^ np.frombuffer(b"".join(pdf.sketch_b), np.uint8)
                differing = np.bitwise_count(x).reshape(len(pdf), -1).sum(1)
                pdf = pdf[similarity(differing) >= least]
            yield pdf[["a", "b"]]
    return task


def near_duplicates(docs: DataFrame, words: int = 3, percent: int = 85, margin: float = 0.1) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every document; links where ``100 * both >= percent * either``.

    ``margin`` is how far below ``percent`` an estimate still goes to confirmation (some four standard deviations).
    """
    ship_modules()
    ship(meetings)
    rows = texts(docs)
    sketched = saved(rows.mapInPandas(_sketch_task(words), "doc_id long, n_shingles long, same binary, sketch binary, bands array<long>"), "sketches")
    heads = saved(sketched.where("same IS NOT NULL").groupBy("same").agg(
        F.min("doc_id").alias("id"), F.first("n_shingles").alias("n"), F.first("sketch").alias("sketch"), F.first("bands").alias("bands")), "sets")
    keyed = heads.select(F.explode("bands").alias("key"), "id", F.col("n").alias("tag"))
    sketch = heads.select("id", "sketch")

    def verify(pairs: DataFrame) -> DataFrame:
        sized = pairs.join(sketch.toDF("a", "sketch_a"), "a").join(sketch.toDF("b", "sketch_b"), "b")
        likely = saved(sized.mapInPandas(_estimate_task(percent / 100 - margin), "a long, b long"), "likely")
        wanted = likely.select(F.explode(F.array("a", "b")).alias("id")).distinct()
        held = saved(only_of(rows, wanted), "texts")
        both = likely.join(held.toDF("a", "text_a"), "a").join(held.toDF("b", "text_b"), "b")
        return both.mapInPandas(_confirm_task(words, percent), "a long, b long")

    def members(ids: DataFrame) -> DataFrame:
        return saved(only_of(rows, ids), "texts").withColumnRenamed("doc_id", "id")

    size = lambda a, b: F.least(a, b) * 100 >= F.greatest(a, b) * percent
    most = int((similarity(np.arange(BITS // 2)) >= percent / 100 - margin).sum()) - 1
    found = link(keyed, verify, sketch.withColumnRenamed("sketch", "bits"), most, size, members=members, alike=_alike(words, percent), few=FEW)
    of_set = heads.select("same", "id").join(found, "id", "left").select("same", F.coalesce("component", "id").alias("component_id"))
    placed = sketched.select("doc_id", "n_shingles", "same").join(of_set, "same", "left").withColumn("component_id", F.coalesce("component_id", "doc_id"))
    return placed.select("doc_id", "n_shingles", "component_id", (F.col("doc_id") == F.col("component_id")).alias("kept"))
