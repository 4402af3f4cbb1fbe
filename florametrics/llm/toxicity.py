"""Toxicity: a linear classifier of character n-grams scaled by naive Bayes log-count ratios.

Features are the hashed byte n-grams that a text holds (lower-cased A-Z, present
or not), however long it is. The log-count ratio of a feature compares how many
toxic and other training texts hold it; the features with most evidence enter a
logistic regression, each scaled by its ratio.

Defined results: null and empty texts hold no feature and get the intercept's
score; a repeated doc_id is scored per row; labels other than 0 and 1 are not
learned from; with one class only the score is 0.5; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from florametrics.llm.common import scored, ship_modules

SIZES = (4, 5)
BITS = 20


def hashed(text: bytes) -> np.ndarray:
    """Hashed n-grams of a text, one per place; white space counts as one blank, and the text's ends as blanks."""
    data = np.frombuffer(b" " + b" ".join(text.lower().split()) + b" ", dtype=np.uint8).astype(np.uint32)
    found = []
    for n in SIZES:
        if len(data) >= n:
            h = np.full(len(data) - n + 1, n * 0x9E3779B1 & 0xFFFFFFFF, dtype=np.uint32)
            for i in range(n):
                h = (h ^ data[i:len(data) - n + 1 + i]) * np.uint32(0x01000193)
            h ^= h >> np.uint32(15)
            h *= np.uint32(0x2C1B3C6D)
            found.append(h >> np.uint32(32 - BITS))
    return np.concatenate(found) if found else np.zeros(0, np.uint32)


def _count_task(frames):
    tally = np.zeros((2, 1 << BITS), dtype=np.int32)
    for pdf in frames:
        for text, y in zip(pdf.text, pdf.y):
            tally[y, np.unique(hashed(text.encode()))] += 1
    ids = np.flatnonzero(tally.any(0))
    for i in range(0, len(ids), 50_000):
        own = ids[i:i + 50_000]
        yield pd.DataFrame({"feature": own, "negative": tally[0, own], "positive": tally[1, own]})


def _held(slot: np.ndarray, text: bytes) -> np.ndarray:
    """The chosen features that a text holds, each once; ``slot`` is -1 for those not chosen."""
    own = slot[hashed(text)]
    return np.unique(own[own >= 0])


def _slots(chosen: np.ndarray) -> np.ndarray:
    slot = np.full(1 << BITS, -1, dtype=np.int32)
    slot[chosen] = np.arange(len(chosen))
    return slot


def _pick_task(chosen: np.ndarray):
    def task(frames):
        slot = _slots(chosen)
        for pdf in frames:
            yield pd.DataFrame({"doc_id": pdf.doc_id, "y": pdf.y, "held": [_held(slot, t.encode()).tobytes() for t in pdf.text]})
    return task


def fit(rows: DataFrame, max_features: int = 512, smoothing: float = 1.0, rounds: int = 400) -> dict | None:
    """Model from a bounded table of (doc_id, text, y) rows; None without both labels."""
    ship_modules()
    sizes = {r["y"]: r["n"] for r in rows.groupBy("y").agg(F.count("*").alias("n")).collect()}
    if len(sizes) < 2:
        return None
    share = sizes[1] / (sizes[0] + sizes[1])
    n = F.col("positive") + F.col("negative")
    surprise = lambda c, p: F.when(F.col(c) > 0, F.col(c) * F.log(F.col(c) / (n * p))).otherwise(0.0)
    tallied = (
        rows.mapInPandas(_count_task, "feature long, negative long, positive long").groupBy("feature")
        .agg(F.sum("negative").alias("negative"), F.sum("positive").alias("positive")).where(n >= 3)
        .withColumn("r", F.log((F.col("positive") + smoothing) / (sizes[1] + 2 * smoothing))
                    - F.log((F.col("negative") + smoothing) / (sizes[0] + 2 * smoothing)))
        # The log-likelihood ratio of the feature's counts against the classes' shares.
        .withColumn("evidence", surprise("positive", share) + surprise("negative", 1 - share)))
    best = tallied.orderBy(F.desc("evidence"), "feature").limit(max_features).select("feature", "r").collect()
    best = sorted((r["feature"], r["r"]) for r in best)
    chosen, r = np.array([b[0] for b in best], dtype=np.uint32), np.array([b[1] for b in best])
    got = rows.mapInPandas(_pick_task(chosen), "doc_id long, y int, held binary").collect()
    got.sort(key=lambda x: (x["doc_id"], x["y"]))
    held = [np.frombuffer(g["held"], dtype=np.int32) for g in got]
    return {"features": chosen} | _regress(held, np.array([g["y"] for g in got], dtype=float), r, rounds)


def _regress(held: list[np.ndarray], y: np.ndarray, r: np.ndarray, rounds: int, decay: float = 1e-4) -> dict:
    """Logistic regression on the ratios of the held features, by accelerated gradient steps."""
    row = np.repeat(np.arange(len(held)), [len(h) for h in held])
    col = np.concatenate(held) if held else np.zeros(0, np.int32)
    x, n = r[col], len(y)
    w = back = np.zeros(len(r))
    b = float(np.log(y.mean() / (1 - y.mean())))
    power = np.full(len(r), 1 / max(1, len(r)) ** 0.5)
    for _ in range(20):  # the largest curvature sets the step
        z = np.bincount(row, x * power[col], n)
        power = np.bincount(col, x * z[row], len(r)) / n
        top = np.linalg.norm(power) or 1.0
        power /= top
    rate = 1 / (0.25 * top + 0.25 + decay)
    prior = b
    for k in range(rounds):
        v, c = w + k / (k + 3) * (w - back), b + k / (k + 3) * (b - prior)
        p = 1 / (1 + np.exp(-np.clip(np.bincount(row, x * v[col], n) + c, -30, 30)))
        d = (p - y) / n
        back, prior = w, b
        w, b = v - rate * (np.bincount(col, x * d[row], len(r)) + decay * v), c - rate * d.sum()
    return {"weights": w * r, "bias": b}


def _scores(model: dict | None):
    def run(texts_: list[bytes]) -> np.ndarray:
        if not model:
            return np.full(len(texts_), 0.5)
        slot = _slots(model["features"])
        z = np.array([model["weights"][_held(slot, t)].sum() for t in texts_]) + model["bias"]
        return 1 / (1 + np.exp(-np.clip(z, -500, 500)))
    return run


def score(docs: DataFrame, model: dict | None, out: str = "score") -> DataFrame:
    """All columns and ``out`` (0 to 1, higher: label 1 likelier), for every row."""
    return scored(docs, _scores(model), out)
