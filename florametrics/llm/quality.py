"""Quality classifier: attention-based multiple-instance learning.

A document is a bag of passages of ``PASSAGE`` words. Every passage is encoded
from its own bytes (frequencies of neighbouring character classes, word lengths,
words equal to the word before), a hidden layer makes it a vector, gated
attention weighs the vectors, and the weighted mean is scored. Only documents
have labels; attention and encoder are learned from those.

Defined results: a null or empty text is one passage of zeros and gets a score
like any other; a repeated doc_id is scored per row; labels that are null, or
not 0 or 1, are not learned from; without any labelled row the score is 0.5;
an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from florametrics.llm.common import scored, ship_modules

PASSAGE = 50
CLASSES = 16
WIDTH = CLASSES * CLASSES + 4
HIDDEN, GATE = 24, 12


def _class_table() -> np.ndarray:
    """Byte to character class: letters, digits, white space and the kinds of marks."""
    of = np.full(256, 15, dtype=np.uint8)
    of[128:] = 2
    groups = ["abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "", "0123456789", " \t\r\f\v", "\n", ".", ",;:",
              "!", "?", "|", "*", "#$%&", "'\"()[]", "-_=/\\@+"]
    for i, chars in enumerate(groups):
        for c in chars:
            of[ord(c)] = i
    return of


CLASS_OF = _class_table()


def encode(texts_: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Passage vectors of many texts at once, and the text that each passage belongs to."""
    data = np.frombuffer(b"".join(t + b"\n" for t in texts_), dtype=np.uint8)
    ends = np.cumsum([len(t) + 1 for t in texts_])
    doc = np.repeat(np.arange(len(texts_)), np.diff(ends, prepend=0))
    kind = CLASS_OF[data]
    space = (kind == 4) | (kind == 5)
    first = ~space & np.concatenate([[True], space[:-1]])
    nth = np.cumsum(first)
    base = np.concatenate([[0], nth[ends - 1]])  # words up to the end of each text
    words = np.diff(base)
    counts = np.maximum(1, -(-words // PASSAGE))
    offset = np.concatenate([[0], np.cumsum(counts)])
    at = offset[doc] + np.maximum(nth - 1 - base[doc], 0) // PASSAGE
    n = int(offset[-1])
    code = at[1:] * (CLASSES * CLASSES) + kind[:-1].astype(np.int64) * CLASSES + kind[1:]
    same = doc[1:] == doc[:-1]
    pairs = np.bincount(code[same], minlength=n * CLASSES * CLASSES).reshape(n, -1).astype(np.float32)
    total = np.maximum(pairs.sum(1, keepdims=True), 1)
    out = np.zeros((n, WIDTH), dtype=np.float32)
    out[:, :-4] = np.sqrt(pairs / total)
    starts = np.flatnonzero(first)
    if len(starts):
        inside = np.arange(len(data)) - np.repeat(starts, np.diff(np.append(starts, len(data)))) if starts[0] == 0 else \
            np.concatenate([np.zeros(starts[0], np.int64), np.arange(starts[0], len(data)) - np.repeat(starts, np.diff(np.append(starts, len(data))))])
        size = np.add.reduceat((~space).astype(np.int64), starts)
        mark = np.add.reduceat(np.where(space, 0, data.astype(np.int64) * (inside * 31 + 7)), starts)
        where, of = at[starts], doc[starts]
        again = np.concatenate([[False], (mark[1:] == mark[:-1]) & (size[1:] == size[:-1]) & (of[1:] == of[:-1])])
        m = np.maximum(np.bincount(where, minlength=n), 1)
        out[:, -4] = np.bincount(where, again, n) / m
        out[:, -3] = np.log1p(np.bincount(where, size, n) / m) / 3
        out[:, -2] = np.bincount(where, size == 1, n) / m
        out[:, -1] = np.log1p(np.bincount(where, minlength=n)) / np.log1p(PASSAGE)
    return out, np.repeat(np.arange(len(texts_)), counts)


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def forward(model: dict, x: np.ndarray, bag: np.ndarray, n: int) -> dict:
    """Scores of ``n`` bags; ``bag`` is sorted and every bag has a passage."""
    h = np.tanh((x - model["mean"]) / model["dev"] @ model["E"] + model["e"])
    t, g = np.tanh(h @ model["V"]), _sigmoid(h @ model["U"])
    a = (t * g) @ model["w"]
    starts = np.searchsorted(bag, np.arange(n))
    a = np.exp(a - np.maximum.reduceat(a, starts)[bag])
    a /= np.add.reduceat(a, starts)[bag]
    z = np.add.reduceat(h * a[:, None], starts)
    return {"h": h, "t": t, "g": g, "a": a, "z": z, "p": _sigmoid(z @ model["c"] + model["b"]), "starts": starts}


def train(x: np.ndarray, bag: np.ndarray, y: np.ndarray, epochs: int = 30, batch: int = 64, rate: float = 0.01,
          decay: float = 1e-3, seed: int = 7) -> dict:
    """Gated attention and encoder by Adam on the documents' log loss."""
    rng = np.random.default_rng(seed)
    near = lambda *s: rng.normal(0, 1 / np.sqrt(s[0]), s)
    model = {"E": near(x.shape[1], HIDDEN), "e": np.zeros(HIDDEN), "V": near(HIDDEN, GATE), "U": near(HIDDEN, GATE),
             "w": near(GATE), "c": near(HIDDEN), "b": np.zeros(())}
    fixed = {"mean": x.mean(0), "dev": x.std(0) + 0.02}
    first = {k: np.zeros_like(v) for k, v in model.items()}
    second = {k: np.zeros_like(v) for k, v in model.items()}
    edge = np.searchsorted(bag, np.arange(len(y) + 1))
    steps = 0
    for _ in range(epochs):
        order = rng.permutation(len(y))
        for lot in np.array_split(order, max(1, len(y) // batch)):
            rows = np.concatenate([np.arange(edge[i], edge[i + 1]) for i in lot])
            own = np.repeat(np.arange(len(lot)), edge[lot + 1] - edge[lot])
            f = forward(model | fixed, x[rows], own, len(lot))
            d = (f["p"] - y[lot]) / len(lot)
            dz = d[:, None] * model["c"]
            inner = (f["h"] * dz[own]).sum(1)
            da = f["a"] * (inner - np.add.reduceat(f["a"] * inner, f["starts"])[own])
            dt = da[:, None] * model["w"] * f["g"] * (1 - f["t"] ** 2)
            dg = da[:, None] * model["w"] * f["t"] * f["g"] * (1 - f["g"])
            dh = f["a"][:, None] * dz[own] + dt @ model["V"].T + dg @ model["U"].T
            dh *= 1 - f["h"] ** 2
            grad = {"E": ((x[rows] - fixed["mean"]) / fixed["dev"]).T @ dh, "e": dh.sum(0), "V": f["h"].T @ dt, "U": f["h"].T @ dg,
                    "w": (da[:, None] * f["t"] * f["g"]).sum(0), "c": f["z"].T @ d, "b": d.sum()}
            steps += 1
            for k in model:
                g = grad[k] + decay * model[k] * (k != "b")
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                model[k] = model[k] - rate * first[k] / (1 - 0.9**steps) / (np.sqrt(second[k] / (1 - 0.999**steps)) + 1e-8)
    return {k: np.asarray(v, dtype=np.float32) for k, v in (model | fixed).items()}


def _encode_task(frames):
    for pdf in frames:
        for i in range(0, len(pdf), 64):
            part = pdf.iloc[i:i + 64]
            x, bag = encode([t.encode() for t in part.text])
            blocks = np.split(x, np.searchsorted(bag, np.arange(1, len(part))))
            yield pd.DataFrame({"doc_id": part.doc_id.to_numpy(), "y": part.y.to_numpy(), "x": [b.tobytes() for b in blocks]})


def fit(labelled: DataFrame, **options) -> dict | None:
    """Model from a bounded table of (doc_id, text, y) rows; None without both labels."""
    ship_modules()
    got = labelled.mapInPandas(_encode_task, "doc_id long, y int, x binary").collect()
    got.sort(key=lambda r: (r["doc_id"], r["y"], r["x"]))
    if len({r["y"] for r in got}) < 2:
        return None
    blocks = [np.frombuffer(r["x"], dtype=np.float32).reshape(-1, WIDTH) for r in got]
    bag = np.repeat(np.arange(len(blocks)), [len(b) for b in blocks])
    return train(np.concatenate(blocks), bag, np.array([r["y"] for r in got], dtype=float), **options)


def _scores(model: dict | None):
    def run(texts_: list[bytes]) -> np.ndarray:
        out = np.full(len(texts_), 0.5)
        for i in range(0, len(texts_) if model else 0, 64):
            x, bag = encode(texts_[i:i + 64])
            out[i:i + 64] = forward(model, x, bag, len(texts_[i:i + 64]))["p"]
        return out
    return run


def score(docs: DataFrame, model: dict | None, out: str = "score") -> DataFrame:
    """All columns and ``out`` (0 to 1, higher: label 1 likelier), for every row."""
    return scored(docs, _scores(model), out)
