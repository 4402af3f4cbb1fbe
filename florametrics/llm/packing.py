"""Best-fit packing by a configuration linear program.

The lengths of all pieces form a histogram of at most ``capacity`` counts; that
histogram is all the driver sees. A configuration is a multiset of lengths that
fits one sequence. The covering program (fewest sequences, every length used as
often as it occurs) is solved by multiplicative weights: each round prices the
lengths by their weights, finds the best configurations by a knapsack dynamic
program, and lowers the weights of what they cover, until every length is
covered. The fractional solution is rounded; what rounding leaves is placed
best-fit, largest first, on the histogram.
Pieces then take the places of their length in order of rank.
"""

from __future__ import annotations

import json
import zlib
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from florametrics.llm.common import saved, ship_modules, texts

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
PLACED = PIECES + ", sequence_id long, offset long"
#: How much more than its tokens a length of the whole capacity is worth, and about how many lengths one knapsack picks from.
LONG, GROUP = 1.0, 128
#: The split pattern of the byte-level vocabulary (fixed value), in its form without backtracking.
SPLIT = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"""


@lru_cache(maxsize=2)
def encoder(path: str):
    """Text to token ids (numpy) for a byte-level BPE file, once per worker.

    The ranks come from the file itself. A text that holds the spelling of a
    special token goes to the file's own library.
    """
    import tiktoken
    from tokenizers import Tokenizer

    with open(path, encoding="utf-8") as f:
        model = json.load(f)
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte_of = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(x for x in range(256) if x not in plain)}
    special = [t["content"] for t in model.get("added_tokens", [])]
    ranks = {bytes(byte_of[c] for c in t): i for t, i in model["model"]["vocab"].items() if t not in special}
    fast = tiktoken.Encoding("ranks", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})
    own = Tokenizer.from_file(path)

    def encode(text: str) -> np.ndarray:
        if any(s in text for s in special):
            return np.array(own.encode(text, add_special_tokens=False).ids, dtype="<u4")
        return fast.encode_to_numpy(text)

    return encode


def _cut(path: str, end_id: int, capacity: int):
    def task(frames):
        encode = encoder(path)
        end = np.array([end_id], dtype="<u4")
        for pdf in frames:
            out = []
            for doc_id, text in zip(pdf.doc_id, pdf.text):
                ids = np.concatenate([encode(text), end]).astype("<u4")
                first = len(ids) % capacity or capacity
                cuts = [0, *range(first, len(ids) + 1, capacity)]
                out += [(doc_id, i, a, b - a, zlib.crc32(ids[a:b].tobytes())) for i, (a, b) in enumerate(zip(cuts, cuts[1:]))]
            yield pd.DataFrame(out, columns=["doc_id", "piece", "start", "length", "ids_crc32"])
    return task


def pieces(docs: DataFrame, tokenizer: str, capacity: int = 1024, end_id: int = 2) -> DataFrame:
    """Token pieces of every document: ids, then ``end_id``; longer ones cut so that only the first piece is short.

    A null or empty text gives one piece that holds the end id alone; a repeated
    doc_id gives its pieces once per row; an empty table gives no rows.
    """
    ship_modules()
    return texts(docs).mapInPandas(_cut(tokenizer, end_id, capacity), PIECES)


def price(lengths: np.ndarray, values: np.ndarray, capacity: int) -> list[dict[int, int]]:
    """Knapsack by dynamic programming, for each row of lengths: the multiset of most value that fits; lengths without value are not used."""
    rows = len(lengths)
    best = np.full((2 * capacity + 1, rows), -np.inf)  # a room below 0 holds nothing
    best[capacity] = 0
    take, flat = np.full((capacity + 1, rows), -1), best.ravel()
    at, every = (capacity - lengths) * rows + np.arange(rows)[:, None], np.arange(rows)
    for room in range(1, capacity + 1):
        got = flat[at + room * rows] + values
        i = got.argmax(1)
        most, before = got[every, i], best[capacity + room - 1]
        take[room] = np.where(most > before, i, -1)
        best[capacity + room] = np.maximum(most, before)
    out = []
    for row in range(rows):
        config, room = {}, capacity
        while room > 0:
            i = take[room, row]
            length = int(lengths[row, i]) if i >= 0 else 0
            if length:
                config[length] = config.get(length, 0) + 1
            room -= length or 1
        out.append(config)
    return out


def solve(counts: dict[int, int], capacity: int, rounds: int = 400, step: float = 0.05) -> list[tuple[dict[int, int], float]]:
    """Configurations with fractional counts that use every length as often as it occurs: multiplicative weights, knapsack pricing.

    Weight ``exp(-covered share)``. A round deals the lengths not yet covered to
    groups of some 128, long and short ones to each, and adds the best
    configuration of every group until the scarcest of its lengths is covered by
    a further ``step``, or at all. After ``rounds`` rounds a configuration covers
    its scarcest length at once, so that the last lengths take few rounds.
    """
    sizes = np.array(sorted(n for n, c in counts.items() if c > 0), dtype=np.int64)
    need = np.array([counts[n] for n in sizes.tolist()], dtype=float)
    place = {n: i for i, n in enumerate(sizes.tolist())}
    left, found, rng, turn = need.copy(), {}, np.random.default_rng(0), 0
    while (left > 0).any():
        open_ = np.flatnonzero(left > 0)
        groups = -(-len(open_) // GROUP)
        dealt = np.full(-(-len(open_) // groups) * groups, -1)
        dealt[:len(open_)] = open_
        dealt = rng.permuted(dealt.reshape(-1, groups), axis=1).T
        covered = 1 - left / need
        # Under equal weights a length is worth its tokens, so that full sequences win; long ones, which fewer configurations hold, a little more.
        worth = np.exp(-(covered - covered[open_].min()) * 4) * sizes * (1 + LONG * sizes / capacity)
        for config in price(np.where(dealt < 0, capacity, sizes[dealt]), np.where(dealt < 0, -np.inf, worth[dealt]), capacity):
            at = np.array([place[n] for n in config])
            used = np.array(list(config.values()), dtype=float)
            most = float((left[at] / used).min())
            amount = most if turn >= rounds else min(most, max(1.0, float((need[at] / used).min()) * step))
            left[at] -= amount * used
            left[at[left[at] < 1e-9 * need[at]]] = 0
            key = tuple(sorted(config.items()))
            found[key] = found.get(key, 0.0) + amount
        turn += 1
    return [(dict(k), v) for k, v in found.items()]


def rounded(solved: list[tuple[dict[int, int], float]], counts: dict[int, int]) -> tuple[list[tuple[dict[int, int], int]], dict[int, int]]:
    """Whole counts of a fractional solution, what one configuration loses going to the next, and how often each length is then left."""
    left, whole, due = dict(counts), [], 0.0
    for config, amount in solved:
        due += amount
        times = max(0, min(int(due + 1e-9), *(left[k] // v for k, v in config.items())))
        due = min(due - times, 1.0)
        if times > 0:
            whole.append((config, times))
            for k, v in config.items():
                left[k] -= v * times
    return whole, {k: v for k, v in left.items() if v > 0}


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[dict[int, int], int]]:
    """Best fit, largest first, on counts: equal sequences are one entry, so time depends on the lengths, not on the rows."""
    open_: dict[int, list[tuple[dict[int, int], int]]] = {}
    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left > 0:
            rooms = [r for r, held in open_.items() if r >= length and held]
            if rooms:
                room = min(rooms)
                config, times = open_[room].pop()
            else:
                room, config, times = capacity, {}, left
            each = min(room // length, left)
            use = min(times, left // each)
            if rooms and times > use:
                open_[room].append((config, times - use))
            open_.setdefault(room - each * length, []).append((config | {length: each}, use))
            left -= each * use
    return [entry for held in open_.values() for entry in held]


def plan(counts: dict[int, int], capacity: int, rounds: int = 400) -> list[tuple[dict[int, int], int]]:
    """Configurations with whole counts that use every length exactly as often as it occurs.

    They come from the fractional solution, fullest first; only what its rounding leaves is placed best-fit.
    """
    counts = {k: v for k, v in counts.items() if v > 0}
    solved = sorted(solve(counts, capacity, rounds), key=lambda x: -sum(k * v for k, v in x[0].items()))

    covered = dict.fromkeys(counts, 0.0)
    for config, amount in solved:
        for k, v in config.items():
            covered[k] += amount * v
    assert all(covered[k] >= n * (1 - 1e-6) for k, n in counts.items()), "a length is not covered by the program"
    whole, left = rounded(solved, counts)
    return whole + best_fit(left, capacity)


def _places(entries: list[tuple[dict[int, int], int]]):
    """Sorted arrays that turn (length, rank) into a place; as long as the plan, whatever the rows."""
    at, base = {}, 0
    rows = []
    for config, times in entries:
        offset = 0
        for length in sorted(config, reverse=True):
            each = config[length]
            rows.append((length, at.get(length, 0), base, each, offset))
            at[length] = at.get(length, 0) + each * times
            offset += each * length
        base += times
    rows.sort()
    return np.array(rows, dtype=np.int64).reshape(-1, 5)


def _place(rows: np.ndarray):
    def task(frames):
        keys = (rows[:, 0] << 44) + rows[:, 1]
        for pdf in frames:
            length, rank = pdf.length.to_numpy(np.int64), pdf["rank"].to_numpy(np.int64)
            entry = rows[np.searchsorted(keys, (length << 44) + rank, side="right") - 1]
            nth = rank - entry[:, 1]
            yield pdf.drop(columns="rank").assign(
                sequence_id=entry[:, 2] + nth // entry[:, 3], offset=entry[:, 4] + (nth % entry[:, 3]) * length)
    return task


def pack(docs: DataFrame, tokenizer: str, capacity: int = 1024, end_id: int = 2, rounds: int = 400) -> DataFrame:
    """Every piece with its sequence and its place there; sequences are gapless from 0 and hold at most ``capacity`` tokens."""
    cut = saved(pieces(docs, tokenizer, capacity, end_id).withColumn("part", F.spark_partition_id()), "pieces")
    per_part = cut.groupBy("length", "part").agg(F.count("*").alias("n"))
    counts = {r["length"]: r["n"] for r in per_part.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    before = per_part.select(
        "length", "part", F.coalesce(F.sum("n").over(
            Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    # A rank within (length, part) keeps a frequent length from meeting in one task.
    ranked = cut.withColumn("nth", F.row_number().over(Window.partitionBy("length", "part").orderBy("doc_id", "piece")) - 1)
    ranked = ranked.join(before, ["length", "part"]).withColumn("rank", F.col("nth") + F.col("before"))
    names = [c.split()[0] for c in PIECES.split(", ")]
    return ranked.select(*names, "rank").mapInPandas(_place(_places(plan(counts, capacity, rounds))), PLACED)
