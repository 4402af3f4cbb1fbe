"""Removal of byte strings that occur before, by column-wise suffix sorting of a collection.

All ``span``-byte strings that occur twice hold the same anchor at the same
place: of the hashes of their ``gram``-byte parts, the least. So only regions
around anchors that occur more than once are compared, and equal regions of an
anchor are one: every later one is a repeat throughout. Where an anchor has
several regions, these are the documents of a collection, built column by
column: each round puts one more symbol of every region, from its end to its
start, into the collection's Burrows-Wheeler transform at the place that the
last-to-first mapping gives. A symbol is a byte and its place beside the
anchor, since equal strings have it at the same place: so the suffixes that a
round adds lie together, and only the rows of the round before are mapped. In
the order of suffixes that results, neighbours whose common prefix reaches
``span`` are equal strings; all but the first in the corpus are repeats.
Anchors of more regions than a collection holds are compared string by string
in an aggregate.

Defined results: a null text is empty; texts shorter than ``span`` lose nothing; a repeated
doc_id counts as one document for "earlier" (equal starts are no repeats of each other); an
empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from florametrics.llm.common import bit_table, only_of, saved, ship_modules, texts
from florametrics.llm.words import may_hold, mix

GRAM = 24
FILTER_BITS = 27
_BASE = 0x9E3779B97F4A7C15
#: Another base than that of the anchors' hashes, so that regions of one anchor clash no more than others.
_REGION = 0xD6E8FEB86659FD93
_MASK = (1 << 64) - 1


def gram_hashes(data: np.ndarray, n: int) -> np.ndarray:
    """Hash of every ``n`` bytes in a row, put together from halves."""
    have, size, power = data.astype(np.uint64) + np.uint64(1), 1, _BASE
    out, done = None, 0
    while True:
        if n & size:
            if out is None:
                out, done = have, size
            else:
                shift = np.uint64(pow(_BASE, done, 1 << 64))
                m = min(len(out), len(have) - done)
                out, done = out[:m] + have[done:done + m] * shift, done + size
        size *= 2
        if size > n:
            return mix(out[:max(0, len(data) - n + 1)])
        half = size // 2
        have = have[:len(have) - half] + have[half:] * np.uint64(power)
        power = power * power & _MASK


def _slide(x: np.ndarray, n: int, pick) -> np.ndarray:
    """``pick`` (minimum or maximum) of every ``n`` values in a row."""
    size, out = 1, x
    while size * 2 <= n:
        out = pick(out[:len(out) - size], out[size:])
        size *= 2
    return pick(out[:len(x) - n + 1], out[n - size:n - size + len(x) - n + 1]) if size < n else out


def anchors(data: np.ndarray, span: int, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the grams that are least in some ``span`` bytes."""
    wide = span - gram + 1
    h = gram_hashes(data, gram) if len(data) >= span else np.zeros(0, np.uint64)
    if len(h) < wide:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    least = _slide(h, wide, np.minimum)
    edge = np.zeros(wide - 1, np.uint64)
    at = np.flatnonzero(_slide(np.concatenate([edge, least, edge]), wide, np.maximum) == h)
    return at, h[at]


@lru_cache(maxsize=1)
def _powers(bits: int) -> tuple[np.ndarray, np.ndarray]:
    n = 1 << bits
    up = np.cumprod(np.concatenate([[np.uint64(1)], np.full(n - 1, np.uint64(_REGION))]), dtype=np.uint64)
    down = np.cumprod(np.concatenate([[np.uint64(1)], np.full(n - 1, np.uint64(pow(_REGION, -1, 1 << 64)))]), dtype=np.uint64)
    return up, down


def _region_hash(data: np.ndarray, low: np.ndarray, high: np.ndarray, left: np.ndarray) -> np.ndarray:
    """64-bit hash of each region's bytes, length and the anchor's place in it."""
    up, down = _powers(max(16, int(len(data)).bit_length()))
    sums = np.concatenate([[np.uint64(0)], np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:len(data)], dtype=np.uint64)])
    return mix((sums[high] - sums[low]) * down[low] + (high - low).astype(np.uint64) * np.uint64(131) + left.astype(np.uint64)).view(np.int64)


def _anchor_task(span: int, table: np.ndarray | None = None):
    """Anchor hashes; with a bit table, those it may hold, with their regions' hashes and places."""
    reach = span - GRAM

    def task(frames):
        for pdf in frames:
            doc_ids, ats, hashes, regions = [], [], [], []
            for doc_id, text in zip(pdf.doc_id, pdf.text):
                data = np.frombuffer(text.encode(), dtype=np.uint8)
                at, h = anchors(data, span)
                if table is not None and len(at):
                    may = may_hold(table, h)
                    at, h = at[may], h[may]
                if not len(at):
                    continue
                hashes.append(h.view(np.int64))
                if table is not None:
                    low, high = np.maximum(at - reach, 0), np.minimum(at + span, len(data))
                    doc_ids.append(np.full(len(at), doc_id))
                    ats.append(at)
                    regions.append(_region_hash(data, low, high, at - low))
            if not hashes:
                continue
            h = np.concatenate(hashes)
            yield pd.DataFrame({"h": h, "r": np.concatenate(regions), "doc_id": np.concatenate(doc_ids), "at": np.concatenate(ats)}) if table is not None else pd.DataFrame({"h": h})
    return task


def sort_suffixes(strings: list[bytes], least: int) -> tuple[np.ndarray, np.ndarray]:
    """(string, start) of all suffixes of at least ``least`` bytes, in the order of a collection built column by column."""
    m = len(strings)
    size = np.array([len(s) for s in strings])
    columns = int(size.max(initial=0))
    # One row per string, its end at the right; 0 stands for the end marker, symbols for bytes plus one.
    grid = np.zeros((m, columns + 1), dtype=np.uint16)
    for i, s in enumerate(strings):
        grid[i, columns + 1 - len(s):] = np.frombuffer(s, np.uint8).astype(np.uint16) + 1
    string, length = np.arange(m, dtype=np.int32), np.zeros(m, dtype=np.int32)
    bwt = grid[:, columns].copy()  # round 0: the empty suffixes, by string
    place = np.arange(m)
    for j in range(1, columns + 1):
        order = np.argsort(bwt, kind="stable")
        to = np.empty(len(bwt), dtype=np.int64)
        # Ends sort first: they map onto the empty suffixes, all others behind these.
        ended = int((bwt == 0).sum())
        to[order] = np.arange(len(bwt)) + (m - ended)
        live = np.flatnonzero(size >= j)
        new = to[place[live]]
        by = np.argsort(new, kind="stable")
        # The new places count the suffixes inserted in this round, so subtract those before each.
        at = new[by] - np.arange(len(live))
        symbol = grid[live, columns - j]
        bwt = np.insert(bwt, at, symbol[by])
        string = np.insert(string, at, live[by].astype(np.int32))
        length = np.insert(length, at, np.int32(j))
        place = np.zeros(m, dtype=np.int64)
        place[live] = new
    keep = length >= least
    return string[keep], (size[string] - length)[keep]


def sort_columns(strings: list[bytes], begin: np.ndarray):
    """(column, strings in the order of their suffixes from there on), last column first; a string's bytes lie from column ``begin`` on.

    The same construction over symbols that are a byte and its column. Suffixes of one column then are one run of the
    transform, empty ones first, and the last-to-first mapping of a run is a stable sort of its symbols.
    """
    size = np.array([len(s) for s in strings], dtype=np.int64)
    end = begin + size
    columns = int(end.max(initial=0))
    column = np.arange(columns)
    grid = np.zeros((len(strings), columns), dtype=np.uint16)
    grid[(column >= begin[:, None]) & (column < end[:, None])] = np.frombuffer(b"".join(strings), np.uint8).astype(np.uint16) + 1
    grid = np.ascontiguousarray(grid.T)  # 0: the string has begun, its first byte is in the column behind
    rows = np.flatnonzero(end == columns)
    for c in range(columns - 1, -1, -1):
        bwt = grid[c][rows]
        rows = rows[np.argsort(bwt, kind="stable")][np.count_nonzero(bwt == 0):]
        rows = np.concatenate([np.flatnonzero(end == c), rows])
        yield c, rows


def repeats(strings: list[bytes], first: np.ndarray, begin: np.ndarray, span: int) -> tuple[np.ndarray, np.ndarray]:
    """(string, start), in order, of ``span``-byte parts that also start earlier.

    ``first`` holds each string's (document, place), ``begin`` the column of its first byte: only parts of one column are compared.
    """
    size = np.array([len(s) for s in strings], dtype=np.int64)
    data = np.frombuffer(b"".join(strings), dtype=np.uint8)
    offset = np.cumsum(size) - size
    string, start = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    parts = np.lib.stride_tricks.sliding_window_view(data, span) if len(data) >= span else None
    for c, rows in sort_columns(strings, begin):
        rows = rows[size[rows] + begin[rows] - c >= span]
        if len(rows) < 2:
            continue
        at = offset[rows] + c - begin[rows]
        same = np.zeros(len(rows), dtype=bool)
        for i in range(1, len(rows), 50_000):
            same[i:i + 50_000] = (parts[at[i:i + 50_000]] == parts[at[i - 1:i - 1 + len(at[i:i + 50_000])]]).all(1)
        group = np.cumsum(~same)
        shared = same | np.append(same[1:], False)
        rows, group = rows[shared], group[shared]
        doc, place = first[rows, 0], first[rows, 1] + c - begin[rows]
        order = np.lexsort((place, doc, group))
        lead = np.concatenate([[True], np.diff(group[order]) != 0])[:len(order)]
        # An equal start found through another region of the same place is no earlier one.
        to = order[np.flatnonzero(lead)][np.cumsum(lead) - 1]
        later = rows[order[(doc[order] != doc[to]) | (place[order] != place[to])]]
        string.append(later)
        start.append(c - begin[later])
    string, start = np.concatenate(string), np.concatenate(start)
    order = np.lexsort((start, string))
    return string[order], start[order]


def _collection_task(span: int):
    reach = span - GRAM

    def task(key, pdf):
        pdf = pdf.sort_values(["doc_id", "low"])
        first = pdf[["doc_id", "low"]].to_numpy(np.int64)
        string, start = repeats(list(pdf.region), first, reach - pdf.before.to_numpy(np.int64), span)
        # Parts of a string that overlap or touch are one range.
        cut = (np.diff(string) != 0) | (np.diff(start) > span)
        head, tail = np.flatnonzero(np.append(True, cut)[:len(string)]), np.flatnonzero(np.append(cut, True)[:len(string)])
        low = first[string[head], 1]
        return pd.DataFrame({"doc_id": first[string[head], 0], "low": low + start[head], "high": low + start[tail] + span})
    return task


def _squeeze_task(frames):
    squeeze = zstandard.ZstdCompressor(level=1).compress
    for pdf in frames:
        yield pd.DataFrame({"doc_id": pdf.doc_id, "packed": [squeeze(t.encode()) for t in pdf.text]})


def _unpack(packed: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(packed)


def _packed(rows: DataFrame) -> DataFrame:
    """Texts compressed before they are shuffled."""
    return rows.mapInPandas(_squeeze_task, "doc_id long, packed binary")


def _cut_task(span: int):
    """Regions of the wanted anchors of each document."""
    reach = span - GRAM

    def task(frames):
        for pdf in frames:
            out = []
            for doc_id, packed, spots in zip(pdf.doc_id, pdf.packed, pdf.spots):
                data = _unpack(packed)
                for s in spots:
                    low = max(s["at"] - reach, 0)
                    out.append((s["h"], s["regions"], doc_id, low, s["at"] - low, data[low:s["at"] + span]))
            yield pd.DataFrame(out, columns=["h", "regions", "doc_id", "low", "before", "region"])
    return task


def _part_task(span: int):
    """Every ``span`` bytes of regions, as two hashes."""
    def task(frames):
        for pdf in frames:
            for i in range(0, len(pdf), 500):
                part = pdf.iloc[i:i + 500]
                size = np.array([len(x) for x in part.region])
                count = np.maximum(size - span + 1, 0)
                begin = np.concatenate([[0], np.cumsum(size)])[:-1]
                inside = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
                data = np.frombuffer(b"".join(part.region), np.uint8)
                w = gram_hashes(data, span)[np.repeat(begin, count) + inside] if count.sum() else np.zeros(0, np.uint64)
                rep = lambda c: np.repeat(part[c].to_numpy(np.int64), count)
                yield pd.DataFrame({"h": rep("h"), "w": w.view(np.int64), "doc_id": rep("doc_id"), "start": rep("low") + inside})
    return task


def _digest_task(frames):
    for pdf in frames:
        out = []
        for doc_id, packed, ranges in zip(pdf.doc_id, pdf.packed, pdf.ranges):
            data = _unpack(packed)
            at, spans, removed, kept = 0, 0, 0, hashlib.sha256()
            for low, high in _joined([] if ranges is None else [(r["low"], min(r["high"], len(data))) for r in ranges]):
                kept.update(data[at:low])
                at, spans, removed = high, spans + 1, removed + high - low
            kept.update(data[at:])
            out.append((doc_id, len(data), removed, spans, kept.hexdigest()))
        yield pd.DataFrame(out, columns=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"], dtype=object)


def _joined(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for low, high in sorted(ranges):
        if out and low <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], high))
        else:
            out.append((low, high))
    return out


def repeated_ranges(docs: DataFrame, span: int = 100, most: int = 50_000, collection: int = 8000) -> DataFrame:
    """(doc_id, low, high): byte ranges covered by ``span``-byte strings that also start earlier; ranges of a document may overlap.

    ``collection`` is about how many regions are sorted together; an anchor of more than ``most`` regions goes to the aggregate.
    """
    ship_modules()
    rows = texts(docs)
    twice = saved(rows.mapInPandas(_anchor_task(span), "h long").groupBy("h").agg(F.count("*").alias("n")).where("n > 1").select("h"), "anchors")
    spots = saved(rows.mapInPandas(_anchor_task(span, bit_table(twice.toDF("id"), FILTER_BITS)), "h long, r long, doc_id long, at int").join(twice, "h"), "spots")
    firsts = saved(spots.groupBy("h", "r").agg(F.min(F.struct("doc_id", "at")).alias("first"), F.count("*").alias("n")), "regions")
    reach = span - GRAM
    # Later occurrences of a region: all of it is repeated. The text's end, where the region may be shorter, is cut off when ranges meet the text.
    later = spots.join(firsts.where("n > 1"), ["h", "r"]).where(F.struct("doc_id", "at") != F.col("first")).select(
        "doc_id", F.greatest(F.col("at") - reach, F.lit(0)).cast("long").alias("low"), (F.col("at") + span).cast("long").alias("high"))
    several = firsts.groupBy("h").agg(F.count("*").alias("regions")).where("regions > 1")
    compared = firsts.join(several, "h").select("h", "regions", F.col("first.doc_id").alias("doc_id"), F.col("first.at").alias("at"))
    wanted = saved(compared.groupBy("doc_id").agg(F.collect_list(F.struct("h", "regions", "at")).alias("spots")), "wanted")
    some = only_of(rows, wanted.select(F.col("doc_id").alias("id")))
    cut = saved(_packed(some).join(wanted, "doc_id").mapInPandas(
        _cut_task(span), "h long, regions long, doc_id long, low long, before int, region binary"), "collections")
    total = cut.count()
    some = cut.where(F.col("regions") <= most).withColumn("lot", F.pmod("h", F.lit(-(-max(1, total) // collection))))
    sorted_ = some.groupBy("lot").applyInPandas(_collection_task(span), "doc_id long, low long, high long")
    parts = saved(cut.where(F.col("regions") > most).mapInPandas(_part_task(span), "h long, w long, doc_id long, start long").distinct(), "parts")
    lead = parts.groupBy("h", "w").agg(F.min(F.struct("doc_id", "start")).alias("first"), F.count("*").alias("n")).where("n > 1")
    single = parts.join(lead, ["h", "w"]).where(F.struct("doc_id", "start") != F.col("first")).select(
        "doc_id", F.col("start").alias("low"), (F.col("start") + span).alias("high"))
    return later.unionByName(sorted_).unionByName(single)


def remove_repeats(docs: DataFrame, span: int = 100) -> DataFrame:
    """Per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    ranges = saved(repeated_ranges(docs, span), "ranges").groupBy("doc_id").agg(F.collect_list(F.struct("low", "high")).alias("ranges"))
    return _packed(texts(docs)).join(ranges, "doc_id", "left").mapInPandas(
        _digest_task, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
