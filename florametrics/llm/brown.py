"""Language-model scoring with Brown class bigrams.

Words become units: a word that makes up at least ``head`` of all training tokens
is a unit of its own (so there are at most ``1 / head`` of these, whatever the
corpus), all rarer words that end alike share a unit. Exchange clustering
assigns units to classes: every round works out, for each unit, the class that
gives the training bigrams the largest likelihood, and moves half of the units
(distributed exchange). Every word without a unit of its own that occurs at
least ``least`` times is then placed by its own bigrams: it gets the class that
gives these the largest likelihood beside the clustered units. Only rarer and
unseen words stay in the class of their ending.

A token then costs the transition from the class before it and the emission of
the word by its class, both smoothed:
``p(c | b) = (n(b, c) + 0.5) / (n(b) + 0.5 * K)`` and
``p(w | c) = (n(w) + 0.5) / (n(c) + 0.5 * (v(c) + 1))``, where v(c) counts the
class's distinct words and the one more stands for words not seen.

Words are told apart by 64-bit hashes. Only tables of bounded length are
broadcast: the units, and the most frequent words. Counts and classes of other
words are joined by shuffle, so that no frequent word makes a task large; a text
is kept as its class bigrams meanwhile.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from florametrics.llm.common import saved, ship_modules, texts
from florametrics.llm.words import SPACE, word_hashes

END = b""  # no token is empty, so this stands for the end of a text
SMOOTH = 0.5
#: Occurrences from which a word is placed by its own bigrams.
LEAST = 5
#: Tokens that a task puts together before it passes them on, and bytes of text looked at together.
AT_ONCE = 1_500_000
PIECE = 1 << 20


def tokens(text: str | None) -> list[bytes]:
    """Words between ASCII white space, A-Z in lower case, then one end."""
    words = (text or "").encode().lower().split()
    words.append(END)
    return words


def coded(values: list[bytes], groups: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash and ending's group of all ``tokens`` of some texts (0 and 0 for an end), and each text's number of tokens."""
    hashes, edges = word_hashes(values)
    data = np.frombuffer(b"\n".join(values).lower() + b"\n", np.uint8)
    word = ~SPACE[data]
    first, last = np.flatnonzero(word[1:] > word[:-1]) + 1, np.flatnonzero(word[:-1] & ~word[1:])
    if len(data) and word[0]:
        first = np.append(0, first)
    size = last - first + 1
    # A group is that of the last three bytes and whether the word is short.
    value = (size < 4).astype(np.int64)
    for back in (2, 1, 0):
        value = np.where(size > back, value * 257 + data[np.maximum(last - back, 0)], value)
    group = value * 2654435761 % (1 << 32) % groups
    return np.insert(hashes, edges[1:], 0), np.insert(group, edges[1:], 0), np.diff(edges) + 1


def _pieces(texts_: list[str | None]):
    """Places (from, to) and the texts of some ``PIECE`` bytes at a time."""
    first, held, n = 0, [], 0
    for i, text in enumerate(texts_):
        held.append((text or "").encode())
        n += len(held[-1])
        if n > PIECE or i + 1 == len(texts_):
            yield first, i + 1, held
            first, held, n = i + 1, [], 0


def _batched(groups: int, frame):
    """A task that hands ``frame`` the hashes and groups of some ``AT_ONCE`` tokens of whole texts."""
    def task(frames):
        held, n = [], 0
        for pdf in frames:
            for _, _, values in _pieces(pdf.text.to_list()):
                held.append(coded(values, groups)[:2])
                n += len(held[-1][0])
                if n > AT_ONCE:
                    yield frame(*(np.concatenate(x) for x in zip(*held)))
                    held, n = [], 0
        if held:
            yield frame(*(np.concatenate(x) for x in zip(*held)))
    return task


def word_counts(docs: DataFrame, groups: int) -> DataFrame:
    """(hash, group, n) of all tokens of the texts."""
    ship_modules()

    def frame(hashes, group):
        at, first, n = np.unique(hashes, return_index=True, return_counts=True)
        return pd.DataFrame({"hash": at.view(np.int64), "group": group[first].astype(np.int32), "n": n})

    return docs.select("text").mapInPandas(_batched(groups, frame), "hash long, group int, n long").groupBy("hash").agg(
        F.max("group").alias("group"), F.sum("n").alias("n"))


def _found(table_: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Place of each hash in a sorted table, -1 where it is not held."""
    if not len(table_):
        return np.full(len(hashes), -1)
    at = np.minimum(np.searchsorted(table_, hashes), len(table_) - 1)
    return np.where(table_[at] == hashes, at, -1)


class Units:
    """Units of words: heads by their hash (the end is the first), of others by their ending, after the heads."""
    def __init__(self, heads: np.ndarray, groups: int):
        self.order = np.argsort(heads)
        self.table, self.heads, self.size = heads[self.order], len(heads), len(heads) + groups

    def __call__(self, hashes: np.ndarray, group: np.ndarray) -> np.ndarray:
        at = _found(self.table, hashes)
        return np.where(at < 0, self.heads + group, self.order[at])


def _pair_frame(units: Units):
    def frame(hashes, group):
        u = units(hashes, group)
        # A text begins where another has ended.
        codes, n = np.unique(np.append(0, u[:-1]) * units.size + u, return_counts=True)
        return pd.DataFrame({"a": (codes // units.size).astype(np.int32), "b": (codes % units.size).astype(np.int32), "n": n})
    return frame


def _gain_task(classes: np.ndarray, counts: np.ndarray, turn: int):
    """Best class of each unit given all others' classes: the change in the likelihood of the training bigrams."""
    k = len(counts)
    xlogx = lambda x: np.where(x > 0, x * np.log(np.maximum(x, 1e-12)), 0.0)

    def best(unit: int, right: np.ndarray, left: np.ndarray, own: float) -> int:
        now = classes[unit]
        base = counts.copy()  # without this unit
        base[now] -= right
        base[:, now] -= left
        base[now, now] -= own
        rows, cols = base.sum(1), base.sum(0)
        total = right.sum() + own
        # Row and column of each class, as it is and with the unit's counts added.
        gain = (xlogx(base + right[None]) - xlogx(base)).sum(1) + (xlogx(base + left[:, None]) - xlogx(base)).sum(0)
        diagonal = base.diagonal()
        gain += (xlogx(diagonal + right + left + own) - xlogx(diagonal)) - (
            xlogx(diagonal + right) - xlogx(diagonal)) - (xlogx(diagonal + left) - xlogx(diagonal))
        gain -= xlogx(rows + total) - xlogx(rows) + xlogx(cols + left.sum() + own) - xlogx(cols)
        return int(gain.argmax()) if gain.max() > gain[now] + 1e-9 else int(now)

    def task(frames):
        for pdf in frames:
            new = []
            for unit, side, other, n in zip(pdf.unit, pdf.side, pdf.other, pdf.n):
                right, left = np.zeros(k), np.zeros(k)
                side, other, n = np.asarray(side), np.asarray(other), np.asarray(n, dtype=float)
                own = float(n[side == 2].sum())
                np.add.at(right, other[side == 0], n[side == 0])
                np.add.at(left, other[side == 1], n[side == 1])
                moves = (unit * 2654435761 + turn * 40503) >> 7 & 1
                new.append(best(unit, right, left, own) if moves else int(classes[unit]))
            yield pd.DataFrame({"unit": pdf.unit, "class": np.array(new, dtype=np.int32)})
    return task


def exchange(pairs: DataFrame, sizes: np.ndarray, classes: int, rounds: int) -> tuple[np.ndarray, np.ndarray, list[float]]:
    """Class of each unit, class bigram counts, and the class model's log likelihood before every round.

    ``pairs`` holds (a, b, n) unit bigrams; ``sizes`` the units' counts. Units start in
    classes by rank of count. The best assignment of all rounds is returned.
    """
    spark = pairs.sparkSession
    of = np.zeros(len(sizes), dtype=np.int64)
    of[np.argsort(-sizes, kind="stable")] = np.arange(len(sizes)) % classes
    best, trail = None, []
    for turn in range(rounds + 1):
        names = F.broadcast(spark.createDataFrame(pd.DataFrame({"unit": np.arange(len(of)), "class": of})))
        named = pairs.join(names.select(F.col("unit").alias("a"), F.col("class").alias("ca")), "a").join(
            names.select(F.col("unit").alias("b"), F.col("class").alias("cb")), "b")
        counts = np.zeros((classes, classes))
        for r in named.groupBy("ca", "cb").agg(F.sum("n").alias("n")).collect():
            counts[r["ca"], r["cb"]] = r["n"]
        with np.errstate(divide="ignore", invalid="ignore"):
            like = float(np.nansum(counts * np.log(counts / counts.sum(1, keepdims=True) / counts.sum(0, keepdims=True))))
        trail.append(like)
        if best is None or like > best[0]:
            best = like, of.copy(), counts
        if turn == rounds:
            break
        self_pair = F.col("a") == F.col("b")
        sides = named.select(F.explode(F.when(self_pair, F.array(
            F.struct(F.col("a").alias("unit"), F.lit(2).alias("side"), F.col("ca").alias("other"), "n"))).otherwise(F.array(
                F.struct(F.col("a").alias("unit"), F.lit(0).alias("side"), F.col("cb").alias("other"), "n"),
                F.struct(F.col("b").alias("unit"), F.lit(1).alias("side"), F.col("ca").alias("other"), "n")))).alias("s")).select("s.*")
        profile = sides.groupBy("unit", "side", "other").agg(F.sum("n").alias("n")).groupBy("unit").agg(
            *(F.collect_list(c).alias(c) for c in ("side", "other", "n")))
        moved = of.copy()
        for r in profile.mapInPandas(_gain_task(of, counts, turn), "unit int, class int").collect():
            moved[r["unit"]] = r["class"]
        if (moved == of).all():
            break
        of = moved
    return best[1], best[2], trail


def best_classes(now: np.ndarray, at: np.ndarray, side: np.ndarray, other: np.ndarray, n: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The class of each of some words that gives the training bigrams the largest likelihood, all others staying where they are.

    ``now`` holds the words' classes in ``counts``; the rows (at, side, other, n) are the words' neighbours by class, each cell once a word.
    Only cells a word has are walked through, so a rare word costs little.
    """
    k, w = len(counts), len(now)
    f = lambda x: np.where(x > 0, x * np.log(np.maximum(x, 1e-12)), 0.0)
    right, left = (np.bincount((at * k + other)[side == s], n[side == s], w * k).reshape(w, k) for s in (0, 1))
    own = np.bincount(at[side == 2], n[side == 2], w)
    each, to, fro = np.arange(w), right.sum(1) + own, left.sum(1) + own
    # Sums of rows and columns, and the diagonal, of the counts without the word.
    rows, cols, diagonal = (np.tile(x, (w, 1)) for x in (counts.sum(1), counts.sum(0), counts.diagonal()))
    rows[each, now] -= to
    cols[each, now] -= fro
    diagonal[each, now] -= right[each, now] + left[each, now] + own
    gain = f(diagonal + right + left + own[:, None]) - f(diagonal + right) - f(diagonal + left) + f(diagonal)
    gain -= f(rows + to[:, None]) - f(rows) + f(cols + fro[:, None]) - f(cols)
    for mine, across, table_ in ((right, left, counts.T), (left, right, counts)):
        i, d = np.nonzero(mine)
        x = mine[i, d][:, None]
        base = table_[d].copy()
        cell = np.arange(len(i))
        base[cell, now[i]] -= x[:, 0]
        inner = d == now[i]
        base[inner] -= across[i[inner]]
        base[cell[inner], now[i[inner]]] -= own[i[inner]]
        more = f(base + x) - f(base)
        if len(i):
            first = np.flatnonzero(np.diff(i, prepend=-1))
            gain[i[first]] += np.add.reduceat(more, first, axis=0)
    return np.where(gain.max(1) > gain[each, now] + 1e-9, gain.argmax(1), now)


def _profile_frame(units: Units, of: np.ndarray, classes: int, slices: int):
    """(slice, held): neighbours by class of the words that are no heads, packed; a slice has all there is of its words."""
    def frame(hashes, group):
        u = units(hashes, group)
        words, some, at = np.unique(hashes, return_index=True, return_inverse=True)
        free, c = u >= units.heads, of[u]
        a, b, same = at[:-1], at[1:], at[:-1] == at[1:]
        after, before, itself = free[:-1] & ~same, free[1:] & ~same, free[:-1] & same
        width = 3 * classes
        # The first token of all has an end before it.
        head = [at[:1] * width + classes + of[0]] if free[0] else []
        codes = np.concatenate([a[after] * width + c[1:][after], b[before] * width + classes + c[:-1][before], a[itself] * width + 2 * classes + c[:-1][itself], *head])
        codes, n = np.unique(codes, return_counts=True)
        word, ending = words[codes // width], group[some[codes // width]].astype(np.uint32)
        part = (word % np.uint64(slices)).astype(np.int64)
        order = np.argsort(part, kind="stable")
        edge = np.searchsorted(part[order], np.arange(slices + 1))
        squeeze = zstandard.ZstdCompressor(level=1).compress
        columns = word[order], ending[order], (codes % width).astype(np.uint16)[order], n.astype(np.uint32)[order]
        out = [(i, squeeze(b"".join(x[p:q].tobytes() for x in columns))) for i, (p, q) in enumerate(zip(edge[:-1], edge[1:])) if q > p]
        return pd.DataFrame(out, columns=["slice", "held"])
    return frame


def _class_task(counts: np.ndarray, of: np.ndarray, units: Units, least: int):
    """(hash, class) of the words of a slice that occur ``least`` times or more."""
    k = len(counts)

    def task(pdf):
        parts = [zstandard.ZstdDecompressor().decompress(x) for x in pdf.held]
        rows = [len(x) // 18 for x in parts]
        read = lambda kind, begin: np.concatenate([np.frombuffer(x, kind, r, begin * r) for x, r in zip(parts, rows)])
        hashes, ending, cell, n = read(np.uint64, 0), read(np.uint32, 8), read(np.uint16, 12), read(np.uint32, 14)
        words, some, at = np.unique(hashes, return_index=True, return_inverse=True)
        code, at = np.unique(at * 3 * k + cell, return_inverse=True)
        n = np.bincount(at, n, len(code))
        at, side, other = code // (3 * k), code // k % 3, code % k
        # Every token has one before it.
        often = np.bincount(at, n * (side > 0), len(words)) >= least
        keep = often[at]
        number = np.cumsum(often) - 1
        at, side, other, n, words = number[at[keep]], side[keep], other[keep], n[keep], words[often].view(np.int64)
        now = of[units.heads + ending[some[often]].astype(np.int64)]
        new = now.copy()
        for i in range(0, len(words), 500):
            p, q = np.searchsorted(at, (i, i + 500))
            new[i:i + 500] = best_classes(now[i:i + 500], at[p:q] - i, side[p:q], other[p:q], n[p:q], counts)
        return pd.DataFrame({"hash": words, "class": new.astype(np.int32)})
    return task


def _listed(row: np.ndarray, code: np.ndarray, rows: int, codes: int) -> list[pa.Array]:
    """Distinct codes of each row and how often each occurs, as two columns of lists."""
    key, n = np.unique(row * codes + code, return_counts=True)
    edge = pa.array(np.searchsorted(key, np.arange(rows + 1) * codes).astype(np.int32))
    return [pa.ListArray.from_arrays(edge, pa.array(x)) for x in ((key % codes).astype(np.int16), n.astype(np.int32))]


def _row_task(words: np.ndarray, n: np.ndarray, word_of: np.ndarray, units: Units, of: np.ndarray, groups: int, classes: int):
    """Per text what its words add to a score, as class bigrams; words that are not broadcast are listed with their place and neighbours."""
    def task(batches):
        for batch in batches:
            for first, last, values in _pieces(batch.column(2).to_pylist()):
                hashes, group, size = coded(values, groups)
                i = _found(words, hashes)
                known = i >= 0
                row = np.repeat(np.arange(len(size)), size)
                # The class before the first token is that of an end.
                c = np.concatenate([[of[0]], np.where(known, word_of[i], -1)])
                both = (c[:-1] >= 0) & (c[1:] >= 0)
                times = np.where(known, n[i], 0)
                rare = np.flatnonzero(~known)
                edge = pa.array(np.searchsorted(rare, np.concatenate([[0], np.cumsum(size)])).astype(np.int32))
                place = rare - (np.cumsum(size) - size)[row[rare]]
                lists = [pa.ListArray.from_arrays(edge, pa.array(x)) for x in (
                    hashes[rare].view(np.int64), place.astype(np.int32), *(x.astype(np.int16) for x in (
                        of[units.heads + group[rare]], c[rare], c[rare + 2])))]
                yield pa.RecordBatch.from_arrays([
                    *(batch.column(j).slice(first, last - first) for j in range(2)), pa.array(size), pa.array(np.bincount(row, times > 0, len(size)).astype(np.int64)),
                    pa.array(np.bincount(row, np.log10(times + SMOOTH), len(size))), *_listed(row[both], (c[:-1] * classes + c[1:])[both], len(size), classes * classes),
                    *lists], names=[x.split()[0] for x in ROWS.split(", ")])
    return task


def _rest_task(classes: int):
    """Class bigrams of a text in which words that are not broadcast take part, once these have their classes; in order of place."""
    def task(batches):
        for batch in batches:
            lists = batch.columns[-3:]
            c, before, after = (x.flatten().to_numpy(zero_copy_only=False).astype(np.int64) for x in lists)
            row = np.repeat(np.arange(batch.num_rows), lists[0].value_lengths().to_numpy(zero_copy_only=False))
            before = np.where(before < 0, np.append(0, c)[:len(c)], before)  # such a word follows another one
            open_ = after >= 0  # else the next one counts the step
            codes = np.concatenate([before * classes + c, (c * classes + after)[open_]])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-3], *_listed(np.concatenate([row, row[open_]]), codes, batch.num_rows, classes * classes)],
                names=[*batch.schema.names[:-3], "codes", "times"])
    return task


def _sum_task(classes: int):
    """Class bigrams of all texts of a task, added up."""
    def task(batches):
        total = np.zeros(classes * classes, np.int64)
        for batch in batches:
            codes, times = (batch.column(i).flatten().to_numpy(zero_copy_only=False) for i in range(2))
            total += np.bincount(codes, times, len(total)).astype(np.int64)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at], pa.int64())], names=["code", "n"])
    return task


def _worth_task(worth: np.ndarray):
    """The columns but ``codes`` and ``times`` (the last two), and what these add to a text's score."""
    def task(batches):
        for batch in batches:
            codes, times = batch.column(batch.num_columns - 2), batch.column(batch.num_columns - 1)
            row = np.repeat(np.arange(batch.num_rows), codes.value_lengths().to_numpy(zero_copy_only=False))
            value = worth[codes.flatten().to_numpy(zero_copy_only=False)] * times.flatten().to_numpy(zero_copy_only=False)
            names = batch.schema.names[:-2]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-2], pa.array(np.bincount(row, value, batch.num_rows))], names=[*names, "moves"])
    return task


ROWS = ("doc_id long, learns boolean, n_tokens long, n_known long, seen double, codes array<short>, times array<int>, "
        "words array<long>, places array<int>, ends array<short>, before array<short>, after array<short>")


def score(docs: DataFrame, learns: Column, head: float = 1e-4, groups: int = 1024, classes: int = 48, rounds: int = 6,
          broadcast: float = 2e-6, least: int = LEAST) -> DataFrame:
    """Score every text by a model learned from the rows for which ``learns`` holds.

    Returns doc_id, n_tokens, n_known, train_tokens, base_score (unigram), score
    (class bigram), both log10. A null or empty text is one end token; a repeated doc_id is scored
    per row; without training rows every word is unseen and all classes are
    alike; an empty table gives no rows. The most frequent words, at most
    ``1 / broadcast`` of them, are broadcast.

    Exchange clustering places the units. Every other word that occurs ``least`` times
    or more then gets the class its own bigrams ask for; rarer and unseen words stay in
    the class of their ending.
    """
    ship_modules()
    rows = texts(docs).select("doc_id", F.coalesce(learns, F.lit(False)).alias("learns"), "text")
    training = rows.where("learns")
    counts = saved(word_counts(training, groups), "words")
    n_all, v_all = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    top = counts.where((F.col("n") >= head * n_all) & (F.col("hash") != 0)).orderBy(F.desc("n"), "hash").toArrow().to_pydict()
    units = Units(np.array([0, *top["hash"]], np.int64).view(np.uint64), groups)
    pairs = saved(training.select("text").mapInPandas(_batched(groups, _pair_frame(units)), "a int, b int, n long")
                  .groupBy("a", "b").agg(F.sum("n").alias("n")), "pairs")
    sizes = np.zeros(units.size)
    for r in pairs.groupBy("b").agg(F.sum("n").alias("n")).collect():
        sizes[r["b"]] = r["n"]
    of, table_, _ = exchange(pairs, sizes, classes, rounds)
    slices = max(64, int(n_all // 1_000_000))
    profiles = training.select("text").mapInPandas(_batched(groups, _profile_frame(units, of, classes, slices)), "slice int, held binary")
    placed = profiles.groupBy("slice").applyInPandas(_class_task(table_, of, units, least), "hash long, class int")
    known = saved(counts.join(placed, "hash", "left"), "classes")
    # The most frequent words: as many of the largest counts as there is room for.
    cut, room = 1, 1 / broadcast
    for r in sorted(counts.groupBy("n").count().collect(), key=lambda r: -r["n"]):
        room -= r["count"]
        if room < 0:
            cut = r["n"] + 1
            break
    common = (F.col("n") >= cut) | (F.col("hash") == 0)
    words = known.where(common).select("hash", "group", "n", "class").toArrow().to_pandas()
    if not (words.hash == 0).any():
        words = pd.concat([words, pd.DataFrame({"hash": [0], "group": [0], "n": [0], "class": [None]})])
    hashes, group = words.hash.to_numpy(np.int64).view(np.uint64), words.group.to_numpy(np.int64)
    own = pd.to_numeric(words["class"]).fillna(-1).to_numpy(np.int64)
    own, order = np.where(own < 0, of[units(hashes, group)], own), np.argsort(hashes)
    first = saved(rows.mapInArrow(_row_task(
        hashes[order], words.n.to_numpy(np.int64)[order], own[order], units, of, groups, classes), ROWS).withColumn(
            "row", F.monotonically_increasing_id()), "scores")
    # Words not broadcast meet their counts and classes here; those not seen in training stay in the class of their ending.
    rare = first.select("row", "learns", F.explode(F.arrays_zip("words", "places", "ends", "before", "after")).alias("w")).select(
        "row", "learns", F.col("w.words").alias("hash"), F.col("w.places").alias("place"), F.col("w.ends").alias("end"),
        F.col("w.before").alias("before"), F.col("w.after").alias("after"))
    gain = F.log10(F.col("n") + SMOOTH) - float(np.log10(SMOOTH))
    held = rare.join(known.where(~common), "hash", "left").groupBy("row", "learns").agg(
        F.count("n").alias("more_known"), F.coalesce(F.sum(gain), F.lit(0.0)).alias("more"), F.array_sort(F.collect_list(F.struct(
            "place", F.coalesce("class", F.col("end").cast("int")).alias("c"), "before", "after"))).alias("held")).select(
                "row", "learns", "more_known", "more", "held.c", "held.before", "held.after")
    rest = saved(held.mapInArrow(
        _rest_task(classes), "row long, learns boolean, more_known long, more double, codes array<short>, times array<int>"), "rest")
    table_ = np.zeros(classes * classes)
    learnt = first.where("learns").select("codes", "times").unionByName(rest.where("learns").select("codes", "times"))
    for r in learnt.mapInArrow(_sum_task(classes), "code int, n long").groupBy("code").agg(F.sum("n").alias("n")).collect():
        table_[r["code"]] = r["n"]
    table_ = table_.reshape(classes, classes)
    step = np.log10((table_ + SMOOTH) / (table_.sum(1, keepdims=True) + SMOOTH * classes))
    # Distinct words of each class: heads and placed words one by one, those of an ending together.
    class_v = np.zeros(classes)
    for r in known.groupBy("class", F.when(F.col("class").isNull(), F.col("group")).alias("group")).agg(F.count("*").alias("n")).collect():
        class_v[of[units.heads + r["group"]] if r["class"] is None else r["class"]] += r["n"]
    head_groups = [*top["group"], *([0] if n_all else [])]
    np.add.at(class_v, of[units.heads + np.array(head_groups, np.int64)], -1)
    np.add.at(class_v, of[[*range(1, units.heads), *([0] if n_all else [])]].astype(np.int64), 1)
    below = np.log10(table_.sum(0) + SMOOTH * (class_v + 1))
    base_below = float(np.log10(n_all + SMOOTH * (v_all + 1)))
    worth = (step - below).ravel()
    scored = first.select("row", "doc_id", "n_tokens", "n_known", "seen", "codes", "times").mapInArrow(
        _worth_task(worth), "row long, doc_id long, n_tokens long, n_known long, seen double, moves double")
    more = rest.select("row", "more_known", "more", "codes", "times").mapInArrow(
        _worth_task(worth), "row long, more_known long, more double, moves double").withColumnRenamed("moves", "more_moves")
    seen = F.col("seen") + F.coalesce("more", F.lit(0.0))
    return scored.join(more, "row", "left").select(
        "doc_id", "n_tokens", (F.col("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(n_all).cast("long").alias("train_tokens"), (seen - F.col("n_tokens") * base_below).alias("base_score"),
        (seen + F.col("moves") + F.coalesce("more_moves", F.lit(0.0))).alias("score"))
