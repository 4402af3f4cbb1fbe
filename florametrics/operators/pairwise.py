"""Values shared by pairs of samples.

``shared_min`` returns every pair, so its size is given; what can be saved is the
work before it. Samples are hashed into blocks and keys into slices; a tile
is one pair of blocks for one slice and adds ``min(x_a, x_b)`` into a dense
block-by-block matrix. A block's slice is one row of arrays. Blocks meet in
a Cartesian product, which reads the blocks where they lie: the input is written
and shuffled a fixed number of times, however many blocks there are. A key present
in every sample never expands into rows, and neither a sample nor a key with very
many rows lands in one task whole.

``pairs_within`` returns only pairs that share a key, so it looks at no others:
rows meet by key, a key with many rows in pairs of its own blocks.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from florametrics.operators.joins import join_back
from florametrics.operators.ordered import order_levels
from florametrics.session import cut_lineage, ship

TILE_SCHEMA = "id_a string, id_b string, shared double, total_a double, total_b double"
#: Products of a tile that are laid out at a time.
AT_ONCE = 4_000_000
#: Where pairs are sorted to be counted, several arrays of this length are held at a time.
COUNTED_AT_ONCE = 1_000_000
#: Meetings of a tile in one key from which these are added as a rectangle.
RECTANGLE = 4096
#: Values of a sample that travel in one row, about.
CELLS = 250_000
#: Pairs that a tile passes on at a time.
PAIRS_AT_ONCE = 100_000


def meetings(a_code: np.ndarray, b_code: np.ndarray, n_codes: int, at_once: int = AT_ONCE):
    """Places (in a, in b) of all pairs of rows with equal codes, some ``at_once`` at a time; both sides sorted by code.

    Each row of a meets the run of its code in b, so the pairs are counted and laid out by arithmetic, not key by key.
    """
    start = np.searchsorted(b_code, np.arange(n_codes + 1))
    meets = np.diff(start)[a_code]
    ends = np.cumsum(meets)
    first = 0
    while first < len(a_code):
        done = ends[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(ends, done + at_once, side="right")))
        n = meets[first:last]
        in_a = np.repeat(np.arange(first, last), n)
        in_run = np.arange(len(in_a)) - np.repeat(np.cumsum(n) - n, n)
        yield in_a, np.repeat(start[a_code[first:last]], n) + in_run
        first = last


def _add_tile(key: tuple, rows: pa.Table) -> pa.Table:
    """Sum of minima for one pair of blocks and one slice of keys."""
    left_block, right_block, piece = (k.as_py() for k in key)
    ids, at = np.unique(rows["id"].to_numpy(), return_inverse=True)
    totals = rows["total"].to_numpy()
    marks = ~np.isnan(totals)
    total = np.zeros(len(ids))
    total[at[marks]] = totals[marks]
    block = np.zeros(len(ids), dtype=np.int64)
    block[at] = rows["block"].to_numpy()
    a_ids, b_ids = np.flatnonzero(block == left_block), np.flatnonzero(block == right_block)
    a_row, b_row = np.full(len(ids), -1), np.full(len(ids), -1)
    a_row[a_ids], b_row[b_ids] = np.arange(len(a_ids)), np.arange(len(b_ids))

    held = [(c.value_lengths().to_numpy(), c.flatten().to_numpy()) for c in rows["codes"].chunks]
    at = np.repeat(at, np.concatenate([n for n, _ in held]))
    x = np.concatenate([c.flatten().to_numpy() for c in rows["xs"].chunks])
    _, codes = np.unique(np.concatenate([c for _, c in held]), return_inverse=True)
    cell = codes * len(ids) + at
    order = np.argsort(cell)
    at, x, codes, cell = at[order], x[order], codes[order], cell[order]
    a, b = a_row[at] >= 0, b_row[at] >= 0
    (ia, xa, ca), (ib, xb, cb) = (a_row[at[a]], x[a], codes[a]), (b_row[at[b]], x[b], codes[b])
    n_codes = int(codes[-1]) + 1 if len(codes) else 0
    n_a, n_b = np.bincount(ca, minlength=n_codes), np.bincount(cb, minlength=n_codes)

    shared = np.zeros((len(a_ids), len(b_ids)))
    # A key with many meetings is a rectangle of the matrix, if no sample holds it twice; all others are laid out together.
    dense = (n_a * n_b >= RECTANGLE) & (len(cell) == 0 or bool((np.diff(cell) > 0).all()))
    end_a, end_b = np.cumsum(n_a), np.cumsum(n_b)
    flat = shared.reshape(-1)
    for c in np.flatnonzero(dense):
        i, j = slice(end_a[c] - n_a[c], end_a[c]), slice(end_b[c] - n_b[c], end_b[c])
        cells = ia[i][:, None] * len(b_ids) + ib[j]
        flat[cells] = flat.take(cells) + np.minimum.outer(xa[i], xb[j])
    few_a, few_b = ~dense[ca], ~dense[cb]
    ia, xa, ib, xb = ia[few_a], xa[few_a], ib[few_b], xb[few_b]
    for i, j in meetings(ca[few_a], cb[few_b], n_codes):
        flat += np.bincount(ia[i] * len(b_ids) + ib[j], np.minimum(xa[i], xb[j]), len(flat))

    # The first slice emits every pair, the others only what they add.
    emit = np.ones_like(shared, dtype=bool) if piece == 0 else shared != 0
    if left_block == right_block:
        emit &= a_ids[:, None] < b_ids[None, :]
    i, j = np.nonzero(emit)
    lo, hi = np.minimum(a_ids[i], b_ids[j]), np.maximum(a_ids[i], b_ids[j])
    names = pa.array(ids, pa.string())
    return pa.table({
        "id_a": names.take(pa.array(lo)), "id_b": names.take(pa.array(hi)), "shared": shared[i, j], "total_a": total[lo], "total_b": total[hi],
    })


PACKED = "block int, slice int, rows array<struct<id: string, total: double, codes: array<bigint>, xs: array<double>>>"


def _pack(key: tuple, rows: pa.Table) -> pa.Table:
    """The rows of one block and slice as one."""
    held = rows.select(["id", "total", "codes", "xs"]).to_struct_array()
    held = held.combine_chunks() if isinstance(held, pa.ChunkedArray) else held
    return pa.table({
        "block": pa.array([key[0].as_py()], pa.int32()), "slice": pa.array([key[1].as_py()], pa.int32()),
        "rows": pa.ListArray.from_arrays(pa.array([0, len(held)], pa.int32()), held)})


def _add_tiles(batches):
    """``_add_tile`` of each pair of blocks: block, slice and rows of both."""
    for batch in batches:
        for block, piece, rows, other, _, others in zip(*batch.columns):
            parts = [(block, rows)] if block == other else [(block, rows), (other, others)]
            table = pa.concat_tables([
                pa.Table.from_struct_array(r.values).append_column("block", pa.repeat(b, len(r.values))) for b, r in parts])
            yield from _add_tile((block, other, piece), table).to_batches(max_chunksize=PAIRS_AT_ONCE)


def _layout(n_rows: int, n_ids: int, largest: int, parallelism: int, block_size: int,
            tile_rows: int) -> tuple[int, int]:
    """Number of sample blocks and key slices: within memory, and enough tiles to keep the cluster busy.

    More blocks repeat the input once per block, more slices repeat the pairs
    once per slice; the cheaper of the two makes up for missing parallelism. The
    slices allow for a block that holds the ``largest`` sample.
    """
    blocks = max(1, math.ceil(n_ids / block_size))
    wide = math.ceil(math.sqrt(2 * parallelism))
    by_blocks = n_rows * wide <= n_rows + n_ids * n_ids / 2 * parallelism
    if by_blocks:
        blocks = max(blocks, min(wide, n_ids))
    slices = max(1, math.ceil(2 * (n_rows / blocks + largest) / tile_rows))
    if not by_blocks:
        slices = max(slices, math.ceil(parallelism / (blocks * (blocks + 1) / 2)))
    return blocks, slices


def shared_min(df: DataFrame, sample: str, key: str, value: str,
               block_size: int = 1024, tile_rows: int = 4_000_000) -> DataFrame:
    """``sum(min(x_a, x_b))`` over common keys and both totals, for every pair of samples.

    ``df`` has one row per (sample, key) and values above zero. Every pair is
    returned, with 0 where nothing is shared. Sums of whole numbers do not
    depend on the tiling; those of fractions may differ in their last digits.
    """
    ship(_add_tile)
    long = cut_lineage(df.select(
        F.col(sample).cast("string").alias("id"), F.col(key).cast("string").alias("key"),
        F.col(value).cast("double").alias("x"),
    ).filter("id is not null and key is not null and x > 0"))
    totals = long.groupBy("id").agg(F.sum("x").alias("x"), F.count(F.lit(1)).alias("rows"))
    size = totals.agg(
        F.count(F.lit(1)).alias("ids"), F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
        F.coalesce(F.max("rows"), F.lit(0)).alias("largest"),
    ).first()
    parallelism = df.sparkSession.sparkContext.defaultParallelism
    blocks, slices = _layout(size["rows"], size["ids"], size["largest"], parallelism, block_size, tile_rows)

    # Keys are numbered, so that a tile holds numbers; a sample's values of a slice are a row, or several rows of a large sample.
    parts = max(1, math.ceil(size["largest"] / slices / CELLS))
    numbered = long.join(order_levels(long, ["key"], "code"), "key")
    cells = numbered.groupBy(
        "id", F.pmod(F.xxhash64("key"), F.lit(slices)).cast("int").alias("slice"), F.pmod(F.xxhash64("key", F.lit(1)), F.lit(parts)).alias("part"),
    ).agg(F.collect_list(F.struct("code", "x")).alias("cells"))
    # A row without values carries the sample's total into the first slice.
    marked = cells.select(
        "id", F.lit(None).cast("double").alias("total"), F.transform("cells", lambda c: c["code"]).alias("codes"),
        F.transform("cells", lambda c: c["x"]).alias("xs"), "slice",
    ).unionByName(totals.select(
        "id", F.col("x").alias("total"), F.expr("cast(array() as array<bigint>) as codes"), F.expr("cast(array() as array<double>) as xs"), F.lit(0).alias("slice")))
    own = F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int")
    packed = marked.withColumn("block", own).groupBy("block", "slice").applyInArrow(_pack, PACKED)
    # A part holds blocks of about a tile's rows; every part meets every other, and tasks keep one part beside a row of the other.
    # Numbers of blocks and slices are compared by difference, as an equality would deal all rows by it.
    parts = max(1, min(blocks, max(math.ceil(size["rows"] / tile_rows), math.ceil(math.sqrt(2 * parallelism)))))
    dealt = packed.repartitionById(parts, F.pmod("block", F.lit(parts)))
    names = packed.columns
    left, right = (dealt.select(*[F.col(c).alias(f"{c}_{side}") for c in names]) for side in "ab")
    tiles = left.hint("shuffle_replicate_nl").join(right, (F.col("block_a") <= F.col("block_b")) & (F.col("slice_a") - F.col("slice_b") == 0))
    pairs = tiles.select(*[f"{c}_a" for c in names], *[f"{c}_b" for c in names]).mapInArrow(_add_tiles, TILE_SCHEMA)
    if slices == 1:
        return pairs
    return pairs.groupBy("id_a", "id_b").agg(
        F.sum("shared").alias("shared"), F.max("total_a").alias("total_a"), F.max("total_b").alias("total_b")
    )


def _count_tile(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    """Pairs of ids with a common key, and how many, of one tile: all rows of its keys, or two blocks of each key's rows.

    One row per smaller id, with its partners and counts as arrays.
    """
    _, _, low, high = key
    ids, at = np.unique(rows["id"].to_numpy(), return_inverse=True)
    codes, names = pd.factorize(rows["key"])
    by_key = np.argsort(codes, kind="stable")
    at, codes, block = at[by_key], codes[by_key], rows["block"].to_numpy()[by_key]
    a, b = block == low, block == high
    found, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for i, j in meetings(codes[a], codes[b], len(names), COUNTED_AT_ONCE):
        i, j = at[a][i], at[b][j]
        once = i < j if low == high else np.ones(len(i), bool)
        pair = np.minimum(i, j)[once] * len(ids) + np.maximum(i, j)[once]
        pair, n = np.unique(pair, return_counts=True)
        found, where = np.unique(np.concatenate([found, pair]), return_inverse=True)
        counts = np.bincount(where, np.concatenate([counts, n]), len(found)).astype(np.int64)
    own, first = np.unique(found // len(ids), return_index=True) if len(found) else (found, found)
    partners = np.split(ids[found % len(ids)], first[1:]) if len(found) else []
    times = np.split(counts, first[1:]) if len(found) else []
    return pd.DataFrame({"id_a": ids[own], "id_b": pd.Series(partners, dtype=object), "n": pd.Series(times, dtype=object)})


def pairs_within(df: DataFrame, sample: str, key: str, block_size: int = 1024, tile_pairs: int = 2_000_000) -> DataFrame:
    """Pairs of samples with at least one common key and how many they share.

    Work and shuffle follow the meetings of two samples in a key, not the square
    of the samples. A key with more than ``block_size`` rows is dealt into
    blocks that meet in pairs; keys are dealt into as many slices as keep a
    tile at about ``tile_pairs`` meetings. Both are expressions of the plan.
    Tiles pass on arrays of partners, which are added up where their id lies.
    """
    ship(_count_tile)
    marks = df.select(F.col(sample).cast("string").alias("id"), F.col(key).cast("string").alias("key")).dropna().distinct()
    held = marks.groupBy("key").agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1")
    # A power of two, so that keys of like size share tiles.
    blocks = F.expr(f"cast(pow(2, greatest(0, ceil(log2(rows / {block_size})))) as int)")
    met = held.agg(F.coalesce(F.ceil(F.sum(F.col("rows").cast("double") * F.col("rows")) / 2 / tile_pairs), F.lit(1)).alias("slices"))
    sized = join_back(held.withColumn("blocks", blocks), met, [])
    dealt = marks.join(sized, "key").select(
        "id", "key", "blocks", F.pmod(F.xxhash64("key"), F.col("slices")).alias("slice"),
        F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int").alias("block"))
    tiles = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "id", "key", "block", "blocks", "slice", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"))
    counted = tiles.groupBy("blocks", "slice", "low", "high").applyInPandas(_count_tile, "id_a string, id_b array<string>, n array<long>")
    # Dealt out by the smaller id alone, as arrays; single pairs are never shuffled.
    met = counted.repartition("id_a").select("id_a", F.explode(F.arrays_zip("id_b", "n")).alias("__with"))
    return met.select("id_a", F.col("__with.id_b").alias("id_b"), F.col("__with.n").alias("n")).groupBy("id_a", "id_b").agg(
        F.sum("n").alias("n_shared"))
