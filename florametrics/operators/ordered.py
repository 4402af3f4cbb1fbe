"""Operators that depend on row order: fill-down, running sums, ordinals.

A window sends every row of its partition to one task. When one group (or no
grouping at all) holds a large part of the table that task never ends, so these
operators cut the order by ``(group, order)`` into ranges (see ``ranges``): each
range of a group is one window, the only shuffle of the rows, and what a range
inherits from those before it comes from a table with one row per range. A row's
range is an expression, so both passes see the same cut without a checkpoint,
also when an executor is lost.

Rows of equal order follow a hash of the whole row, so results do not depend on
how rows arrive or how many ranges there are. ``split=False`` gives the plain
window, for groups with a known small size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from florametrics.functions import col_of
from florametrics.operators.joins import KEY, join_back, key_struct, keyed
from florametrics.operators.ranges import RANGE, RANGE_ROWS, with_range

TIE = "__tie"
PAST = (Window.unboundedPreceding, Window.currentRow)


def _sort_keys(by, order) -> list[Column]:
    return [F.col(c).asc_nulls_first() for c in by] + [
        F.col(c).asc_nulls_first() if isinstance(c, str) else c for c in order
    ]


def _names(order) -> list[str]:
    bad = [c for c in order if not isinstance(c, str)]
    if bad:
        raise TypeError("split order columns must be names; derive a column for an expression")
    return list(order)


def _tied(df: DataFrame) -> DataFrame:
    """Rows with a hash of their values (maps cannot be hashed), the last order column."""
    return df.withColumn(TIE, F.xxhash64(*[F.col(f"`{c}`") for c, kind in df.dtypes if "map<" not in kind]))


def _ranges(df: DataFrame, by, order, rows: int) -> DataFrame:
    return with_range(df, F.struct(*[F.col(c) for c in [*by, *order]]), rows)


def fill_down(df: DataFrame, cols, order, by=(), split: bool = True, range_rows: int = RANGE_ROWS) -> DataFrame:
    """Carry the last non-NULL value forward, within ``by`` or over the whole table."""
    if not split:
        w = Window.partitionBy(*by).orderBy(*_sort_keys((), [*_names(order), TIE])).rowsBetween(*PAST)
        return _tied(df).withColumns({c: F.last(c, ignorenulls=True).over(w) for c in cols}).drop(TIE)
    return fill_down_levels(df, [(cols, by)], order, range_rows)


def fill_down_levels(df: DataFrame, levels, order, range_rows: int = RANGE_ROWS) -> DataFrame:
    """Fills one after another in the same order: ``levels`` are (cols, by), and a later ``by`` may name columns filled before.

    The order is cut once, by the first level's groups. A later level's groups begin
    with the first level's, so their rows lie in the same ranges in the same order,
    only not side by side; they inherit by range and group.
    """
    order = [*_names(order), TIE]
    (cols, by), *more = levels
    filled = _fill_ranges(_ranges(_tied(df), by, order, range_rows), cols, order, by)
    for cols, inner in more:
        if not set(by) <= set(inner):
            raise ValueError("a later level's groups must lie within the first level's")
        filled = _fill_groups(filled, cols, order, inner)
    return filled.select(*df.columns)


def _fill_ranges(cut: DataFrame, cols, order, by) -> DataFrame:
    group = key_struct(by)
    # One row per range: its first group, and the last value seen with the group it belongs to.
    ends = cut.groupBy(RANGE).agg(
        F.min(group).alias("__first"),
        *[
            F.max(F.when(F.col(c).isNotNull(), F.struct(group.alias("g"), *order_cols(order), F.col(c).alias("v"))))
            .alias(f"__end_{c}")
            for c in cols
        ],
    )
    before = Window.orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)
    carry = ends.select(
        RANGE, F.col("__first").alias("__carry_group"),
        *[F.last(f"__end_{c}", ignorenulls=True).over(before).alias(f"__end_{c}") for c in cols],
    ).select(
        F.col(RANGE).alias("__carry_range"), "__carry_group",
        *[
            F.when(F.col(f"__end_{c}.g") == F.col("__carry_group"), F.col(f"__end_{c}.v")).alias(f"__carry_{c}")
            for c in cols
        ],
    )
    w = Window.partitionBy(RANGE, *by).orderBy(*_sort_keys((), order)).rowsBetween(*PAST)
    local = cut.withColumns({c: F.last(c, ignorenulls=True).over(w) for c in cols})
    # `carry` has one row per range, at most MAX_RANGES, whatever the data size.
    filled = local.join(
        F.broadcast(carry), (F.col(RANGE) == F.col("__carry_range")) & (group == F.col("__carry_group")), "left"
    )
    return filled.withColumns({c: F.coalesce(F.col(c), F.col(f"__carry_{c}")) for c in cols}).select(*cut.columns)


def _fill_groups(cut: DataFrame, cols, order, by) -> DataFrame:
    cut = keyed(cut, by)
    ends = cut.groupBy(RANGE, KEY).agg(*[
        F.max(F.when(F.col(c).isNotNull(), F.struct(*order_cols(order), F.col(c).alias("v")))).alias(f"__end_{c}") for c in cols])
    before = Window.partitionBy(KEY).orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)
    carry = ends.select(RANGE, KEY, *[F.last(f"__end_{c}", ignorenulls=True).over(before).getField("v").alias(f"__carry_{c}") for c in cols])
    w = Window.partitionBy(RANGE, KEY).orderBy(*_sort_keys((), order)).rowsBetween(*PAST)
    local = cut.withColumns({c: F.last(c, ignorenulls=True).over(w) for c in cols})
    filled = local.join(carry, [RANGE, KEY], "left")
    return filled.withColumns({c: F.coalesce(F.col(c), F.col(f"__carry_{c}")) for c in cols}).select(*[c for c in cut.columns if c != KEY])


def order_cols(order) -> list[Column]:
    return [F.col(c).alias(f"o{i}") for i, c in enumerate(order)]


def running_sum(df: DataFrame, value, out: str, order, by=(), split: bool = True, range_rows: int = RANGE_ROWS) -> DataFrame:
    """Inclusive cumulative sum in order, within ``by`` or over the whole table."""
    if not split:
        w = Window.partitionBy(*by).orderBy(*_sort_keys((), order), F.col(TIE)).rowsBetween(*PAST)
        return _tied(df).withColumn(out, F.sum(col_of(value)).over(w)).drop(TIE)

    order = [*_names(order), TIE]
    group = key_struct(by)
    cut = _ranges(_tied(df).withColumn("__value", col_of(value)), by, order, range_rows)
    per_group = cut.groupBy(RANGE, group.alias("__group")).agg(F.sum("__value").alias("__sum"))
    ends = per_group.groupBy(RANGE).agg(
        F.min("__group").alias("__first"),
        F.max("__group").alias("__last"),
        F.max_by("__sum", "__group").alias("__sum"),
    )
    # Ranges that end in the same group are neighbours, so the previous range holds the carried total.
    upto = Window.partitionBy("__last").orderBy(RANGE).rowsBetween(*PAST)
    ends = ends.withColumn("__cum", F.sum("__sum").over(upto))
    prev = Window.orderBy(RANGE)
    carry = ends.select(
        F.col(RANGE).alias("__carry_range"),
        F.col("__first").alias("__carry_group"),
        F.when(F.lag("__last").over(prev) == F.col("__first"), F.lag("__cum").over(prev)).alias("__carry"),
    )
    w = Window.partitionBy(RANGE, *by).orderBy(*_sort_keys((), order)).rowsBetween(*PAST)
    local = cut.withColumn(out, F.sum("__value").over(w))
    summed = local.join(
        F.broadcast(carry), (F.col(RANGE) == F.col("__carry_range")) & (group == F.col("__carry_group")), "left"
    )
    # NULL sums (no value yet) stay NULL unless something is carried in.
    total = F.coalesce(F.col(out) + F.col("__carry"), F.col(out), F.col("__carry"))
    keep = [F.col(f"`{c}`") for c in df.columns if c != out]
    return summed.select(*keep, total.alias(out))


def na_last(df: DataFrame, cols) -> tuple[DataFrame, list[str]]:
    """Helper columns and the order list that put missing values after all others."""
    marked = df.withColumns({f"__missing_{c}": F.col(c).isNull() for c in cols})
    return marked, [x for c in cols for x in (f"__missing_{c}", c)]


def stack_positions(df: DataFrame, keys, order, pct: str, cum: str = "cum_pct", mid: str = "y_text",
                    split: bool = True) -> DataFrame:
    """Cumulative share in stacking order and the midpoint of each slice."""
    out = running_sum(df, pct, cum, order, keys, split)
    return out.withColumn(mid, F.col(cum) - F.col(pct) / 2)


def order_levels(df: DataFrame, cols, out: str = "level") -> DataFrame:
    """Distinct combinations numbered 1.. in sort order (missing values last)."""
    levels, order = na_last(df.select(*cols).distinct(), cols)
    ranked = running_sum(levels, F.lit(1), out, order)
    return ranked.select(*cols, F.col(out).cast("long").alias(out))


def member_index(df: DataFrame, keys, order, out: str = "index", cycle: int | None = None,
                 split: bool = True) -> DataFrame:
    """Position 1.. in the group, wrapped around after ``cycle`` members."""
    ranked = running_sum(df, F.lit(1), out, order, keys, split)
    n = F.col(out).cast("long")
    return ranked.withColumn(out, F.pmod(n - 1, F.lit(cycle)) + 1 if cycle else n)


def relative_to_max(df: DataFrame, keys, of: str, by: str, out: str, tie=()) -> DataFrame:
    """``of`` divided by its value on the group's row with the largest ``by``."""
    top = df.groupBy(*keys).agg(
        F.max(F.struct(F.col(by), *[F.col(t) for t in tie], F.col(of).alias("__of"))).getField("__of").alias("__ref")
    )
    return join_back(df, top, keys).withColumn(out, F.try_divide(F.col(of), F.col("__ref"))).drop("__ref")
