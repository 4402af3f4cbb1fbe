"""Joins in which a missing key matches a missing key.

Every condition is an equality Catalyst can hash, so a plan is a broadcast join
when the measured size of one side allows it and otherwise a shuffled join that
adaptive execution splits when one key dominates. Full joins are a left join plus
the unmatched right rows: both halves can be split, a full outer join cannot.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KEY = "__key"


def _pairs(on) -> list[tuple[str, str]]:
    on = [on] if isinstance(on, str) else on
    return [(k, k) if isinstance(k, str) else tuple(k) for k in on]


def _right(r: DataFrame, pairs) -> tuple[DataFrame, list[tuple[str, str]]]:
    """Right side with its keys under private names."""
    private = {rk: f"__r_{rk}" for _, rk in pairs}
    return r.withColumnsRenamed(private), [(lk, private[rk]) for lk, rk in pairs]


def null_safe(pairs) -> Column:
    return reduce(lambda a, b: a & b, [F.col(f"`{a}`").eqNullSafe(F.col(f"`{b}`")) for a, b in pairs])


def key_struct(keys) -> Column:
    """The keys as one struct, which plain equality compares: a missing key equals a missing key."""
    return F.struct(*[F.col(f"`{k}`").alias(k) for k in keys]) if keys else F.struct(F.lit(0).alias("__all"))


def keyed(df: DataFrame, keys) -> DataFrame:
    """``df`` with its keys as the struct KEY.

    Frames grouped by KEY and joined on it by ``join_groups`` are shuffled once:
    Catalyst turns a missing-matches-missing equality of plain columns into
    conditions that no group's partitioning satisfies, an equality of structs is
    the grouping itself.
    """
    return df.withColumn(KEY, key_struct(keys))


def join_groups(l: DataFrame, *others: DataFrame, how: str = "left") -> DataFrame:
    """Join frames with one row per KEY where they lie; for detail rows, of which a key may have many, see ``join_back``."""
    return reduce(lambda a, b: a.join(b, KEY, how), others, l)


def unkeyed(df: DataFrame, keys) -> DataFrame:
    """Keys as columns again, before all others."""
    return df.select(*[F.col(KEY).getField(k).alias(k) for k in keys], *[F.col(f"`{c}`") for c in df.columns if c != KEY])


def common_columns(l: DataFrame, r: DataFrame) -> list[str]:
    keys = [c for c in l.columns if c in r.columns]
    if not keys:
        raise ValueError("no common columns to join on")
    return keys


def left_join_ns(l: DataFrame, r: DataFrame, on, how: str = "left") -> DataFrame:
    """Left join on ``name`` or ``(left, right)`` keys; clashing other columns get ``_x``/``_y``."""
    pairs = _pairs(on)
    right, cond = _right(r, pairs)
    right_keys = {rk for _, rk in pairs}
    clash = {c for c in l.columns if c in r.columns and c not in right_keys}
    left_clash = clash - {lk for lk, _ in pairs}
    left = l.withColumnsRenamed({c: f"{c}_x" for c in left_clash}) if left_clash else l
    right = right.withColumnsRenamed({c: f"{c}_y" for c in clash}) if clash else right
    return left.join(right, null_safe(cond), how).drop(*[rk for _, rk in cond])


def inner_join_ns(l: DataFrame, r: DataFrame, on) -> DataFrame:
    return left_join_ns(l, r, on, how="inner")


def natural_left(l: DataFrame, r: DataFrame) -> DataFrame:
    """Left join on all common columns."""
    return left_join_ns(l, r, common_columns(l, r))


def full_join_ns(l: DataFrame, r: DataFrame, on=None) -> DataFrame:
    """Full join; keys are coalesced under the left names, clashing other columns get ``_x``/``_y``."""
    pairs = _pairs(on if on is not None else common_columns(l, r))
    keys = [lk for lk, _ in pairs]
    renames = {rk: lk for lk, rk in pairs if rk != lk}
    # A right column that is named like a left key, without being one, makes room for it.
    taken = {lk: f"{lk}_y" for lk in keys if lk in r.columns and lk not in [rk for _, rk in pairs]}
    right = r.withColumnsRenamed(taken).withColumnsRenamed(renames)
    clash = {c for c in l.columns if c in right.columns and c not in keys}
    return full_join_all([
        l.withColumnsRenamed({c: f"{c}_x" for c in clash}), right.withColumnsRenamed({c: f"{c}_y" for c in clash})], keys)


def full_join_all(frames: list[DataFrame], on: list[str]) -> DataFrame:
    """Full join of any number of frames on the same keys; other columns must not clash.

    One table of distinct keys tells for each key which frames hold it, however many
    frames there are. Every frame gets a row of missing values for each key it lacks,
    after which the joins are inner ones, on the keys as one struct: of a dominant
    key both sides can be split, and no join is planned inside another one twice.
    """
    held = [keyed(f, on) for f in frames]
    spine = reduce(DataFrame.unionAll, [f.select(KEY, F.lit(1 << i).alias("__in")) for i, f in enumerate(held)])
    # One value says which frames hold the key: with a column each, no two uses of the table would be the same shuffle.
    spine = spine.groupBy(KEY).agg(F.bit_or("__in").alias("__in"))
    whole = [
        f.drop(*on).unionByName(spine.filter(F.col("__in").bitwiseAND(1 << i) == 0).select(KEY), allowMissingColumns=True)
        for i, f in enumerate(held)]
    return unkeyed(reduce(lambda a, b: a.join(b, KEY), whole), on)


def full_natural(l: DataFrame, r: DataFrame) -> DataFrame:
    return full_join_ns(l, r)


def _keys_only(keys: DataFrame, pairs) -> tuple[DataFrame, list[tuple[str, str]]]:
    # distinct() combines before the shuffle, so a hot key arrives once per task.
    return _right(keys.select(*[rk for _, rk in pairs]).distinct(), pairs)


def semi_ns(l: DataFrame, keys: DataFrame, on) -> DataFrame:
    """Rows whose key occurs in ``keys``."""
    right, cond = _keys_only(keys, _pairs(on))
    return l.join(right, null_safe(cond), "left_semi")


def anti_ns(l: DataFrame, keys: DataFrame, on) -> DataFrame:
    """Rows whose key does not occur in ``keys``."""
    right, cond = _keys_only(keys, _pairs(on))
    return l.join(right, null_safe(cond), "left_anti")


def flag_member(l: DataFrame, keys: DataFrame, on, out: str, yes="Yes", no="No") -> DataFrame:
    """Mark rows whose key occurs in ``keys``."""
    right, cond = _keys_only(keys, _pairs(on))
    right = right.withColumn("__hit", F.lit(True))
    return (
        l.join(right, null_safe(cond), "left")
        .withColumn(out, F.when(F.col("__hit"), F.lit(yes)).otherwise(F.lit(no)))
        .drop("__hit", *[rk for _, rk in cond])
    )


def join_back(detail: DataFrame, per_group: DataFrame, on) -> DataFrame:
    """Put one-row-per-group values on the detail rows.

    Used instead of an unordered window: a window sends a whole group to one
    task, the join is split by adaptive execution. For that both sides must come
    straight from a shuffle, so the small side is shuffled as well, on purpose,
    even if it was grouped by the same keys. Without keys ``per_group`` is a global
    aggregate, one row, and is broadcast.
    """
    if not on:
        return detail.crossJoin(F.broadcast(per_group))
    return left_join_ns(detail, per_group, on)
