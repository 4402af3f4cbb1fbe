"""Projections and row filters."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from florametrics.functions import col_of, matches, member


def project(df: DataFrame, keep=None, drop=(), first=()) -> DataFrame:
    """Choose, drop and reorder columns. ``prefix*`` names a group of columns."""

    def expand(names):
        out = []
        for n in names:
            hits = [c for c in df.columns if c.startswith(n[:-1])] if n.endswith("*") else [n]
            out += [c for c in hits if c not in out]
        return out

    lead = expand(first)
    rest = expand(keep) if keep is not None else df.columns
    gone = set(expand(drop))
    names = lead + [c for c in rest if c not in lead]
    return df.select(*[F.col(f"`{c}`") for c in names if c not in gone])


def select_any(df: DataFrame, names) -> DataFrame:
    """Those of ``names`` that exist."""
    return df.select(*[c for c in names if c in df.columns])


def rename(df: DataFrame, names: dict[str, str] | Callable[[str], str]) -> DataFrame:
    """Rename by mapping old to new, or by a function of the old name."""
    mapping = names if isinstance(names, dict) else {c: names(c) for c in df.columns}
    return df.withColumnsRenamed(mapping)


def derive(df: DataFrame, only: bool = False, **exprs: Column) -> DataFrame:
    """Add columns; with ``only`` keep nothing else."""
    if only:
        return df.select(*[e.alias(n) for n, e in exprs.items()])
    return df.withColumns(exprs)


def derive_each(df: DataFrame, names, fn: Callable[[Column], Column]) -> DataFrame:
    """Apply one function to several columns."""
    return df.withColumns({c: fn(F.col(c)) for c in names})


def where_all(df: DataFrame, *predicates: Column) -> DataFrame:
    """Rows for which every predicate is true; NULL is not true."""
    return df.filter(reduce(lambda a, b: a & b, predicates))


def where_matches(df: DataFrame, col, regex: str, negate: bool = False) -> DataFrame:
    return df.filter(matches(col, regex, negate))


def where_in(df: DataFrame, col, values, negate: bool = False) -> DataFrame:
    return df.filter(member(col, values, negate))


def require_columns(df: DataFrame, names) -> DataFrame:
    """Fail while planning when a column is missing."""
    missing = [c for c in names if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df


def ensure_columns(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Add the absent columns as NULL."""
    absent = {f.name: F.lit(None).cast(f.dataType) for f in schema.fields if f.name not in df.columns}
    return df.withColumns(absent) if absent else df


def literal_map(values: dict) -> Column:
    return F.create_map(*[F.lit(x) for pair in values.items() for x in pair])


def lookup(df: DataFrame, col, values: dict, out: str) -> DataFrame:
    """Dictionary value of a column; NULL for unknown keys."""
    return df.withColumn(out, F.try_element_at(literal_map(values), col_of(col)))


def correct(df: DataFrame, col: str, fixes: dict[str, str]) -> DataFrame:
    """Replace listed wrong values, keep the others."""
    return df.withColumn(col, F.coalesce(F.try_element_at(literal_map(fixes), F.col(col)), F.col(col)))


def recode_levels(df: DataFrame, col: str, labels: dict[str, str], keep=None, ordinal: str | None = None) -> DataFrame:
    """Relabel and restrict to the listed levels; optionally add their rank."""
    kept = list(labels.values()) if keep is None else list(keep)
    out = lookup(df, col, labels, col).filter(F.col(col).isin(kept))
    return lookup(out, col, {v: i + 1 for i, v in enumerate(kept)}, ordinal) if ordinal else out


def orient(df: DataFrame, start: str, end: str, strand: str, minus: str = "minus") -> DataFrame:
    """Swap start and end on the minus strand."""
    flip = F.coalesce(F.col(strand) == minus, F.lit(False))
    return df.withColumns({
        start: F.when(flip, F.col(end)).otherwise(F.col(start)),
        end: F.when(flip, F.col(start)).otherwise(F.col(end)),
    })
