"""Predicates and aggregates with the missing-value rules of statistical tables.

Spark's three-valued logic drops NULL rows from negated filters and its
aggregates skip NULLs. Here a negated filter keeps NULLs, and an aggregate over
a group that holds a NULL is NULL.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = [
    "col_of", "matches", "member", "if_else_na", "case", "blank_to", "null_to", "blank_to_null",
    "na_guard", "na_sum", "na_mean", "na_max", "na_min", "na_count_true",
]


def col_of(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def matches(c, regex: str, negate: bool = False) -> Column:
    """Regex test; NULL never matches, so it passes the negated test."""
    hit = F.coalesce(col_of(c).rlike(regex), F.lit(False))
    return ~hit if negate else hit


def member(c, values, negate: bool = False) -> Column:
    """Set test on literals; NULL is outside every set of non-NULL values."""
    hit = F.coalesce(col_of(c).isin(list(values)), F.lit(False))
    return ~hit if negate else hit


def if_else_na(condition: Column, yes, no) -> Column:
    """Two-way choice that is NULL where the condition is NULL."""
    return F.when(condition, yes).when(~condition, no)


def case(*pairs, default=None) -> Column:
    """First true condition wins; a NULL condition falls through."""
    out = F.when(*pairs[0])
    for condition, value in pairs[1:]:
        out = out.when(condition, value)
    return out.otherwise(default)


def null_to(c, value) -> Column:
    return F.coalesce(col_of(c), F.lit(value))


def blank_to(c, value) -> Column:
    """Replace the empty string; NULL stays NULL."""
    return F.when(col_of(c) == "", F.lit(value)).otherwise(col_of(c))


def blank_to_null(c) -> Column:
    return F.nullif(col_of(c), F.lit(""))


def na_guard(c, aggregate: Column) -> Column:
    """The aggregate, or NULL when any row of the group has a NULL in ``c``."""
    return F.when(F.count(col_of(c)) == F.count(F.lit(1)), aggregate)


def na_sum(c) -> Column:
    return na_guard(c, F.sum(col_of(c)))


def na_mean(c) -> Column:
    return na_guard(c, F.avg(col_of(c)))


def na_max(c) -> Column:
    return na_guard(c, F.max(col_of(c)))


def na_min(c) -> Column:
    return na_guard(c, F.min(col_of(c)))


def na_count_true(condition: Column) -> Column:
    return na_guard(condition, F.count_if(condition))
