"""Ranges of an order, cut where the rows lie.

Work that depends on order is split into ranges of about ``rows`` rows each. The
cut points come from keys picked by hash, ``PICKS`` a range, sorted in one row, so
there are as many ranges as the input's size asks for; a row finds its range by
search in that row's array, an expression over the row alone. A retried task, and
every branch of a plan, therefore gives a row the same range. Picks and cut points
are a scalar subquery of the plan: nothing runs while it is planned, and rows move
only where the caller shuffles them.

Equal keys share a range. Beyond ``MAX_RANGES`` ranges become larger instead of
more; the picks, two millionths of the rows, are sorted by one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from florametrics.functions import unit_hash

RANGE = "__range"
RANGE_ROWS = 4_000_000
PICKS = 8
#: The search looks at every quarter of what is left.
STEPS = [4 ** i for i in range(5, -1, -1)]
MAX_RANGES = 4 * STEPS[0]


def with_range(df: DataFrame, key: Column, rows: int = RANGE_ROWS, out: str = RANGE) -> DataFrame:
    """``df`` with ``out``, the number of its range of the order by ``key`` (a struct; missing values first), from 0."""
    at = df.withColumn("__at", key)
    picked = at.select("__at").filter(unit_hash("__at") < min(1.0, PICKS / rows)).agg(F.array_sort(F.collect_set("__at")).alias("picks"))
    ranges = f"least({MAX_RANGES}, CAST(ceil(size(picks) / {PICKS}) AS INT))"
    cuts = picked.selectExpr(
        f"CASE WHEN {ranges} > 1 THEN transform(sequence(1, greatest({ranges} - 1, 1)), "
        f"i -> get(picks, CAST(floor(i * size(picks) / {ranges}) AS INT))) END AS cuts"
    ).scalar().alias("__cuts")
    # Each step builds on the alias before it in the same projection: one pass of analysis for all of them.
    search, place = [F.lit(0).alias("__at0")], "__at0"
    for i, step in enumerate(STEPS, 1):
        cases = " ".join(f"WHEN get(__cuts, {place} + {k * step - 1}) <= __at THEN {k * step}" for k in (3, 2, 1))
        search.append(F.expr(f"{place} + CASE {cases} ELSE 0 END AS __at{i}"))
        place = f"__at{i}"
    # As a generated column the number is opaque to the optimizer, which would else write the whole search into every join on it.
    return at.select("*", cuts, *search).select(*[f"`{c}`" for c in df.columns], F.expr(f"explode(array({place}))").alias(out))
