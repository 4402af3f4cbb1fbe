"""Top rows, picks and sorts.

Groups are ranked by aggregates that combine on the map side; the rows behind
the best values come back by an equality join on group and value. A ranking
window would sort a whole group in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from florametrics.functions import col_of, unit_digest
from florametrics.operators.joins import semi_ns
from florametrics.operators.ordered import running_sum


def top_n(df: DataFrame, keys, wt: str, n: int = 1) -> DataFrame:
    """Rows whose weight has minimum rank at most ``n``: ties stay, NULL weights go."""
    keys = list(keys)
    weights = df.filter(F.col(wt).isNotNull())
    if n == 1:
        best = weights.groupBy(*keys).agg(F.max(wt).alias(wt))
        return semi_ns(df, best, keys + [wt])
    heaviest = Window.partitionBy(*keys).orderBy(F.col(wt).desc())
    # At most n distinct weights per group pass the limit, on the map side already.
    distinct = weights.groupBy(*keys, wt).agg(F.count(F.lit(1)).alias("__n"))
    top = distinct.withColumn("__r", F.row_number().over(heaviest)).filter(F.col("__r") <= n)
    above = F.sum("__n").over(heaviest.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("__n")
    kept = top.withColumn("__above", above).filter(F.col("__above") < n)
    return semi_ns(df, kept, keys + [wt])


def best_struct(criteria) -> Column:
    """Comparable struct: larger is better, a NULL loses to every value."""
    fields = []
    for i, (expr, direction) in enumerate(criteria):
        value = col_of(expr)
        fields.append((-value if direction == "asc" else value).alias(f"k{i}"))
    return F.struct(*fields)


def cascade_top(df: DataFrame, keys, criteria) -> DataFrame:
    """Keep the rows best on the first criterion, of those the best on the second, and so on.

    One comparison of the whole tuple does it. A group whose best row misses a
    later value is left empty, as narrowing step by step would.
    """
    keys = list(keys)
    names = [f"__k{i}" for i in range(len(criteria))]
    scored = df.withColumn("__score", best_struct(criteria))
    scored = scored.withColumns({n: F.col(f"__score.k{i}") for i, n in enumerate(names)}).drop("__score")
    best = scored.groupBy(*keys).agg(F.max(F.struct(*names)).alias("__best")).select(*keys, "__best.*")
    best = best.dropna(subset=names)
    return semi_ns(scored, best, keys + names).drop(*names)


def weighted_pick(df: DataFrame, keys, wt: str, seed: int = 0, mode: str = "random", name=None) -> DataFrame:
    """One row per group with probability proportional to its weight.

    Each distinct row draws ``ln(u) / weight`` and the largest wins; equal rows
    are counted first and draw once with their joint weight. ``u`` is a digest of
    the seed and the row's text, so reruns, retries and other engines pick the same row.
    ``mode="deterministic"`` takes the largest weight, then the smallest ``name``.
    """
    keys, cols = list(keys), df.columns
    distinct = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("__copies"))
    row = F.struct(*cols)
    if mode == "deterministic":
        heavy = F.col(wt).cast("double")
        lead = [(-heavy).alias("w"), F.col(name or wt).alias("n")]
        pick = F.min(F.struct(F.isnull(heavy).alias("z"), *lead, row.alias("row")))
    else:
        draw = F.ln(unit_digest(*cols, seed=seed)) / (F.col(wt).cast("double") * F.col("__copies"))
        pick = F.max(F.struct(draw.alias("w"), row.alias("row")))
        distinct = distinct.filter(F.col(wt) > 0)
    return distinct.groupBy(*keys).agg(pick.getField("row").alias("__row")).select("__row.*")


def best_weighted(df: DataFrame, keys, criteria, subject: str, wt: str = "swt", seed: int = 0,
                  mode: str = "random") -> DataFrame:
    """One best row per group; ties are settled by how many tied rows each subject has.

    The same as :func:`cascade_top`, a count per subject in ``wt`` and
    :func:`weighted_pick`, in two aggregates without a join. A tied row weighs as
    much as its subject has tied rows, so a subject with n of them wins in
    proportion to n squared; its smallest row stands for it.
    """
    keys = list(keys)
    lead = [f"__k{i}" for i in range(len(criteria))]
    rest = [c for c in df.columns if c not in keys and c != subject]
    scored = df.withColumn("__score", best_struct(criteria))
    per_subject = scored.groupBy(*keys, subject, "__score").agg(
        F.count(F.lit(1)).alias(wt), F.min(F.struct(*rest)).alias("__row")
    )
    if mode == "deterministic":
        draw = F.col(wt).cast("double")
    else:
        draw = F.ln(unit_digest(*keys, subject, seed=seed)) / (F.col(wt).cast("double") * F.col(wt))
    # min() with negated numbers: NULL criteria lose, equal draws go to the smaller name.
    order = [e for i in range(len(criteria)) for e in (
        F.col(f"__score.k{i}").isNull().alias(f"m{i}"), (-F.col(f"__score.k{i}")).alias(lead[i]))]
    pick = F.min(F.struct(*order, (-draw).alias("d"), F.col(subject).alias("s"), F.col(wt), F.col("__row")))
    won = per_subject.groupBy(*keys).agg(pick.alias("__p"))
    for i in range(len(criteria)):
        won = won.filter(~F.col(f"__p.m{i}"))
    cols = [
        F.col(c) if c in keys else F.col("__p.s").alias(c) if c == subject else F.col(f"__p.__row.`{c}`").alias(c)
        for c in df.columns
    ]
    return won.select(*cols, F.col(f"__p.{wt}").alias(wt))


def first_n_padded(df: DataFrame, keys, order, col: str, n: int, pad: str = "NA", prefix: str = "hit") -> DataFrame:
    """First ``n`` values per group in order, as ``n`` columns filled up with ``pad``."""
    keys = list(keys)
    w = Window.partitionBy(*keys).orderBy(*[F.col(c).asc_nulls_last() for c in order])
    # row_number <= n is applied before the shuffle, so a task meets at most n rows per group and input split.
    top = df.withColumn("__r", F.row_number().over(w)).filter(F.col("__r") <= n)
    return top.groupBy(*keys).agg(*[
        F.coalesce(F.max(F.when(F.col("__r") == i, F.col(col))), F.lit(pad)).alias(f"{prefix}{i}")
        for i in range(1, n + 1)
    ])


def sort_na_last(df: DataFrame, order) -> DataFrame:
    """Total sort with missing values at the end in either direction."""
    return df.orderBy(*[
        F.col(c).desc_nulls_last() if direction == "desc" else F.col(c).asc_nulls_last() for c, direction in order
    ])


def latest_input(df: DataFrame, path: str = "filename") -> DataFrame:
    """Rows of the input file with the greatest path."""
    return semi_ns(df, df.agg(F.max(path).alias(path)), [path])


def order_by_mean(df: DataFrame, label: str, col: str, out: str = "position") -> DataFrame:
    """Labels numbered 1.. by the mean of another column."""
    means = df.groupBy(label).agg(F.avg(col).alias("mean")).withColumn("__missing", F.col("mean").isNull())
    ranked = running_sum(means, F.lit(1), out, ["__missing", "mean", label])
    return ranked.select(label, "mean", F.col(out).cast("long").alias(out))


