"""Group aggregates.

Everything here is a combination of hash aggregates, which combine on the map
side. Quantiles and Nx select a position in the sorted values. They count per
(group, value), cut these counts into ranges of bounded size whatever the values
(see ``ranges``), add up per range, and look at single values only inside the
ranges that hold a wanted position; no task ever sorts a whole group. All of a
group's statistics come out of this one pass.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from florametrics.functions import col_of, na_guard, signif
from florametrics.operators.joins import KEY, join_back, keyed, unkeyed
from florametrics.operators.ranges import RANGE, RANGE_ROWS, with_range

QUARTILES = {"q1": 0.25, "median": 0.5, "q3": 0.75}


def count_by(df: DataFrame, keys, name: str = "n", wt=None) -> DataFrame:
    """Rows per group, or the sum of a weight."""
    agg = F.count(F.lit(1)) if wt is None else F.sum(col_of(wt))
    return df.groupBy(*keys).agg(agg.alias(name))


def sum_by(df: DataFrame, keys, col, out: str | None = None) -> DataFrame:
    return df.groupBy(*keys).agg(F.sum(col_of(col)).alias(out or col))


def run_totals(df: DataFrame, reads_in: str, reads_out: str, sample: str, digits: int = 4) -> DataFrame:
    """One row: total reads, the share kept in percent, number of samples."""
    per_sample = df.groupBy(sample).agg(F.sum(reads_in).alias("i"), F.sum(reads_out).alias("o"))
    totals = per_sample.agg(
        F.sum("i").alias("total_reads"), F.sum("o").alias("kept_reads"), F.count(F.lit(1)).alias("n_samples")
    )
    share = signif(F.try_divide(F.col("kept_reads").cast("double"), F.col("total_reads").cast("double")) * 100, digits)
    return totals.withColumn("kept_pct", share)


def first_by(df: DataFrame, keys, order) -> DataFrame:
    """Distinct by key, keeping the first row in order; ties fall to the smaller row."""
    rest = [c for c in df.columns if c not in keys]
    lead = [F.struct(F.col(c).isNull(), F.col(c)) if isinstance(c, str) else c for c in order]
    pick = F.min(F.struct(*[e.alias(f"o{i}") for i, e in enumerate(lead)], F.struct(*rest).alias("row")))
    return df.groupBy(*keys).agg(pick.getField("row").alias("__row")).select(
        *[F.col(k) if k in keys else F.col(f"__row.`{k}`").alias(k) for k in df.columns]
    )


def distinct_rows(df: DataFrame) -> DataFrame:
    return df.distinct()


def collapse_by(df: DataFrame, keys, col: str, order, sep: str = "", out: str | None = None) -> DataFrame:
    """Concatenate the group's strings in order. The result is one cell, so a group must fit one row."""
    pieces = F.array_sort(F.collect_list(F.struct(*order, F.col(col).alias("__v"))))
    return df.groupBy(*keys).agg(F.array_join(F.transform(pieces, lambda p: p["__v"]), sep).alias(out or col))


def single_values(cols, flag: str = "ambiguous") -> list[Column]:
    """Aggregates giving each column's only value, and ``flag``: true where a group holds several."""
    # Several values exist when min and max differ, or when NULL stands beside a value.
    several = F.lit(False)
    for c in cols:
        mixed = (F.min(c) != F.max(c)) | ((F.count(c) > 0) & (F.count(c) < F.count(F.lit(1))))
        several = several | F.coalesce(mixed, F.lit(False))
    return [*[F.min(c).alias(c) for c in cols], several.alias(flag)]


def single_by(df: DataFrame, keys, cols, flag: str = "ambiguous") -> DataFrame:
    """The group's only value of each column; ``flag`` is true where a group holds several."""
    return df.groupBy(*keys).agg(*single_values(cols, flag))


def count_true(df: DataFrame, keys, predicate: Column, out: str = "n_true") -> DataFrame:
    """Rows with a true predicate, NULL where the group holds an unknown one."""
    return df.groupBy(*keys).agg(na_guard(predicate, F.count_if(predicate)).alias(out))


def margin_sums(counts: DataFrame, axis: str, value: str = "numseqs", out: str = "total") -> DataFrame:
    """Row or column sums of a sample×taxon table."""
    return sum_by(counts, [axis], value, out)


def _dealt_values(df: DataFrame, keys, col, range_rows: int) -> DataFrame:
    """Rows per (KEY, value ``__v``), ``__n`` with missing values and ``__p`` without, dealt out by ranges of (KEY, value).

    The exchange is explicit so that all that follows, sums per range, the joins
    that come back to single values and the order inside a range, shares it.
    """
    counted = keyed(df.withColumn("__v", col_of(col)), keys).groupBy(KEY, "__v").agg(F.count(F.lit(1)).alias("__n"))
    counted = counted.withColumn("__p", F.when(F.col("__v").isNotNull(), F.col("__n")).otherwise(0))
    return with_range(counted, F.struct(KEY, "__v"), range_rows).repartition(KEY, RANGE)


def _key_stats(dealt: DataFrame, probs: dict[str, float], nx: dict[str, float], sums: bool = False) -> DataFrame:
    """One row per KEY: quantiles ``probs``, lengths ``nx``, rows ``__rows``, values ``__count`` and, with ``sums``, ``__sum`` and ``__max``."""
    sums = sums or bool(nx)
    values = dealt.withColumn("__w", F.col("__v") * F.col("__n")) if sums else dealt
    per = values.groupBy(KEY, RANGE).agg(
        F.sum("__p").alias("__rp"), F.sum("__n").alias("__rn"),
        *([F.sum("__w").alias("__rw"), F.max("__v").alias("__top")] if sums else []))
    whole = Window.partitionBy(KEY)
    upto = whole.orderBy(RANGE).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    down = whole.orderBy(F.desc(RANGE)).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    every = {"__rows": F.sum("__rn").over(whole), "__count": F.sum("__rp").over(whole), "__last": F.max(RANGE).over(whole)}
    if sums:
        every |= {"__sum": F.sum("__rw").over(whole), "__max": F.max("__top").over(whole), "__before": F.sum("__rw").over(down)}
    per = per.withColumns({"__end": F.sum("__rp").over(upto), **every}).withColumn("__start", F.col("__end") - F.col("__rp"))
    # The range in which the longest pieces first make up the share.
    crossing = {f"__x_{name}": F.max(F.when(F.col("__before") >= F.col("__sum") * F.lit(x), F.col(RANGE))).over(whole) for name, x in nx.items()}
    if nx:
        per = per.withColumns(crossing).withColumn("__before", F.col("__before") - F.col("__rw"))
    # Zero-based positions wanted: the two neighbours of (n - 1) * p.
    spots = {name: (F.col("__count") - 1) * F.lit(float(p)) for name, p in probs.items()}
    # The last range stands for its group, which is reported whatever it holds.
    wanted = F.col(RANGE) == F.col("__last")
    for position in [f(s) for s in spots.values() for f in (F.floor, F.ceil)]:
        wanted = wanted | ((position >= F.col("__start")) & (position < F.col("__end")))
    for name in crossing:
        wanted = wanted | F.coalesce(F.col(RANGE) == F.col(name), F.lit(False))
    constant = ["__rows", "__count", *(["__sum", "__max"] if sums else [])]
    hit = per.filter(wanted).select(KEY, RANGE, "__start", *constant, *(["__before", "__rw", *crossing] if nx else []))
    order = Window.partitionBy(KEY, RANGE)
    past = (Window.unboundedPreceding, Window.currentRow)
    rising = order.orderBy("__v").rowsBetween(*past)
    places = {"__hi": F.col("__start") + F.sum("__p").over(rising)}
    if nx and values.schema["__w"].dataType.typeName() in ("double", "float"):
        places["__reached"] = F.col("__before") + F.sum("__w").over(order.orderBy(F.desc("__v")).rowsBetween(*past))
    elif nx:
        # The longest pieces down to this one are those of the range without the shorter ones; of exact numbers one order gives both.
        places["__reached"] = F.col("__before") + F.col("__rw") - F.sum("__w").over(rising) + F.col("__w")
    inside = values.join(hit, [KEY, RANGE]).withColumns(places)
    lo, hi = F.col("__hi") - F.col("__p"), F.col("__hi")

    def at(position) -> Column:
        return F.max(F.when((position >= lo) & (position < hi), F.col("__v").cast("double")))

    found = inside.groupBy(KEY).agg(
        *[F.max(c).alias(c) for c in constant],
        *[F.max(F.when((F.col(RANGE) == F.col(f"__x_{n}")) & (F.col("__reached") >= F.col("__sum") * F.lit(x)), F.col("__v"))).alias(n)
          for n, x in nx.items()],
        *[e for n, s in spots.items() for e in (
            at(F.floor(s)).alias(f"__lo_{n}"), at(F.ceil(s)).alias(f"__hi_{n}"), F.max(s - F.floor(s)).alias(f"__f_{n}"))])
    between = {n: F.col(f"__lo_{n}") + (F.col(f"__hi_{n}") - F.col(f"__lo_{n}")) * F.col(f"__f_{n}") for n in probs}
    return found.select(KEY, *constant, *nx, *[e.alias(n) for n, e in between.items()])


def quantiles_by(df: DataFrame, keys, col, probs: dict[str, float], range_rows: int = RANGE_ROWS) -> DataFrame:
    """Exact quantiles with linear interpolation, one column per entry of ``probs``; groups without a value are left out."""
    stats = _key_stats(_dealt_values(df, keys, col, range_rows), probs, {}).filter(F.col("__count") > 0)
    return unkeyed(stats, keys).select(*keys, *probs)


def nx_by(df: DataFrame, keys, length, x: float = 0.5, out: str = "n50", range_rows: int = RANGE_ROWS) -> DataFrame:
    """Length at which the longest pieces first make up the share ``x`` of the total; groups without a length are left out."""
    stats = _key_stats(_dealt_values(df, keys, length, range_rows), {}, {out: x}).filter(F.col("__count") > 0)
    return unkeyed(stats, keys).select(*keys, out)


def describe_by(df: DataFrame, keys, col, n50: str | None = None, range_rows: int = RANGE_ROWS) -> DataFrame:
    """Median, mean, max, n and sum per group; NULL where the group holds a missing value.

    ``n50`` is of the values that are there.
    """
    return unkeyed(_described(df, keys, col, n50, range_rows), keys)


def _described(df: DataFrame, keys, col, n50: str | None, range_rows: int = RANGE_ROWS) -> DataFrame:
    stats = _key_stats(_dealt_values(df, keys, col, range_rows), {"median": 0.5}, {n50: 0.5} if n50 else {}, sums=True)
    whole = F.col("__count") == F.col("__rows")
    return stats.select(
        KEY, F.when(whole, F.col("__sum") / F.col("__rows")).alias("mean"), F.when(whole, F.col("__max")).alias("max"),
        F.col("__rows").alias("n"), F.when(whole, F.col("__sum")).alias("total"), F.when(whole, F.col("median")).alias("median"),
        *([n50] if n50 else []))


def box_stats(df: DataFrame, keys, col: str, log10: bool = False, range_rows: int = RANGE_ROWS) -> DataFrame:
    """Box-plot summary: quartiles, whiskers inside 1.5 IQR, and how many values lie outside.

    Ranges that lie inside or outside the fences as a whole are counted as they
    are; single values are looked at where a fence falls into a range.
    """
    keys = list(keys)
    dealt = _dealt_values(_box_input(df, col, log10), keys, "__x", range_rows)
    fences = _fences(_key_stats(dealt, QUARTILES, {})).select(KEY, *QUARTILES, "__lo", "__hi")
    per = dealt.groupBy(KEY, RANGE).agg(F.min("__v").alias("__low"), F.max("__v").alias("__high"), F.sum("__n").alias("__n")).join(fences, KEY)
    inside = (F.col("__low") >= F.col("__lo")) & (F.col("__high") <= F.col("__hi"))
    outside = (F.col("__high") < F.col("__lo")) | (F.col("__low") > F.col("__hi"))
    cut = per.filter(~inside & ~outside).select(KEY, RANGE, *QUARTILES, "__lo", "__hi")
    rows = ["__low", "__high", "__n", KEY, *QUARTILES, "__lo", "__hi"]
    pieces = per.filter(inside | outside).select(*rows).unionByName(
        dealt.withColumns({"__low": F.col("__v"), "__high": F.col("__v")}).join(cut, [KEY, RANGE]).select(*rows))
    stats = pieces.groupBy(KEY).agg(
        *[F.max(q).alias(q) for q in QUARTILES],
        F.min(F.when(inside, F.col("__low"))).alias("lower"), F.max(F.when(inside, F.col("__high"))).alias("upper"),
        F.sum(F.when(inside, 0).otherwise(F.col("__n"))).alias("n_outliers"), F.sum("__n").alias("n"))
    return unkeyed(stats, keys)


def _box_input(df: DataFrame, col: str, log10: bool) -> DataFrame:
    """Rows with their value ``__x``; on a log scale only positive values remain."""
    data = df.filter(F.col(col).isNotNull())
    if log10:
        data = data.filter(F.col(col) > 0)
    return data.withColumn("__x", F.log10(col) if log10 else F.col(col).cast("double"))


def _fences(quartiles: DataFrame) -> DataFrame:
    reach = (F.col("q3") - F.col("q1")) * 1.5
    return quartiles.withColumns({"__lo": F.col("q1") - reach, "__hi": F.col("q3") + reach})


def box_outliers(df: DataFrame, keys, col: str, log10: bool = False) -> DataFrame:
    """The rows outside the whiskers."""
    data = box_values(df, list(keys), col, log10)
    out = data.filter((F.col("__x") < F.col("__lo")) | (F.col("__x") > F.col("__hi")))
    return out.select(*df.columns)


def box_values(df: DataFrame, keys, col: str, log10: bool = False) -> DataFrame:
    """Rows with their group's quartiles and fences; on a log scale only positive values remain."""
    data = _box_input(df, col, log10)
    return join_back(data, _fences(quantiles_by(data, keys, "__x", QUARTILES)), keys)


def log_histogram(df: DataFrame, keys, col: str, bins: int = 120, range_by=()) -> DataFrame:
    """Counts in equal bins of log10, numbered from 0; the range is global or per ``range_by``."""
    data = df.filter(F.col(col) > 0).withColumn("__x", F.log10(col))
    span = data.groupBy(*range_by).agg(F.min("__x").alias("__min"), F.max("__x").alias("__max"))
    data = join_back(data, span, list(range_by))
    width = F.col("__max") - F.col("__min")
    place = F.floor(F.try_divide(F.col("__x") - F.col("__min"), width) * bins)
    bin_no = F.coalesce(F.least(place, F.lit(bins - 1)), F.lit(0))
    return data.withColumn("bin", bin_no.cast("long")).groupBy(*keys, "bin").agg(F.count(F.lit(1)).alias("n"))


def add_count(df: DataFrame, keys, name: str = "n") -> DataFrame:
    """Group size on every row."""
    keys = list(keys)
    return join_back(df, count_by(df, keys, name), keys)


def add_sum(df: DataFrame, keys, col, name: str) -> DataFrame:
    """Group sum on every row."""
    keys = list(keys)
    return join_back(df, sum_by(df, keys, col, name), keys)


def add_share(df: DataFrame, keys, col: str, name: str = "share") -> DataFrame:
    """Each row's part of the group sum."""
    return add_sum(df, keys, col, "__sum").withColumn(
        name, F.try_divide(F.col(col).cast("double"), F.col("__sum").cast("double"))
    ).drop("__sum")
