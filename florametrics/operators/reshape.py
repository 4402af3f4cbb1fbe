"""Long/wide changes and nested columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from florametrics.functions import col_of, word_parts
from florametrics.operators.aggregates import add_sum
from florametrics.operators.joins import inner_join_ns, left_join_ns


def widen(df: DataFrame, keys, name: str, value: str, values, how=F.first) -> DataFrame:
    """Long to wide with the new columns given, so Spark needs no extra pass to find them."""
    return df.groupBy(*keys).pivot(name, list(values)).agg(how(value))


def lengthen(df: DataFrame, ids, cols, name: str = "name", value: str = "value", dtype: str | None = None) -> DataFrame:
    """Wide to long; mixed types need a common ``dtype``."""
    src = df.withColumns({c: F.col(f"`{c}`").cast(dtype) for c in cols}) if dtype else df
    return src.unpivot(list(ids), list(cols), name, value)


def explode_list(df: DataFrame, col: str, sep: str = ",", out: str | None = None) -> DataFrame:
    """One row per item of a delimited string; a NULL list keeps its row."""
    return df.withColumn(out or col, F.explode_outer(F.split(F.col(col), sep)))


def unnest(df: DataFrame, col: str, keep_empty: bool = False, prefix: str = "") -> DataFrame:
    """One row per struct of an array column, its fields as columns."""
    step = F.explode_outer if keep_empty else F.explode
    rest = [c for c in df.columns if c != col]
    out = df.select(*rest, step(col).alias("__item"))
    fields = out.schema["__item"].dataType.names
    return out.select(*rest, *[F.col(f"__item.`{f}`").alias(prefix + f) for f in fields])


def unnest_zip(df: DataFrame, cols) -> DataFrame:
    """Explode several array columns in step."""
    rest = [c for c in df.columns if c not in cols]
    out = df.select(*rest, F.explode(F.arrays_zip(*cols)).alias("__item"))
    return out.select(*rest, *[F.col(f"__item.{c}").alias(c) for c in cols])


def separate(df: DataFrame, col: str, names, convert: dict[str, str] | None = None, keep: bool = False,
             sep: str | None = None) -> DataFrame:
    """Split a string into columns: extra pieces are dropped, missing ones NULL."""
    parts = word_parts(col) if sep is None else F.split(col_of(col), sep)
    convert = convert or {}
    made = {}
    for i, name in enumerate(names):
        piece = F.try_element_at(parts, F.lit(i + 1))
        made[name] = piece.try_cast(convert[name]) if name in convert else piece
    out = df.withColumns(made)
    return out if keep or col in names else out.drop(col)


def melt_abundance(counts: DataFrame, tax: DataFrame, samples: DataFrame | None = None,
                   sample: str = "sample", taxon: str = "taxon", value: str = "numseqs") -> DataFrame:
    """Non-zero counts with their share of the sample, ranks and sample columns."""
    out = add_sum(counts.filter(F.col(value) > 0), [sample], value, "__total")
    out = out.withColumn("pctseqs", F.col(value) / F.col("__total")).drop("__total")
    out = left_join_ns(out, tax, [taxon])
    return left_join_ns(out, samples, [sample]) if samples is not None else out


def wide_counts(counts: DataFrame, taxa, sample: str = "sample", taxon: str = "taxon", value: str = "numseqs",
                rest: str = "other") -> DataFrame:
    """Sample×taxon matrix for export; counts of taxa outside ``taxa`` (and of none) are summed in ``rest``, which must not be one of them."""
    taxa = list(taxa)
    if rest in taxa:
        raise ValueError(f"{rest!r} is a taxon: name the column of all others differently")
    named = counts.withColumn(taxon, F.when(F.col(taxon).isin(taxa), F.col(taxon)).otherwise(rest))
    return named.groupBy(sample).pivot(taxon, list(dict.fromkeys([*taxa, rest]))).agg(F.sum(value)).fillna(0)


def csv_cell(c) -> Column:
    """Text as a CSV cell: quoted where it holds a comma, a quote or a line break."""
    text = F.coalesce(col_of(c).cast("string"), F.lit(""))
    quoted = F.concat(F.lit('"'), F.replace(text, F.lit('"'), F.lit('""')), F.lit('"'))
    return F.when(text.rlike('[,"\r\n]'), quoted).otherwise(text)


def wide_lines(counts: DataFrame, by, sample: str = "sample", taxon: str = "taxon", value: str = "numseqs",
               corner: str = "sampleID") -> DataFrame:
    """Sample×taxon matrices as CSV lines, one matrix per ``by`` and no column per taxon in the plan.

    Returns ``by``, ``is_row`` (false: the header) and ``line``. A matrix has the
    taxa with any count in it, in byte order; a missing count is 0, repeated ones
    are added up, and a sample without any count is a line of zeros. Rows without
    sample take no part, those without taxon only name their sample.
    """
    by = [by] if isinstance(by, str) else list(by)
    cells = counts.filter(F.col(sample).isNotNull()).groupBy(*by, sample, taxon).agg(
        F.coalesce(F.sum(value), F.lit(0)).alias("__n"))
    held = cells.filter(F.col(taxon).isNotNull()).groupBy(*by, taxon).agg(F.max("__n").alias("__most")).filter("__most > 0")
    heads = held.groupBy(*by).agg(F.array_sort(F.collect_list(taxon)).alias("__taxa"))
    placed = heads.select(*by, F.posexplode("__taxa").alias("__pos", taxon))
    placed = inner_join_ns(cells, placed, [*by, taxon]).filter("__n <> 0")
    rows = cells.select(*by, sample).distinct()
    entries = placed.groupBy(*by, sample).agg(F.array_sort(F.collect_list(F.struct("__pos", "__n"))).alias("__cells"))
    rows = left_join_ns(rows, entries, [*by, sample])
    rows = left_join_ns(rows, heads.select(*by, F.size("__taxa").alias("__wide")), by)
    none, own = F.lit(",0"), F.coalesce("__cells", F.array().cast(entries.schema["__cells"].dataType))
    # Only counts that are there are walked through; what lies between them is zeros.
    gap = lambda x, i: x["__pos"] - F.when(i == 0, -1).otherwise(F.get(own, i - 1)["__pos"]) - 1
    shown = F.transform(own, lambda x, i: F.concat(F.repeat(none, gap(x, i)), F.lit(","), x["__n"].cast("string")))
    last = F.coalesce(F.get(own, F.size(own) - 1)["__pos"], F.lit(-1))
    left = F.coalesce(F.col("__wide"), F.lit(0)) - last - 1
    line = F.concat(csv_cell(sample), F.array_join(shown, ""), F.repeat(none, left))
    header = F.concat_ws(",", F.lit(corner), F.transform("__taxa", csv_cell))
    return heads.select(*by, F.lit(False).alias("is_row"), header.alias("line")).unionByName(
        rows.select(*by, F.lit(True).alias("is_row"), line.alias("line")))
