"""Read survival, library quality and assembly metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from florametrics.functions import extract, lenient_number, matches, ratio, sub
from florametrics.operators.aggregates import count_by, describe_by, first_by, margin_sums
from florametrics.operators.columns import recode_levels, rename, where_matches
from florametrics.operators.joins import left_join_ns
from florametrics.operators.reshape import lengthen, widen
from florametrics.sources.readers import FILE_ORDER

# Log labels of the read-cleaning stages and the name families kept in reports.
STAGES = {
    "raw pair": "raw", "trimmed pair": "trimmed", "decontaminated mouse_C57BL_6NJ pair": "deMouse",
    "decontaminated hg37dec_v0.1 pair": "deHuman", "final pair": "final",
}
COHORT_NAMES = "^EP|DFI|MSK|SL"
READ_LINES = {"low_line": 1e6, "high_line": 5e6}


def trim_stats(log: DataFrame, compat: bool = False, order=None) -> DataFrame:
    """Stage counts per sample, mates merged, first line kept.

    ``compat`` compares (stage, count) across all samples, so equal counts of
    different samples collapse; the default compares within a sample.
    """
    order = order or ([FILE_ORDER] if FILE_ORDER in log.columns else ["logfn", "handlerfoo", "description"])
    named = log.select(
        F.split_part("logfn", F.lit("_"), F.lit(1)).alias("seq_id"),
        sub("handlerfoo", "pair[12]", "pair").alias("countType"), "count", "description",
        *[F.col(c).alias(f"__o{i}") for i, c in enumerate(order)],
    )
    keys = ["countType", "count"] if compat else ["seq_id", "countType", "count"]
    first = first_by(named, keys, [f"__o{i}" for i in range(len(order))])
    return first.select("seq_id", "countType", "count", "description")


def stage_table(stats: DataFrame, sample: Column | None = None) -> DataFrame:
    """One row per sample with the read count of each stage."""
    sample = sample if sample is not None else sub(F.split_part("seq_id", F.lit("/"), F.lit(2)), "^[0-9]{6}-", "")
    kept = recode_levels(stats, "countType", STAGES, keep=["raw", "trimmed", "deHuman", "final"])
    wide = widen(kept.select("seq_id", "countType", "count"), ["seq_id"], "countType", "count",
                 ["raw", "trimmed", "deHuman", "final"], how=F.max)
    return wide.withColumn("ID", sample)


def read_survival(stats: DataFrame, sample: Column | None = None) -> DataFrame:
    """Share of raw reads trimmed, removed as host and left clean, in long form."""
    wide = stage_table(stats, sample).select(
        "ID",
        ratio(F.col("raw") - F.col("trimmed"), "raw").alias("Trimmed"),
        ratio(F.col("trimmed") - F.col("final"), "raw").alias("Host"),
        ratio("final", "raw").alias("Clean"),
    )
    return lengthen(wide, ["ID"], ["Trimmed", "Host", "Clean"], "type", "perc")


def read_counts(stats: DataFrame, sample: Column | None = None) -> DataFrame:
    """Raw and final counts in long form beside the two reference lines."""
    long = lengthen(stage_table(stats, sample), ["ID"], ["raw", "final"], "readType", "cnt", "double")
    return long.withColumns({n: F.lit(v) for n, v in READ_LINES.items()})


def run_summary(stats: DataFrame) -> DataFrame:
    """Mean and median over samples of the raw and the final pairs."""
    pairs = where_matches(stats, "countType", "[finlraw] pair")
    wide = widen(pairs, ["seq_id"], "countType", "count", ["final pair", "raw pair"], how=F.max)
    wide = rename(wide, {"final pair": "final", "raw pair": "raw"})
    # Both stages are groups of one long table: one pass for means and medians, missing where a sample lacks the stage.
    stats = describe_by(lengthen(wide, ["seq_id"], ["final", "raw"], "stage", "value", "double"), ["stage"], "value")
    return stats.agg(*[
        F.max(F.when(F.col("stage") == stage, F.col(of))).alias(f"{stage}_{of}") for of in ("mean", "median") for stage in ("final", "raw")])


def library_order(c: str) -> Column:
    # Fixed value: pools named SM carry their number first, the others last.
    return F.when(matches(c, "^SM"), lenient_number(extract(c, "[0-9]+"))).otherwise(
        lenient_number(extract(c, "[0-9]+$"))
    )


def library_sizes(samples: DataFrame) -> DataFrame:
    """Samples per library in library order."""
    return count_by(samples, ["libraryname"], "sampleN").withColumn("liborder", library_order("libraryname"))


def library_quality(counts: DataFrame, samples: DataFrame) -> DataFrame:
    """Per sample: reads left after all steps and after filtering, in percent of the input."""
    after = rename(margin_sums(counts, "sample", "numseqs", "after"), {"sample": "samplename"})
    joined = left_join_ns(samples.select("samplename", "libraryname", "reads_in", "reads_out"), after, "samplename")
    return joined.withColumns({
        "highQualSurvPerc": ratio("after", "reads_in", 100),
        "filterSurPerc": ratio("reads_out", "reads_in", 100),
        "liborder": library_order("libraryname"),
    })


def library_quality_long(quality: DataFrame) -> DataFrame:
    return lengthen(quality, ["samplename", "libraryname", "reads_in", "liborder"],
                    ["highQualSurvPerc", "filterSurPerc"], "percentage", "value")


def metrics_long(quast: DataFrame, assembly: str = "Assembly", names: str = COHORT_NAMES) -> DataFrame:
    """Assembly metrics in long form with clean names, restricted to the known cohorts."""
    cleaned = quast.withColumn(assembly, sub(sub(assembly, r"[_\.]spades.contigs", ""), "_", "-"))
    kept = where_matches(cleaned, assembly, names)
    metrics = [c for c in kept.columns if c not in (assembly, "filename")]
    return rename(lengthen(kept, [assembly], metrics, "stat", "value", "string"), {assembly: "seq_id"})
