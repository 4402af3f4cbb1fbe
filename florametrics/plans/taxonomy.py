"""Taxon counts, abundance profiles, assignment and classification."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from florametrics.functions import blank_to, file_name, matches, null_to, paste, ratio, sub, taxid
from florametrics.operators.aggregates import count_by, sum_by
from florametrics.operators.columns import literal_map, rename, require_columns
from florametrics.operators.joins import anti_ns, join_back, left_join_ns, natural_left, semi_ns
from florametrics.operators.ordered import member_index, na_last, stack_positions
from florametrics.operators.ranking import best_weighted

RANKS = ["Kingdom", "Phylum", "Class", "Order", "Family", "Genus", "Species"]

# Plot classes of gut taxa, most specific rank first; Genus entries are name endings.
TAXON_CLASSES = {
    "Genus": {
        "Enterococcus": "#129246", "Streptococcus": "#9FB846", "Staphylococcus": "#f1eb25",
        "Lactobacillus": "#3b51a3", "Turicibacter": "#bf5700", "Akkermansia": "#63615f",
    },
    "Family": {
        "Lachnospiraceae": "#EC9B96", "Ruminococcaceae": "#9AAE73", "Oscillospiraceae": "#9AAE73",
        "Erysipelotrichaceae": "orange", "Lactobacillaceae": "#293a75", "Staphylococcaceae": "#d4ce20",
    },
    "Order": {"Clostridiales": "#9C854E", "Eubacteriales": "#9C854E"},
    "Class": {"Clostridia": "#7a683d"},
    "Phylum": {
        "Proteobacteria": "red", "Thermodesulfobacteriota": "red", "Pseudomonadota": "red",
        "Actinobacteria": "#A77097", "Actinomycetota": "#A77097",
        "Bacteroidetes": "#51AB9B", "Bacteroidota": "#51AB9B",
    },
}
# Top functional categories.
FUNCTION_CLASSES = {
    "09100 Metabolism": "#FF7F0EFF",
    "09190 Not Included in Pathway or Brite": "#dae0eb",
    "09120 Genetic Information Processing": "#2CA02CFF",
    "09130 Environmental Information Processing": "#9467BDFF",
    "09140 Cellular Processes": "#8C564BFF",
    "09160 Human Diseases": "#E377C2FF",
    "09150 Organismal Systems": "#17BECFFF",
}


def taxon_counts(reads: DataFrame, by_genome: bool = False) -> DataFrame:
    """Reads per (file, status, taxon). By genome the counts stay separate though the genome is not shown."""
    keys = ["filename", "uc", "taxon"]
    if by_genome:
        reads, keys = reads.withColumn("genome", sub("read", "-[0-9]+", "")), keys + ["genome"]
    counted = count_by(reads, keys, "numseqs").withColumn("filename", file_name("filename"))
    return counted.select(
        sub("filename", r"\.standard\.txt", "").alias("seq_id"), "uc", "taxon", taxid("taxon").alias("taxid"),
        "numseqs", "filename",
    )


def _stacked_shares(amounts: DataFrame, keys, ranks, amount: str, split: bool) -> DataFrame:
    """Share, cumulative share and slice midpoint in rank order.

    Amounts are stacked before they are divided, so whole numbers add up exactly.
    Without ``split`` the group is stacked in one window, and its total is taken where it lies.
    """
    if split:
        amounts = join_back(amounts, sum_by(amounts, keys, amount, "total"), keys)
    ordered, order = na_last(amounts, ranks)
    placed = stack_positions(ordered, keys, order, amount, cum="__cum", mid="__mid", split=split)
    if not split:
        placed = placed.withColumn("total", F.sum(amount).over(Window.partitionBy(*keys)))
    return placed.withColumns({
        "pctseqs": ratio(amount, "total"), "cum_pct": ratio("__cum", "total"), "y_text": ratio("__mid", "total"),
    })


def contig_abundance(contigs: DataFrame, taxdump: DataFrame, label_from: float = 0.1,
                     split: bool = False) -> DataFrame:
    """Share of contig length per lineage and isolate, with label text and position.

    After the aggregate an isolate has one row per lineage, so the stacking
    window is bounded by the taxonomy; ``split`` lifts that bound too.
    """
    lineage = [r.lower() for r in RANKS]
    known = natural_left(contigs.withColumn("tax_id", taxid("taxon")), taxdump)
    by_lineage = rename(sum_by(known, ["seq_id", *lineage], "length"), {r.lower(): r for r in RANKS})
    by_lineage = by_lineage.withColumns({r: blank_to(r, "unclassified") for r in RANKS})
    placed = _stacked_shares(sum_by(by_lineage, ["seq_id", *RANKS], "length"), ["seq_id"], RANKS, "length", split)
    long_genus = paste("Phylum", "Class", "Order", "Family", "Genus", sep="-")
    text = F.when(matches(long_genus, "unclassified$"), F.col("Genus")).otherwise(sub("Species", " ", "\n"))
    return placed.select(
        "seq_id", *[r for r in RANKS if r != "Genus"], F.col("Genus").alias("genus_label"), long_genus.alias("Genus"),
        "pctseqs", "cum_pct", "y_text",
        F.when(F.col("pctseqs") >= label_from, text).otherwise("").alias("tax_label"),
    )


def abundance_profile(counts: DataFrame, tax: DataFrame, samples: DataFrame | None = None, level: str = "Genus",
                      group: str | None = None, label: str = "genus", top: str = "Kingdom",
                      label_from: float = 0.1, split: bool = False) -> DataFrame:
    """Share of each taxon per sample with stacking position, label and sample total.

    ``level`` is the last rank shown. At Genus level an unclassified genus is
    named after its family. ``label="plain"`` writes "unclassified" for those.
    """
    ranks = [top] + RANKS[1:RANKS.index(level) + 1]
    keys = ["sample", *([group] if group else [])]
    long = counts.filter(F.col("numseqs") > 0)
    if group:
        # Before the lineage, while rows are narrow.
        long = left_join_ns(long, samples.select("sample", group), "sample")
    long = left_join_ns(long, tax, "taxon")
    long = long.withColumns({r: null_to(r, "unclassified") for r in RANKS[1:] if r in long.columns})
    if level == "Genus":
        unnamed = F.concat(F.col("Family"), F.lit("\n"), F.col("Genus"))
        long = long.withColumn("Genus", F.when(F.col("Genus") == "unclassified", unnamed).otherwise(F.col("Genus")))
    placed = _stacked_shares(sum_by(long, [*keys, *ranks], "numseqs"), keys, ranks, "numseqs", split)
    text = F.col("Genus")
    if label == "plain":
        text = F.when(matches("Genus", "unclassified"), "unclassified").otherwise(text)
    labelled = placed.withColumn("tax_label", F.when(F.col("pctseqs") >= label_from, text).otherwise(""))
    return labelled.select(*keys, *ranks, "pctseqs", "cum_pct", "y_text", "tax_label", "total")


def assign_taxonomy(hits: DataFrame, seed: int = 0, mode: str = "random") -> DataFrame:
    """One lineage per sequence from its best alignment."""
    span = (F.col("qend") - F.col("qstart")) / F.col("qlen")
    best = best_weighted(
        hits.withColumn("__span", span), ["qaccver"],
        [("bitscore", "desc"), ("pident", "desc"), ("__span", "desc"), ("evalue", "asc")],
        "species", wt="spwt", seed=seed, mode=mode,
    ).drop("__span")
    return rename(best, {"kingdom": "Superkingdom", **{r.lower(): r for r in RANKS[1:]}})


def replace_tax(counts: DataFrame, assigned: DataFrame, sequence: str = "qaccver") -> tuple[DataFrame, DataFrame]:
    """Counts and taxonomy restricted to the sequences present in both."""
    tax = rename(assigned, {sequence: "taxon"})
    return semi_ns(counts, tax, "taxon"), semi_ns(tax, counts, "taxon")


def classify_taxa(tax: DataFrame, classes: dict[str, dict[str, str]] | None = None, shades: int = 3,
                  other: str = "gray") -> DataFrame:
    """First matching class from genus up to phylum, and a cycling index inside the class."""
    classes = TAXON_CLASSES if classes is None else classes
    ranks = [r for r in RANKS if r != "Species"]
    distinct = require_columns(tax, ranks).select(*ranks).distinct()
    found = []
    for rank, names in classes.items():
        if rank == "Genus":
            found += [F.when(matches(rank, f"{name}$"), F.lit(value)) for name, value in names.items()]
        else:
            found.append(F.try_element_at(literal_map(names), F.col(rank)))
    named = distinct.withColumn("kind", F.coalesce(*found, F.lit(other)))
    ordered, order = na_last(named, ranks)
    # Everything without a class shares one group, so the numbering is split by range.
    return member_index(ordered, ["kind"], order, "shade", cycle=shades).select(*ranks, "kind", "shade")


def classify_functions(functions: DataFrame, base: dict[str, str] | None = None, level: int = 2) -> DataFrame:
    """Category of each functional entry, category size and the entry's index in it.

    Entries outside the dictionary are numbered together as ``other``.
    """
    if not 2 <= level <= 4:
        raise ValueError("level must be between 2 and 4")
    base = FUNCTION_CLASSES if base is None else base
    ranks = [f"rank{i}" for i in range(1, level + 1)]
    distinct = require_columns(functions, ranks).select(*ranks).distinct()
    known = distinct.sparkSession.createDataFrame(list(base.items()), "rank1 string, color string")
    hit = left_join_ns(semi_ns(distinct, known, "rank1"), known, "rank1").withColumn("category", F.col("rank1"))
    other = anti_ns(distinct, known, "rank1").withColumns({
        "color": F.lit(None).cast("string"), "category": F.lit("other"),
    })
    both = hit.unionByName(other)
    sized = join_back(both, count_by(both, ["category"], "n_members"), ["category"])
    ordered, order = na_last(sized, ranks)
    return member_index(ordered, ["category"], order, "member").select(
        *ranks, "category", "color", "n_members", "member"
    )

