"""Tables of a run made ready for the warehouse: known libraries only, columns in the warehouse's terms."""

from __future__ import annotations

from pyspark.sql import DataFrame

from florametrics.functions import lenient_number, sub
from florametrics.operators.aggregates import count_by
from florametrics.operators.columns import derive_each, project, rename
from florametrics.operators.joins import semi_ns
from florametrics.operators.setops import union_fill
from florametrics.sources.sinks import append_or_snapshot, conform

# Mark of the first read file in a library's name; columns of the read-level table.
READ_MARK = "_R1"
READ_LEVEL = ["seq_id", "uc", "taxon", "taxid", "numseqs", "filename"]


def known_libraries(df: DataFrame, lookup: DataFrame, mark: str = READ_MARK + "$") -> DataFrame:
    """Rows whose ``seq_id``, without the read mark, is one of the lookup table's; ``seq_id`` comes first.

    A missing ``seq_id`` is kept when the lookup table holds a missing one.
    """
    named = derive_each(df, ["seq_id"], lambda c: sub(c, mark, ""))
    return project(semi_ns(named, lookup, "seq_id"), first=["seq_id"])


def read_level_load(counts: DataFrame, lookup: DataFrame) -> DataFrame:
    """Reads per library, status and taxon. Here the read mark may stand anywhere in the name."""
    return known_libraries(counts, lookup, READ_MARK).select(*READ_LEVEL)


def abundance_load(lookup: DataFrame, *reports: DataFrame) -> DataFrame:
    """Abundance reports of one or more runs under one another; a column that a run lacks is missing there."""
    return known_libraries(rename(union_fill(*reports), {"taxonomy_id": "taxid"}), lookup)


def profile_load(lookup: DataFrame, *profiles: DataFrame) -> DataFrame:
    """Taxonomic profiles of one or more runs; a ``taxid`` that is no number becomes missing."""
    numbered = derive_each(union_fill(*profiles), ["taxid"], lenient_number)
    return known_libraries(numbered, lookup)


def contig_load(contigs: DataFrame, target: DataFrame | list[str]) -> DataFrame:
    """Classified contigs in the target's columns; all isolates are loaded."""
    return conform(contigs, target)


def rows_per_library(df: DataFrame, *also: str) -> DataFrame:
    """What a load holds: its rows per library (and ``also``)."""
    return count_by(df, ["seq_id", *also], "n")


def load_run(tables: dict[str, DataFrame], warehouse: str, snapshots: str, load: bool = True) -> dict[str, bool]:
    """Append each table to ``warehouse/<name>``; one with no rows, or any when loading is off, is kept in ``snapshots``.

    Returns for each table whether it was appended.
    """
    return {
        name: append_or_snapshot(df, f"{warehouse}/{name}", f"{snapshots}/{name}", load) for name, df in tables.items()
    }
