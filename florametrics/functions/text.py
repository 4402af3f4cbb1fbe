"""Text functions: patterns, paths and sample identifiers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from florametrics.functions.nulls import col_of, matches

__all__ = [
    "sub", "extract", "extract_all", "paste", "title", "file_name", "sample_from_path", "last_part",
    "path_part", "taxid", "pool_id", "subject_id", "padded_id", "zero_pad", "word_parts",
]

# Identifier patterns used by sequencing runs.
STUDY_ID = r"[HTCUMIFLD]+-[0-9]{3}[-.][0-9]{2}"
RUN_DATE_PREFIX = r"^[0-9]{6}-"
DONOR_MARK = r"[0-9]{6}\-Donor\-|\.S"
POOL_FAMILY = r"MMF.16S.[0-9]+"
POOL_OWNER = r"[A-Za-z]+\.final"


def sub(c, regex: str, replacement: str) -> Column:
    return F.regexp_replace(col_of(c), regex, replacement)


def extract(c, regex: str) -> Column:
    """First match, or NULL when there is none."""
    return F.regexp_substr(col_of(c), F.lit(regex))


def extract_all(c, regex: str, sep: str = "_") -> Column:
    """All matches joined by ``sep``."""
    return F.array_join(F.regexp_extract_all(col_of(c), F.lit(regex), F.lit(0)), sep)


def paste(*cols, sep: str = "") -> Column:
    """Concatenate; NULL contributes the text ``NA``."""
    return F.concat_ws(sep, *[F.coalesce(col_of(c).cast("string"), F.lit("NA")) for c in cols])


def title(c) -> Column:
    return F.initcap(col_of(c))


def last_part(c, sep: str = "/") -> Column:
    """Part after the last ``sep`` (a literal, not a pattern)."""
    return F.substring_index(col_of(c), sep, -1)


def file_name(c) -> Column:
    return last_part(c, "/")


def path_part(c, k: int) -> Column:
    """``k``-th ``/`` component, from the end when negative; NULL when there is none."""
    return F.try_element_at(F.split(col_of(c), "/"), F.lit(k))


def sample_from_path(c, suffix: str) -> Column:
    """File name without the part matching ``suffix``."""
    return sub(file_name(c), suffix, "")


def word_parts(c) -> Column:
    """Array of alphanumeric runs."""
    return F.split(col_of(c), "[^A-Za-z0-9]+")


def taxid(c) -> Column:
    """The integer of ``... taxid N ...``."""
    return F.try_element_at(word_parts(extract(c, "taxid [0-9]+")), F.lit(2)).try_cast("int")


def pool_id(c) -> Column:
    """Pool name from a run file, for both naming families."""
    name = col_of(c)
    owner = F.coalesce(sub(extract(name, POOL_OWNER), ".final", ""), F.lit("NA"))
    family = F.concat_ws("_", extract_all(name, POOL_FAMILY), owner)
    plain = F.split_part(file_name(name), F.lit("."), F.lit(1))
    return F.when(matches(name, "MMF.16S."), family).otherwise(plain)


def subject_id(c) -> Column:
    """``study-subject.timepoint`` from a sample name, or the donor form."""
    bare = sub(c, RUN_DATE_PREFIX, "")
    parts = word_parts(F.when(matches(bare, STUDY_ID), bare))
    study = F.try_element_at(parts, F.lit(1))
    subject = F.concat(
        study, F.lit("-"), F.coalesce(F.try_element_at(parts, F.lit(2)), F.lit("NA")),
        F.lit("."), F.coalesce(F.try_element_at(parts, F.lit(3)), F.lit("NA")),
    )
    donor = sub(sub(sub(c, DONOR_MARK, ""), r"\.", "00"), "^[0-9]+-", "")
    return F.when(study.isNull(), donor).otherwise(subject)


def zero_pad(c, width: int) -> Column:
    """Zero-padded integer, never truncated; NULL gives blank-padded ``NA``."""
    return F.when(col_of(c).isNull(), F.lit("NA".rjust(width))).otherwise(
        F.format_string(f"%0{width}d", col_of(c).cast("long"))
    )


def padded_id(a, n, m, n_width: int = 3, m_width: int = 2) -> Column:
    """``A-003.05``."""
    return F.concat(
        F.coalesce(col_of(a).cast("string"), F.lit("NA")),
        F.lit("-"), zero_pad(n, n_width), F.lit("."), zero_pad(m, m_width),
    )
