"""Clinical export harmonisation and identifier joins across data kinds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from florametrics.functions import blank_to_null, if_else_na, lenient_date, matches, padded_id, sub
from florametrics.operators.aggregates import distinct_rows
from florametrics.operators.columns import correct, rename
from florametrics.operators.joins import full_join_all
from florametrics.operators.ordered import fill_down, fill_down_levels, na_last
from florametrics.operators.ranking import top_n
from florametrics.operators.reshape import separate
from florametrics.operators.setops import union_distinct, union_fill
from florametrics.functions.text import subject_id
from florametrics.sources.readers import FILE_ORDER

# Export schemas, sample-name patterns and known wrong identifiers.
LT_SAMPLES = "record_id string, mrn string, sample_id string, date_collected string, sample_type string"
LT_EVENTS = "record_id string, mrn string, event_date string, event_description string"
MICU = "studyid string, mrn string, sampleid string, stool string"
HT = "study_id string, mrn string, sample_id string, ohtdate string, date_collected string"
LD = "subject_id string, mrn string, sample_id string, collection_date string, sample_type string"
SAMPLE_PATTERN = (
    r"_[MICU\.\_\-]{3,}[0-9]{2}|_[UC\.\_\-]{3,}[0-9]{2}|_[HT\.\_\-]{3,}[0-9]{2}|_[LD\.\_\-]{3,}[0-9]{2}"
)
METABOLOMICS_FIXES = {
    "HT_005_01_RI": "HT_005_01", "U_C_003_05": "UC_003_05", "U_C_003_06": "UC_003_06", "U_C_003_07": "UC_003_07",
    "U_C_006_01": "UC_006_01", "U_C_005_01": "UC_005_01", "U_C_007_02": "UC_007_02", "U_C_004_03": "UC_004_03",
    "MICU_048_01_RI": "MICU_048_01",
}


def _study(c: str) -> Column:
    return sub(c, ",.+", "")


def transplant_samples(samples: DataFrame, across: bool = False) -> DataFrame:
    named = samples.withColumns({"studyid": _study("record_id"), "mrn": blank_to_null("mrn")})
    if across:
        marked, order = na_last(named.withColumn("__mrn", F.col("mrn")), ["studyid", "__mrn"])
        filled = fill_down(marked, ["mrn"], [*order, FILE_ORDER])
    else:
        marked, order = na_last(named.withColumn("__mrn", F.col("mrn")), ["__mrn"])
        filled = fill_down(marked, ["mrn"], [*order, FILE_ORDER], by=["studyid"])
    return filled.filter(F.col("sample_id") != "").select(
        "studyid", "mrn", F.col("sample_id").alias("sampleid"), lenient_date("date_collected").alias("date_collected"),
        F.col("sample_type").alias("sampletype"), F.lit("LiverTransplant").alias("db"),
    )


def transplant_events(events: DataFrame, across: bool = False) -> DataFrame:
    named = events.withColumns({"studyid": _study("record_id"), "mrn": blank_to_null("mrn")})
    filled = fill_down(named, ["mrn"], [FILE_ORDER], by=() if across else ["studyid"])
    kept = filled.filter((F.col("event_date") != "") & matches("event_description", "Transplant"))
    return distinct_rows(kept.select(
        "studyid", "mrn", F.lit("LiverTransplant").alias("db"), lenient_date("event_date").alias("date_transplant"),
    ))


def intensive_care(exports: DataFrame) -> DataFrame:
    return exports.select(
        blank_to_null("studyid").alias("studyid"), blank_to_null("mrn").alias("mrn"), "sampleid",
        lenient_date("stool").alias("date_collected"), F.lit("Stool").alias("sampletype"), F.lit("MICU").alias("db"),
        (F.col("stool") != "").alias("__kept"), FILE_ORDER,
    )


def heart_transplant(exports: DataFrame) -> DataFrame:
    # A missing or unreadable transplant date is NULL and takes the one before it.
    return exports.select(
        blank_to_null("study_id").alias("studyid"), blank_to_null("mrn").alias("mrn"),
        F.col("sample_id").alias("sampleid"), lenient_date("date_collected").alias("date_collected"),
        lenient_date("ohtdate").alias("date_transplant"), F.lit("Stool").alias("sampletype"),
        F.lit("HeartTransplant").alias("db"), (F.col("sample_id") != "").alias("__kept"), FILE_ORDER,
    )


def liver_disease(exports: DataFrame) -> DataFrame:
    return exports.select(
        blank_to_null("subject_id").alias("studyid"), blank_to_null("mrn").alias("mrn"),
        F.col("sample_id").alias("sampleid"), lenient_date("collection_date").alias("date_collected"),
        if_else_na(blank_to_null("sample_type") == "1", F.lit("Stool"), F.lit("Other")).alias("sampletype"),
        F.lit("LiverDisease").alias("db"), (F.col("sample_id") != "").alias("__kept"), FILE_ORDER,
    )


def filled_cohorts(*cohorts: DataFrame, across: bool = False) -> DataFrame:
    """Subjects carried down in each cohort's file order, then their record number and transplant date.

    All cohorts are filled in the same passes. Rows that are not samples carry
    values but are not returned.
    """
    rows = union_fill(*cohorts)
    if across:
        filled = fill_down(rows, ["studyid", "mrn", "date_transplant"], [FILE_ORDER], by=["db"])
    else:
        filled = fill_down_levels(rows, [(["studyid"], ["db"]), (["mrn", "date_transplant"], ["db", "studyid"])], [FILE_ORDER])
    return filled.filter("__kept").drop("__kept", FILE_ORDER)


def sample_key(df: DataFrame, col: str, out: str = "ID") -> DataFrame:
    """``study-subject.timepoint`` from the parts of an identifier."""
    parts = separate(df, col, ["__a", "__n", "__m"], {"__n": "int", "__m": "int"}, keep=True)
    return parts.withColumn(out, padded_id("__a", "__n", "__m")).drop("__a", "__n", "__m")


def harmonise_clinical(lt_samples: DataFrame, lt_events: DataFrame, micu: DataFrame, ht: DataFrame,
                       ld: DataFrame, across: bool = False) -> DataFrame:
    """Four cohorts under one schema.

    ``across=True`` lets record numbers run on into the next subject, as an
    ungrouped fill does; the default keeps them inside the subject.
    """
    lt = full_join_all([transplant_samples(lt_samples, across), transplant_events(lt_events, across)], ["studyid", "mrn", "db"])
    cohorts = [intensive_care(micu), heart_transplant(ht), liver_disease(ld)]
    total = union_fill(lt, filled_cohorts(*cohorts, across=across))
    return sample_key(total.withColumn("sampleid", sub("sampleid", " ", "")), "sampleid")


def subject_lookup(stats: DataFrame) -> DataFrame:
    """Sample name to subject identifier."""
    return stats.select("seq_id").distinct().withColumn("ID", subject_id("seq_id"))


def amplicon_lookup(samples: DataFrame) -> DataFrame:
    """Best replicate per subject and time point among the clinical 16S samples."""
    kept = samples.filter(matches("MiSeq_id", SAMPLE_PATTERN) & matches("MiSeq_id", "CC", negate=True))
    named = separate(kept, "MiSeq_id", ["pool", "ID"], keep=True, sep="_")
    best = top_n(named, ["ID"], "reads_out", 1)
    parts = separate(best.select("MiSeq_id", "ID"), "ID", ["study", "subj", "tp"])
    text = [F.coalesce(F.col(c), F.lit("NA")) for c in ("study", "subj", "tp")]
    return parts.select("MiSeq_id", F.concat(text[0], F.lit("-"), text[1], F.lit("."), text[2]).alias("ID"))


def metabolite_lookup(*tables: DataFrame) -> DataFrame:
    """Distinct metabolomics identifiers, known slips corrected, with their subject key."""
    ids = tables[0].select("metabolomicsID").distinct()
    for other in tables[1:]:
        ids = union_distinct(ids, other, "metabolomicsID")
    cleaned = ids.withColumn("__id", sub(sub("metabolomicsID", " ", ""), "[a-z]+$", ""))
    return sample_key(correct(cleaned, "__id", METABOLOMICS_FIXES), "__id").select("metabolomicsID", "ID")


def cross_lookup(clinical: DataFrame, shotgun: DataFrame, amplicon: DataFrame, *metabolites: DataFrame) -> DataFrame:
    """One table that names a subject's samples in every kind of data."""
    out = full_join_all(
        [amplicon_lookup(amplicon), clinical, rename(shotgun, {"seq_id": "shotgunSeq_id"}), metabolite_lookup(*metabolites)], ["ID"])
    return out.withColumn("sampletype", F.lower("sampletype"))
