"""Profiles without split: a group's total is taken in the window that stacks it, not by a join."""

from pyspark.sql import functions as F

from florametrics.plans import taxonomy as TX


def frames(spark):
    counts = spark.createDataFrame([("a", "t1", 3), ("a", "t2", 1), ("a", "t9", 4), ("b", "t1", 5), (None, "t2", 2), ("b", "t2", 0)], "sample string, taxon string, numseqs long")
    tax = spark.createDataFrame([("t1", "K", "P", "C", "O", "F", "G", "S"), ("t2", "K", "P", "C", "O", "F", None, None)], "taxon string, " + ", ".join(f"`{r}` string" for r in TX.RANKS))
    samples = spark.createDataFrame([("a", "g1"), ("b", "g2"), (None, "g3")], "sample string, grp string")
    return counts, tax, samples


def test_totals_and_positions(spark, rows):
    out = TX.abundance_profile(*frames(spark), "Species", group="grp", label_from=0.5)
    assert rows(out, "sample", "grp", "Species", "pctseqs", "cum_pct", "y_text", "total") == sorted([
        ("a", "g1", "S", 0.375, 0.375, 0.1875, 8), ("a", "g1", "unclassified", 0.125, 0.5, 0.4375, 8), ("a", "g1", "unclassified", 0.5, 1.0, 0.75, 8),
        ("b", "g2", "S", 1.0, 1.0, 0.5, 5), (None, "g3", "unclassified", 1.0, 1.0, 0.5, 2)], key=lambda t: tuple((x is not None, str(x)) for x in t))
    assert rows(out) == rows(TX.abundance_profile(*frames(spark), "Species", group="grp", label_from=0.5, split=True))


def test_one_shuffle_after_the_lineages_are_counted(spark):
    out = TX.abundance_profile(*frames(spark), "Species", group="grp")
    text = out._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("Join") == 2
    assert out.select(F.sum("total")).first()[0] == 3 * 8 + 5 + 2
