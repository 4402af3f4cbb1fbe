"""What bounds a task's memory: small shuffles, and one order for quantiles and lengths."""

from florametrics.operators import aggregates as A
from florametrics.session import SHUFFLE_START, bounded_shuffles

START = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
SIZE = "spark.sql.adaptive.advisoryPartitionSizeInBytes"


def test_shuffles_begin_small_unless_the_session_says_otherwise(spark):
    own = spark.newSession()
    bounded_shuffles(own)
    assert int(own.conf.get(START)) == SHUFFLE_START and own.conf.get(SIZE) == "16m"
    own = spark.newSession()
    own.conf.set(SIZE, "8m")
    own.conf.set("spark.sql.shuffle.partitions", "3000")
    bounded_shuffles(own)
    assert own.conf.get(START) == "3000" and own.conf.get(SIZE) == "8m"


def test_whole_numbers_are_ordered_once_for_median_and_n50(spark, rows):
    lengths = spark.sql("SELECT concat('g', id % 7) g, if(id % 11 = 0, null, id % 13) w FROM range(500)")
    out = A.describe_by(lengths, ["g"], "w", n50="N50", range_rows=20)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "__v" in plan and not any("__v" in line.split(" DESC")[0].rsplit(",", 1)[-1] for line in plan.splitlines() if " DESC" in line)
    doubles = A.describe_by(lengths.withColumn("w", lengths["w"].cast("double")), ["g"], "w", n50="N50", range_rows=20)
    assert rows(out, "g", "median", "N50", "n") == [(g, m, int(n), c) for g, m, n, c in rows(doubles, "g", "median", "N50", "n")]
