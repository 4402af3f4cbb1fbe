"""Session defaults and the two ways a job leaves memory: checkpoints and scratch files."""

from __future__ import annotations

import sys
import tempfile
import uuid
from collections.abc import Callable

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession

SESSION_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A skewed join followed by an aggregate on the same key is still split.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


#: How queries over whole tables are shuffled: many partitions at first, which adaptive execution merges to tasks of
#: this much compressed data, so that a task's memory does not grow with the table.
SHUFFLE_START = 512
SHUFFLE_DEFAULTS = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m"}


def build_session(app: str = "florametrics", master: str | None = None, **conf) -> SparkSession:
    """A session with the settings the operators were planned for; ``conf`` overrides them."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_DEFAULTS, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def prepare(spark: SparkSession) -> SparkSession:
    """Give a session made elsewhere the adaptive settings the plans count on."""
    for key, value in SESSION_DEFAULTS.items():
        if key.startswith("spark.sql.adaptive."):
            spark.conf.set(key, value)
    return spark


def bounded_shuffles(spark: SparkSession) -> SparkSession:
    """Let a session's shuffles begin with enough partitions to keep tasks small; what the session sets itself stays."""
    first = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    start = max(SHUFFLE_START, int(spark.conf.get("spark.sql.shuffle.partitions")))
    for key, value in {**SHUFFLE_DEFAULTS, first: str(start)}.items():
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared folder (``spark.checkpoint.dir``).

    Only a local master may fall back to a temporary folder: on a cluster the
    executors would each write to a disk the others cannot read.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    folder = tempfile.mkdtemp(prefix="florametrics-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: survives executor loss, unlike a local one."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
    return df.checkpoint(eager=True)


def ship(task: Callable) -> None:
    """Let a task function travel with its module, so that workers need no copy of the package."""
    if task.__module__ not in cloudpickle.list_registry_pickle_by_value():
        cloudpickle.register_pickle_by_value(sys.modules[task.__module__])
