"""Writers. A target is a path (contains ``/``), a table name, or a JDBC table when options are given."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from florametrics.operators.joins import left_join_ns

#: Rows of a folder that go into one file.
ROWS_PER_FILE = 1_000_000
#: Bytes of text that go into one file where rows are wide.
BYTES_PER_FILE = 1_000_000_000


def _write(df: DataFrame, target: str, mode: str, options: dict | None) -> None:
    writer = df.write.mode(mode)
    if options:
        writer.format("jdbc").options(dbtable=target, **options).save()
    elif "/" in target:
        writer.parquet(target)
    else:
        writer.saveAsTable(target)


def append_table(df: DataFrame, target: str, options: dict | None = None) -> None:
    _write(df, target, "append", options)


def overwrite_table(df: DataFrame, target: str, options: dict | None = None) -> None:
    _write(df, target, "overwrite", options)


def append_or_snapshot(df: DataFrame, target: str, snapshot_path: str, load: bool,
                       options: dict | None = None) -> bool:
    """Append when there is something to append and loading is on, else keep a snapshot. True when appended."""
    if load and not df.isEmpty():
        append_table(df, target, options)
        return True
    snapshot(df, snapshot_path)
    return False


def conform(df: DataFrame, target: DataFrame | list[str]) -> DataFrame:
    """Columns of the target in its order; a missing one is an error."""
    names = target.columns if isinstance(target, DataFrame) else list(target)
    missing = [c for c in names if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df.select(*names)


def snapshot(df: DataFrame, path: str, partition_by=()) -> None:
    """Parquet copy of an intermediate, optionally one folder per value (such as the input file)."""
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def restore(spark: SparkSession, path: str, schema=None) -> DataFrame:
    return (spark.read.schema(schema) if schema is not None else spark.read).parquet(path)


def dealt_by(df: DataFrame, by, rows_per_file: int = ROWS_PER_FILE) -> DataFrame:
    """Rows of each folder ``by`` gathered for as few files as ``rows_per_file`` asks for; a large folder is split."""
    by = [by] if isinstance(by, str) else list(by)
    files = df.groupBy(*by).agg(F.ceil(F.count(F.lit(1)) / rows_per_file).alias("__files"))
    dealt = left_join_ns(df, files, by).withColumn("__file", F.pmod(F.xxhash64(*df.columns), F.col("__files")))
    return dealt.repartition(*by, "__file").drop("__files", "__file")


def write_lines(lines: DataFrame, path: str, by: str, rows_per_file: int = ROWS_PER_FILE, bytes_per_file: int = BYTES_PER_FILE,
                compression: str | None = None) -> None:
    """Lines of ``wide_lines`` as CSV text: ``path/<by>=.../part=N`` folders of one file, each of which starts with its header.

    A file has up to ``rows_per_file`` rows, and fewer where rows are as wide as that many bytes, its header's width standing for a row's.
    """
    rows = lines.filter("is_row")
    wide = lines.filter("not is_row").groupBy(by).agg(F.max(F.length("line")).alias("__wide"))
    parts = left_join_ns(rows.groupBy(by).agg(F.count(F.lit(1)).alias("__rows")), wide, by).select(by, F.greatest(
        F.ceil(F.col("__rows") / rows_per_file), F.ceil(F.col("__rows").cast("double") * F.col("__wide") / bytes_per_file)).cast("int").alias("__parts"))
    rows = left_join_ns(rows, parts, by).withColumn("part", F.pmod(F.xxhash64("line"), F.col("__parts")).cast("int"))
    heads = left_join_ns(lines.filter("not is_row"), parts, by).withColumn(
        "part", F.explode(F.sequence(F.lit(0), F.col("__parts") - 1)))
    both = heads.unionByName(rows).drop("__parts").repartition(by, "part")
    ordered = both.sortWithinPartitions(by, "part", "is_row", "line")
    writer = ordered.select(by, "part", F.col("line").alias("value")).write.mode("overwrite").partitionBy(by, "part")
    (writer.option("compression", compression) if compression else writer).text(path)


def write_csv(df: DataFrame, path: str, partition_by=()) -> None:
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).csv(path, header=True)


def write_fasta(df: DataFrame, path: str, name: str = "seq_name", sequence: str = "sequence",
                partition_by=()) -> None:
    """``>name`` and sequence lines; partition columns become folders."""
    header = F.when(F.col(name).startswith(">"), F.col(name)).otherwise(F.concat(F.lit(">"), F.col(name)))
    # A line break inside a name or a sequence would start another line, or another record.
    header = F.regexp_replace(header, r"[\r\n]+", " ")
    text = df.select(*partition_by, F.concat(header, F.lit("\n"), F.regexp_replace(sequence, r"\s", "")).alias("value"))
    writer = text.write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).text(path)
