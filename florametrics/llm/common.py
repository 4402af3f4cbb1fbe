"""What the training-data operators share: typed inputs, tables written to the shared folder, pickling."""

from __future__ import annotations

import string
import sys
from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from florametrics.llm.words import marks_at, may_hold, mix, table_marks
from florametrics.session import prepare, scratch_path

#: ASCII white space: what parts words everywhere in this folder.
WHITE = r"[\x20\x09-\x0D]+"
#: Words of a bit table that are put together in one task.
PIECE = 1 << 16


def ship_modules() -> None:
    """Let task functions of this folder travel with the task, so that workers need no copy of the package."""
    for name in [n for n in sys.modules if n.startswith(__package__ + ".")]:
        if name not in cloudpickle.list_registry_pickle_by_value():
            cloudpickle.register_pickle_by_value(sys.modules[name])


def texts(docs: DataFrame, *extra: str) -> DataFrame:
    """``doc_id`` and ``text`` (null: empty) of a documents table, other columns only if named.

    Rows without a doc_id have no identity to report under and take no part.
    """
    return docs.where(F.col("doc_id").isNotNull()).select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        *extra)


def lowered(value: Column) -> Column:
    """A-Z in lower case, all else as it is."""
    return F.translate(value, string.ascii_uppercase, string.ascii_lowercase)


def fold(column: str, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % folds


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read back: computed once, kept when an executor is lost.

    What was shuffled for it is read no more. Spark deletes such files when the driver's
    memory is collected, which may be long after: it is asked to do so at once.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    df.sparkSession.sparkContext._jvm.System.gc()
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def scored(docs: DataFrame, score: Callable[[list[bytes]], np.ndarray], out: str = "score") -> DataFrame:
    """All columns of ``docs`` and ``out``, the value ``score`` gives each text (null: empty); a column called ``out`` is replaced."""
    ship_modules()
    docs = docs.drop(out)
    kinds = T.StructType([*docs.schema.fields, T.StructField(out, T.DoubleType())])
    at = docs.columns.index("text")

    def task(batches):
        for batch in batches:
            values = score([(t or "").encode() for t in batch.column(at).to_pylist()]) if batch.num_rows else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(values, pa.float64())], names=kinds.names)

    return docs.mapInArrow(task, kinds)


def labelled_sample(docs: DataFrame, labels: DataFrame, column: str, keep: Column, max_documents: int) -> DataFrame:
    """(doc_id, text, y) of at most ``max_documents`` labelled ids for which ``keep`` holds, chosen by hash of the id.

    Labels other than 0 and 1 are left out; of several labels of an id the larger
    counts. Only the bounded list of ids is broadcast.
    """
    ids = (
        labels.where(F.col(column).isin(0, 1) & F.col("doc_id").isNotNull())
        .groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(column).cast("int").alias("y"))
        .where(keep).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_documents))
    return saved(texts(docs).join(F.broadcast(ids), "doc_id").select("doc_id", "text", "y"), "labelled")


def met_twice(rows: DataFrame, column: str, slices: int = 256) -> DataFrame:
    """Hashes (``id`` long) that mark, in a bit table, every value of a long column that several rows hold, and few others.

    Values are 40 bits of their hash: tasks pass on, for each slice, a packed sorted array; no value is a row of the shuffle.
    """
    ship_modules()

    def task(frames):
        held, n = [], 0

        def packed():
            at = np.sort(mix(np.concatenate(held).view(np.uint64)) >> np.uint64(24))
            part = (at >> np.uint64(32)).astype(np.int64)
            edge = np.searchsorted(part, np.arange(slices + 1))
            low = at.astype(np.uint32)
            squeeze = zstandard.ZstdCompressor(level=1).compress
            out = [(s, squeeze(np.diff(low[a:b], prepend=np.uint32(0)).view(np.uint8).reshape(-1, 4).T.tobytes()))
                   for s, (a, b) in enumerate(zip(edge[:-1], edge[1:])) if b > a]
            return pd.DataFrame(out, columns=["slice", "held"])

        for pdf in frames:
            held.append(pdf[column].to_numpy(np.int64))
            n += len(pdf)
            if n > 2_000_000:
                yield packed()
                held, n = [], 0
        if n:
            yield packed()

    def twice(key, pdf):
        parts = [np.frombuffer(zstandard.ZstdDecompressor().decompress(x), np.uint8).reshape(4, -1).T for x in pdf.held]
        low = np.sort(np.concatenate([np.cumsum(np.ascontiguousarray(p).view(np.uint32).ravel(), dtype=np.uint32) for p in parts]))
        again = np.unique(low[1:][low[1:] == low[:-1]]).astype(np.uint64)
        return pd.DataFrame({"id": (again | np.uint64(int(key[0]) << 32)).view(np.int64)})

    return rows.select(column).mapInPandas(task, "slice int, held binary").groupBy("slice").applyInPandas(twice, "id long")


def bit_table(ids: DataFrame, bits: int, hashed: bool = False) -> np.ndarray:
    """Table of ``2 ** bits`` bits that marks the ``id`` (long) column's values; its size does not depend on the data.

    A full table would let everything through: it only spares work, the joins behind it decide.
    With ``hashed`` the ids are what ``met_twice`` gives, the first 40 bits of the values' hashes.
    Its pieces are put together in tasks: the driver gets the bytes of each, never a row per word.
    """
    ship_modules()
    words = 1 << (bits - 6)
    size = min(words, PIECE)

    def task(frames):
        for pdf in frames:
            ids_ = pdf.id.to_numpy(np.int64).view(np.uint64)
            word, mark = marks_at(ids_ >> np.uint64(40 - bits)) if hashed else table_marks(ids_, bits)
            yield pd.DataFrame({"word": word, "bits": mark})

    def piece(key, pdf):
        held = np.zeros(size, dtype=np.int64)
        held[pdf.word.to_numpy(np.int64) % size] = pdf.bits.to_numpy(np.int64)
        return pd.DataFrame({"piece": [key[0]], "held": [held.tobytes()]})

    marks = ids.select("id").mapInPandas(task, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits"))
    pieces = marks.groupBy(F.floor(F.col("word") / size).alias("piece")).applyInPandas(piece, "piece long, held binary")
    table_ = np.zeros(words, dtype=np.uint64)
    for r in pieces.collect():
        table_[r["piece"] * size:(r["piece"] + 1) * size] = np.frombuffer(r["held"], np.uint64)
    return table_


def sifted(rows: DataFrame, column: str, table_: np.ndarray) -> DataFrame:
    """The rows whose ``column`` (long, not null) a bit table may hold."""
    ship_modules()
    at = rows.columns.index(column)

    def task(batches):
        for batch in batches:
            values = batch.column(at).to_numpy(zero_copy_only=False).astype(np.int64)
            yield batch.filter(pa.array(may_hold(table_, values.view(np.uint64))))

    return rows.mapInArrow(task, rows.schema)


def only_of(rows: DataFrame, ids: DataFrame, bits: int = 24) -> DataFrame:
    """The rows whose doc_id is an ``id`` of ``ids`` (distinct); a bit table keeps most others out of the shuffle."""
    return sifted(rows, "doc_id", bit_table(ids, bits)).join(ids.toDF("doc_id"), "doc_id", "left_semi")
