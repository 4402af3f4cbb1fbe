"""The driver's retail tables seen as sequencing tables, in Spark and as SQL.

Suppliers are samples, parts are taxa or genes, orders are reads or assemblies
and their lines are hits or contigs. Only names change; the operators are the
library's own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _sql(spark: SparkSession, sf: str, text: str, *names: str) -> DataFrame:
    """Rename-only projection written once for both engines."""
    return spark.sql(text, **{n: table(spark, sf, n) for n in names})


_HITS = """
SELECT concat('/data/', l_returnflag, '/S', l_suppkey, '.R', 1 + l_linenumber % 2, '.', l_returnflag, '.dmnd') AS filename,
       concat('R', l_orderkey) AS qseqid, concat('P', l_partkey) AS sseqid, l_discount AS pident,
       CAST(l_linenumber AS BIGINT) AS length, l_tax AS evalue, l_quantity AS bitscore,
       CAST(l_quantity AS BIGINT) AS qlen, l_partkey % 50 + 1 AS slen
FROM {lineitem}
"""
_COUNTS = """
SELECT concat('S', l_suppkey) AS sample, concat('T', l_partkey) AS taxon, CAST(sum(l_quantity) AS BIGINT) AS numseqs
FROM {lineitem} GROUP BY l_suppkey, l_partkey
"""
_TAX = """
SELECT concat('T', p_partkey) AS taxon, p_type AS Kingdom, p_brand AS Phylum, concat('C', p_size % 3) AS Class,
       concat('O', p_size % 4) AS `Order`, concat('F', p_size % 5) AS Family,
       CASE WHEN p_size % 7 <> 0 THEN split_part(p_name, ' ', 2) END AS Genus,
       CASE WHEN p_size % 6 <> 0 THEN p_name END AS Species
FROM {part}
"""
_SAMPLES = """
SELECT concat('S', s_suppkey) AS sample, concat('G', s_nationkey % 5) AS grp,
       CASE WHEN s_nationkey % 2 = 0 THEN concat('SM', s_nationkey, 'x') ELSE concat('LIB-', s_nationkey) END AS libraryname,
       CASE WHEN s_nationkey % 4 <> 0 THEN concat('Lab ', s_nationkey % 4) END AS request_by,
       CAST(floor(abs(s_acctbal)) AS BIGINT) + 20000 AS reads_in, CAST(floor(abs(s_acctbal)) AS BIGINT) + 9000 AS reads_out
FROM {supplier}
"""
_CONTIGS = """
SELECT concat('I', o_custkey) AS isolate, concat('./I', o_custkey, '/',
         CASE o_orderstatus WHEN 'F' THEN 'hybridAssembly' WHEN 'O' THEN 'flye' ELSE 'hybridAssemblyTrim' END,
         '/A', o_orderkey) AS path,
       concat('c', l_linenumber, '_', l_partkey) AS contig, CAST(floor(l_extendedprice) AS BIGINT) AS length,
       l_quantity AS depth, CASE WHEN l_linestatus = 'F' THEN 'circular=true' END AS circular
FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey
"""
_STAGES = """
SELECT concat('U', user_id) AS seq_id, CASE event_type WHEN 'view' THEN 'raw pair' WHEN 'click' THEN 'trimmed pair'
         WHEN 'purchase' THEN 'decontaminated hg37dec_v0.1 pair' WHEN 'error' THEN 'final pair'
         ELSE 'decontaminated mouse_C57BL_6NJ pair' END AS countType, CAST(count(*) AS DOUBLE) AS count
FROM {events} GROUP BY user_id, event_type
"""


def hits(spark, sf) -> DataFrame:
    return _sql(spark, sf, _HITS, "lineitem")


def counts(spark, sf) -> DataFrame:
    return _sql(spark, sf, _COUNTS, "lineitem")


def tax(spark, sf) -> DataFrame:
    return _sql(spark, sf, _TAX, "part")


def samples(spark, sf) -> DataFrame:
    return _sql(spark, sf, _SAMPLES, "supplier")


def contigs(spark, sf) -> DataFrame:
    return _sql(spark, sf, _CONTIGS, "lineitem", "orders")


def stages(spark, sf) -> DataFrame:
    return _sql(spark, sf, _STAGES, "events")


def _duck(text: str, *names: str) -> str:
    for n in names:
        text = text.replace("{" + n + "}", n)
    return text.strip().replace("`", '"')


HITS = f"hits AS ({_duck(_HITS, 'lineitem')})"
COUNTS = f"counts AS ({_duck(_COUNTS, 'lineitem')})"
TAX = f"tax AS ({_duck(_TAX, 'part')})"
SAMPLES = f"samples AS ({_duck(_SAMPLES, 'supplier')})"
CONTIGS = f"contigs AS ({_duck(_CONTIGS, 'lineitem', 'orders')})"
STAGES = f"stages AS ({_duck(_STAGES, 'events')})"


def rounded(df: DataFrame, digits: int = 6, *cols: str) -> DataFrame:
    """Round doubles for comparison; all double columns when none is named."""
    names = cols or [c for c, t in df.dtypes if t == "double"]
    return df.withColumns({c: F.round(c, digits) for c in names})
