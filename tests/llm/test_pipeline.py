"""The pipeline's stages and the registered queries on the smallest tables."""

import corpus_pipeline
from florametrics.llm import queries  # noqa: F401  (importing registers)
from florametrics.llm.registry import ORACLES, QUERIES
from tests.compare import connect, difference, duck_rows, spark_rows
from tests.llm.test_operators import check_packing, groups

SF = "/root/testdata/sf0.001"


def test_checked_queries(spark):
    con = connect(SF)
    for name, sql in ORACLES.items():
        assert difference(spark_rows(QUERIES[name](spark, SF)), duck_rows(con, sql)) is None


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names, kept = docs.columns, []
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(f"{tmp_path}/{i}")
        before, docs = docs, spark.read.parquet(f"{tmp_path}/{i}")
        if i < 4:
            assert docs.columns == names and docs.select("doc_id").subtract(before.select("doc_id")).count() == 0
            kept.append(docs.count())
        if name == "MinHash near-dedup":
            rows = [(r["doc_id"], r["text"]) for r in before.collect()]
            assert {r["doc_id"] for r in docs.collect()} == {i for i, g in groups(rows, 5, 80).items() if g[2]}
    assert kept == sorted(kept, reverse=True) and kept[0] < 200
    check_packing([(r["doc_id"], r["text"]) for r in before.collect()], docs.collect(), 1024)
