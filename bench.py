"""Time the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import time

from florametrics.session import build_session
from florametrics_queries import QUERIES

HEADLINE = [
    "cpm_rpkm", "best_hit", "cascade_top1", "top5_hits", "top3_report", "taxon_counts", "taxon_abundance",
    "abundance_profile_genus", "assign_taxonomy", "length_stats", "nx_lengths", "box_stats", "log_histogram",
    "gene_types", "ko_explode", "survival", "dedup_first", "fill_down_group", "fill_down_global", "library_quality",
    "assembly_verdict", "isolate_report", "harmonise_clinical", "cross_lookup", "read_protein_alignments",
    "fasta_records", "requestor_export", "bray_curtis", "unifrac", "rarefied_counts",
]
WARM_RUNS = 2


def run(fn, spark, sf) -> float:
    start = time.perf_counter()
    fn(spark, sf).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus, spark__ui__enabled="false",
        spark__driver__memory="16g", spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    budget = time.perf_counter() + float(os.environ.get("BENCH_SECONDS", "500"))
    for name in HEADLINE:
        cold = run(QUERIES[name], spark, sf)
        # A slow machine gets fewer warm runs, never fewer queries.
        warm = [run(QUERIES[name], spark, sf) for _ in range(WARM_RUNS) if time.perf_counter() < budget]
        times[name] = round(statistics.median(warm or [cold]), 3)
    print(json.dumps({
        "metric": "total_query_time", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
        "sf": os.path.basename(sf.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
