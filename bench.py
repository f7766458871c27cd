"""Times the headline queries and prints one JSON line.

Every query runs once to warm up and then BENCH_RUNS times (default 1); the median counts. Tables that
queries share (index, intelligence) are timed where they are built, as queries of their own.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from clinisift.session import build_session  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "1"))

QUERIES = [
    "billed_by_specialty", "claims_by_status", "patients_most_appointments", "visit_type_stats", "claims_summary",
    "approval_rate_by_provider", "semantic_query", "semantic_query_multi", "check_constraints", "profile_dimensions",
    "append_files_log", "dedup_arrivals", "parse_text", "parse_layout", "assemble_transcript", "extract_fields", "classify",
    "sentiment_score", "detect_language", "translate_if_needed", "redact", "summarize", "key_insights", "summarize_agg", "embed",
    "similarity_pairs", "similarity_candidates", "nearest_neighbors", "batch_infer", "search_lexical", "search_vector",
    "search_hybrid", "search_batch", "search_filtered", "search_filtered_hybrid", "search_federated", "refresh_index", "combined_insights", "resolve_patient", "visit_recording_link", "patient_360",
]


def noop(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    spark = build_session(f"local[{CPUS}]", "bench", **{
        "spark.sql.shuffle.partitions": CPUS, "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "12g", "spark.driver.bindAddress": "127.0.0.1", "spark.driver.host": "127.0.0.1"})
    spark.sparkContext.setLogLevel("OFF")
    from clinisift.operators import retrieval as R
    from driver_queries import ALL_QUERIES, shared
    from driver_queries.enrichment import docs

    jobs = {
        "enrich_txt": lambda: noop(shared.enriched(spark, SF_DIR, "TXT")),
        "enrich_pdf": lambda: noop(shared.enriched(spark, SF_DIR, "PDF")),
        "enrich_audio": lambda: noop(shared.enriched(spark, SF_DIR, "AUDIO")),
        "build_index": lambda: R.build_index(docs(spark, SF_DIR)),
        **{q: (lambda q=q: noop(ALL_QUERIES[q](spark, SF_DIR))) for q in QUERIES},
    }
    only = sys.argv[1:]
    times = {}
    for name, job in jobs.items():
        if only and name not in only:
            continue
        spent = []
        for i in range(RUNS + 1):
            t = time.perf_counter()
            job()
            if i:
                spent.append(time.perf_counter() - t)
        times[name] = round(statistics.median(spent), 3)
        print(f"{name}: {times[name]}", file=sys.stderr, flush=True)
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
                      "sf": os.path.basename(SF_DIR.rstrip("/")).replace("sf", "")}))
    spark.stop()


if __name__ == "__main__":
    main()
