"""Time the headline queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_QUERIES (comma list).
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

HEADLINE = [
    "corpus_aspects", "clean_text", "extract_aspects", "preprocess", "dedup_text", "dedup_id",
    "tokenize", "stem_text", "emoji_demojize", "aspect_sentences", "json_reviews_dedup",
    "html_posts", "link_ids", "flatten_threads", "search_terms_join", "lookup_fallback",
    "keyword_theta_join", "tier_eval", "class_report", "cohen_kappa", "aspect_degradation",
    "degradation_matrix", "variant_comparison", "agreement_report", "finalize_sheet",
    "seeded_shuffle", "stratified_split", "balanced_sample", "eval_pool_scarce", "running_cap",
    "vocabulary", "tfidf", "language_id", "logreg_fit", "svm_fit", "ablation_emoji",
    "ablation_stemming", "analyze_batch",
]


def main() -> None:
    from voxloom.plans import catalogue
    from voxloom.session import local_session

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE
    spark = local_session("voxloom-bench", cores=cpus, shuffle_partitions=int(cpus))
    spark.read.parquet(os.path.join(sf_dir, "labels.parquet")).count()  # start the executors
    seconds = {}
    for name in names:
        start = time.perf_counter()
        catalogue.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    scale = re.search(r"sf([\d.]+)", sf_dir)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3),
        "unit": "sec", "queries": seconds, "sf": float(scale.group(1)) if scale else None}))
    spark.stop()


if __name__ == "__main__":
    main()
