"""Times the headline queries; prints one JSON line.

Each query runs twice and the second run counts, so that JVM start and code generation
are not measured. Results are consumed in full by the no-op sink.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from loglake import registry  # noqa: E402
from loglake.session import build_session, job  # noqa: E402

HEADLINES = (
    "parse_logs", "parse_stats", "clean_logs", "processed_projection", "enrich_logs", "aggregate_all",
    "duration_stats", "record_features", "feature_summary", "window_features", "iforest_scores",
    "tfidf", "svd_components", "kmeans_patterns", "dbscan_patterns", "cluster_terms", "top_keywords", "ngrams", "severity_counts", "nlp_insights",
    "report_sections",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "loglake-bench",
        f"local[{cpus}]",
        **{
            "spark.ui.enabled": "false",
            "spark.sql.shuffle.partitions": cpus,
            "spark.checkpoint.dir": os.environ.get("BENCH_SHARED_DIR") or tempfile.mkdtemp(prefix="loglake-bench-"),
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = registry.queries()
    seconds: dict[str, float] = {}
    for name in sys.argv[1:] or HEADLINES:
        for _ in range(2):
            start = time.perf_counter()
            with job(spark):
                queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.perf_counter() - start, 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "headline queries, second run, total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
