"""Benchmark the headline queries.

Runs each query of ``HEADLINE`` on ``$BENCH_SF_DIR`` (default
/root/testdata/sf0.1) with ``local[$BENCH_CPUS]`` and prints one JSON line:
``{"metric", "value", "unit", "queries": {name: sec}, "sf", ...}``.

Each query is executed in full with the ``noop`` sink (no collect to the
driver).  ``value`` is the end-to-end analysis time; throughput in
sentences per second is reported next to it for comparison with the
published single-request figures.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from feedlens.plans.catalog import QUERIES  # noqa: E402
from feedlens.plans.inputs import doc_sentences  # noqa: E402
from feedlens.session import get_spark  # noqa: E402

HEADLINE = [
    "sentence_scores",
    "theme_sentiment",
    "keywords",
    "phrases",
    "insights",
    "theme_report",
    "analysis_pipeline",
    "stream_scores",
    "validation_violations",
    "log_duration_stats",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = get_spark(master=f"local[{cpus}]", shuffle_partitions=cpus * 2)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(m.group(1)) if m else None

    n_sent = doc_sentences(spark, sf_dir).count()      # also warms the JVM
    times = {}
    for name in HEADLINE:
        if name not in QUERIES:
            continue
        t0 = time.time()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t0, 3)
    e2e = times.get("analysis_pipeline") or sum(times.values())
    out = {
        "metric": "analysis_pipeline_seconds",
        "value": round(e2e, 3),
        "unit": "sec",
        "queries": times,
        "sf": sf,
        "sentences": n_sent,
        "sentences_per_sec": round(n_sent / e2e, 1) if e2e else None,
        "total_sec": round(sum(times.values()), 3),
        "cpus": cpus,
    }
    print(json.dumps(out))


if __name__ == "__main__":
    main()
