"""Benchmark: run the query catalog on ``$BENCH_SF_DIR`` with ``local[$BENCH_CPUS]``.

Every query is executed in full through the ``noop`` sink (no driver
collect), after one warm-up pass over the same data. Prints one JSON line:
``{"metric": "total_query_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ...}``.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from wordmill.plans.catalog import QUERIES  # noqa: E402
from wordmill.session import build_session  # noqa: E402

# Headline queries first; the rest of the catalog follows.
HEADLINE = ("word_frequency", "top_words", "word_trend", "top_word_series", "trend_matrix", "chunk_text")


def run(spark, name, sf_dir):
    t0 = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    spark = build_session(f"local[{cpus}]", app_name="wordmill-bench", shuffle_partitions=int(cpus) * 2)
    names = only or list(HEADLINE) + [q for q in QUERIES if q not in HEADLINE]
    # Warm-up: JIT and file-system caches, not counted.
    run(spark, "word_frequency", sf_dir)
    times = {}
    for name in names:
        times[name] = round(min(run(spark, name, sf_dir) for _ in range(repeats)), 3)
    spark.stop()
    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {
        "metric": "total_query_sec",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
    }
    print(json.dumps(out))


if __name__ == "__main__":
    main()
