"""Benchmark: every registered query at $BENCH_SF_DIR on local[$BENCH_CPUS].

1. Map the driver tables onto the catalog and store it as clustered Parquet
   (timed as ``catalog_build``; a deployment keeps its catalog stored).
2. Run each registered query against the stored catalog, executing the whole
   plan with the ``noop`` sink (no driver collect). Each query runs twice;
   the faster (warm) run is reported.

Prints one JSON line. ``value`` is the sum of the per-query seconds.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)


def _run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    from cadenza.plans.registry import registry
    from cadenza.session import build_session
    from cadenza.sources.files import load_catalog, save_catalog
    from cadenza.sources.testdata import from_testdata, read_sources

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeats = int(os.environ.get("BENCH_REPEATS", "2"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    spark = build_session(f"local[{cpus}]", shuffle_partitions=2 * cpus, extra_conf={"spark.driver.memory": "16g"})

    store = os.environ.get("BENCH_CATALOG_DIR") or tempfile.mkdtemp(prefix="cadenza-bench-")
    t0 = time.perf_counter()
    save_catalog(from_testdata(spark, sf_dir), store)
    build_sec = time.perf_counter() - t0
    cat = load_catalog(spark, store).with_sources(read_sources(spark, sf_dir))

    timings: dict[str, float] = {}
    for name, q in registry().items():
        if only and name not in only:
            continue
        best = float("inf")
        for _ in range(max(1, repeats)):
            t = time.perf_counter()
            _run(q.build(cat))
            best = min(best, time.perf_counter() - t)
        timings[name] = round(best, 4)
    sf = os.path.basename(sf_dir).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "sum_query_seconds",
                "value": round(sum(timings.values()), 4),
                "unit": "sec",
                "queries": timings,
                "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
                "catalog_build_sec": round(build_sec, 3),
                "cpus": cpus,
                "repeats": repeats,
            }
        )
    )


if __name__ == "__main__":
    main()
