"""Time the headline queries; prints one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_QUERIES (optional comma list), BENCH_REPEAT (default 2, best of N for
the catalogue queries; the pipeline stages run once after a warm-up run).
Each query is forced with a ``noop`` write, so the whole plan runs and nothing
is collected to the driver.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

# Headline queries: the mart, the row-level join chain, the biggest and the
# widest refinement, the archive round trip, link extraction and selection.
HEADLINE = [
    "active_by_activity_state",
    "left_join_chain",
    "refine_socios",
    "refine_estabelecimentos",
    "landed_roundtrip",
    "zip_members",
    "link_extract",
    "select_files",
    "landing_manifest",
    "gate_required",
]


def pipeline_stages(spark, sf_dir: str) -> dict[str, float]:
    """The production path: archives -> land -> refine (10 tables, gated, parquet) -> mart.

    Writing the archives is setup and is not timed.
    """
    from terrace import adapters as A
    from terrace.plans import pipeline as P
    from terrace.queries import REFERENCE_DATE
    from terrace.session import fresh_dir

    pages = A.build_archive_site(spark, sf_dir, fresh_dir(spark, "bench-site"), parts=4)
    root = fresh_dir(spark, "bench-lake")
    layout = P.Layout(f"{root}/landed", f"{root}/refined", f"{root}/mart")
    out: dict[str, float] = {}
    t0 = time.perf_counter()
    selected = P.select_archives(spark, pages, REFERENCE_DATE, max_files=10)
    P.land_archives(spark, selected, layout, REFERENCE_DATE).collect()
    out["pipeline_land"] = round(time.perf_counter() - t0, 3)
    t0 = time.perf_counter()
    P.refine_all(spark, layout, REFERENCE_DATE)
    out["pipeline_refine_all"] = round(time.perf_counter() - t0, 3)
    t0 = time.perf_counter()
    P.build_mart(spark, layout, REFERENCE_DATE)
    out["pipeline_mart"] = round(time.perf_counter() - t0, 3)
    return out


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeat = int(os.environ.get("BENCH_REPEAT", "2"))
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE

    from terrace.queries import QUERIES
    from terrace.session import local_session

    spark = local_session(cores=cpus, shuffle_partitions=max(8, int(cpus)))
    spark.sparkContext.setLogLevel("ERROR")
    # warm-up: JVM, Python workers and file listing are not part of a query's time
    spark.read.parquet(f"{sf_dir}/nation.parquet").write.format("noop").mode("overwrite").save()

    times: dict[str, float] = {}
    if os.environ.get("BENCH_PIPELINE", "1") == "1" and not os.environ.get("BENCH_QUERIES"):
        warm_dir = os.path.join(os.path.dirname(sf_dir), "sf0.001")
        if os.path.isdir(warm_dir):  # untimed warm-up run of the same code on the smallest tables
            pipeline_stages(spark, warm_dir)
        times.update(pipeline_stages(spark, sf_dir))
    for name in names:
        best = None
        for _ in range(repeat):
            t0 = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            dt = time.perf_counter() - t0
            best = dt if best is None else min(best, dt)
        times[name] = round(best, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(m.group(1)) if m else sf_dir,
                "cpus": int(cpus),
                "repeat": repeat,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
