"""Run the pipeline with Spark's event log on and summarise every stage.

Usage: python scripts/stage_report.py [sf_dir]  |  --log <event log file or folder>
Prints one line per stage: tasks, wall time, input, shuffle read/write, spill.
The event log goes to a fresh folder under /tmp (a local run only).
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def mb(n: int) -> str:
    return f"{n / 1e6:8.1f}"


def _lines(path: str):
    if path.endswith(".zstd"):
        import io

        import zstandard

        with open(path, "rb") as raw:
            yield from io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(raw), encoding="utf-8")
    else:
        yield from open(path, encoding="utf-8")


def events(log_path: str):
    files = sorted(glob.glob(os.path.join(log_path, "*"))) if os.path.isdir(log_path) else [log_path]
    for f in files:
        if os.path.basename(f).startswith("events_") or not os.path.isdir(log_path):
            for line in _lines(f):
                yield json.loads(line)


def summarise(log_path: str) -> None:
    stages: dict[int, dict] = {}
    for ev in events(log_path):
        kind = ev.get("Event")
        if kind == "SparkListenerTaskEnd":
            sid = ev["Stage ID"]
            m = ev.get("Task Metrics") or {}
            s = stages.setdefault(sid, dict(tasks=0, input=0, sr=0, sw=0, spill=0, name="", ms=0))
            s["tasks"] += 1
            s["input"] += (m.get("Input Metrics") or {}).get("Bytes Read", 0)
            sr = m.get("Shuffle Read Metrics") or {}
            s["sr"] += sr.get("Remote Bytes Read", 0) + sr.get("Local Bytes Read", 0)
            s["sw"] += (m.get("Shuffle Write Metrics") or {}).get("Shuffle Bytes Written", 0)
            s["spill"] += m.get("Disk Bytes Spilled", 0)
        elif kind == "SparkListenerStageCompleted":
            info = ev["Stage Info"]
            s = stages.setdefault(info["Stage ID"], dict(tasks=0, input=0, sr=0, sw=0, spill=0, name="", ms=0))
            s["name"] = info["Stage Name"][:60]
            if info.get("Completion Time") and info.get("Submission Time"):
                s["ms"] = info["Completion Time"] - info["Submission Time"]
    print(f"{'stage':>5} {'tasks':>5} {'ms':>6} {'in MB':>8} {'shufR MB':>8} {'shufW MB':>8} {'spill MB':>8}  name")
    for sid in sorted(stages):
        s = stages[sid]
        print(f"{sid:5d} {s['tasks']:5d} {s['ms']:6d} {mb(s['input'])} {mb(s['sr'])} {mb(s['sw'])} {mb(s['spill'])}  {s['name']}")


def main() -> None:
    if len(sys.argv) > 2 and sys.argv[1] == "--log":
        summarise(sys.argv[2])
        return
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    log_dir = tempfile.mkdtemp(prefix="run-eventlog-")
    from pyspark.sql import SparkSession

    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.eventLog.enabled", "true")
        .config("spark.eventLog.dir", "file://" + log_dir)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    import bench

    t0 = time.time()
    print(json.dumps(bench.pipeline_stages(spark, sf_dir)), f"{time.time() - t0:.1f}s")
    spark.stop()
    for path in glob.glob(os.path.join(log_dir, "*")):
        summarise(path)  # a rolling event log is a folder of events_* files


if __name__ == "__main__":
    main()
