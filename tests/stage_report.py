"""Summarize a Spark event log written by ``BENCH_EVENT_LOG=<folder> python bench.py``:
number of jobs, stages and tasks, and the slowest stages.

Usage: python tests/stage_report.py <event-log folder> [top]"""

from __future__ import annotations

import collections
import glob
import io
import json
import os
import sys


def events(folder: str):
    for path in sorted(glob.glob(os.path.join(folder, "**", "events_*"), recursive=True)
                       + glob.glob(os.path.join(folder, "**", "*.inprogress"), recursive=True)):
        with open(path, "rb") as fh:
            if path.endswith(".zstd"):
                import zstandard
                stream = io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(fh), encoding="utf-8")
            else:
                stream = io.TextIOWrapper(fh, encoding="utf-8")
            for line in stream:
                try:
                    yield json.loads(line)
                except ValueError:
                    continue


def main() -> None:
    folder, top = sys.argv[1], int(sys.argv[2]) if len(sys.argv) > 2 else 15
    stages, busy = {}, collections.Counter()
    jobs = 0
    stage_label: dict[int, str] = {}
    for e in events(folder):
        kind = e.get("Event")
        if kind == "SparkListenerJobStart":
            jobs += 1
            label = (e.get("Properties") or {}).get("spark.job.description", "-")
            for sid in e.get("Stage IDs", []):
                stage_label[sid] = label
        elif kind == "SparkListenerStageCompleted":
            info = e["Stage Info"]
            if "Submission Time" in info and "Completion Time" in info:
                stages[info["Stage ID"]] = (info["Stage Name"][:70],
                                            (info["Completion Time"] - info["Submission Time"]) / 1000,
                                            info["Number of Tasks"])
        elif kind == "SparkListenerTaskEnd":
            busy[e["Stage ID"]] += (e["Task Info"]["Finish Time"] - e["Task Info"]["Launch Time"]) / 1000
    print(f"jobs {jobs}  stages {len(stages)}  task seconds {sum(busy.values()):.1f}")
    per_label = collections.defaultdict(lambda: [0, 0.0])
    for sid, secs in busy.items():
        per_label[stage_label.get(sid, "-")][0] += 1
        per_label[stage_label.get(sid, "-")][1] += secs
    print("task seconds by job description (query):")
    for label, (n, secs) in sorted(per_label.items(), key=lambda kv: -kv[1][1])[:top]:
        print(f"  {label:32s} stages {n:4d}  task seconds {secs:7.2f}")
    for sid, (name, wall, tasks) in sorted(stages.items(), key=lambda kv: -kv[1][1])[:top]:
        print(f"stage {sid:5d}  wall {wall:6.2f}s  tasks {tasks:4d}  busy {busy[sid]:6.2f}s  {name}")


if __name__ == "__main__":
    main()
