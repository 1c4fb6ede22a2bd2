"""Summarize a Spark event log: per job, wall time, stages, tasks and the
slowest stage (task time, shuffle read/write). Usage:
    python tests/event_log_summary.py <event-log-file> [top_n]
"""

from __future__ import annotations

import io
import json
import os
import sys
from collections import defaultdict


def _lines(path: str):
    """Event-log lines from a plain file or a rolling (v2) log folder, zstd or not."""
    files = [path]
    if os.path.isdir(path):
        files = sorted(os.path.join(path, f) for f in os.listdir(path) if f.startswith("events_"))
    for name in files:
        if name.endswith(".zstd"):
            import zstandard

            with open(name, "rb") as raw:
                reader = zstandard.ZstdDecompressor().stream_reader(raw, read_across_frames=True)
                yield from io.TextIOWrapper(reader, encoding="utf-8")
        else:
            with open(name, encoding="utf-8") as f:
                yield from f


def summarize(path: str, top_n: int = 15) -> list[dict]:
    jobs: dict[int, dict] = {}
    stages: dict[int, dict] = defaultdict(lambda: {"tasks": 0, "task_ms": 0, "shuffle_read": 0, "shuffle_write": 0})
    for line in _lines(path):
        e = json.loads(line)
        kind = e.get("Event")
        if kind == "SparkListenerJobStart":
            jobs[e["Job ID"]] = {"job": e["Job ID"], "start": e["Submission Time"], "stages": e["Stage IDs"]}
        elif kind == "SparkListenerJobEnd" and e["Job ID"] in jobs:
            jobs[e["Job ID"]]["ms"] = e["Completion Time"] - jobs[e["Job ID"]]["start"]
        elif kind == "SparkListenerTaskEnd":
            st = stages[e["Stage ID"]]
            info, metrics = e.get("Task Info", {}), e.get("Task Metrics") or {}
            st["tasks"] += 1
            st["task_ms"] += info.get("Finish Time", 0) - info.get("Launch Time", 0)
            st["shuffle_read"] += (metrics.get("Shuffle Read Metrics") or {}).get("Remote Bytes Read", 0) + \
                (metrics.get("Shuffle Read Metrics") or {}).get("Local Bytes Read", 0)
            st["shuffle_write"] += (metrics.get("Shuffle Write Metrics") or {}).get("Shuffle Bytes Written", 0)
    out = []
    for j in jobs.values():
        ss = [(s, stages[s]) for s in j["stages"] if s in stages]
        worst = max(ss, key=lambda x: x[1]["task_ms"], default=(None, {}))
        out.append({"job": j["job"], "ms": j.get("ms", 0), "tasks": sum(s["tasks"] for _, s in ss),
                    "task_ms": sum(s["task_ms"] for _, s in ss), "slowest_stage": worst[0], **{
                        k: worst[1].get(k, 0) for k in ("shuffle_read", "shuffle_write")}})
    return sorted(out, key=lambda r: -r["ms"])[:top_n]


if __name__ == "__main__":
    for row in summarize(sys.argv[1], int(sys.argv[2]) if len(sys.argv) > 2 else 15):
        print(row)
