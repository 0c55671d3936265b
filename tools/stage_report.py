"""Summarise a Spark event log: per stage, task count and task-time spread.

Usage: python tools/stage_report.py EVENT_LOG (file or rolling-log folder) [top_n]
Run the job with STRATA_EVENT_LOG_DIR=<scratch folder> to write the log.
A stage whose slowest task takes many times its median task is skewed.
"""

from __future__ import annotations

import io
import json
import os
import statistics
import sys
from collections import defaultdict


def _lines(path: str):
    files = ([os.path.join(path, f) for f in sorted(os.listdir(path)) if f.startswith("events_")]
             if os.path.isdir(path) else [path])
    for f in files:
        if f.endswith(".zstd"):
            import zstandard
            with open(f, "rb") as fh:
                reader = zstandard.ZstdDecompressor().stream_reader(fh)
                yield from io.TextIOWrapper(reader, encoding="utf-8")
        else:
            yield from open(f, encoding="utf-8")


def main() -> None:
    path = sys.argv[1]
    top = int(sys.argv[2]) if len(sys.argv) > 2 else 15
    tasks = defaultdict(list)
    names = {}
    desc = {}
    for line in _lines(path):
        ev = json.loads(line)
        kind = ev.get("Event")
        if kind == "SparkListenerTaskEnd":
            info = ev["Task Info"]
            tasks[ev["Stage ID"]].append(info["Finish Time"] - info["Launch Time"])
        elif kind == "SparkListenerJobStart":
            d = (ev.get("Properties") or {}).get("spark.job.description", "")
            for sid in ev.get("Stage IDs", []):
                desc[sid] = d
        elif kind == "SparkListenerStageCompleted":
            st = ev["Stage Info"]
            names[st["Stage ID"]] = st["Stage Name"].split(" at ")[0]
    rows = []
    for sid, ds in tasks.items():
        med = statistics.median(ds)
        rows.append((sum(ds), sid, len(ds), med, max(ds), max(ds) / med if med else 1.0))
    rows.sort(reverse=True)
    total = sum(r[0] for r in rows)
    print(f"stages={len(rows)} tasks={sum(r[2] for r in rows)} task_ms_total={total}")
    print(f"{'stage':>5} {'tasks':>5} {'sum_ms':>8} {'median':>7} {'max':>6} {'max/med':>7}  name")
    for tot, sid, n, med, mx, ratio in rows[:top]:
        label = desc.get(sid) or names.get(sid, "")
        print(f"{sid:>5} {n:>5} {tot:>8} {med:>7.0f} {mx:>6} {ratio:>7.1f}  {label[:60]}")
    worst = max((r for r in rows if r[2] >= 4), key=lambda r: r[5], default=None)
    if worst:
        print(f"most uneven stage with >=4 tasks: {worst[1]} max/median={worst[5]:.1f} "
              f"({desc.get(worst[1], '')})")


if __name__ == "__main__":
    main()
