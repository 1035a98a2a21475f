"""Summarise a Spark event log: jobs, stages and task time per job.

usage: python scripts/stage_times.py <event log folder or file> [top]
"""

from __future__ import annotations

import glob
import json
import os
import sys
from collections import defaultdict


def events(path):
    files = [path] if os.path.isfile(path) else sorted(glob.glob(os.path.join(path, "**", "*"), recursive=True))
    for f in files:
        if not os.path.isfile(f):
            continue
        if f.endswith(".zstd"):
            import io

            import zstandard

            with open(f, "rb") as raw:
                fh = io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(raw), encoding="utf-8")
                lines = fh.read().splitlines()
        else:
            with open(f, encoding="utf-8", errors="replace") as fh:
                lines = fh.read().splitlines()
        for line in lines:
            try:
                yield json.loads(line)
            except ValueError:
                continue


def main():
    path = sys.argv[1]
    top = int(sys.argv[2]) if len(sys.argv) > 2 else 15
    job_start, job_end, job_stages, stage_tasks, task_ms = {}, {}, {}, defaultdict(int), defaultdict(int)
    stage_job = {}
    for e in events(path):
        kind = e.get("Event")
        if kind == "SparkListenerJobStart":
            jid = e["Job ID"]
            job_start[jid] = e["Submission Time"]
            job_stages[jid] = e.get("Stage IDs", [])
            for s in job_stages[jid]:
                stage_job[s] = jid
        elif kind == "SparkListenerJobEnd":
            job_end[e["Job ID"]] = e["Completion Time"]
        elif kind == "SparkListenerTaskEnd":
            sid = e["Stage ID"]
            info = e.get("Task Info", {})
            stage_tasks[sid] += 1
            task_ms[sid] += info.get("Finish Time", 0) - info.get("Launch Time", 0)
    rows = []
    for jid, t0 in job_start.items():
        stages = [s for s in job_stages[jid] if stage_tasks.get(s)]
        rows.append((job_end.get(jid, t0) - t0, jid, len(stages),
                     sum(stage_tasks[s] for s in stages), sum(task_ms[s] for s in stages)))
    wall = sum(r[0] for r in rows)
    print(f"jobs {len(rows)}, wall ms {wall}, stages run {sum(r[2] for r in rows)}, "
          f"tasks {sum(r[3] for r in rows)}, task ms {sum(r[4] for r in rows)}")
    for r in sorted(rows, reverse=True)[:top]:
        print(f"job {r[1]:5d}: {r[0]:7d} ms wall, {r[2]:3d} stages, {r[3]:5d} tasks, {r[4]:8d} task ms")


if __name__ == "__main__":
    main()
