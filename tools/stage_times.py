"""Summarise stage durations from a Spark event log (no UI needed).

usage: python tools/stage_times.py <event-log-file-or-folder> [top_n]
"""

import glob
import io
import json
import os
import sys


def lines(path):
    """Event-log lines from a file or a rolling event-log folder (zstd or plain)."""
    files = sorted(glob.glob(os.path.join(path, "events_*"))) if os.path.isdir(path) else [path]
    for f in files:
        if f.endswith(".zstd"):
            import zstandard
            with open(f, "rb") as fh:
                data = zstandard.ZstdDecompressor().stream_reader(fh)
                yield from io.TextIOWrapper(data, encoding="utf-8")
        else:
            with open(f) as fh:
                yield from fh


def main():
    path = sys.argv[1]
    top = int(sys.argv[2]) if len(sys.argv) > 2 else 25
    stages, jobs, stage_group = [], {}, {}
    if True:
        for line in lines(path):
            ev = json.loads(line)
            kind = ev.get("Event")
            if kind == "SparkListenerStageCompleted":
                info = ev["Stage Info"]
                dur = (info.get("Completion Time", 0) - info.get("Submission Time", 0)) / 1000
                stages.append((dur, info["Stage ID"], info["Number of Tasks"], info["Stage Name"][:90]))
            elif kind == "SparkListenerJobStart":
                props = ev.get("Properties") or {}
                jobs[ev["Job ID"]] = props.get("spark.jobGroup.id", "")
                for sid in ev.get("Stage IDs", []):
                    stage_group[sid] = jobs[ev["Job ID"]]
    total = sum(s[0] for s in stages)
    print(f"stages={len(stages)} jobs={len(jobs)} sum_stage_sec={total:.1f}")
    groups = {}
    for dur, sid, _, _ in stages:
        g = stage_group.get(sid, "")
        groups[g] = groups.get(g, 0.0) + dur
    for g, d in sorted(groups.items(), key=lambda x: -x[1]):
        print(f"group {g or '-':20s} stage_sec={d:7.1f}")
    for dur, sid, ntasks, name in sorted(stages, reverse=True)[:top]:
        print(f"{dur:7.2f}s stage={sid:4d} tasks={ntasks:4d} [{stage_group.get(sid, '')}] {name}")


if __name__ == "__main__":
    main()
