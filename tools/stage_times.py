"""Summarise a Spark event log: wall time per job group and the slowest stages.

usage: python tools/stage_times.py <event-log-file>
"""

import json
import os
import sys
from collections import defaultdict


def lines(path):
    """Event-log lines from a file or a rolling (v2) event-log directory."""
    files = [path] if os.path.isfile(path) else sorted(
        os.path.join(path, f) for f in os.listdir(path) if f.startswith("events"))
    for f in files:
        if f.endswith(".zstd"):
            import io

            import zstandard
            with open(f, "rb") as raw:
                yield from io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(raw), encoding="utf-8")
        else:
            yield from open(f, encoding="utf-8")


def main():
    jobs, stages, group_of_job, stage_group = {}, {}, {}, {}
    for line in lines(sys.argv[1]):
        e = json.loads(line)
        ev = e.get("Event")
        if ev == "SparkListenerJobStart":
            props = e.get("Properties") or {}
            group_of_job[e["Job ID"]] = props.get("spark.jobGroup.id", "-")
            jobs[e["Job ID"]] = [e["Submission Time"], None]
            for sid in e.get("Stage IDs", []):
                stage_group[sid] = group_of_job[e["Job ID"]]
        elif ev == "SparkListenerJobEnd":
            jobs[e["Job ID"]][1] = e["Completion Time"]
        elif ev == "SparkListenerStageCompleted":
            info = e["Stage Info"]
            stages[info["Stage ID"]] = (info.get("Completion Time", 0) - info.get("Submission Time", 0),
                                        info["Number of Tasks"], info["Stage Name"][:70])
    per_group = defaultdict(lambda: [0, 0])
    for jid, (start, end) in jobs.items():
        g = per_group[group_of_job.get(jid, "-")]
        g[0] += (end or start) - start
        g[1] += 1
    print("group                       jobs   job-time(s)")
    for g, (ms, n) in sorted(per_group.items(), key=lambda kv: -kv[1][0]):
        print(f"{g:28s} {n:4d} {ms / 1000:10.2f}")
    print("\nslowest stages (ms, tasks, group, name)")
    for sid, (ms, n, name) in sorted(stages.items(), key=lambda kv: -kv[1][0])[:15]:
        print(f"{ms:8d} {n:5d}  {stage_group.get(sid, '-'):22s} {name}")


if __name__ == "__main__":
    main()
