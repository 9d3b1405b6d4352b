"""Per-stage task statistics from a Spark event log (file or eventlog_v2 folder).

    python tools/tasktimes.py <event log path>

Prints, per stage with shuffle input, task count and the max/median task
time and shuffle records read: a max far above the median is skew.
"""

from __future__ import annotations

import collections
import glob
import json
import os
import statistics
import sys


def _lines(f: str):
    if f.endswith(".zstd"):
        import io

        import zstandard
        with open(f, "rb") as raw:
            text = io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(raw), "utf-8")
            yield from text
    else:
        with open(f) as fh:
            yield from fh


def events(path: str):
    files = sorted(glob.glob(os.path.join(path, "events_*"))) if os.path.isdir(path) else [path]
    for f in files:
        for line in _lines(f):
            if line.strip():
                yield json.loads(line)


def main() -> None:
    stages = collections.defaultdict(list)
    names = {}
    for e in events(sys.argv[1]):
        if e["Event"] == "SparkListenerTaskEnd":
            m = e.get("Task Metrics") or {}
            recs = (m.get("Shuffle Read Metrics") or {}).get("Total Records Read", 0)
            info = e["Task Info"]
            stages[e["Stage ID"]].append((info["Finish Time"] - info["Launch Time"], recs))
        elif e["Event"] == "SparkListenerStageCompleted":
            names[e["Stage Info"]["Stage ID"]] = e["Stage Info"]["Stage Name"].split(" at ")[0]
    for sid, ts in sorted(stages.items()):
        d = [t for t, _ in ts]
        r = [x for _, x in ts]
        if max(r) == 0:
            continue
        print(f"stage {sid:>3} {names.get(sid, ''):<12} tasks {len(ts):>4}  "
              f"ms max/median {max(d):>6}/{int(statistics.median(d)):<6} "
              f"shuffle records max/median {max(r):>9}/{int(statistics.median(r))}")


if __name__ == "__main__":
    main()
