"""Per-query stage summary from a Spark event log written by bench.py.

    BENCH_EVENT_LOG=$(mktemp -d /tmp/run-XXXXXX) python bench.py
    python tools/stage_times.py <that folder>/<app id> [top]

Jobs are attributed to queries by their job description (bench.py sets it to
the query name). For each query: job count, stage count, summed stage time,
tasks, shuffle bytes written and read; then its slowest stages.
"""

from __future__ import annotations

import json
import sys
from collections import defaultdict


def _lines(path: str):
    """Event-log lines from one file or a rolling event-log folder."""
    import os
    files = [path] if os.path.isfile(path) else sorted(
        (os.path.join(path, n) for n in os.listdir(path) if n.startswith("events_")),
        key=lambda p: int(os.path.basename(p).split("_")[1]))
    for fp in files:
        opener = open
        if fp.endswith(".zstd"):
            import io
            import zstandard
            with open(fp, "rb") as raw:
                data = zstandard.ZstdDecompressor().stream_reader(raw).read()
            yield from io.StringIO(data.decode()).readlines()
            continue
        with opener(fp) as f:
            yield from f


def main() -> None:
    path = sys.argv[1]
    top = int(sys.argv[2]) if len(sys.argv) > 2 else 3
    stage_query: dict[int, str] = {}
    jobs: dict[str, int] = defaultdict(int)
    stages: dict[str, list] = defaultdict(list)
    for line in _lines(path):
        e = json.loads(line)
        ev = e.get("Event")
        if ev == "SparkListenerJobStart":
            q = (e.get("Properties") or {}).get("spark.job.description", "?")
            jobs[q] += 1
            for sid in e.get("Stage IDs", []):
                stage_query[sid] = q
        elif ev == "SparkListenerStageCompleted":
            info = e["Stage Info"]
            sid = info["Stage ID"]
            dur = (info.get("Completion Time", 0) - info.get("Submission Time", 0)) / 1000.0
            acc = {a.get("Name"): a.get("Value") for a in info.get("Accumulables", [])}
            stages[stage_query.get(sid, "?")].append({
                "stage": sid, "name": info.get("Stage Name", "")[:60], "sec": round(dur, 3),
                "tasks": info.get("Number of Tasks"),
                "shuffle_write": int(acc.get("internal.metrics.shuffle.write.bytesWritten", 0) or 0),
                "shuffle_read": int(acc.get("internal.metrics.shuffle.read.remoteBytesRead", 0) or 0)
                + int(acc.get("internal.metrics.shuffle.read.localBytesRead", 0) or 0)})
    rows = sorted(stages.items(), key=lambda kv: -sum(s["sec"] for s in kv[1]))
    for q, ss in rows:
        print(f"{q}: jobs={jobs[q]} stages={len(ss)} stage_sec={sum(s['sec'] for s in ss):.2f} "
              f"tasks={sum(s['tasks'] or 0 for s in ss)} "
              f"shuffle_write={sum(s['shuffle_write'] for s in ss)} shuffle_read={sum(s['shuffle_read'] for s in ss)}")
        for s in sorted(ss, key=lambda s: -s["sec"])[:top]:
            print(f"    stage {s['stage']}: {s['sec']}s tasks={s['tasks']} "
                  f"write={s['shuffle_write']} read={s['shuffle_read']} {s['name']}")


if __name__ == "__main__":
    main()
