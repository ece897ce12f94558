"""Per-query stage/task summary from a Spark event log (bench.py BENCH_EVENT_LOG).

    python tools/eventlog_summary.py <event-log-folder-or-file>

For each job description (query name): jobs, stages, tasks, summed task run
time, shuffle write/read bytes, spill bytes, and the worst stage's skew
(max task time / median task time, over stages with >= 4 tasks).
"""

from __future__ import annotations

import io
import json
import statistics
import sys
from collections import defaultdict
from pathlib import Path


def events(path: Path):
    """Events of a log file or folder (rolling ``eventlog_v2_*`` folders and
    zstd-compressed files included)."""
    files = sorted(p for p in path.rglob("*") if p.is_file()) if path.is_dir() else [path]
    for f in files:
        if f.name.startswith(".") or f.name.startswith("appstatus") or f.stat().st_size == 0:
            continue
        if f.suffix == ".zstd":
            import zstandard

            with open(f, "rb") as raw:
                text = io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(raw), encoding="utf-8")
                for line in text:
                    yield json.loads(line)
        elif f.suffix in ("", ".inprogress", ".json"):
            with open(f, encoding="utf-8") as fh:
                for line in fh:
                    yield json.loads(line)


def main() -> None:
    path = Path(sys.argv[1])
    stage_query: dict[int, str] = {}
    job_query: dict[int, str] = {}
    stats = defaultdict(lambda: defaultdict(float))
    task_times = defaultdict(list)
    for e in events(path):
        kind = e.get("Event")
        if kind == "SparkListenerJobStart":
            q = (e.get("Properties") or {}).get("spark.job.description") or "(none)"
            job_query[e["Job ID"]] = q
            stats[q]["jobs"] += 1
            for sid in e.get("Stage IDs", []):
                stage_query[sid] = q
        elif kind == "SparkListenerStageCompleted":
            info = e["Stage Info"]
            q = stage_query.get(info["Stage ID"], "(none)")
            if "Completion Time" in info and "Submission Time" in info:
                stats[q]["stages"] += 1
        elif kind == "SparkListenerTaskEnd":
            q = stage_query.get(e["Stage ID"], "(none)")
            m = e.get("Task Metrics") or {}
            s = stats[q]
            s["tasks"] += 1
            s["run_ms"] += m.get("Executor Run Time", 0)
            s["shuffle_write"] += (m.get("Shuffle Write Metrics") or {}).get("Shuffle Bytes Written", 0)
            r = m.get("Shuffle Read Metrics") or {}
            s["shuffle_read"] += r.get("Remote Bytes Read", 0) + r.get("Local Bytes Read", 0)
            s["spill"] += m.get("Memory Bytes Spilled", 0) + m.get("Disk Bytes Spilled", 0)
            task_times[(q, e["Stage ID"])].append(m.get("Executor Run Time", 0))
    skew = defaultdict(float)
    for (q, _), times in task_times.items():
        if len(times) >= 4:
            med = statistics.median(times) or 1
            skew[q] = max(skew[q], max(times) / med)
    print("| Query | Jobs | Stages | Tasks | Task time (s) | Shuffle write (MB) | Shuffle read (MB) | Spill (MB) | Max skew |")
    print("|---|---|---|---|---|---|---|---|---|")
    for q in sorted(stats):
        s = stats[q]
        print(f"| {q} | {int(s['jobs'])} | {int(s['stages'])} | {int(s['tasks'])} | {s['run_ms'] / 1000:.2f} | "
              f"{s['shuffle_write'] / 1e6:.2f} | {s['shuffle_read'] / 1e6:.2f} | {s['spill'] / 1e6:.2f} | "
              f"{skew[q]:.1f} |")


if __name__ == "__main__":
    main()
