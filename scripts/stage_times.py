"""Stage and task times from a Spark event log (no UI needed).

    BENCH_EVENT_LOG_DIR=$(mktemp -d /tmp/run-XXXXXX) python bench.py
    python scripts/stage_times.py <that dir> [top_n]

Prints the slowest stages: duration, task count, summed task time, shuffle
read/write bytes, and the job description they belong to.
"""

from __future__ import annotations

import glob
import json
import os
import sys


def _lines(path: str):
    if path.endswith(".zstd"):
        import io

        import zstandard

        with open(path, "rb") as raw:
            yield from io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(raw), encoding="utf-8")
    else:
        with open(path, encoding="utf-8") as fh:
            yield from fh


def _events(paths):
    for path in paths:
        for line in _lines(path):
            line = line.strip()
            if line:
                yield json.loads(line)


def _log_files(folder: str) -> list[str]:
    """The newest application's log: a plain file, or the parts of a rolling
    ``eventlog_v2_*`` folder in order."""
    apps = sorted((os.path.getmtime(p), p) for p in glob.glob(os.path.join(folder, "*")))
    if not apps:
        return []
    newest = apps[-1][1]
    if os.path.isdir(newest):
        parts = glob.glob(os.path.join(newest, "events_*"))
        return sorted(parts, key=lambda p: int(os.path.basename(p).split("_")[1]))
    return [newest]


def main() -> None:
    folder = sys.argv[1]
    top = int(sys.argv[2]) if len(sys.argv) > 2 else 20
    logs = _log_files(folder)
    if not logs:
        sys.exit(f"no event log in {folder}")
    stages: dict[tuple[int, int], dict] = {}
    job_desc: dict[int, str] = {}
    stage_job: dict[int, int] = {}
    for ev in _events(logs):
        kind = ev.get("Event")
        if kind == "SparkListenerJobStart":
            props = ev.get("Properties") or {}
            job_desc[ev["Job ID"]] = (props.get("spark.job.description") or props.get("callSite.short") or "")[:60]
            for sid in ev.get("Stage IDs", []):
                stage_job[sid] = ev["Job ID"]
        elif kind == "SparkListenerTaskEnd":
            info, metrics = ev.get("Task Info", {}), ev.get("Task Metrics") or {}
            key = (ev["Stage ID"], ev["Stage Attempt ID"])
            st = stages.setdefault(key, {"tasks": 0, "task_ms": 0, "shuffle_read": 0, "shuffle_write": 0})
            st["tasks"] += 1
            st["task_ms"] += info.get("Finish Time", 0) - info.get("Launch Time", 0)
            sr = metrics.get("Shuffle Read Metrics") or {}
            st["shuffle_read"] += sr.get("Remote Bytes Read", 0) + sr.get("Local Bytes Read", 0)
            st["shuffle_write"] += (metrics.get("Shuffle Write Metrics") or {}).get("Shuffle Bytes Written", 0)
        elif kind == "SparkListenerStageCompleted":
            info = ev["Stage Info"]
            key = (info["Stage ID"], info["Stage Attempt ID"])
            st = stages.setdefault(key, {"tasks": 0, "task_ms": 0, "shuffle_read": 0, "shuffle_write": 0})
            st["ms"] = info.get("Completion Time", 0) - info.get("Submission Time", 0)
            st["name"] = info.get("Stage Name", "")[:50]
    rows = sorted(((v.get("ms", 0), k, v) for k, v in stages.items()), reverse=True)[:top]
    print(f"{'stage':>8} {'ms':>7} {'tasks':>5} {'task_ms':>8} {'shuf_rd':>10} {'shuf_wr':>10}  job")
    for ms, (sid, att), v in rows:
        job = stage_job.get(sid)
        print(
            f"{sid:>5}.{att:<2} {ms:>7} {v['tasks']:>5} {v['task_ms']:>8} {v['shuffle_read']:>10} "
            f"{v['shuffle_write']:>10}  {job_desc.get(job, '')} | {v.get('name', '')}"
        )


if __name__ == "__main__":
    main()
