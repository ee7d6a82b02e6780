"""Summarise a Spark event log: per-job stage count, time, tasks, shuffle bytes and spill.

usage: python scripts/stage_report.py EVENT_LOG_FILE_OR_DIR

Reads the JSON-lines event log Spark writes with ``spark.eventLog.enabled``
(``BENCH_EVENT_LOG=<folder> python bench.py``); no UI or REST endpoint is used.
"""

from __future__ import annotations

import json
import os
import sys
from collections import defaultdict

METRICS = {
    "internal.metrics.shuffle.write.bytesWritten": "shuffle_write",
    "internal.metrics.shuffle.read.remoteBytesRead": "shuffle_read_remote",
    "internal.metrics.shuffle.read.localBytesRead": "shuffle_read_local",
    "internal.metrics.memoryBytesSpilled": "spill_memory",
    "internal.metrics.diskBytesSpilled": "spill_disk",
    "internal.metrics.input.bytesRead": "input",
}


def _files(path: str) -> list[str]:
    if os.path.isdir(path):
        out = []
        for root, _, names in os.walk(path):
            out += [os.path.join(root, n) for n in names if not n.startswith(".")]
        return sorted(out)
    return [path]


def _lines(path: str):
    """Lines of a plain or zstd-compressed (Spark's default codec) event log file."""
    with open(path, "rb") as fh:
        head = fh.read(4)
    if head == b"\x28\xb5\x2f\xfd":
        import io

        import zstandard
        with open(path, "rb") as fh:
            reader = zstandard.ZstdDecompressor().stream_reader(fh, read_across_frames=True)
            yield from io.TextIOWrapper(reader, encoding="utf-8")
    else:
        with open(path, encoding="utf-8") as fh:
            yield from fh


def summarise(path: str) -> dict:
    stage_job: dict[int, int] = {}
    job_desc: dict[int, str] = {}
    jobs = defaultdict(lambda: defaultdict(float))
    for f in _files(path):
        for line in _lines(f):
            ev = json.loads(line)
            kind = ev.get("Event")
            if kind == "SparkListenerJobStart":
                jid = ev["Job ID"]
                props = ev.get("Properties") or {}
                job_desc[jid] = (props.get("spark.job.description")
                                 or props.get("callSite.short") or "")
                for sid in ev.get("Stage IDs", []):
                    stage_job[sid] = jid
            elif kind == "SparkListenerStageCompleted":
                info = ev["Stage Info"]
                jid = stage_job.get(info["Stage ID"], -1)
                j = jobs[jid]
                j["stages"] += 1
                j["tasks"] += info.get("Number of Tasks", 0)
                if info.get("Submission Time") and info.get("Completion Time"):
                    j["stage_ms"] += info["Completion Time"] - info["Submission Time"]
                for acc in info.get("Accumulables", []):
                    name = METRICS.get(acc.get("Name"))
                    if name:
                        j[name] += float(acc.get("Value", 0))
    total = defaultdict(float)
    by_desc = defaultdict(lambda: defaultdict(float))
    for jid, j in jobs.items():
        d = by_desc[job_desc.get(jid, "")[:40]]
        d["jobs"] += 1
        for k, v in j.items():
            total[k] += v
            d[k] += v
    return {"jobs": len(jobs), "total": dict(total),
            "by_description": {k: dict(v) for k, v in by_desc.items()},
            "top_jobs_by_stage_time": sorted(
                ({"job": jid, "desc": job_desc.get(jid, "")[:80], **dict(v)}
                 for jid, v in jobs.items()),
                key=lambda r: -r.get("stage_ms", 0))[:10]}


def main() -> None:
    rep = summarise(sys.argv[1])
    t = rep["total"]
    mb = 1024 * 1024
    print(f"jobs={rep['jobs']} stages={int(t.get('stages', 0))} tasks={int(t.get('tasks', 0))} "
          f"stage_time={t.get('stage_ms', 0) / 1000:.1f}s input={t.get('input', 0) / mb:.1f}MB "
          f"shuffle_write={t.get('shuffle_write', 0) / mb:.1f}MB "
          f"spill_memory={t.get('spill_memory', 0) / mb:.1f}MB "
          f"spill_disk={t.get('spill_disk', 0) / mb:.1f}MB")
    print("per job description (bench query):")
    for desc, d in sorted(rep["by_description"].items(), key=lambda kv: -kv[1].get("stage_ms", 0)):
        print(f"  {desc or '(none)':40s} jobs={int(d['jobs']):4d} stage_time={d.get('stage_ms', 0) / 1000:6.2f}s "
              f"tasks={int(d.get('tasks', 0)):5d} shuffle_write={d.get('shuffle_write', 0) / mb:7.2f}MB "
              f"spill={(d.get('spill_memory', 0) + d.get('spill_disk', 0)) / mb:.1f}MB")
    print("slowest jobs:")
    for r in rep["top_jobs_by_stage_time"]:
        print(f"  job {r['job']:>4} {r.get('stage_ms', 0) / 1000:6.2f}s "
              f"stages={int(r.get('stages', 0))} tasks={int(r.get('tasks', 0))} "
              f"shuffle_write={r.get('shuffle_write', 0) / mb:7.2f}MB  {r['desc']}")


if __name__ == "__main__":
    main()
