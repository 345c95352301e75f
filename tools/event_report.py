"""Summarize a Spark event log per benchmark query (jobs tagged ``bench:<name>:<run>``).

usage: BENCH_EVENT_LOG_DIR=/tmp/run-x/events python bench.py
       python tools/event_report.py /tmp/run-x/events [run]

Prints a markdown table: jobs, tasks, summed executor run time, shuffle bytes
written and read, for one timed run (default run 0) of every query.  (Input
bytes are left out: the vectorized Parquet reader does not report them fully.)
"""

from __future__ import annotations

import glob
import json
import os
import sys
from collections import defaultdict


def _lines(paths):
    """Event lines from plain or zstd-compressed (Spark 4 default) event files."""
    import io

    for p in paths:
        if p.endswith(".zstd"):
            import zstandard

            with open(p, "rb") as raw:
                reader = zstandard.ZstdDecompressor().stream_reader(raw)
                yield from io.TextIOWrapper(reader, encoding="utf-8")
        else:
            with open(p, encoding="utf-8") as fh:
                yield from fh


def main() -> None:
    folder = sys.argv[1]
    run = sys.argv[2] if len(sys.argv) > 2 else "0"
    entries = sorted(glob.glob(os.path.join(folder, "*")), key=os.path.getmtime)
    latest = entries[-1]
    # Spark 4 writes rolling logs: a folder of event files per application
    paths = sorted(glob.glob(os.path.join(latest, "events_*"))) if os.path.isdir(latest) else [latest]
    job_of_stage: dict[int, str] = {}
    stats: dict[str, dict[str, float]] = defaultdict(lambda: defaultdict(float))
    order: list[str] = []
    for line in _lines(paths):
        if True:
            ev = json.loads(line)
            kind = ev.get("Event")
            if kind == "SparkListenerJobStart":
                desc = (ev.get("Properties") or {}).get("spark.job.description", "")
                if not desc.startswith("bench:") or not desc.endswith(f":{run}"):
                    continue
                name = desc.split(":")[1]
                if name not in order:
                    order.append(name)
                stats[name]["jobs"] += 1
                for sid in ev.get("Stage IDs", []):
                    job_of_stage[sid] = name
            elif kind == "SparkListenerTaskEnd":
                name = job_of_stage.get(ev.get("Stage ID"))
                m = ev.get("Task Metrics") or {}
                if not name or not m:
                    continue
                st = stats[name]
                st["tasks"] += 1
                st["run_ms"] += m.get("Executor Run Time", 0)
                st["shuffle_w"] += (m.get("Shuffle Write Metrics") or {}).get("Shuffle Bytes Written", 0)
                sr = m.get("Shuffle Read Metrics") or {}
                st["shuffle_r"] += sr.get("Remote Bytes Read", 0) + sr.get("Local Bytes Read", 0)
    mb = 1024 * 1024
    print("| query | jobs | tasks | executor time (s) | shuffle write (MB) | shuffle read (MB) |")
    print("|---|---|---|---|---|---|")
    for name in order:
        st = stats[name]
        print(f"| {name} | {int(st['jobs'])} | {int(st['tasks'])} | {st['run_ms'] / 1000:.1f} | "
              f"{st['shuffle_w'] / mb:.1f} | {st['shuffle_r'] / mb:.1f} |")


if __name__ == "__main__":
    main()
