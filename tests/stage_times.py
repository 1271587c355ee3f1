"""Summarize a Spark event log: the slowest stages with their task counts.

    python tests/stage_times.py EVENT_LOG [N]

EVENT_LOG is a log file, or a rolling log folder (``eventlog_v2_*``), or the
event-log folder holding one such run.
"""

from __future__ import annotations

import glob
import json
import os
import sys


def _lines(fp: str):
    """Lines of one log file; Spark compresses event logs (zstd by default)."""
    if fp.endswith(".zstd") or fp.endswith(".zst"):
        import io

        import zstandard

        with open(fp, "rb") as raw:
            reader = zstandard.ZstdDecompressor().stream_reader(raw)
            yield from io.TextIOWrapper(reader, encoding="utf-8")
    else:
        with open(fp, encoding="utf-8") as f:
            yield from f


def _files(path: str) -> list[str]:
    if os.path.isfile(path):
        return [path]
    inner = sorted(glob.glob(os.path.join(path, "events_*")))
    if inner:
        def seq(p: str) -> int:
            parts = os.path.basename(p).split("_")
            return int(parts[1]) if len(parts) > 1 and parts[1].isdigit() else 0

        return sorted(inner, key=seq)
    runs = sorted(glob.glob(os.path.join(path, "*")))
    return _files(runs[-1]) if runs else []


def main() -> None:
    path = sys.argv[1]
    top = int(sys.argv[2]) if len(sys.argv) > 2 else 20
    stages = []
    for fp in _files(path):
        for line in _lines(fp):
            ev = json.loads(line)
            if ev.get("Event") == "SparkListenerStageCompleted":
                info = ev["Stage Info"]
                start, end = info.get("Submission Time"), info.get("Completion Time")
                if start and end:
                    stages.append((end - start, info["Stage ID"], info["Number of Tasks"], info["Stage Name"][:80]))
    stages.sort(reverse=True)
    total = sum(s[0] for s in stages)
    print(f"{len(stages)} stages, {total / 1000:.1f} s stage time in total")
    for ms, sid, tasks, name in stages[:top]:
        print(f"{ms / 1000:8.2f}s  stage {sid:5d}  tasks {tasks:4d}  {name}")


if __name__ == "__main__":
    main()
