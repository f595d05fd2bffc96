"""Slowest stages from a Spark event log (no web UI needed).

usage: python tools/stage_times.py EVENT_LOG_FILE_OR_DIR [top_n]
Prints stage id, duration, task count and the stage name (call site).
"""

import io
import json
import os
import sys


def _open(f):
    """Plain or zstd-compressed (Spark 4's default event-log codec)."""
    if f.endswith(".zstd") or f.endswith(".zst"):
        import zstandard
        return io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(open(f, "rb")), encoding="utf-8")
    return open(f, encoding="utf-8")


def _files(path):
    """Event-log files under ``path`` (Spark 4 writes rolling logs: a folder
    per application holding ``events_*`` files)."""
    if not os.path.isdir(path):
        return [path]
    out = []
    for root, _, names in os.walk(path):
        out += [os.path.join(root, n) for n in sorted(names)
                if not n.startswith(".") and not n.startswith("appstatus")]
    return out


def main():
    path = sys.argv[1]
    top = int(sys.argv[2]) if len(sys.argv) > 2 else 15
    stages = []
    for f in _files(path):
        with _open(f) as fh:
            for line in fh:
                ev = json.loads(line)
                if ev.get("Event") != "SparkListenerStageCompleted":
                    continue
                info = ev["Stage Info"]
                start, end = info.get("Submission Time"), info.get("Completion Time")
                if start and end:
                    stages.append((end - start, info["Stage ID"], info["Number of Tasks"], info["Stage Name"]))
    for ms, sid, tasks, name in sorted(stages, reverse=True)[:top]:
        print(f"stage {sid:5d} {ms / 1000:8.2f} s {tasks:5d} tasks  {name[:90]}")
    print(f"{len(stages)} stages, {sum(s[0] for s in stages) / 1000:.1f} s total")


if __name__ == "__main__":
    main()
