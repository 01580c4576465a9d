"""Summarise stage durations from a Spark event log: python tools/stage_times.py <eventlog file or folder> [top]"""

import glob
import io
import json
import os
import sys


def _lines(path):
    if os.path.isdir(path):
        path = sorted(glob.glob(os.path.join(path, "**", "events_*"), recursive=True))[0]
    if path.endswith(".zstd"):
        import zstandard
        with open(path, "rb") as f:
            data = zstandard.ZstdDecompressor().stream_reader(f).read()
        return io.StringIO(data.decode("utf-8"))
    return open(path)


def main():
    path = sys.argv[1]
    top = int(sys.argv[2]) if len(sys.argv) > 2 else 25
    stages = {}
    for line in _lines(path):
        e = json.loads(line)
        if e.get("Event") == "SparkListenerStageCompleted":
            si = e["Stage Info"]
            dur = (si.get("Completion Time", 0) - si.get("Submission Time", 0)) / 1000
            acc = {a["Name"]: a.get("Value") for a in si.get("Accumulables", [])}
            stages[si["Stage ID"]] = (dur, si["Number of Tasks"], si["Stage Name"][:60],
                                      acc.get("internal.metrics.shuffle.write.recordsWritten"),
                                      acc.get("internal.metrics.input.recordsRead"))
    for sid, (dur, n, name, sw, inp) in sorted(stages.items(), key=lambda kv: -kv[1][0])[:top]:
        print(f"stage {sid:4d} {dur:7.2f}s tasks={n:4d} shuffleW={sw} in={inp} {name}")
    print("total stage seconds", round(sum(v[0] for v in stages.values()), 2), "stages", len(stages))


if __name__ == "__main__":
    main()
