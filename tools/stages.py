"""Stage and task times of a run, read from Spark's event log (no UI, no REST).

Run the job with ``spark.eventLog.enabled=true`` and ``spark.eventLog.dir=<scratch folder>``, then:

usage: python tools/stages.py <event log folder> [min_task_ms]
"""
import glob
import io
import json
import sys


def _lines(path):
    if path.endswith(".zstd"):
        import zstandard
        return io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(open(path, "rb")), encoding="utf-8")
    return open(path, encoding="utf-8")


def main():
    folder = sys.argv[1]
    min_ms = int(sys.argv[2]) if len(sys.argv) > 2 else 0
    files = sorted(glob.glob(f"{folder}/**/events_*", recursive=True)) or sorted(glob.glob(f"{folder}/*"))
    stages, tasks = {}, {}
    for f in files:
        for line in _lines(f):
            e = json.loads(line)
            if e["Event"] == "SparkListenerStageCompleted":
                si = e["Stage Info"]
                stages[si["Stage ID"]] = (si["Stage Name"][:48], si.get("Completion Time", 0) - si.get("Submission Time", 0),
                                          si["Number of Tasks"])
            elif e["Event"] == "SparkListenerTaskEnd":
                m = e.get("Task Metrics") or {}
                t = tasks.setdefault(e["Stage ID"], [0, 0.0, 0])
                t[0] += m.get("Executor Run Time", 0)
                t[1] += m.get("Executor CPU Time", 0) / 1e6
                t[2] += m.get("JVM GC Time", 0)
    for sid in sorted(stages):
        name, wall, n = stages[sid]
        run, cpu, gc = tasks.get(sid, [0, 0.0, 0])
        if run >= min_ms:
            print(f"{sid:4d} {name:48s} wall {wall:7d} ms  tasks {n:4d}  run {run:7d}  cpu {int(cpu):7d}  gc {gc:6d}")


if __name__ == "__main__":
    main()
