"""Stage and job times of one registered key, from Spark's event log (no UI needed).

usage: python tools/stage_times.py KEY [sf_dir]

The event log is written to a fresh scratch folder (mktemp under /tmp); the script prints
each job's wall time and each stage's task count and duration.
"""

import glob
import io
import json
import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def _events(path: str):
    if path.endswith(".zstd"):
        import zstandard

        stream = io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(open(path, "rb")), encoding="utf-8")
    else:
        stream = open(path, encoding="utf-8")
    for line in stream:
        yield json.loads(line)


def main():
    key = sys.argv[1]
    sf = sys.argv[2] if len(sys.argv) > 2 else "/root/testdata/sf0.01"
    log_dir = tempfile.mkdtemp(prefix="run-eventlog-", dir="/tmp")
    from ledgerlens.plans.registry import QUERIES
    from ledgerlens.session import build_session

    spark = build_session(extra={"spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir})
    QUERIES[key](spark, sf).write.format("noop").mode("overwrite").save()
    spark.stop()
    files = [f for f in glob.glob(os.path.join(log_dir, "**", "*"), recursive=True)
             if os.path.isfile(f) and os.path.basename(f).startswith(("events", "local"))]
    jobs, stages = {}, {}
    for path in files:
        for e in _events(path):
            ev = e.get("Event")
            if ev == "SparkListenerJobStart":
                jobs[e["Job ID"]] = [e["Submission Time"], None]
            elif ev == "SparkListenerJobEnd" and e["Job ID"] in jobs:
                jobs[e["Job ID"]][1] = e["Completion Time"]
            elif ev == "SparkListenerStageCompleted":
                si = e["Stage Info"]
                stages[si["Stage ID"]] = (si["Number of Tasks"],
                                          (si.get("Completion Time", 0) - si.get("Submission Time", 0)) / 1000,
                                          si["Stage Name"][:60])
    t0 = min((s for s, _ in jobs.values()), default=0)
    for jid, (start, end) in sorted(jobs.items()):
        print(f"job {jid:3d}  start +{(start - t0) / 1000:6.2f}s  took {((end or start) - start) / 1000:6.2f}s")
    for sid, (tasks, secs, name) in sorted(stages.items()):
        print(f"  stage {sid:3d}  tasks {tasks:5d}  {secs:6.2f}s  {name}")
    print(f"event log: {log_dir}")


if __name__ == "__main__":
    main()
