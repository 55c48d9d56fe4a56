"""Per-query jobs, stages, tasks and shuffle volume of the headline queries,
read from Spark's event log (written to a fresh scratch folder; no UI).

    python tools/stages.py /root/testdata/sf0.1
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile
import time

sys.path.insert(0, "/root/repo")

from bench import HEADLINE  # noqa: E402
from termflow.plans.catalog import QUERIES  # noqa: E402
from termflow.session import build_session  # noqa: E402


def _acc(info: dict, name: str) -> int:
    for a in info.get("Accumulables", []):
        if a.get("Name") == name:
            return int(a.get("Value", 0))
    return 0


def main(sf_dir: str) -> None:
    log_dir = tempfile.mkdtemp(prefix="termflow-events-")
    spark = build_session("local[8]", extra={"spark.eventLog.enabled": "true",
                                             "spark.eventLog.dir": log_dir,
                                             "spark.eventLog.compress": "false"})
    sc = spark.sparkContext
    wall = {}
    for name in HEADLINE:
        sc.setJobGroup(name, name)
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        wall[name] = time.perf_counter() - t0
    sc.setJobGroup("done", "done")
    spark.stop()

    job_group, stage_job, stages = {}, {}, {}
    paths = [p for p in glob.glob(f"{log_dir}/**/*", recursive=True) if not os.path.isdir(p)]
    for path in sorted(paths):
        if path.endswith((".zstd", ".lz4", ".snappy")):
            raise SystemExit(f"compressed event log {path}: set spark.eventLog.compress=false")
        with open(path) as fh:
            for line in fh:
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart":
                    group = ev.get("Properties", {}).get("spark.jobGroup.id")
                    job_group[ev["Job ID"]] = group
                    for sid in ev.get("Stage IDs", []):
                        stage_job[sid] = ev["Job ID"]
                elif kind == "SparkListenerStageCompleted":
                    info = ev["Stage Info"]
                    stages[(info["Stage ID"], info.get("Stage Attempt ID", 0))] = info
    rows = {n: {"jobs": set(), "stages": 0, "tasks": 0, "shuffle_write": 0, "shuffle_read": 0,
                "input": 0, "stage_sec": 0.0} for n in HEADLINE}
    for (sid, _), info in stages.items():
        group = job_group.get(stage_job.get(sid))
        if group not in rows or "Completion Time" not in info:
            continue
        r = rows[group]
        r["jobs"].add(stage_job[sid])
        r["stages"] += 1
        r["tasks"] += info.get("Number of Tasks", 0)
        r["shuffle_write"] += _acc(info, "internal.metrics.shuffle.write.bytesWritten")
        r["shuffle_read"] += (_acc(info, "internal.metrics.shuffle.read.remoteBytesRead")
                              + _acc(info, "internal.metrics.shuffle.read.localBytesRead"))
        r["input"] += _acc(info, "internal.metrics.input.bytesRead")
        r["stage_sec"] += (info["Completion Time"] - info["Submission Time"]) / 1000.0
    print("| query | wall s | jobs | stages | tasks | input MB | shuffle write MB | shuffle read MB |")
    print("| --- | --- | --- | --- | --- | --- | --- | --- |")
    mb = 1024 * 1024
    for n in HEADLINE:
        r = rows[n]
        print(f"| {n} | {wall[n]:.1f} | {len(r['jobs'])} | {r['stages']} | {r['tasks']} | "
              f"{r['input'] / mb:.1f} | {r['shuffle_write'] / mb:.1f} | {r['shuffle_read'] / mb:.1f} |")
    print(f"\nevent log: {log_dir}")


if __name__ == "__main__":
    main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1")
