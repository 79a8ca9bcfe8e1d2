"""Write STAGES.md: jobs, stages, tasks, input and shuffle bytes per query.

Usage: python tools/stages.py [data_dir] [event_log_dir] > STAGES.md

Each registered query runs under its own job group with Spark's event log
on; the log is then read back and the stage metrics summed per group. The
log folder defaults to a fresh temp folder, which suits a local run only; on
a cluster pass a shared folder.
"""

import glob
import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from kestrel.plans import QUERIES  # noqa: E402
from kestrel.session import get_session  # noqa: E402

METRICS = {
    "internal.metrics.input.bytesRead": "input",
    "internal.metrics.shuffle.write.bytesWritten": "shuffle_write",
    "internal.metrics.shuffle.write.recordsWritten": "shuffle_records",
    "internal.metrics.executorRunTime": "run_ms",
}


def run(data_dir: str, log_dir: str) -> dict[str, float]:
    spark = get_session("local[8]", app="kestrel-stages", shuffle_partitions=8,
                        conf={"spark.ui.showConsoleProgress": "false",
                              "spark.eventLog.enabled": "true",
                              "spark.eventLog.compress": "false",
                              "spark.eventLog.rolling.enabled": "false",
                              "spark.eventLog.dir": log_dir})
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).selectExpr("sum(id)").collect()  # JVM warm-up, not attributed
    wall = {}
    for key in sorted(QUERIES):
        spark.sparkContext.setJobGroup(key, key)
        t0 = time.perf_counter()
        QUERIES[key](spark, data_dir).write.format("noop").mode("overwrite").save()
        wall[key] = time.perf_counter() - t0
    spark.stop()
    return wall


def summarize(log_dir: str) -> dict[str, dict[str, float]]:
    stage_group, per = {}, {}
    paths = sorted(p for p in glob.glob(os.path.join(log_dir, "**", "*"), recursive=True)
                   if os.path.isfile(p))  # Spark 4 rolls the log into a folder of files
    for path in paths:
        with open(path) as f:
            for line in f:
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart":
                    group = (ev.get("Properties") or {}).get("spark.jobGroup.id")
                    if group:
                        per.setdefault(group, {"jobs": 0, "stages": 0, "tasks": 0})["jobs"] += 1
                        for sid in ev.get("Stage IDs", []):
                            stage_group[sid] = group
                elif kind == "SparkListenerStageCompleted":
                    info = ev["Stage Info"]
                    group = stage_group.get(info["Stage ID"])
                    if group is None or "Completion Time" not in info:
                        continue
                    acc = per[group]
                    acc["stages"] += 1
                    acc["tasks"] += info.get("Number of Tasks", 0)
                    for a in info.get("Accumulables", []):
                        name = METRICS.get(a.get("Name"))
                        if name:
                            acc[name] = acc.get(name, 0) + int(a.get("Value", 0))
    return per


def main():
    data_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    log_dir = sys.argv[2] if len(sys.argv) > 2 else tempfile.mkdtemp(prefix="kestrel-evlog-")
    wall = run(data_dir, log_dir)
    per = summarize(log_dir)
    print("# STAGES\n")
    print(f"Per registered query on `{data_dir}`, local[8]: Spark jobs, completed stages, tasks,")
    print("bytes read from files, shuffle bytes and records written, summed executor run time,")
    print("from Spark's event log. Generated by `tools/stages.py`. Iterative queries show one")
    print("job per pass; aggregations show how little crosses the shuffle.\n")
    print("| query | wall s | jobs | stages | tasks | input MB | shuffle MB | shuffle rows | run s |")
    print("| --- | --- | --- | --- | --- | --- | --- | --- | --- |")
    for key in sorted(wall):
        a = per.get(key, {})
        print(f"| {key} | {wall[key]:.2f} | {a.get('jobs', 0)} | {a.get('stages', 0)} | "
              f"{a.get('tasks', 0)} | {a.get('input', 0) / 1e6:.2f} | "
              f"{a.get('shuffle_write', 0) / 1e6:.3f} | {a.get('shuffle_records', 0)} | "
              f"{a.get('run_ms', 0) / 1e3:.2f} |")


if __name__ == "__main__":
    main()
