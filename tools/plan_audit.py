"""Audit the physical plans of the registered queries, the rows-only ones and every job that
a query runs while it is built included: no cartesian products, no nested-loop joins.

Usage: python tools/plan_audit.py [sf_dir] [name-substring ...]

The final plan of a query is explained; the plans of the jobs before it are read from the
event log that the session writes to a scratch folder.
"""

from __future__ import annotations

import contextlib
import glob
import io
import json
import os
import sys
import tempfile

sys.path.insert(0, __file__.rsplit("/tools/", 1)[0])

from stationflow.plans.catalog import load_all  # noqa: E402
from stationflow.session import build_session  # noqa: E402

BAD = ("CartesianProduct", "BroadcastNestedLoopJoin")


def plan_text(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def logged_plans(folder: str):
    """``(query, plan)`` of every SQL execution in the event logs below ``folder``."""
    for path in glob.glob(f"{folder}/**", recursive=True):
        if os.path.isfile(path):
            with open(path, encoding="utf-8") as f:
                for line in f:
                    if "physicalPlanDescription" in line:
                        event = json.loads(line)
                        yield event.get("executionId"), event.get("description"), event["physicalPlanDescription"]


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    wanted = sys.argv[2:]
    folder = tempfile.mkdtemp(prefix="plan-audit-")
    spark = build_session(extra={"spark.eventLog.enabled": "true", "spark.eventLog.dir": f"file://{folder}", "spark.eventLog.compress": "false"})
    found: dict[str, set] = {}
    n = 0
    for name, q in load_all().items():
        if wanted and not any(w in name for w in wanted):
            continue
        n += 1
        spark.sparkContext.setJobDescription(name)
        text = plan_text(q.build(spark, sf_dir))
        for b in BAD:
            if b in text:
                found.setdefault(name, set()).add(b)
    spark.stop()
    names, jobs = {}, 0
    for execution, name, text in logged_plans(folder):
        name = names.setdefault(execution, name)
        jobs += 1
        for b in BAD:
            if b in text:
                found.setdefault(str(name), set()).add(f"{b} in a job while built")
    for name, hits in sorted(found.items()):
        print(f"BAD   {name}: {sorted(hits)}")
    print(f"audited {n} queries and {jobs} plans of jobs while built; queries with cartesian or nested-loop joins: {len(found)}")


if __name__ == "__main__":
    main()
