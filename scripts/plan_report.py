"""Summarise the final (post-AQE) physical plans of every driver query.

Usage: python scripts/plan_report.py [sf_dir] [query ...] > PLANS.md

Each query is executed once (noop sink) with Spark's event log in a scratch folder. The last plan of every execution
is read from that log, so the plans of writes that a storage query makes count as well as that of its result.
"""

from __future__ import annotations

import json
import re
import sys
import tempfile
from collections import defaultdict
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

_JOINS = {"BroadcastHashJoin": "broadcast joins", "SortMergeJoin": "shuffle joins", "ShuffledHashJoin": "shuffle joins"}
COLUMNS = ("plans", "scans", "shuffles", "single", "broadcast joins", "shuffle joins", "limits", "aggregates", "writes", "python")


def nodes(plan: dict) -> list[tuple[str, str, str]]:
    """(name, text, pushed filters) of every operator of a plan as the event log has it."""
    meta = plan.get("metadata") or {}
    out = [(plan["nodeName"], plan.get("simpleString", ""), meta.get("PushedFilters", ""))]
    for child in plan.get("children", []):
        out += nodes(child)
    return out


class Log:
    """Plans of the executions since the last call."""

    def __init__(self, folder: str):
        self.folder, self.at = Path(folder), 0

    def plans(self) -> list[list[tuple[str, str, str]]]:
        last: dict[int, dict] = {}
        with next(f for f in self.folder.rglob("*") if f.is_file() and not f.name.startswith(("appstatus", "."))).open() as f:
            f.seek(self.at)
            for line in iter(f.readline, ""):
                if "sparkPlanInfo" in line:
                    event = json.loads(line)
                    last[event["executionId"]] = event["sparkPlanInfo"]
            self.at = f.tell()
        return [nodes(p) for p in last.values()]


def summarize(plans: list[list[tuple[str, str, str]]]) -> dict[str, object]:
    count: dict[str, int] = defaultdict(int, plans=len(plans))
    pushed = set()
    for name, text, filters in (x for p in plans for x in p):
        pushed |= set(re.findall(r"(GreaterThanOrEqual|GreaterThan|LessThanOrEqual|LessThan|EqualTo|In)\((\w+)", filters))
        if name == "Exchange":
            count["single" if "SinglePartition" in text else "shuffles"] += 1
        elif name in _JOINS:
            count[_JOINS[name]] += 1
        elif name == "WindowGroupLimit":
            count["limits"] += 1
        elif name.endswith("HashAggregate") or name == "SortAggregate":
            count["aggregates"] += 1
        elif name.startswith("Scan parquet"):
            count["scans"] += 1
        elif name.startswith("Execute InsertInto"):
            count["writes"] += 1
        elif re.search("Python|Pandas|MapInArrow", name):
            count["python"] += 1
    return {c: count[c] for c in COLUMNS} | {"pushed": ", ".join(f"{op}({c})" for op, c in sorted(pushed)[:6]) or "-"}


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    from strata.plans.queries import registry
    from strata.session import build_session
    folder = tempfile.mkdtemp(prefix="strata-plans-")
    spark = build_session("local[8]", shuffle_partitions=8, extra={
        "spark.eventLog.enabled": "true", "spark.eventLog.dir": f"file://{folder}", "spark.eventLog.rolling.enabled": "false",
        "spark.eventLog.compress": "false", "spark.eventLog.buffer.kb": "1k", "spark.sql.maxMetadataStringLength": "2000"})
    print(f"# Final physical plans of the driver queries ({Path(sf).name}, local[8], AQE on)\n")
    print("Counts are operators in the final adaptive plans of all executions of a query, its own writes included.")
    print("`single` = exchanges to one partition (only over bounded aggregates); `limits` = WindowGroupLimit nodes")
    print("(partial + final); `python` = operators with Python workers.\n")
    print("| query | " + " | ".join(COLUMNS) + " | pushed filters |")
    print("|---" * (len(COLUMNS) + 2) + "|")
    log = Log(folder)
    for name, fn in registry().items():
        if sys.argv[2:] and name not in sys.argv[2:]:
            continue
        fn(spark, sf).write.format("noop").mode("overwrite").save()
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
        s = summarize(log.plans())
        print(f"| {name} | " + " | ".join(str(s[c]) for c in COLUMNS) + f" | {s['pushed']} |", flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
