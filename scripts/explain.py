"""Print the physical plan of registered queries (after running them, so AQE's
final plan is shown) and a one-line operator census per query.

    python scripts/explain.py --root /root/testdata/sf0.1 fact_resolve segment_pit_vs_current
"""

from __future__ import annotations

import argparse
import contextlib
import io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from starloom.plans.registry import REGISTRY  # noqa: E402
from starloom.session import build_session  # noqa: E402

OPERATORS = (
    "Exchange hashpartitioning",
    "Exchange rangepartitioning",
    "Exchange SinglePartition",
    "BroadcastExchange",
    "BroadcastHashJoin",
    "SortMergeJoin",
    "ShuffledHashJoin",
    "BroadcastNestedLoopJoin",
    "CartesianProduct",
    "Window",
    "HashAggregate",
    "BatchEvalPython",
    "ArrowEvalPython",
)


def census(plan: str) -> dict[str, int]:
    final = plan.split("== Initial Plan ==")[0]
    return {op: len(re.findall(re.escape(op), final)) for op in OPERATORS if op in final}


def main() -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("--root", default="/root/testdata/sf0.01")
    ap.add_argument("--full", action="store_true", help="print the formatted plan too")
    ap.add_argument("names", nargs="*")
    args = ap.parse_args()
    spark = build_session()
    for name in args.names or list(REGISTRY):
        df = REGISTRY[name][0](spark, args.root)
        df.write.format("noop").mode("overwrite").save()
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            df.explain("formatted" if args.full else "simple")
        plan = buf.getvalue()
        print(name, census(plan), flush=True)
        if args.full:
            print(plan)


if __name__ == "__main__":
    main()
