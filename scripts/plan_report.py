"""Physical-plan summary per query: shuffles, join strategies, windows,
Python stages and scan pruning, read from ``explain()`` output.

    python scripts/plan_report.py [sf_dir] [key ...]     (default: headline queries, sf0.1)
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from bench import HEADLINE  # noqa: E402
from fieldkit.plans import catalog  # noqa: E402
from fieldkit.session import get_spark  # noqa: E402

MARKS = {
    "shuffles": r"Exchange (hashpartitioning|rangepartitioning|RoundRobinPartitioning|SinglePartition)",
    "broadcast joins": r"BroadcastHashJoin",
    "sort-merge joins": r"SortMergeJoin",
    "windows": r"\bWindow \[",
    "python stages": r"MapInPandas|ArrowEvalPython|BatchEvalPython",
    "partial aggs": r"functions=\[partial_",
}


def summarize(df) -> dict[str, object]:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    plan = buf.getvalue()
    out: dict[str, object] = {k: len(re.findall(rx, plan)) for k, rx in MARKS.items()}
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    out["scan columns"] = ", ".join(sorted({len(s.split(",")) for s in schemas}, reverse=True) and
                                    [str(len(s.split(","))) for s in schemas])
    out["pushed filters"] = sum(1 for f in re.findall(r"PushedFilters: \[([^\]]*)\]", plan) if f.strip())
    return out


def main() -> None:
    args = sys.argv[1:]
    sf_dir = args[0] if args and os.path.isdir(args[0]) else "/root/testdata/sf0.1"
    keys = [a for a in args if not os.path.isdir(a)] or HEADLINE
    spark = get_spark()
    q = catalog.queries()
    cols = list(MARKS) + ["scan columns", "pushed filters"]
    print("| query | " + " | ".join(cols) + " |")
    print("| --- " * (len(cols) + 1) + "|")
    for k in keys:
        s = summarize(q[k](spark, sf_dir))
        print(f"| {k} | " + " | ".join(str(s[c]) for c in cols) + " |")


if __name__ == "__main__":
    main()
