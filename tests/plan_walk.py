"""What an executed plan really did: its scans and exchanges, below adaptive stages and in subqueries."""

from __future__ import annotations

import re
from collections import Counter


def _seq(s) -> list:
    return [s.apply(i) for i in range(s.length())]


def nodes(df) -> list:
    """All physical nodes that ran, each once: what a reused exchange or subquery stands for is not
    walked again. Run the query (``df.collect()``) first."""
    out = []

    def walk(n) -> None:
        kind = n.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            return walk(n.executedPlan())
        if kind.endswith("QueryStageExec"):
            return walk(n.plan())
        out.append((kind, n))
        if kind.startswith("Reused"):
            return None
        for child in _seq(n.children()) + _seq(n.subqueries()):
            walk(child)
        return None

    walk(df._jdf.queryExecution().executedPlan())
    return out


def scans(df) -> Counter:
    """How often each table was read."""
    found = Counter()
    for kind, n in nodes(df):
        if kind == "FileSourceScanExec":
            found[re.search(r"Location:[^\[]*\[[^\]]*?/([a-z_]+)(?:\.parquet)?[\],]", n.toString().replace("...", "")).group(1)] += 1
    return found


def kinds(df) -> Counter:
    return Counter(kind for kind, _ in nodes(df))
