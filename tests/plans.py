"""Reading executed plans."""

from __future__ import annotations

import re


def executed(df) -> str:
    """The final adaptive plan, subqueries included, after running ``df``."""
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    # every adaptive plan prints its initial plan below the final one, at the same or a deeper indent
    kept, skip = [], None
    for line in text.splitlines():
        indent = len(line) - len(line.lstrip(" :|"))
        if skip is not None and indent > skip:
            continue
        skip = None
        if "== Initial Plan ==" in line:
            skip = indent
            continue
        kept.append(line)
    return "\n".join(kept)


def scans(plan: str, name: str) -> int:
    return len(re.findall(rf"FileScan .*?{name}", plan))


def shuffles(plan: str) -> int:
    return len(re.findall(r"(?<!Reused)(?<!Broadcast)Exchange (?:hash|range|Single|RoundRobin)", re.sub(r"ReusedExchange.*", "", plan)))
