"""What a query's plan holds after it ran."""

import re


def final_plan(df) -> str:
    """The plan that ran, subqueries included, without what was planned at first."""
    lines, skip = [], None
    for line in df._jdf.queryExecution().executedPlan().toString().split("\n"):
        depth = len(line) - len(line.lstrip(" :+-*"))
        if skip is not None and depth > skip:
            continue
        skip = None
        if "== Initial Plan ==" in line:
            skip = line.index("==") - 1
            continue
        lines.append(line)
    return "\n".join(lines)


def shuffles(plan: str) -> int:
    """Shuffles of rows; a shuffle that is used again counts once."""
    return len(re.findall(r"[ -]Exchange ", plan))
