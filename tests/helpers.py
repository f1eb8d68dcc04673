"""Small helpers shared by the tests."""

import re
from pathlib import Path

PYTHON_WS = r"\s"


def rows(df, *order):
    """Collected rows as tuples, sorted when an order is given."""
    if order:
        df = df.orderBy(*order)
    return [tuple(r) for r in df.collect()]


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def python_strip_lines(text: str) -> list[str]:
    return [line for line in (part.strip() for part in text.split("\n")) if line]


def fixture(name: str) -> str:
    return (Path(__file__).parent / "fixtures" / name).read_text(encoding="utf-8")


def first_match(patterns, text, flags=re.IGNORECASE):
    for pattern in patterns:
        if found := re.search(pattern, text, flags):
            return found
    return None
