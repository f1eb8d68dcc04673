"""Choosing among attempts stored as rows.

Both operators are plain grouped aggregates: each task first reduces its own rows to one per
key, so a key that holds a large share of all attempts costs no more than any other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEFAULT_MAX_RETRIES = 2


def first_valid(
    df: DataFrame,
    key: str | list[str],
    attempt: str = "attempt",
    max_retries: int = DEFAULT_MAX_RETRIES,
    response_col: str = "response",
) -> DataFrame:
    """The result of the first valid attempt per key, within ``max_retries + 1`` attempts.

    Attempts count from 1. Keys without a valid attempt do not come out. Two rows with the same
    key and attempt are ordered by their response, so the choice never depends on partitioning.
    """
    keys = [key] if isinstance(key, str) else key
    order = F.when(
        F.col("parse_status") == "ok", F.struct(F.col(attempt), F.col(response_col))
    )
    # min_by passes over rows without an order.
    best = F.min_by(F.struct(F.col(attempt), F.col("result")), order)
    grouped = df.filter(F.col(attempt) <= max_retries + 1).groupBy(*keys).agg(best.alias("__best"))
    return grouped.filter(F.col("__best").isNotNull()).select(
        *keys, F.col(f"__best.{attempt}").alias(attempt), F.col("__best.result").alias("result")
    )


def attempt_report(
    df: DataFrame,
    key: str | list[str],
    attempt: str = "attempt",
    max_retries: int = DEFAULT_MAX_RETRIES,
) -> DataFrame:
    """Attempts a sequential run would have used per key, and why unsolved keys failed.

    Attempts count from 1; other numbers are passed over.
    """
    if max_retries > 62:
        raise ValueError("max_retries can be 62 at most")
    keys = [key] if isinstance(key, str) else key
    number = F.col(attempt)
    ok = F.col("parse_status") == "ok"
    # Attempts that a key has are bits of one number, so that telling them apart needs no second shuffle.
    seen = F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), (number - 1).cast("int")))
    grouped = df.filter(number.between(1, max_retries + 1)).groupBy(*keys).agg(
        F.min(F.when(ok, number)).alias("__solved_at"),
        F.bit_count(seen).cast("bigint").alias("__attempts"),
        F.max_by("parse_status", F.struct(number, F.col("parse_status"))).alias("__last"),
    )
    solved = F.col("__solved_at").isNotNull()
    return grouped.select(
        *keys,
        solved.alias("solved"),
        F.coalesce(F.col("__solved_at").cast("bigint"), F.col("__attempts")).alias(
            "attempts_used"
        ),
        F.when(~solved, F.col("__last")).alias("failure"),
    )
