"""Checking results: agreement of strategies, validation verdicts, schema."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketry.functions.expr import SEARCH_DOTALL, spark_pattern
from docketry.functions.sqltext import first_match, squeeze, strip
from docketry.sources.taxonomy import one_entry_each


def strategy_consensus(
    df: DataFrame,
    taxonomy: DataFrame,
    key: str | list[str],
    label_col: str = "event_type",
) -> DataFrame:
    """Majority label per document over its strategies, and the share that agrees.

    Votes are counted per document and label first, map-side, so the second grouping only sees
    one row per distinct label. Ties go to the label earlier in the taxonomy; labels outside
    the taxonomy come last, by name.
    """
    keys = [key] if isinstance(key, str) else key
    votes = (
        df.filter(F.col(label_col).isNotNull())
        .groupBy(*keys, F.col(label_col).alias("event_type"))
        .agg(F.count(F.lit(1)).alias("votes"))
    )
    order = one_entry_each(taxonomy).select("event_type", "ordinal")
    ranked = votes.join(order, "event_type", "left").withColumn(
        "preference",
        F.struct(
            (-F.col("votes")).alias("votes"),
            F.coalesce("ordinal", F.lit(2147483647)).alias("ordinal"),
            F.col("event_type"),
        ),
    )
    return ranked.groupBy(*keys).agg(
        F.min("preference").alias("best"), F.sum("votes").alias("n_strategies")
    ).select(
        *keys,
        F.col("best.event_type").alias("event_type"),
        "n_strategies",
        (-F.col("best.votes") / F.col("n_strategies")).alias("agreement"),
    )


def parse_validation(
    df: DataFrame, response_col: str = "response"
) -> DataFrame:
    """Add ``validation_status`` (``VALID``/``INVALID``, null if absent) and ``issues``.

    Issues are read only for an invalid verdict; blanks are squeezed, an empty list is null.
    """
    response = f"`{response_col}`"
    # Decoration around words, such as ** or [ ], is allowed.
    verdict = (spark_pattern(r"Status:[\s*\[]*(INVALID|VALID)"),)
    problems = (spark_pattern(r"Issues:[*]*\s*(.+)", SEARCH_DOTALL),)
    status = F.upper(F.expr(first_match(response, verdict, 1)))
    issues = F.nullif(F.expr(squeeze(strip(first_match(response, problems, 1)))), F.lit(""))
    return df.withColumn("validation_status", status).withColumn(
        "issues", F.when(F.col("validation_status") == "INVALID", issues)
    )


def schema_violations(
    df: DataFrame,
    taxonomy: DataFrame,
    key: str = "accession_number",
    label_col: str = "event_type",
    confidence_col: str = "confidence",
    relevant_col: str = "relevant",
) -> DataFrame:
    """Rows that break the result schema, with the first rule each one breaks."""
    known = one_entry_each(taxonomy).select(F.col("event_type").alias("__known"))
    joined = df.join(known, F.col(label_col) == F.col("__known"), "left")
    confidence = F.col(confidence_col)
    violation = (
        F.when(F.col(key).isNull(), "missing_key")
        .when(F.col(label_col).isNull(), "missing_label")
        .when(F.col("__known").isNull(), "unknown_label")
        .when(F.col(relevant_col).isNull(), "missing_relevance")
        .when(confidence.isNull() | ~confidence.between(0.0, 1.0), "bad_confidence")
    )
    return joined.withColumn("violation", violation).drop("__known").filter(
        F.col("violation").isNotNull()
    )
