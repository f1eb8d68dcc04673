"""Taxonomy relevance over stated relevance."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketry.sources.taxonomy import one_entry_each


def apply_relevance(
    df: DataFrame,
    taxonomy: DataFrame,
    label_col: str = "event_type",
    stated_col: str = "stated_relevant",
    out: str = "relevant",
) -> DataFrame:
    """C4: the taxonomy's flag replaces the stated one; unknown labels keep the latter.

    Of a label that the taxonomy has twice, the first entry counts. The join carries no hint: Spark
    broadcasts the taxonomy as long as it is below its size threshold, so the large side is not
    shuffled.
    """
    flags = one_entry_each(taxonomy).select(
        F.col("event_type").alias("__event_type"), F.col("relevant").alias("__relevant")
    )
    joined = df.join(flags, F.col(label_col) == F.col("__event_type"), "left")
    return joined.withColumn(out, F.coalesce("__relevant", stated_col)).drop(
        "__event_type", "__relevant"
    )


def relevance_conflicts(
    df: DataFrame,
    label_col: str = "event_type",
    stated_col: str = "stated_relevant",
    relevant_col: str = "relevant",
) -> DataFrame:
    """How often the stated relevance differs from the taxonomy's, per label."""
    return (
        df.filter(F.col(stated_col) != F.col(relevant_col))
        .groupBy(F.col(label_col), F.col(stated_col), F.col(relevant_col))
        .agg(F.count(F.lit(1)).alias("n_conflicts"))
    )
