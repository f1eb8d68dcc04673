"""Summaries and readable reports (K3-K5)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

# The title and the marks of source, text length, label, flag and percentage.
RULE = "=" * 60
TITLE = "8-K FILING CLASSIFICATION RESULTS"


_SUMMARY = ("found", "processed", "classified", "failed")


def _summary(status_col: str) -> list[Column]:
    status = F.coalesce(F.col(status_col), F.lit(""))
    failed = status == "unreadable"
    counts = (F.count(F.lit(1)), F.count_if(~failed), F.count_if(status == "classified"), F.count_if(failed))
    return [count.alias(name) for name, count in zip(_SUMMARY, counts)]


def batch_summary(
    df: DataFrame, strategy: str | None = None, status_col: str = "status"
) -> DataFrame:
    """K3: one row with found, processed, classified and failed counts of ``process_filings``.

    Failed are filings whose document could not be read; all others are processed, if only as metadata.
    """
    return df.agg(*_summary(status_col)).withColumn("strategy", F.lit(strategy).cast("string"))


def observe_summary(df: DataFrame, status_col: str = "status") -> tuple[DataFrame, Observation]:
    """K3 without a second pass: write the first, then give the second to :func:`observed_summary`.

    The counts are taken as the rows go by, so the model is not called again to count them.
    """
    observation = Observation()
    return df.observe(observation, *_summary(status_col)), observation


def observed_summary(spark: SparkSession, observation: Observation, strategy: str | None = None) -> DataFrame:
    """The row of :func:`batch_summary` from what a write has observed; waits for that write."""
    counts = observation.get
    row = tuple(int(counts.get(name, 0)) for name in _SUMMARY)
    return spark.createDataFrame(
        [(*row, strategy)], ", ".join(f"{name} bigint" for name in _SUMMARY) + ", strategy string"
    )


def event_counts(df: DataFrame, by: list[str] | None = None, totals: bool = False) -> DataFrame:
    """K4: counts per event type and relevance within ``by``; ``totals`` adds roll-up rows."""
    keys = [*(by or []), "event_type", "relevant"]
    grouped = df.rollup(*keys) if totals else df.groupBy(*keys)
    return grouped.agg(F.count(F.lit(1)).alias("n_filings"))


def with_month(df: DataFrame, date_col: str = "filing_date", out: str = "month") -> DataFrame:
    """Month of a date as ``yyyy-MM``, a key for :func:`event_counts`."""
    return df.withColumn(out, F.date_format(F.col(date_col).cast("date"), "yyyy-MM"))


def percent(c: Column) -> Column:
    return F.format_string("%.1f%%", c * 100)


def yes_no(c: Column) -> Column:
    return F.when(c, "Yes").otherwise("No")


def render_report(df: DataFrame, out: str = "report") -> DataFrame:
    """K5: add a readable report for document results (see ``to_document_result``)."""
    c = F.col("classification")
    reasoning = F.when(
        F.coalesce(c["reasoning"], F.lit("")) != "",
        F.concat(F.lit("\n\nWhy:\n"), c["reasoning"]),
    ).otherwise("")
    report = F.concat(
        F.lit(f"{RULE}\n{TITLE}\n{RULE}\nSource: "),
        F.col("input_source"),
        F.lit("\nAsked by: "),
        F.col("strategy"),
        F.lit("\nText Length: "),
        F.format_number("text_length", 0),
        F.lit(" characters\nEvent Type: "),
        c["event_type"],
        F.lit("\nRelevant: "),
        yes_no(c["relevant"]),
        F.lit("\nConfidence: "),
        percent(c["confidence"]),
        reasoning,
        F.lit("\n\nAnswer as given:\n"),
        c["raw_response"],
        F.lit(f"\n\n{RULE}"),
    )
    return df.withColumn(out, report)
