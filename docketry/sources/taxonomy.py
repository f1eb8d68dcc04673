"""Event taxonomies: from a JSON file, from a mapping, and the built-in default.

A taxonomy is a DataFrame of one row per label, ordered by ``ordinal``. Operators need all of
it for each row of data, so :func:`labels_array` packs it into one value that Spark computes
once (a scalar subquery, no join). It is bounded: more than ``max_labels`` labels (by default
``MAX_LABELS``), or more than ``max_characters`` of text in them, is an error.
"""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docketry.sources.schemas import TAXONOMY_FILE

MAX_LABELS = 10_000
MAX_CHARACTERS = 10_000_000

# Labels, their order, their relevance and their keywords. The descriptions are
# our own wording.
DEFAULT_TAXONOMY: dict[str, dict[str, Any]] = {
    "Acquisition": {
        "relevant": True,
        "description": "One company buys, merges with or takes over another, or buys its assets",
        "keywords": ["acquisition", "merger", "purchase", "acquire", "bought", "deal",
                     "takeover"],
    },
    "Customer Event": {
        "relevant": True,
        "description": "A contract won or lost, or other news about an important customer",
        "keywords": ["contract", "partnership", "customer", "agreement", "deal", "alliance"],
    },
    "Personnel Change": {
        "relevant": True,
        "description": "Someone joins or leaves the board or the top management",
        "keywords": ["CEO", "CFO", "president", "director", "appointment", "resignation",
                     "departure", "hire"],
    },
    "Financial Event": {
        "relevant": True,
        "description": "Figures for a quarter or year, a forecast, or a payout to shareholders",
        "keywords": ["earnings", "results", "revenue", "profit", "dividend", "financial",
                     "quarterly"],
    },
    "Regulatory/Legal Event": {
        "relevant": True,
        "description": "A court case, an inquiry, a ruling or a breach of rules",
        "keywords": ["lawsuit", "litigation", "SEC", "investigation", "regulatory",
                     "compliance", "violation", "settlement", "FDA approval", "patent"],
    },
    "Corporate Restructuring": {
        "relevant": True,
        "description": "Parts of the group are split off, sold, merged, wound up or insolvent",
        "keywords": ["spin-off", "divestiture", "bankruptcy", "restructuring", "subsidiary",
                     "reorganization", "liquidation"],
    },
    "Capital Market Event": {
        "relevant": True,
        "description": "Shares or debt are issued, bought back or refinanced",
        "keywords": ["offering", "debt", "credit agreement", "buyback", "repurchase", "bond",
                     "loan", "financing", "dividend"],
    },
    "Product/Service Event": {
        "relevant": True,
        "description": "A product or service is launched, approved, tested or recalled",
        "keywords": ["product launch", "recall", "FDA", "approval", "drug", "clinical trial",
                     "patent approval"],
    },
    "Strategic Alliance": {
        "relevant": True,
        "description": "Companies agree to work together, share technology or grant licences",
        "keywords": ["joint venture", "strategic partnership", "licensing", "collaboration",
                     "alliance", "technology transfer"],
    },
    "Scheduling Event": {
        "relevant": False,
        "description": "The date of a call, meeting or conference is announced",
        "keywords": ["schedule", "meeting", "conference", "call", "date", "announce"],
    },
    "Other": {
        "relevant": False,
        "description": "Anything that no other category covers",
        "keywords": [],
    },
}


def taxonomy_from_dict(spark: SparkSession, entries: Mapping[str, Mapping[str, Any]]) -> DataFrame:
    """Taxonomy from a mapping in its own order; missing fields get defaults.

    An empty mapping is an error here rather than a silent fall-back to some other taxonomy.
    """
    if not entries:
        raise ValueError("the taxonomy has no entries")
    table = pa.table(
        {
            "ordinal": pa.array(range(len(entries)), pa.int32()),
            "event_type": pa.array(list(entries), pa.string()),
            "relevant": pa.array(
                [bool(e.get("relevant", False)) for e in entries.values()], pa.bool_()
            ),
            "description": pa.array(
                [e.get("description") or "" for e in entries.values()], pa.string()
            ),
            "keywords": pa.array(
                [list(e.get("keywords") or []) for e in entries.values()], pa.list_(pa.string())
            ),
        }
    )
    return spark.createDataFrame(table)


def default_taxonomy(spark: SparkSession) -> DataFrame:
    return taxonomy_from_dict(spark, DEFAULT_TAXONOMY)


def read_taxonomy(spark: SparkSession, path: str) -> DataFrame:
    """Taxonomy from a JSON object file, in file order. A missing or broken file is an error.

    A label given twice keeps its first place and its last definition.
    """
    text = spark.read.text(path, wholetext=True)
    parsed = F.from_json("value", TAXONOMY_FILE, {"mode": "FAILFAST"})
    entries = text.select(F.posexplode(parsed)).select(
        F.col("pos"), F.col("key").alias("event_type"), "value.*"
    )
    return entries.groupBy("event_type").agg(
        F.min("pos").cast("int").alias("ordinal"),
        F.max_by(F.struct("relevant", "description", "keywords"), "pos").alias("entry"),
    ).select(
        "ordinal",
        "event_type",
        F.coalesce("entry.relevant", F.lit(False)).alias("relevant"),
        F.coalesce("entry.description", F.lit("")).alias("description"),
        F.coalesce("entry.keywords", F.array().cast("array<string>")).alias("keywords"),
    )


def load_taxonomy(
    spark: SparkSession,
    path: str | None = None,
    entries: Mapping[str, Mapping[str, Any]] | None = None,
) -> DataFrame:
    """A mapping wins over a file; with neither, the default taxonomy."""
    if entries is not None:
        return taxonomy_from_dict(spark, entries)
    return read_taxonomy(spark, path) if path else default_taxonomy(spark)


def one_entry_each(taxonomy: DataFrame) -> DataFrame:
    """The first entry of every label, so that a join with a taxonomy never multiplies rows."""
    rest = [name for name in taxonomy.columns if name != "event_type"]
    first = F.min_by(F.struct(*rest), "ordinal")
    return taxonomy.groupBy("event_type").agg(first.alias("first")).select("event_type", "first.*")


def one_row(
    taxonomy: DataFrame, value: Column, max_labels: int | None = None, max_characters: int | None = None
) -> DataFrame:
    """One row holding ``value`` over the whole taxonomy, or an error beyond the bounds.

    These are MAX_LABELS and MAX_CHARACTERS if not given.
    """
    max_labels = MAX_LABELS if max_labels is None else max_labels
    max_characters = MAX_CHARACTERS if max_characters is None else max_characters
    bounded = taxonomy.limit(max_labels + 1)
    text = F.to_json(F.struct(*[F.col(name) for name in taxonomy.columns]))
    fits = (F.count(F.lit(1)) <= max_labels) & (
        F.coalesce(F.sum(F.length(text)), F.lit(0)) <= max_characters
    )
    too_large = F.raise_error(
        F.lit(f"a taxonomy may have at most {max_labels} labels and {max_characters} characters here")
    )
    return bounded.agg(F.when(fits, value).otherwise(too_large).alias("v"))


def labels_array(taxonomy: DataFrame, *fields: str) -> Column:
    """The taxonomy as one array of structs in order, computed once per query."""
    packed = F.array_sort(F.collect_list(F.struct("ordinal", "event_type", *fields)))
    return one_row(taxonomy, packed).scalar()

