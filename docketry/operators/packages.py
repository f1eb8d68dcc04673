"""Full submissions: one text file that holds the documents of a filing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docketry.functions.expr import strip

# The tags around a document and those of its header lines.
DOCUMENT, TEXT = "DOCUMENT", "TEXT"
HEADER = {"doc_type": "TYPE", "sequence": "SEQUENCE", "filename": "FILENAME", "description": "DESCRIPTION"}


def _before(text: Column, tag: str) -> Column:
    return F.get(F.split(text, f"(?i)<{tag}>", 2), F.lit(0))


def _line(header: Column, tag: str) -> Column:
    value = strip(F.regexp_extract(header, rf"(?im)^[ \t]*<{tag}>([^\r\n<]*)", 1))
    return F.when(value != "", value)


def split_submission(df: DataFrame, html_col: str = "html") -> DataFrame:
    """One row per document of a full submission, with ``position, doc_type, sequence, filename, description``.

    ``html_col`` becomes the content between the text tags of that document; the header of the
    submission and what stands between documents is left out. Text without document tags is one
    document at position 0 with null header fields, a null text gives no row. All of it runs in the
    JVM, with no shuffle; give the result to ``extract_text``.
    """
    pieces = F.split(F.col(html_col), f"(?i)<{DOCUMENT}>")
    # What precedes the first tag is the header of the submission.
    parts = F.when(F.size(pieces) == 1, pieces).otherwise(F.slice(pieces, F.lit(2), F.greatest(F.size(pieces) - 1, F.lit(0))))
    others = [F.col(f"`{c}`") for c in df.columns if c != html_col]
    rows = df.select(*others, F.size(pieces).alias("__pieces"), F.posexplode(parts).alias("__at", "__part"))
    wrapped = F.col("__pieces") > 1
    body = _before(F.col("__part"), f"/{DOCUMENT}")
    halves = F.split(body, f"(?i)<{TEXT}>", 2)
    cut = rows.select(
        *others,
        F.when(wrapped, F.col("__at") + 1).otherwise(0).alias("position"),
        F.when(wrapped, F.get(halves, F.lit(0))).alias("__header"),
        F.when(wrapped, _before(F.coalesce(F.get(halves, F.lit(1)), body), f"/{TEXT}")).otherwise(F.col("__part")).alias(html_col),
    )
    fields = {name: _line(F.col("__header"), tag) for name, tag in HEADER.items()}
    fields["sequence"] = fields["sequence"].try_cast("int")
    return cut.withColumns(fields).select(*others, "position", *HEADER, html_col)
