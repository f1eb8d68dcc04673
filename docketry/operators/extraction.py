"""HTML to clean text."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docketry.functions.expr import compute_once, strip
from docketry.functions.lines import (
    MIN_LINE_LENGTH, NOISE_PATTERNS, clean_lines, drop_reason, split_lines,
)
from docketry.operators.batches import release, structs, text_pieces
from docketry.operators.markup import visible_text

Reader = Callable[["str | None"], "str | None"]

# Attachments that are no text come encoded, one letter for six bits, behind such a line.
_ENCODED = re.compile(r"\s*(?:<PDF>\s*)?begin [0-7]{3} \S")


def read_document(html: str | None) -> str | None:
    """T1-T5 for one document: its text nodes; an encoded attachment is an error."""
    if html is not None and _ENCODED.match(html):
        raise ValueError("an encoded attachment, not text")
    return visible_text(html)


def raw_text(reader: Reader = read_document):
    """An Arrow UDF from markup to ``struct<text, error>``: the text, or why it could not be read."""

    def read(document: str | None) -> tuple[str | None, str | None]:
        try:
            return reader(document), None
        except Exception as problem:  # one document must not stop the others
            return None, f"{type(problem).__name__}: {problem}"

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for html in batches:
            piece = None
            for piece in text_pieces(html):
                yield structs([read(document.as_py()) for document in piece], "text", "error")
            del html, piece
            release()

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(run, "text string, error string")


def extract_text(
    df: DataFrame,
    html_col: str = "html",
    text_col: str = "text",
    patterns: tuple[str, ...] = NOISE_PATTERNS,
    min_length: int = MIN_LINE_LENGTH,
    error_col: str | None = None,
    reader: Reader = read_document,
) -> DataFrame:
    """Add the clean text of an HTML column. Null HTML gives null text; no shuffle.

    ``reader`` turns one document into its text nodes, one a line, for formats of your own. A document that cannot be read has null text, too; ``error_col`` names a column for the reason.
    Select the rows wanted before this step: it is the expensive one.
    """
    # Filings are not always UTF-8; bytes that are not become U+FFFD before Arrow sees them.
    read = df.withColumn("__read", raw_text(reader)(F.make_valid_utf8(F.col(html_col))))
    text = clean_lines(F.col("__read.text"), patterns, min_length)
    if error_col is None:
        return compute_once(read, text_col, text).drop("__read")
    both = F.struct(text.alias("text"), F.col("__read.error").alias("error"))
    cleaned = compute_once(read, "__read", both)
    return cleaned.withColumns({text_col: F.col("__read.text"), error_col: F.col("__read.error")}).drop("__read")


def is_blank(text_col: str = "text") -> Column:
    """No text to classify."""
    return F.coalesce(strip(F.col(text_col)) == "", F.lit(True))


def line_drop_reasons(
    df: DataFrame,
    text_col: str = "text",
    patterns: tuple[str, ...] = NOISE_PATTERNS,
    min_length: int = MIN_LINE_LENGTH,
) -> DataFrame:
    """How many lines each cleaning rule drops (``kept`` for the rest).

    Lines are counted map-side first, so only a handful of rows per task are shuffled.
    """
    lines = df.select(F.explode(split_lines(F.col(text_col))).alias("line"))
    reason = F.coalesce(drop_reason(F.col("line"), patterns, min_length), F.lit("kept"))
    return lines.groupBy(reason.alias("reason")).agg(F.count(F.lit(1)).alias("n_lines"))
