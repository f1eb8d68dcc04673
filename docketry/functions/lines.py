"""Line cleaning of extracted text (T6-T12), wholly inside the JVM."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

from docketry.functions.expr import BLANKS, bind, spark_pattern, strip

# A line matching any of these, ignoring case, is boilerplate.
NOISE_PATTERNS = (
    r"SEC\.gov",
    r"EDGAR",
    r"Filing Detail",
    r"Document Format Files",
    r"Complete submission text file",
    r"XBRL.*DOCUMENT",
    r"Washington.*D\.?C\.?\s*20549",
    r"Securities and Exchange Commission",
    r"Form\s+8-K",
    r"Current Report",
    r"Commission File Number",
    r"Check the appropriate box",
    r"☐|☑|□|■",
)
MIN_LINE_LENGTH = 10

RULE_CHARS = BLANKS + "-_=*."
DIGIT_LINE = r"(?U)^\d+\z"

# Letters that match an ASCII letter when case is ignored, besides its own two cases.
_CASE_TWINS = {"i": "\u0130\u0131", "k": "\u212a", "s": "\u017f"}


def _first_characters(patterns: tuple[str, ...]) -> str | None:
    """A class of all characters a match can start with; None when that is not plain to see."""
    starts = set()
    for alternative in "|".join(patterns).split("|"):
        first, follow = alternative[:1], alternative[1:2]
        plain = first.isascii() and first.isalnum() or unicodedata.category(first or " ") == "So"
        if not plain or follow in ("?", "*", "{"):
            return None
        starts |= {first.lower(), first.upper(), *_CASE_TWINS.get(first.lower(), "")}
    return f"[{''.join(sorted(starts))}]"


def noise_regex(patterns: tuple[str, ...] = NOISE_PATTERNS) -> str:
    """All patterns as one alternation, entered only where some pattern can start.

    Trying every alternative at every position is what costs most in line cleaning.
    """
    starts = _first_characters(patterns)
    guard = f"(?-i:(?={starts}))" if starts else ""
    return spark_pattern(guard + "(?:" + "|".join(f"(?:{p})" for p in patterns) + ")")


def _is_rule(line: Column) -> Column:
    return F.trim(line, F.lit(RULE_CHARS)) == ""


def split_lines(text: Column) -> Column:
    """Stripped lines, empty ones included."""
    return F.transform(F.split(text, "\n"), strip)


def drop_reason(
    line: Column, patterns: tuple[str, ...] = NOISE_PATTERNS, min_length: int = MIN_LINE_LENGTH
) -> Column:
    """T6-T10 for one stripped line: the first rule that drops it, null when it is kept."""
    reason = (
        F.when(line == "", "empty")
        .when(_is_rule(line), "rule")
        .when(line.rlike(DIGIT_LINE), "digits")
        .when(F.length(line) < min_length, "short")
    )
    if patterns:
        reason = reason.when(line.rlike(noise_regex(patterns)), "noise")
    return reason


def clean_lines(
    text: Column, patterns: tuple[str, ...] = NOISE_PATTERNS, min_length: int = MIN_LINE_LENGTH
) -> Column:
    """Keep the telling lines, one per line, with single spaces inside."""

    def keep(line: Column) -> Column:
        # The cheap length test first; rules commute because each only drops lines.
        kept = (F.length(line) >= min_length) & ~_is_rule(line) & ~line.rlike(DIGIT_LINE)
        return kept & ~line.rlike(noise_regex(patterns)) if patterns else kept

    def single_spaces(joined: Column) -> Column:
        untidy = F.contains(joined, F.lit("  ")) | F.contains(joined, F.lit("\t"))
        return F.when(untidy, strip(F.regexp_replace(joined, "[ \t]+", " "))).otherwise(
            strip(joined)
        )

    return bind(F.array_join(F.filter(split_lines(text), keep), "\n"), single_spaces)


def text_sample(text: Column, length: int = 200) -> Column:
    """Leading characters of the text."""
    return F.substring(text, 1, length)


