"""Parsing free-text responses into a validated result (R1-R11), without any Python per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docketry.functions.expr import SEARCH_DOTALL, compute_once, spark_pattern
from docketry.functions.sqltext import first_match, let, squeeze, strip
from docketry.sinks.staging import stage
from docketry.sources.taxonomy import labels_array

# The answer formats that are understood, in order of priority.
LABEL_PATTERNS = (
    r"Event Type:\s*([^,]+),\s*Relevant:\s*(true|false)",
    r"Type:\s*([^,]+),\s*Relevant:\s*(true|false)",
    r"Classification:\s*([^,]+),\s*Significant:\s*(true|false)",
    r"([^:,\n]+):\s*(true|false|yes|no)",
)
REASONING_PATTERNS = (
    r"REASONING:\s*(.+?)(?=CLASSIFICATION:|$)",
    r"analysis:\s*(.+?)(?=classification:|event type:|$)",
)
PLAIN_REASONING_PATTERNS = (
    r"reasoning:\s*(.+?)(?:\n|$)",
    r"because:\s*(.+?)(?:\n|$)",
    r"explanation:\s*(.+?)(?:\n|$)",
)
CONFIDENCE = 0.8
MOST_IN_ROW = 1_000  # labels that rows are matched with one by one; more are joined

STATUSES = ("ok", "empty_response", "no_match", "unknown_label", "error")


def _label(text: str) -> str:
    """R2: ``struct<label, word>`` of the first pattern that matches, null without a match.

    The whole match is cut up afterwards: a label has no comma, the text before the first
    colon is fixed (or, in the last pattern, the label), the word follows the last colon.
    """
    *structured, plain = [spark_pattern(p) for p in LABEL_PATTERNS]

    def parts(label: str, match: str) -> str:
        word = f"lower({strip(f"substring_index({match}, ':', -1)")})"
        return f"named_struct('label', {strip(label)}, 'word', {word})"

    behind_colon = "substring(whole, locate(':', whole) + 1)"
    from_structured = parts(f"substring_index({behind_colon}, ',', 1)", "whole")
    from_plain = parts("substring_index(line, ':', 1)", "line")
    return let(
        "whole",
        first_match(text, tuple(structured), 0),
        f"if(whole IS NOT NULL, {from_structured}, "
        + let("line", first_match(text, (plain,), 0), f"if(line IS NOT NULL, {from_plain}, NULL)")
        + ")",
    )


def _reasoning(text: str) -> str:
    """The reasoning section, else a one-line reason, else an empty string."""

    def first(patterns: tuple[str, ...]) -> str:
        return strip(
            first_match(text, tuple(spark_pattern(p, SEARCH_DOTALL) for p in patterns), 1)
        )

    return let(
        "section",
        squeeze(first(REASONING_PATTERNS)),
        f"if(section != '', section, coalesce({first(PLAIN_REASONING_PATTERNS)}, ''))",
    )


def answer_labels(taxonomy: DataFrame, *fields: str) -> Column:
    """The labels that answers are matched with, lowered once: an array from :func:`labels_array`."""
    lowered = taxonomy.withColumn("low", F.lower("event_type"))
    return labels_array(lowered, "low", *fields)


def _entry(label: str, labels: str) -> str:
    """The taxonomy entry a label means, null when there is none.

    Equality ignoring case comes first, then containment either way; the first entry in
    taxonomy order wins.
    """
    same = f"get(filter({labels}, e -> e.low = low), 0)"
    part = f"get(filter({labels}, e -> contains(low, e.low) OR contains(e.low, low)), 0)"
    return let("low", f"lower({label})", f"coalesce({same}, {part})")


def parse_response(response: str, labels: str, failed: str = "false") -> Column:
    """R1-R10 for one response, as one value that is computed once.

    ``struct<parse_status, stated_relevant, taxonomy_relevant, blank_label, result>``. The
    arguments are SQL: a response, an array from :func:`answer_labels` with ``relevant``, and a
    condition that marks failed calls.
    """
    status = f"""CASE WHEN {failed} THEN 'error'
        WHEN text IS NULL OR text = '' THEN 'empty_response'
        WHEN given IS NULL THEN 'no_match'
        WHEN entry IS NULL THEN 'unknown_label' ELSE 'ok' END"""
    stated = "given.word IN ('true', 'yes')"
    result = f"""named_struct('event_type', entry.event_type, 'relevant', {stated},
        'confidence', CAST({CONFIDENCE} AS double), 'reasoning', {_reasoning("text")},
        'raw_response', text)"""
    judged = let(
        "status",
        status,
        f"""named_struct('parse_status', status, 'stated_relevant', {stated},
            'taxonomy_relevant', entry.relevant, 'blank_label', given.label = '',
            'result', if(status = 'ok', {result}, NULL))""",
    )
    with_entry = let("entry", f"if(given IS NULL, NULL, {_entry('given.label', labels)})", judged)
    return F.expr(let("text", response, let("given", _label("text"), with_entry)))


def _numbered(labels: DataFrame) -> DataFrame:
    """``labels`` (low, ordinal, event_type) by ``rank``, their place in the order of taxonomy entries, written down.

    The smallest of many ranks is found by hashing, which Spark does not do for structs or strings.
    """
    ordered = labels.distinct().orderBy("ordinal", "event_type", "low")
    return stage(ordered.select("low", "event_type", F.monotonically_increasing_id().alias("rank")))


def resolved_labels(given: DataFrame, taxonomy: DataFrame) -> DataFrame:
    """R4, R5 by equi-joins alone: ``low`` and the ``event_type`` it means, for distinct ``low``.

    Equal labels come first. For the rest, a label that contains ``low`` is one whose substrings, of the
    lengths that the rest has, hold it, and a label within ``low`` equals one of the substrings of ``low``
    that are as long as some label; each substring has one row, that of the first label, so no join multiplies.
    """
    labels = _numbered(taxonomy.select(F.lower("event_type").alias("low"), "ordinal", "event_type"))
    names = labels.groupBy("low").agg(F.min("rank").alias("rank"))
    equal = stage(given.join(names, "low", "left"))
    rest = equal.filter("rank IS NULL").select("low")

    def lengths(texts: DataFrame) -> Column:
        """One value for each length that occurs."""
        return texts.agg(F.coalesce(F.collect_set(F.length("low")), F.array().cast("array<int>")).alias("sizes")).scalar()

    def substrings(texts: DataFrame, others: DataFrame, *keep: str) -> DataFrame:
        """The distinct substrings of each text that are as long as some other, as ``part``."""
        def of_length(n: Column) -> Column:
            starts = F.sequence(F.lit(1), F.length("low") - n + 1)
            return F.transform(starts, lambda i: F.substring("low", i, n))

        fitting = texts.withColumn("sizes", lengths(others)).withColumn("sizes", F.filter("sizes", lambda n: n <= F.length("low")))
        every = F.array_distinct(F.flatten(F.transform("sizes", of_length)))
        return fitting.select(*keep, F.explode(every).alias("part"))

    inside = substrings(rest, labels, "low").join(names.withColumnRenamed("low", "part"), "part").select("low", "rank")
    index = substrings(labels, rest, "rank").groupBy("part").agg(F.min("rank").alias("rank"))
    around = rest.join(index, F.col("low") == F.col("part")).select("low", "rank")
    part = inside.unionByName(around).groupBy("low").agg(F.min("rank").alias("rank"))
    found = equal.filter("rank IS NOT NULL").unionByName(part)
    return found.join(labels.select("rank", "event_type"), "rank").select("low", "event_type")


def normalize_labels(
    df: DataFrame, taxonomy: DataFrame, column: str, out: str = "label", most_in_row: int = MOST_IN_ROW
) -> DataFrame:
    """R4-R6 for a column of free labels; null where the taxonomy knows none.

    A taxonomy of at most ``most_in_row`` labels, counted first, is a value that each row is matched
    with: no join. A larger one meets the distinct labels of ``df`` in joins (see
    :func:`resolved_labels`), and the outcome is joined back, so ``df`` is used twice: write it down
    first if it calls a model. There is no limit to its size.
    """
    if taxonomy.limit(most_in_row + 1).count() <= most_in_row:
        labelled = df.withColumn("__labels", answer_labels(taxonomy))
        entry = F.expr(_entry(strip(f"`{column}`"), "__labels"))
        return compute_once(labelled, out, entry["event_type"]).drop("__labels")
    low = F.expr(f"lower({strip(f'`{column}`')})")
    given = df.select(low.alias("low")).filter("low IS NOT NULL").distinct()
    resolved = resolved_labels(given, taxonomy).select(F.col("low").alias("__low"), F.col("event_type").alias("__found"))
    joined = df.join(resolved, low == F.col("__low"), "left")
    others = [F.col(f"`{c}`") for c in df.columns if c != out]
    return joined.select(*others, F.col("__found").alias(out))


def parse_responses(
    df: DataFrame,
    taxonomy: DataFrame,
    response_col: str = "response",
    error_col: str | None = None,
) -> DataFrame:
    """Add ``result``, ``stated_relevant``, ``parse_status`` and ``blank_label``.

    ``result`` is null unless the status is ``ok``; its ``relevant`` is the one the response
    states (see ``apply_relevance`` for the taxonomy's). ``error_col`` marks failed calls.
    """
    failed = f"`{error_col}` IS NOT NULL" if error_col else "false"
    labelled = df.withColumn("__labels", answer_labels(taxonomy, "relevant"))
    parsed = parse_response(f"`{response_col}`", "__labels", failed)
    return (
        compute_once(labelled, "__parsed", parsed)
        .withColumns(
            {
                name: F.col(f"__parsed.{name}")
                for name in ("result", "stated_relevant", "parse_status", "blank_label")
            }
        )
        .drop("__labels", "__parsed")
    )


def result_json(result: Column) -> Column:
    """The result as a JSON object."""
    return F.to_json(result)


def split_valid(df: DataFrame, response_col: str = "response") -> tuple[DataFrame, DataFrame]:
    """Parsed rows, and the quarantined rest: the whole response, and its start beside it."""
    ok = F.col("parse_status") == "ok"
    rejected = df.filter(~ok).withColumn("response_start", F.substring(response_col, 1, 100))
    return df.filter(ok), rejected.drop("result")
