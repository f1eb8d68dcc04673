"""Classifying documents and filings end to end."""

from __future__ import annotations

import inspect
from collections.abc import Callable, Mapping, Sequence
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docketry.functions.expr import compute_once
from docketry.functions.keys import source_type
from docketry.functions.templates import DEFAULT_STRATEGY
from docketry.operators.attempts import DEFAULT_MAX_RETRIES
from docketry.operators.extraction import extract_text, is_blank
from docketry.operators.filings import chosen_copies, one_document_each
from docketry.operators.prompts import prompt_column
from docketry.operators.responses import answer_labels, parse_response
from docketry.operators.scoring import Generate, GenerateMany, scorer
from docketry.sinks.staging import stage
from docketry.sources.schemas import RESULT

BROADCAST_ROWS = 1_000_000  # filings whose keys are broadcast, at most

def _for_attempt(setup: Callable | None, attempt: int) -> Callable | None:
    """``setup`` for one attempt; one that takes an argument is told its number."""
    if setup is None or not inspect.signature(setup).parameters:
        return setup
    return partial(setup, attempt)


def _asked(rows: DataFrame, taxonomy: DataFrame, prompt: Column, call, text_col: str) -> DataFrame:
    """One attempt: rows with ``__blank``, ``__parsed`` (null if nothing was sent) and ``__error``."""
    sent = F.when(~F.col("__blank"), F.make_valid_utf8(prompt))
    asked = rows.withColumn("__blank", is_blank(text_col)).withColumn("__prompt", sent)
    asked = asked.withColumn("__outcome", call(F.col("__prompt")))
    # The labels join the rows behind the call, so they do not pass through Python.
    labelled = asked.withColumn("__labels", answer_labels(taxonomy, "relevant"))
    parsed = F.when(
        F.col("__prompt").isNotNull(),
        parse_response("__outcome.response", "__labels", "__outcome.error IS NOT NULL"),
    )
    return (
        compute_once(labelled, "__parsed", parsed)
        .withColumn("__error", F.col("__outcome.error"))
        .drop("__prompt", "__outcome", "__labels")
    )


def _judged(rows: DataFrame, columns: list[str], attempt: int) -> DataFrame:
    """Rows that are done after an attempt, with the columns of :func:`classify`."""
    parse_status = F.col("__parsed.parse_status")
    ok = F.coalesce(parse_status == "ok", F.lit(False))
    result = F.col("__parsed.result").withField("relevant", F.col("__parsed.taxonomy_relevant"))
    return rows.select(
        *columns,
        F.when(ok, result).alias("result"),
        F.when(ok, F.col("__parsed.stated_relevant")).alias("stated_relevant"),
        F.when(F.col("__blank"), "empty_text").when(ok, "classified").otherwise("unclassified").alias("status"),
        F.when(parse_status.isNotNull(), F.lit(attempt)).otherwise(F.lit(0)).alias("attempts"),
        F.when(parse_status == "error", F.col("__error")).when(~ok, parse_status).alias("failure"),
    )


def classify(
    df: DataFrame,
    taxonomy: DataFrame,
    generate: Generate | GenerateMany | None = None,
    strategy: str | Column = DEFAULT_STRATEGY,
    examples: Sequence[Mapping[str, str]] | Column | None = None,
    max_retries: int = DEFAULT_MAX_RETRIES,
    setup: Callable | None = None,
    text_col: str = "text",
    batch_size: int | None = None,
) -> DataFrame:
    """C6 for a table with clean text: add ``result``, ``status``, ``attempts``, ``failure``.

    Attempts are passes over what is left: a pass scores its rows with one Python step and is written
    to the shared folder; the rows that got no valid answer are read again by the next one, if there
    are any. So no answer is generated twice, ``setup`` is called once for each task and pass, and a
    lost executor loses one task. Neither joins nor shuffles are needed, as a row carries its outcome.
    The last pass that is allowed runs when the output is used: write that down before using it twice.

    ``setup`` may take the number of the attempt, to ask otherwise the second time. ``batch_size`` and
    the functions are those of ``score``. ``strategy`` may be a column, as made by
    ``fan_out_strategies``, to compare strategies. ``status`` is ``classified``, ``empty_text`` or
    ``unclassified``; ``result.relevant`` is the taxonomy's flag, ``stated_relevant`` the one in the
    response.
    """
    prompt = prompt_column(F.col(text_col), taxonomy, strategy, examples)
    rows, done = df, None
    for attempt in range(1, max_retries + 2):
        call = scorer(generate, _for_attempt(setup, attempt), batch_size)
        asked = _asked(rows, taxonomy, prompt, call, text_col)
        last = attempt > max_retries
        if not last:
            asked = stage(asked)
            left = asked.filter("__parsed.parse_status != 'ok'")
            last = left.isEmpty()
        judged = asked if last else asked.filter("coalesce(__parsed.parse_status, 'ok') = 'ok'")
        judged = _judged(judged, df.columns, attempt)
        done = judged if done is None else done.unionByName(judged)
        if last:
            return done
        rows = left.select(*df.columns)
    raise ValueError("max_retries must be 0 or more")


def to_document_result(
    df: DataFrame,
    strategy: str,
    source_col: str = "input_source",
    text_col: str = "text",
    result_col: str = "result",
) -> DataFrame:
    """The result record of a classified document; unclassified rows do not come out."""
    return df.filter(F.col(result_col).isNotNull()).select(
        F.col(source_col).alias("input_source"),
        source_type(F.col(source_col)).alias("source_type"),
        F.lit(strategy).alias("strategy"),
        F.length(text_col).alias("text_length"),
        F.col(text_col).alias("extracted_text"),
        F.col(result_col).alias("classification"),
    )


def classify_documents(
    documents: DataFrame,
    taxonomy: DataFrame,
    generate: Generate | None = None,
    strategy: str = DEFAULT_STRATEGY,
    source_col: str = "path",
    **options,
) -> DataFrame:
    """C6 with C7: from ``path, html`` to document results."""
    texts = extract_text(documents)
    classified = classify(texts, taxonomy, generate, strategy, **options)
    return to_document_result(classified, strategy, source_col)


def process_filings(
    filings: DataFrame,
    documents: DataFrame,
    taxonomy: DataFrame | None = None,
    generate: Generate | None = None,
    strategy: str = DEFAULT_STRATEGY,
    **options,
) -> DataFrame:
    """Every filing with metadata, and a result where one could be had.

    Without ``generate`` (or ``setup``) nothing is classified and no document is read; status
    is then ``metadata_only``. A missing document gives ``no_content``, one that cannot be read
    ``unreadable`` with the reason as ``failure``. Trouble with one filing is a value in its row.
    See :func:`filing_texts` on how documents are chosen, :func:`classify` on when the model runs.
    """
    if generate is None and options.get("setup") is None:
        return filings.withColumns(
            {
                "result": F.lit(None).cast(RESULT),
                "stated_relevant": F.lit(None).cast("boolean"),
                "status": F.lit("metadata_only"),
                "attempts": F.lit(0),
                "failure": F.lit(None).cast("string"),
                "prompt_strategy": F.lit(None).cast("string"),
            }
        )
    texts = filing_texts(filings, documents)
    outcome = classify(texts, taxonomy, generate, strategy, **options)
    status = (
        F.when(F.col("__no_content"), "no_content")
        .when(F.col("__read_error").isNotNull(), "unreadable")
        .otherwise(F.col("status"))
    )
    outcome = outcome.withColumns(
        {"status": status, "failure": F.coalesce("__read_error", "failure")}
    ).drop("text", "__no_content", "__read_error")
    return (
        filings.join(outcome, "accession_number", "left")
        .withColumns(
            {
                "status": F.coalesce("status", F.lit("no_content")),
                "attempts": F.coalesce("attempts", F.lit(0)),
                "prompt_strategy": F.lit(strategy),
            }
        )
    )


def filing_texts(
    filings: DataFrame, documents: DataFrame, broadcast_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """``accession_number, text, __no_content, __read_error``: the chosen document of each filing.

    Text is extracted where a document is read, before any shuffle, so markup is neither shuffled,
    sorted nor aggregated (see ``attach_content`` on ``path``). If there are at most
    ``broadcast_rows`` filings, counted first, their keys are broadcast and other documents are not
    even extracted; beyond that, the text of all is, and the join drops what is not wanted.
    """
    key, empty = "accession_number", (F.coalesce("html", F.lit("")) == "").alias("__no_content")
    keys = filings.select(key)
    few = keys.limit(broadcast_rows + 1).count() <= broadcast_rows
    if "path" not in documents.columns:
        wanted = documents.select(key, "html").join(F.broadcast(keys) if few else keys, key, "left_semi")
        content = one_document_each(wanted).select(key, "html", empty)
        return extract_text(content, error_col="__read_error").drop("html")
    if few:
        documents = documents.join(F.broadcast(keys.distinct()), key, "left_semi")
    narrow = [c for c in (key, "path", "length") if c in documents.columns]
    chosen = chosen_copies(documents.select(*narrow).join(keys, key, "left_semi"))
    content = documents.select(key, "path", "html", empty)
    texts = extract_text(content, error_col="__read_error").drop("html")
    return texts.join(chosen, [key, "path"]).drop("path")


def to_classifications(processed: DataFrame) -> DataFrame:
    """K2 records of classified filings, with their ``cik``; the timestamp is the filing date."""
    return processed.filter(F.col("result").isNotNull()).select(
        "cik",
        "accession_number",
        F.col("result.event_type").alias("event_type"),
        F.col("result.relevant").alias("relevant"),
        F.col("result.reasoning").alias("reasoning"),
        F.col("result.confidence").alias("confidence"),
        "prompt_strategy",
        F.col("filing_date").alias("classification_timestamp"),
    )


def filing_status(metadata: DataFrame, classifications: DataFrame) -> DataFrame:
    """All metadata, with the classification where there is one."""
    shared = [c for c in classifications.columns if c in metadata.columns]
    shared.remove("accession_number")
    joined = metadata.join(classifications.drop(*shared), "accession_number", "left")
    return joined.withColumn("classified", F.col("event_type").isNotNull())


def unclassified(metadata: DataFrame, classifications: DataFrame) -> DataFrame:
    """Filings without a classification."""
    return metadata.join(
        classifications.select("accession_number"), "accession_number", "left_anti"
    )

