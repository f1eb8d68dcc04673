"""Prompt rendering: text x taxonomy x strategy."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docketry.functions import templates
from docketry.sources.taxonomy import one_row


def _ordered(value: Column, separator: str) -> Column:
    lines = F.array_sort(F.collect_list(F.struct("ordinal", value.alias("line"))))
    return F.array_join(F.transform(lines, lambda entry: entry["line"]), separator)


def label_list(taxonomy: DataFrame) -> Column:
    """Labels in order, separated by commas, as one value."""
    return one_row(taxonomy, _ordered(F.col("event_type"), ", ")).scalar()


def _label_line() -> Column:
    keywords = F.when(
        F.size("keywords") > 0,
        F.concat(F.lit(" (Keywords: "), F.array_join("keywords", ", "), F.lit(")")),
    ).otherwise("")
    return F.concat(F.lit("- "), F.col("event_type"), F.lit(": "), F.col("description"), keywords)


def label_lines(taxonomy: DataFrame) -> Column:
    """One line per label with its description and keywords, as one value."""
    return one_row(taxonomy, _ordered(_label_line(), "\n")).scalar()


def taxonomy_text(
    taxonomy: DataFrame, max_labels: int | None = None, max_characters: int | None = None
) -> DataFrame:
    """A single row with ``labels`` and ``label_lines``; an error beyond the bounds (see ``one_row``)."""
    value = F.struct(
        _ordered(F.col("event_type"), ", ").alias("labels"),
        _ordered(_label_line(), "\n").alias("label_lines"),
    )
    return one_row(taxonomy, value, max_labels, max_characters).select("v.*")


def examples_text(examples: Sequence[Mapping[str, str]] | Column | None) -> Column:
    """The examples section; the default set for ``None``, nothing for an empty list.

    A column must be an ``array<struct<text, reasoning, classification>>``.
    """
    if isinstance(examples, Column):
        blocks = F.transform(
            examples,
            lambda e, i: templates.example_block(
                i + 1, e["text"], e["reasoning"], e["classification"]
            ),
        )
        return F.array_join(blocks, "\n")
    if examples is None:
        examples = templates.DEFAULT_EXAMPLES
    blocks = [
        templates.example_block(
            F.lit(i), F.lit(e["text"]), F.lit(e.get("reasoning")), F.lit(e["classification"])
        )
        for i, e in enumerate(examples, 1)
    ]
    return F.concat_ws("\n", *blocks) if blocks else F.lit("")


def prompt_column(
    text: Column,
    taxonomy: DataFrame,
    strategy: str | Column = templates.DEFAULT_STRATEGY,
    examples: Sequence[Mapping[str, str]] | Column | None = None,
) -> Column:
    """The prompt for a strategy, given by name or by a column with one name per row.

    An unknown name is a ``ValueError``; in a column it gives a null prompt for its row.
    """
    if isinstance(strategy, Column):
        prompt = F.lit(None).cast("string")
        for name in templates.STRATEGIES:
            rendered = prompt_column(text, taxonomy, name, examples)
            prompt = F.when(strategy == name, rendered).otherwise(prompt)
        return prompt
    if strategy not in templates.STRATEGIES:
        raise ValueError(f"unknown prompt strategy: {strategy!r}")
    slots = {"text": text}
    if strategy == "detailed":
        slots["label_lines"] = label_lines(taxonomy)
    else:
        slots["labels"] = label_list(taxonomy)
    if strategy == "few_shot":
        slots["examples"] = examples_text(examples)
    return templates.fill(templates.STRATEGIES[strategy], **slots)


def render_prompt(
    df: DataFrame,
    taxonomy: DataFrame,
    strategy: str | Column = templates.DEFAULT_STRATEGY,
    examples: Sequence[Mapping[str, str]] | Column | None = None,
    text_col: str = "text",
    out: str = "prompt",
) -> DataFrame:
    """Add the prompt of each row (see :func:`prompt_column`); no shuffle, no join."""
    return df.withColumn(out, prompt_column(F.col(text_col), taxonomy, strategy, examples))


def render_validation_prompt(
    df: DataFrame,
    taxonomy: DataFrame,
    text_col: str = "text",
    classification_col: str = "classification",
    out: str = "prompt",
) -> DataFrame:
    """P5: ask whether a proposed classification is right."""
    prompt = templates.fill(
        templates.VALIDATION,
        text=F.col(text_col),
        classification=F.col(classification_col),
        labels=label_list(taxonomy),
    )
    return df.withColumn(out, prompt)


def basic_prompt(df: DataFrame, taxonomy: DataFrame, **options) -> DataFrame:
    """P8."""
    return render_prompt(df, taxonomy, "basic", **options)


def detailed_prompt(df: DataFrame, taxonomy: DataFrame, **options) -> DataFrame:
    """P8."""
    return render_prompt(df, taxonomy, "detailed", **options)


def cot_prompt(df: DataFrame, taxonomy: DataFrame, **options) -> DataFrame:
    """P8."""
    return render_prompt(df, taxonomy, "cot", **options)


def few_shot_prompt(df: DataFrame, taxonomy: DataFrame, examples=None, **options) -> DataFrame:
    """P8."""
    return render_prompt(df, taxonomy, "few_shot", examples, **options)


def fan_out_strategies(
    df: DataFrame, strategies: Iterable[str] = tuple(templates.STRATEGIES), out: str = "strategy"
) -> DataFrame:
    """One row per document and strategy, without a shuffle."""
    names = list(strategies)
    unknown = [name for name in names if name not in templates.STRATEGIES]
    if unknown:
        raise ValueError(f"unknown prompt strategies: {unknown}")
    return df.withColumn(out, F.explode(F.array(*[F.lit(name) for name in names])))
