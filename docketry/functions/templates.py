"""Prompt wording and its rendering as string concatenation.

A template is plain text with ``{slot}`` marks. Only the template is taken apart, at plan time,
so braces inside a filing are harmless.
"""

from __future__ import annotations

from string import Formatter

from pyspark.sql import Column
from pyspark.sql import functions as F

# The answer grammar the response parser reads.
ANSWER_LINE = "Event Type: [Category], Relevant: [true/false]"
REASONING_HEADER = "REASONING:"
CLASSIFICATION_HEADER = "CLASSIFICATION:"

_ANSWER = f"""Answer in exactly this form:

{REASONING_HEADER}
[%s]

{CLASSIFICATION_HEADER}
{ANSWER_LINE}

"""

BASIC = (
    """Sort the 8-K filing below into one event category.

{text}

The categories are:
{labels}

"""
    + _ANSWER % "What happened, why the category fits, and what it means for shareholders"
    + "Your answer:"
)

DETAILED = (
    """An investment desk wants this 8-K filing filed under one heading.

Headings, each with what belongs there:
{label_lines}

Filing:
{text}

If several events are reported, the one that takes up most of the filing decides. Call it
relevant when a shareholder who learned of it today would have reason to buy, sell or vote
differently tomorrow; call it not relevant otherwise.

"""
    + _ANSWER % "One paragraph: what is reported, which heading covers it, whether holders would act on it"
    + "Your answer:"
)

COT = (
    """Read this 8-K filing and think aloud before you sort it.

{text}

Possible categories: {labels}

Begin with one sentence in plain words on what happened. Rule out the categories that do not
cover it, until one is left. Close with what this would change for someone who holds shares.

"""
    + _ANSWER % "Your thoughts in that order"
    + "Your thoughts and answer:"
)

FEW_SHOT = (
    """Other filings were sorted like this:

{examples}

Go on in the same manner. Categories: {labels}

{text}

"""
    + _ANSWER % "Your reasons"
    + "Your answer:"
)

# The status line and the issues line, which the verdict parser reads.
VALIDATION = """Someone sorted a filing; a second opinion is wanted.

Their answer: {classification}
They could choose from: {labels}

{text}

Say first, under the heading REASONING:, what you would have answered and why. Then end with
two lines:
Status: [VALID or INVALID]
Issues: [what you would change; leave out if VALID]

Your opinion:"""

STRATEGIES = {"basic": BASIC, "detailed": DETAILED, "cot": COT, "few_shot": FEW_SHOT}
DEFAULT_STRATEGY = "detailed"

STOCK_REASONING = "The main facts of the filing and their weight were considered."
DEFAULT_EXAMPLES = (
    {
        "text": "Northwind Tools signed an agreement to buy Harbour Fasteners for $640 million.",
        "reasoning": "A purchase of this size changes the balance sheet and the line of business.",
        "classification": "Event Type: Acquisition, Relevant: true",
    },
    {
        "text": "Sales for the quarter rose to $2.1 billion and the yearly forecast was raised.",
        "reasoning": "New figures and a higher forecast bear directly on what the shares are worth.",
        "classification": "Event Type: Financial Event, Relevant: true",
    },
    {
        "text": "The chief financial officer will leave in May; a successor has been named.",
        "reasoning": "A change in a leading post may alter how the company is run.",
        "classification": "Event Type: Personnel Change, Relevant: true",
    },
)


def fill(template: str, **slots: Column) -> Column:
    """Template with its slots filled; null when a slot is null."""
    parts: list[Column] = []
    for literal, slot, _, _ in Formatter().parse(template):
        if literal:
            parts.append(F.lit(literal))
        if slot:
            parts.append(slots[slot])
    return F.concat(*parts)


def example_block(number: Column, text: Column, reasoning: Column, classification: Column) -> Column:
    """One solved example: seven lines, the last one empty."""
    return F.concat(
        F.lit("Example "), number.cast("string"), F.lit(":\nText: "), text,
        F.lit(f"\n{REASONING_HEADER}\n"), F.coalesce(reasoning, F.lit(STOCK_REASONING)),
        F.lit(f"\n{CLASSIFICATION_HEADER}\n"), classification, F.lit("\n"),
    )
