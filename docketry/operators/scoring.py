"""The scoring stage: prompts to responses through a function of the caller."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docketry.operators.batches import release, structs, text_pieces

Generate = Callable[[str], str | None]
GenerateMany = Callable[[list[str]], Sequence[str | None]]

OUTCOME = "response string, error string"

_Outcome = tuple[str | None, str | None]


def _failed(problem: Exception) -> _Outcome:
    return None, f"{type(problem).__name__}: {problem}"


def answer_many(call: GenerateMany, prompts: list[str]) -> list[_Outcome]:
    """Outcomes of one call for several prompts.

    A call that fails, or that gives not one answer for each prompt, is made again for either half,
    down to single prompts: only the prompts that cause the failure get an error.
    """
    try:
        answers = list(call(prompts))
        if len(answers) != len(prompts):
            raise ValueError(f"{len(answers)} answers for {len(prompts)} prompts")
        return [(answer, None) for answer in answers]
    except Exception as problem:  # any failure of the backend is data
        if len(prompts) == 1:
            return [_failed(problem)]
    half = len(prompts) // 2
    return answer_many(call, prompts[:half]) + answer_many(call, prompts[half:])


def answer_each(call: Generate, prompts: list[str]) -> list[_Outcome]:
    """Outcomes of one call for each prompt."""
    outcomes: list[_Outcome] = []
    for prompt in prompts:
        try:
            outcomes.append((call(prompt), None))
        except Exception as problem:  # any failure of the backend is data
            outcomes.append(_failed(problem))
    return outcomes


def scorer(
    generate: Generate | GenerateMany | None = None,
    setup: Callable[[], Generate | GenerateMany] | None = None,
    batch_size: int | None = None,
):
    """An Arrow UDF that maps prompts to ``struct<response, error>``.

    Give either ``generate`` or ``setup``, called once per task to make it (open a client, load a
    model). Without ``batch_size`` the function takes one prompt and returns one answer; with it, the
    function takes a list of at most so many prompts and returns their answers in order. A null
    prompt is not sent; an exception becomes the ``error`` of the row that causes it.
    """
    if (generate is None) == (setup is None):
        raise ValueError("give exactly one of generate and setup")
    if batch_size is not None and batch_size < 1:
        raise ValueError("batch_size must be 1 or more")

    def outcomes(call: Generate | GenerateMany, prompts: list[str | None]) -> list[_Outcome]:
        sent = [n for n, prompt in enumerate(prompts) if prompt is not None]
        asked = [prompts[n] for n in sent]
        if batch_size is None:
            found = answer_each(call, asked)
        else:
            found = []
            for start in range(0, len(asked), batch_size):
                found += answer_many(call, asked[start: start + batch_size])
        rows: list[_Outcome] = [(None, None)] * len(prompts)
        for n, outcome in zip(sent, found):
            rows[n] = outcome
        return rows

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        call = generate or setup()
        for prompts in batches:
            piece = None
            for piece in text_pieces(prompts, step=batch_size or 1):
                yield structs(outcomes(call, piece.to_pylist()), "response", "error")
            del prompts, piece
            release()

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    # Nondeterministic: Spark must neither repeat nor move a call.
    return F.arrow_udf(run, OUTCOME).asNondeterministic()


def score(
    df: DataFrame,
    generate: Generate | GenerateMany | None = None,
    setup: Callable[[], Generate | GenerateMany] | None = None,
    prompt: str | Column = "prompt",
    batch_size: int | None = None,
) -> DataFrame:
    """Add ``response`` and ``error``. Write the output down before using it twice."""
    column = F.make_valid_utf8(F.col(prompt) if isinstance(prompt, str) else prompt)
    scored = df.withColumn("__outcome", scorer(generate, setup, batch_size)(column))
    return scored.withColumns(
        {"response": F.col("__outcome.response"), "error": F.col("__outcome.error")}
    ).drop("__outcome")
