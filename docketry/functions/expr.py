"""Column helpers that give Spark expressions the string semantics of Python.

Java's ``\\s`` and Spark's ``trim`` know fewer blanks than ``str.strip``; every pattern in
the package is therefore written with :data:`WS` and compiled with one of the flag sets below.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# With (?U) this is the blank set of Python's str.strip and re \s.
WS_CHARS = r"\s\x1c-\x1f"
WS = f"[{WS_CHARS}]"
# The same 29 characters, spelled out for Spark's native trim.
BLANKS = "".join(c for c in map(chr, range(0x3001)) if c.isspace())

# U: Unicode classes, d: only \n ends a line, i: ignore case, s: dot matches \n.
SEARCH = "(?iUd)"
SEARCH_DOTALL = "(?isUd)"


def spark_pattern(pattern: str, flags: str = SEARCH) -> str:
    """Give a pattern written with plain ``\\s`` the Unicode blanks and flags used here."""
    # A class inside a class is a union in Java, so \s may also stand in brackets.
    return flags + pattern.replace(r"\s", WS)


def strip(c: Column) -> Column:
    """Remove leading and trailing Unicode blanks; looks only at the ends."""
    return F.trim(c, F.lit(BLANKS))


def squeeze(c: Column) -> Column:
    """Turn every run of blanks, line ends included, into one space."""
    return F.regexp_replace(c, rf"(?U){WS}+", " ")


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once per row and use it inside ``body``.

    An outer column used in a lambda may be inlined by the optimiser and then be computed
    again for each array element; a lambda variable is not.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def compute_once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """``withColumn`` for costly expressions: ``value`` is evaluated once per row.

    A filter on a projected column is pushed below the projection, which then evaluates the
    expression twice. It is not pushed below the one-element explode used here, while filters
    on other columns still are.
    """
    others = [F.col(f"`{other}`") for other in df.columns if other != name]
    return df.select(*others, F.explode(F.array(value)).alias(name))


def capitalize(c: Column) -> Column:
    """First character upper case, the rest lower case (unlike ``initcap``)."""
    return F.concat(F.upper(F.substring(c, 1, 1)), F.lower(F.substring(c, 2, 2147483647)))
