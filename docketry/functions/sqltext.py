"""SQL text for expressions with many nested steps.

Building such an expression call by call costs a round trip to the JVM per step; as text it is
one call of ``F.expr``.
"""

from __future__ import annotations

from docketry.functions.expr import BLANKS, WS


def literal(value: str) -> str:
    """A raw string literal; backslashes mean themselves, quotes are not allowed."""
    if "'" in value:
        raise ValueError(f"no quotes in a raw literal: {value!r}")
    return f"r'{value}'"


def let(name: str, value: str, body: str) -> str:
    """``body`` with ``name`` standing for ``value``, which is evaluated once."""
    return f"get(transform(array({value}), {name} -> {body}), 0)"


def strip(text: str) -> str:
    return f"trim(BOTH {literal(BLANKS)} FROM {text})"


def squeeze(text: str) -> str:
    return f"regexp_replace({text}, {literal(f'(?U){WS}+')}, ' ')"


def first_match(text: str, patterns: tuple[str, ...], group: int, depth: int = 0) -> str:
    """Captured group of the leftmost match of the first pattern that matches, else null.

    Each pattern runs at most once. Only for groups that cannot match the empty string:
    ``regexp_extract`` yields ``''`` for "no match".
    """
    if not patterns:
        return "CAST(NULL AS string)"
    name = f"match_{depth}"
    return let(
        name,
        f"regexp_extract({text}, {literal(patterns[0])}, {group})",
        f"if({name} != '', {name}, {first_match(text, patterns[1:], group, depth + 1)})",
    )
