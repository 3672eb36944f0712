"""Pieces of SQL expression text.

An expression with hundreds of terms is given to Spark as one text: built with ``Column``
operators, each term is a call from Python to the JVM, and such an expression takes longer to put
together than to run.
"""

from __future__ import annotations

import math


def number(value: float) -> str:
    value = float(value)
    if not math.isfinite(value):
        return f"double('{value}')"
    return f"({value!r}D)" if value < 0 else f"{value!r}D"


def text(value: str) -> str:
    """By its bytes: quoting rules and ``${...}`` substitution cannot touch it."""
    return f"cast(X'{value.encode().hex()}' AS string)"


def name(column: str) -> str:
    return "`" + column.replace("`", "``") + "`"


def array(items: list[str]) -> str:
    return f"array({', '.join(items)})"
