"""Small helpers to write wide expressions as SQL text.

An expression built call by call crosses to the JVM once per operator; one that names
dozens of columns is far quicker to hand over as text, and plans the same.
"""

from __future__ import annotations

import math
from collections.abc import Sequence


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def number(x: float) -> str:
    """A double literal that reads back as exactly ``x``."""
    x = float(x)
    if not math.isfinite(x):
        raise ValueError(f"not a finite number: {x}")
    return f"{x!r}D" if x >= 0 else f"({x!r}D)"


def rows(structs: Sequence[dict[str, str]]) -> str:
    """``inline(...)`` of one struct per row, each given as name -> expression."""
    return (
        "inline(array("
        + ", ".join(
            "named_struct(" + ", ".join(f"{literal(k)}, {v}" for k, v in s.items()) + ")"
            for s in structs
        )
        + "))"
    )


def linear(inputs: Sequence[str], weights: Sequence[float], constant: float) -> str:
    """``constant + sum of weight * column``."""
    return number(constant) + "".join(
        f" + {quoted(c)} * {number(w)}" for c, w in zip(inputs, weights)
    )
