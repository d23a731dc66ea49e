"""Functions by the names that queries use for them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: name (aliases, too) -> function over Columns.
FUNCTIONS: dict[str, Callable[..., Column]] = {}


def register(*names: str) -> Callable:
    def keep(fn: Callable[..., Column]) -> Callable[..., Column]:
        for n in names or (fn.__name__.rstrip("_"),):
            FUNCTIONS[n] = fn
        return fn

    return keep


def col(x: Column | str | object) -> Column:
    """A string names a column; anything else but a Column is a literal."""
    return x if isinstance(x, Column) else F.col(x) if isinstance(x, str) else F.lit(x)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)``, with the value worked out once a row however often the body (or a lambda in it) names it."""
    return F.get(F.transform(F.array(value), lambda v: body(v)), F.lit(0))


def alias(name: str, *more: str) -> None:
    for m in more:
        FUNCTIONS[m] = FUNCTIONS[name]


def call(name: str, *args: object, **named: object) -> Column:
    """The function registered under ``name``, applied."""
    return FUNCTIONS[name](*args, **named)
