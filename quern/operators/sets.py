"""Set operations beyond Spark's own, and recursion."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame

from quern.session import checkpointed


def symmetric_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.subtract(b).unionAll(b.subtract(a))


def union_by_name(a: DataFrame, b: DataFrame, all_: bool = True) -> DataFrame:
    out = a.unionByName(b, allowMissingColumns=True)
    return out if all_ else out.distinct()


def recursive_union(seed: DataFrame, step: Callable[[DataFrame], DataFrame], max_rounds: int = 1000) -> DataFrame:
    """WITH RECURSIVE ... UNION: step(new rows) until it gives none that is not there yet.  Each round is checkpointed."""
    found = new = checkpointed(seed.distinct())
    parts = [found]
    for _ in range(max_rounds):
        made = step(new)
        new = checkpointed(made.toDF(*found.columns).distinct().subtract(found))
        if new.isEmpty():
            return found
        parts.append(new)  # rounds are written once, and again only when there are many
        found = reduce(DataFrame.unionByName, parts)
        if len(parts) > 16:
            found = checkpointed(found)
            parts = [found]
    raise RuntimeError(f"no end after {max_rounds} rounds")


def recursive_using_key(seed: DataFrame, step: Callable[[DataFrame, DataFrame], DataFrame], keys: list[str], max_rounds: int = 1000) -> DataFrame:
    """WITH RECURSIVE ... USING KEY: step(new rows, all rows) replaces the rows of its keys; ends when nothing changes."""
    found = new = checkpointed(seed)
    for _ in range(max_rounds):
        new = checkpointed(step(new, found).subtract(found))
        if new.isEmpty():
            return found
        found = checkpointed(found.join(new, keys, "left_anti").unionByName(new))
    raise RuntimeError(f"no end after {max_rounds} rounds")
