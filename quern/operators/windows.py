"""Window features that Spark lacks: GROUPS frames, EXCLUDE, interpolation, aggregates of distinct values."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def groups_frame(df: DataFrame, make: Callable[[object], Column], by: list[str], order: str, low: int, high: int, name: str) -> DataFrame:
    """``make(window)`` over a frame of peer groups: their dense rank, as a range."""
    ranked = df.withColumn("_g", F.dense_rank().over(Window.partitionBy(*by).orderBy(order)))
    return ranked.withColumn(name, make(Window.partitionBy(*by).orderBy("_g").rangeBetween(low, high))).drop("_g")


def exclude(value: str, by: list[str], order: str, low: int, high: int, what: str, how: str = "sum") -> Column:
    """An aggregate (sum, count, min, max or avg) over rows low..high around the current row, without it (CURRENT ROW),
    its peers (GROUP), the other peers (TIES) or none (NO OTHERS)."""
    w = Window.partitionBy(*by).orderBy(order)
    if what == "NO OTHERS":
        return getattr(F, how)(value).over(w.rowsBetween(low, high))
    if what == "CURRENT ROW":  # the frame before the row and the frame after it
        spans = [(low, min(high, -1)), (max(low, 1), high)]
        sides = lambda f: [f(value).over(w.rowsBetween(a, b)) for a, b in spans if a <= b]
        total = lambda f: sum((F.coalesce(c, F.lit(0)) for c in sides(f)), F.lit(0))
        n = total(F.count)
        if how == "count":
            return n
        if how in ("min", "max"):
            both = sides(getattr(F, how))
            return both[0] if len(both) == 1 else (F.least if how == "min" else F.greatest)(*both)
        return F.when(n > 0, total(F.sum) / n if how == "avg" else total(F.sum))
    # The frame is of a fixed number of rows, so its rows may be listed.
    if what not in ("GROUP", "TIES"):
        raise ValueError(f"EXCLUDE {what}")
    here = F.col(order)
    everyone = F.collect_list(F.struct(here.alias("o"), F.col(value).alias("v"))).over(w.rowsBetween(low, high))
    known = lambda a: F.filter(F.transform(a, lambda s: s["v"]), lambda v: v.isNotNull())
    earlier = lambda s: F.coalesce(s["o"] < here, s["o"].isNull() & here.isNotNull())
    parts = [known(F.filter(everyone, earlier)), known(F.filter(everyone, lambda s: ~earlier(s) & ~s["o"].eqNullSafe(here)))]
    if what == "TIES":
        parts[1] = F.concat(F.filter(F.array(F.col(value)), lambda v: v.isNotNull()), parts[1])
    values = F.concat(*parts)
    if how in ("min", "max"):
        return (F.array_min if how == "min" else F.array_max)(values)
    n = F.size(values)
    if how == "count":
        return n.cast("long")
    # Sums of the rows before the peers and of the others are added up, as for CURRENT ROW: the last digit depends on it.
    before, after = [F.aggregate(F.transform(a, lambda v: v.cast("double")), F.lit(0.0), lambda x, v: x + v) for a in parts]
    return F.when(n > 0, (before + after) / n if how == "avg" else before + after)


def fill(value: str, by: list[str], order: str) -> Column:
    """Nulls of ``value`` on the line through the nearest known neighbours along a numeric ``order``; beyond the outermost
    known ones on the line through the nearest two, and with one known value that value."""
    w = Window.partitionBy(*by).orderBy(order)
    known = F.when(F.col(value).isNotNull(), F.struct(F.col(order).cast("double").alias("x"), F.col(value).cast("double").alias("y")))
    to, since = w.rowsBetween(Window.unboundedPreceding, 0), w.rowsBetween(0, Window.unboundedFollowing)
    before, after = F.last(known, ignorenulls=True).over(to), F.first(known, ignorenulls=True).over(since)
    first, last = (F.nth_value(known, 1, ignoreNulls=True).over(Window.partitionBy(*by).orderBy(o).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)) for o in (order, F.desc(order)))
    second, last_but_one = (F.nth_value(known, 2, ignoreNulls=True).over(Window.partitionBy(*by).orderBy(o).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)) for o in (order, F.desc(order)))
    a = F.when(before.isNull(), first).when(after.isNull(), last_but_one).otherwise(before)
    b = F.when(before.isNull(), second).when(after.isNull(), last).otherwise(after)
    x = F.col(order).cast("double")
    line = a["y"] + (b["y"] - a["y"]) * (x - a["x"]) / F.nullif(b["x"] - a["x"], F.lit(0.0))
    return F.coalesce(F.col(value).cast("double"), line, before["y"], after["y"])


def distinct_aggregate(df: DataFrame, aggregate: Callable[[str], Column], value: str, by: list[str], name: str, where: Column | None = None) -> DataFrame:
    """aggregate(DISTINCT value) [FILTER (where)] over a partition, joined back; null keys are keys like any other."""
    chosen = df if where is None else df.where(where)
    keys = [f"_k{i}" for i in range(len(by))]
    found = chosen.select(*[F.col(b).alias(k) for b, k in zip(by, keys, strict=True)], F.col(value).alias("_v")).distinct().groupBy(*keys).agg(aggregate("_v").alias(name))
    same = F.lit(True)
    for b, k in zip(by, keys, strict=True):
        same &= F.col(b).eqNullSafe(F.col(k))
    return df.join(found, same, "left").drop(*keys)


def distinct_sum(df: DataFrame, value: str, by: list[str], name: str) -> DataFrame:
    """sum(DISTINCT value) over a partition, joined back."""
    return distinct_aggregate(df, F.sum, value, by, name)
