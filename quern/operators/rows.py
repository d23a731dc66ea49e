"""Row-wise operators: numbering, distinct on, qualify, samples, star expressions, unnesting, pivots, summaries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quern.session import checkpointed


def numbered(df: DataFrame, order: list[str], name: str = "row_number") -> DataFrame:
    """``df`` with each row's place (from 1) in a total order, without bringing all rows to one task.

    Rows are sorted in ranges; a range's first number comes from the counts of those before it.
    """
    # Written once: a second evaluation might deal the rows to ranges otherwise.
    placed = checkpointed(df.orderBy(*order).withColumn("_id", F.monotonically_increasing_id()).withColumn("_part", F.shiftright("_id", 33)))
    counts = placed.groupBy("_part").agg(F.count("*").alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = counts.select("_part", before.alias("_start"))
    out = placed.join(F.broadcast(starts), "_part").withColumn(name, F.col("_id") - F.shiftleft("_part", 33) + F.col("_start") + 1)
    return out.select(*df.columns, name)


def distinct_on(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """Of each key's rows the first in ``order``: a minimum of which one a key and task is shuffled (Spark sorts by the key)."""
    names = [f"_o{i}" for i in range(len(order))]
    given = df.select("*", *[o.alias(n) for o, n in zip(order, names, strict=True)])
    rest = [c for c in df.columns if c not in keys]
    best = given.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*names)).alias("_row"))
    return best.select(*keys, "_row.*").select(*df.columns)


def qualify(df: DataFrame, condition: Column) -> DataFrame:
    """Rows for which a condition over window functions holds."""
    return df.withColumn("_qualify", condition).where("_qualify").drop("_qualify")


def sample_rows(df: DataFrame, n: int, seed: int = 0) -> DataFrame:
    """A reservoir of n rows: those with the smallest random numbers."""
    return df.withColumn("_r", F.rand(seed)).orderBy("_r").limit(n).drop("_r")


def sample_percent(df: DataFrame, percent: float, seed: int = 0) -> DataFrame:
    return df.sample(fraction=percent / 100, seed=seed)


def limit_percent(df: DataFrame, percent: float, order: list[Column]) -> DataFrame:
    """The first share of the rows in ``order``."""
    return df.orderBy(*order).limit(int(df.count() * percent / 100))


def columns(df: DataFrame, choose: str | Callable[[str], bool]) -> list[str]:
    """Names that a regular expression matches whole, or that a function is true for."""
    import re

    test = choose if callable(choose) else re.compile(choose).fullmatch
    return [c for c in df.columns if test(c)]


def star(df: DataFrame, exclude: list[str] | None = None, replace: dict[str, Column] | None = None, rename: dict[str, str] | None = None) -> DataFrame:
    """``*`` with columns left out, computed anew or renamed."""
    replace, rename = replace or {}, rename or {}
    return df.select(*[replace.get(c, F.col(c)).alias(rename.get(c, c)) for c in df.columns if c not in (exclude or [])])


def unnest(df: DataFrame, lists: list[str]) -> DataFrame:
    """Lists side by side as rows, shorter ones filled up with nulls; rows whose lists are all empty go."""
    rest = [c for c in df.columns if c not in lists]
    return df.select(*rest, F.explode(F.arrays_zip(*lists)).alias("_z")).select(*rest, *[F.col(f"_z.{c}") for c in lists])


def unnest_recursive(df: DataFrame, column: str) -> DataFrame:
    """Lists of lists to single rows, structs to columns."""
    while True:
        kind = df.schema[column].dataType.typeName()
        if kind == "array":
            df = df.withColumn(column, F.explode(column))
        elif kind == "struct":
            return df.select(*[c for c in df.columns if c != column], f"{column}.*")
        else:
            return df


def pivot(df: DataFrame, keys: list[str], on: str, value: Column, values: list | None = None) -> DataFrame:
    """A column per value of ``on``; without ``values`` a first pass finds them (Spark fails beyond its limit of values)."""
    return df.groupBy(*keys).pivot(on, values).agg(value)


def unpivot(df: DataFrame, keys: list[str], columns_: list[str], name: str = "name", value: str = "value", include_nulls: bool = False) -> DataFrame:
    out = df.unpivot(keys, columns_, name, value)
    return out if include_nulls else out.where(F.col(value).isNotNull())


def summarize(df: DataFrame) -> DataFrame:
    """A row per column: type, min, max, unique values (estimate), avg, std, quartiles (estimates), count, share of nulls."""
    out = []
    for field in df.schema.fields:
        c, numeric = F.col(f"`{field.name}`"), field.dataType.typeName() in ("integer", "long", "double", "float", "short", "byte", "decimal")
        number = lambda e: e.cast("string") if numeric else F.lit(None).cast("string")  # noqa: B023, E731
        q = F.approx_percentile(c, [0.25, 0.5, 0.75]) if numeric else F.array(*[F.lit(None)] * 3)
        out.append(F.struct(
            F.lit(field.name).alias("column_name"), F.lit(field.dataType.simpleString()).alias("column_type"), F.min(c).cast("string").alias("min"), F.max(c).cast("string").alias("max"),
            F.approx_count_distinct(c).alias("approx_unique"), number(F.avg(c) if numeric else F.lit(None)).alias("avg"), number(F.stddev_samp(c) if numeric else F.lit(None)).alias("std"),
            q[0].cast("string").alias("q25"), q[1].cast("string").alias("q50"), q[2].cast("string").alias("q75"), F.count("*").alias("count"),
            F.round(100 * (1 - F.count(c) / F.count("*")), 2).alias("null_percentage"),
        ))
    return df.agg(F.array(*out).alias("s")).select(F.inline("s"))
