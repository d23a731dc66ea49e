"""INSERT ... ON CONFLICT, UPDATE, DELETE and MERGE as rewrites of an immutable table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def insert(target: DataFrame, rows: DataFrame, keys: list[str] | None = None, on_conflict: str = "error") -> DataFrame:
    """By name.  on_conflict: error, nothing or update (the new row's values win)."""
    rows = rows.select(*[F.col(c) if c in rows.columns else F.lit(None).alias(c) for c in target.columns])
    if not keys:
        return target.unionByName(rows)
    if on_conflict == "nothing":
        return target.unionByName(rows.join(target, keys, "left_anti"))
    if on_conflict == "update":
        return target.join(rows, keys, "left_anti").unionByName(rows)
    twice = target.select(*keys).unionByName(rows.select(*keys)).groupBy(*keys).count().where("count > 1")
    if not twice.isEmpty():
        raise ValueError("a key is there already")
    return target.unionByName(rows)


def update(target: DataFrame, where: Column, changes: dict[str, Column]) -> DataFrame:
    return target.select(*[F.when(where, changes[c]).otherwise(F.col(c)).alias(c) if c in changes else F.col(c) for c in target.columns])


def delete(target: DataFrame, where: Column) -> DataFrame:
    """Rows for which the condition is false or null stay."""
    return target.where(~F.coalesce(where, F.lit(False)))


def merge(target: DataFrame, source: DataFrame, keys: list[str], matched: dict[str, Column] | None = None, delete_when: Column | None = None, not_matched: dict[str, Column] | None = None, not_matched_by_source: str = "keep") -> DataFrame:
    """MERGE INTO: conditions and values name target columns as ``t.x`` and source columns as ``s.x``.  A full outer join decides."""
    t, s = target.withColumn("_t", F.lit(True)).alias("t"), source.withColumn("_s", F.lit(True)).alias("s")
    on = F.lit(True)
    for k in keys:
        on &= F.col(f"t.{k}") == F.col(f"s.{k}")
    both = t.join(s, on, "full")
    in_t, in_s = F.col("t._t").isNotNull(), F.col("s._s").isNotNull()
    gone = F.lit(False)
    if delete_when is not None:
        gone |= in_t & in_s & F.coalesce(delete_when, F.lit(False))
    if not_matched_by_source == "delete":
        gone |= in_t & ~in_s
    if not_matched is None:
        gone |= ~in_t
    value = lambda c: F.when(in_t & in_s, (matched or {}).get(c, F.col(f"t.{c}"))).when(in_t, F.col(f"t.{c}")).otherwise((not_matched or {}).get(c, F.lit(None)))
    return both.where(~gone).select(*[value(c).alias(c) for c in target.columns])
