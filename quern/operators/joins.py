"""Joins that Spark has no operator for: as-of, range, interval overlap, positional, any/all comparisons."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quern.operators.rows import numbered
from quern.session import checkpointed

LIST_ROWS = 256  # rows of a list in joins of intervals: a power of two
CHUNK_ROWS = 1024  # single rows that a list meets at once: a power of two
TASK_ROWS = 1 << 14  # rows in the lists of a task, while there are no more than MOST_TASKS
TASK_PAIRS = 1 << 25  # pairs of a task, under the same condition
MOST_TASKS = 4096
BROADCAST_ROWS = 1 << 20

def _number(df: DataFrame, name: str) -> Column:
    """A time (in seconds) or number as a double that keeps its order."""
    c = F.col(name)
    return (c.cast("timestamp") if df.schema[name].dataType.typeName() in ("date", "timestamp", "timestamp_ntz") else c).cast("double")


def _stretch(t: Column, cuts: list[float]) -> Column:
    """How many of the sorted cuts are at most t, by halving."""

    def among(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(t < cuts[middle], among(low, middle)).otherwise(among(middle + 1, high))

    return F.when(t.isNotNull(), among(0, len(cuts)))


def asof_join(
    left: DataFrame, right: DataFrame, left_on: str, right_on: str, by: list[tuple[str, str]] | None = None, how: str = "left", op: str = ">=", buckets: int = 64
) -> DataFrame:
    """Each left row with the nearest right row for which ``left_on op right_on`` and the pairs ``by`` are equal.

    Rows with a null key or time match nothing.  how: inner, left, right, outer, semi or anti.  Of right rows at the same
    time any one may match.  Column names of the two sides must differ.

    Both sides are laid out by key and by one of ``buckets`` stretches of time with about as many rows, so that one key's
    rows are spread over tasks; a stretch takes over the last right row of those before it, found from one row each.
    Whole numbers and decimals are compared as such, also where a double can't tell them apart.
    """
    if op not in (">=", ">", "<=", "<"):
        raise ValueError("an as-of join takes one inequality: >=, >, <= or <")
    by = by or []
    forward = 1 if op[0] == ">" else -1
    rights = right.columns
    times = left.select(_number(left, left_on).alias("t")).unionByName(right.select(_number(right, right_on).alias("t")))
    cuts = times.agg(F.approx_percentile("t", [i / buckets for i in range(1, buckets)], 1000)).first()[0]  # one short row
    cuts = sorted(set(cuts or []))
    keys = [f"_k{i}" for i in range(len(by))]
    strict = len(op) == 1
    # At one time right rows come first, unless the comparison is strict.
    l = left.select(*[F.col(a).alias(k) for (a, _), k in zip(by, keys, strict=True)], F.col(left_on).alias("_t"), F.lit(1 - strict).alias("_side"), F.struct(*left.columns).alias("_l"), F.lit(None).cast(right.schema.simpleString()).alias("_r"))
    r = right.select(*[F.col(b).alias(k) for (_, b), k in zip(by, keys, strict=True)], F.col(right_on).alias("_t"), F.lit(int(strict)).alias("_side"), F.lit(None).cast(left.schema.simpleString()).alias("_l"), F.struct(*rights).alias("_r"))
    known = F.col("_t").isNotNull()
    for k in keys:
        known &= F.col(k).isNotNull()
    both = l.unionByName(r.where(known))
    # A stretch by a number that follows the time's order; within it the times themselves are compared.
    both = both.withColumn("_b", F.coalesce(_stretch(_number(both, "_t"), cuts) * forward, F.lit(0)))
    best = F.max_by if forward > 0 else F.min_by
    ends = both.where("_r is not null").groupBy(*keys, "_b").agg(best("_r", F.col("_t")).alias("_end"))
    before = Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    spots = both.select(*keys, "_b").distinct().join(ends, [*keys, "_b"], "left").withColumn("_carry", F.last("_end", ignorenulls=True).over(before))
    spots = spots.select(*[F.col(k).alias(f"_s{k}") for k in keys], F.col("_b").alias("_sb"), "_carry")
    same = F.col("_b") == F.col("_sb")
    for k in keys:
        same &= F.col(k).eqNullSafe(F.col(f"_s{k}"))
    laid = both.join(spots, same, "left").select(*keys, "_b", "_t", "_side", "_l", "_r", "_carry")
    inside = Window.partitionBy(*keys, "_b").orderBy(F.col("_t") if forward > 0 else F.desc("_t"), "_side").rowsBetween(Window.unboundedPreceding, 0)
    found = laid.withColumn("_m", F.coalesce(F.last("_r", ignorenulls=True).over(inside), "_carry")).where("_l is not null")
    found = found.withColumn("_m", F.when(known, F.col("_m")))
    if how == "semi":
        return found.where("_m is not null").select("_l.*")
    if how == "anti":
        return found.where("_m is null").select("_l.*")
    if how in ("inner", "right"):
        out = found.where("_m is not null").select("_l.*", "_m.*")
    else:
        out = found.select("_l.*", "_m.*")
    if how in ("right", "outer"):
        used = found.where("_m is not null").select(F.col("_m").alias("_u")).distinct()
        rest = right.select(F.struct(*rights).alias("_r")).join(used, F.col("_r") == F.col("_u"), "left_anti")
        out = out.unionByName(rest.select("_r.*"), allowMissingColumns=True).select(*out.columns)
    return out


def _binned(df: DataFrame, low: str, high: str, width: float) -> DataFrame:
    """A row per bin of ``width`` that low..high touches; empty intervals go."""
    bins = F.sequence(F.floor(_number(df, low) / width), F.floor(_number(df, high) / width))
    return df.where(F.col(low) <= F.col(high)).withColumn("_bin", F.explode(bins))


def _numbered_in(df: DataFrame, columns: list[str], low: str, high: str, n: int, size: int, name: str) -> DataFrame:
    """Binned rows laid out in ``n`` ranges of their bounds, with a number (``name``) that up to ``size`` neighbours share."""
    others = [c for c in columns if c not in (low, high) and df.schema[c].dataType.typeName() not in ("map", "variant")]
    order = list(dict.fromkeys(["_bin", "_begins", low, high, *others]))  # all columns, so that a task run again numbers its rows alike
    laid = df.repartitionByRange(n, *order).sortWithinPartitions(*order)
    return laid.withColumn(name, F.shiftright(F.monotonically_increasing_id(), size.bit_length() - 1))


def _meeting(a: DataFrame, b: DataFrame, a_low: str, a_high: str, b_low: str, b_high: str, width: float) -> DataFrame:
    """Pairs of rows whose intervals meet, each made in the bin where the later one begins.

    There may be as many pairs as the product of both sides.  So lists of neighbours of the larger side meet single rows of
    the smaller one, and are unfolded only then: what is compared and moved is far less than what comes out, and a list comes
    out again and again in the same order next to runs of one row, which columnar files hold in little space.

    Spark holds all that comes of one row of a stage at once.  So the smaller side is cut into chunks of neighbours of one
    bin that all begin in it or all before, and a list is of the rows that may meet one chunk: however many rows a bin has,
    no more than LIST_ROWS * CHUNK_ROWS pairs are held.
    """
    x = _binned(a, a_low, a_high, width).withColumn("_begins", F.col("_bin") == F.floor(_number(a, a_low) / width))
    y = _binned(b, b_low, b_high, width).withColumn("_begins", F.col("_bin") == F.floor(_number(b, b_low) / width))
    n, m = x.count(), y.count()
    many, few = (x, a.columns, a_low, a_high), (y, b.columns, b_low, b_high)
    if n < m:
        many, few = few, many
    many, folded, m_low, m_high = many
    few, alone, low, high = few
    cores = many.sparkSession.sparkContext.defaultParallelism
    few = checkpointed(_numbered_in(few, alone, low, high, max(1, min(max(cores, min(n, m) // TASK_ROWS), MOST_TASKS)), CHUNK_ROWS, "_run"))  # numbers differ from run to run
    few = few.withColumnsRenamed({"_bin": "_there", "_begins": "_starts", "_run": "_in"})
    parts = ["_there", "_starts", "_in"]
    chunks = few.groupBy(*parts).agg(F.min(low).alias("_lowest"), F.max(high).alias("_highest"), F.count("*").alias("_singles"))
    bins = few.select(F.col("_there").alias("_bin")).distinct()
    if min(n, m) <= BROADCAST_ROWS:
        few, chunks, bins = F.broadcast(few), F.broadcast(chunks), F.broadcast(bins)
    many = many.join(bins, "_bin", "left_semi")
    near = (F.col("_bin") == F.col("_there")) & (F.col("_begins") | F.col("_starts")) & (F.col(m_low) <= F.col("_highest")) & (F.col("_lowest") <= F.col(m_high))
    held = many.join(chunks, near).agg(F.count("*"), F.sum(F.col("_singles").cast("double"))).first()
    rows, pairs = held[0], int(held[1] or 0)
    tasks = min(max(cores, rows // TASK_ROWS, min(pairs // TASK_PAIRS, rows // LIST_ROWS)), MOST_TASKS)
    laid = _numbered_in(many, folded, m_low, m_high, min(max(cores, max(n, m) // TASK_ROWS), MOST_TASKS), LIST_ROWS, "_list").join(chunks, near)
    lists = laid.repartitionByRange(tasks, "_list", *parts).groupBy("_list", *parts)
    lists = lists.agg(F.min(m_low).alias("_least"), F.max(m_high).alias("_most"), F.collect_list(F.struct(*folded)).alias("_rows"))
    here = F.lit(True)
    for c in parts:
        here &= F.col(f"_lists.{c}") == F.col(f"_few.{c}")
    met = lists.alias("_lists").join(few.alias("_few"), here & (F.col("_least") <= F.col(f"_few.`{high}`")) & (F.col(f"_few.`{low}`") <= F.col("_most")))
    alone = [F.col(f"_few.`{c}`") for c in alone]
    out = met.select(F.inline("_rows"), *alone) if n >= m else met.select(*alone, F.inline("_rows"))
    return out.where((F.col(a_low) <= F.col(b_high)) & (F.col(b_low) <= F.col(a_high)))


def range_join(points: DataFrame, intervals: DataFrame, point: str, low: str, high: str, width: float, how: str = "inner") -> DataFrame:
    """Points with the intervals for which low <= point <= high.

    Both are cut into bins of ``width``, so the join is by equality of bins; the bounds are checked within.
    """
    if how == "inner":
        return _meeting(points, intervals, point, point, low, high, width)
    a = points.withColumn("_bin", F.floor(_number(points, point) / width))
    b = _binned(intervals, low, high, width)
    on = (a["_bin"] == b["_bin"]) & (F.col(point) >= F.col(low)) & (F.col(point) <= F.col(high))
    out = a.join(b, on, how)
    return out.drop(a["_bin"]) if how in ("left_semi", "left_anti") else out.drop("_bin")


def overlap_join(a: DataFrame, b: DataFrame, a_low: str, a_high: str, b_low: str, b_high: str, width: float) -> DataFrame:
    """Pairs of intervals that overlap (two range predicates).  A pair is made in the bin where the later one begins."""
    return _meeting(a, b, a_low, a_high, b_low, b_high, width)


def positional_join(left: DataFrame, right: DataFrame, left_order: list[str], right_order: list[str]) -> DataFrame:
    """Rows side by side by their place in the given orders; the shorter side is filled up with nulls."""
    a, b = numbered(left, left_order, "_place"), numbered(right, right_order, "_place")
    return a.join(b, "_place", "full").drop("_place")


def compare_all(df: DataFrame, column: str, op: str, other: DataFrame, value: str, every: bool) -> DataFrame:
    """Rows for which ``column op`` all (or any) of the other's values holds; op: < <= > >=.  Nulls as in SQL.

    One bound of the other side decides, which is a single row.
    """
    bound = (F.min if (op[0] == "<") == every else F.max)(value)
    edge = other.agg(bound.alias("_edge"), F.count("*").alias("_n"), F.count(value).alias("_known"))
    true = {"<": F.col(column) < F.col("_edge"), "<=": F.col(column) <= F.col("_edge"), ">": F.col(column) > F.col("_edge"), ">=": F.col(column) >= F.col("_edge")}[op]
    holds = ((F.col("_n") == 0) | (true & (F.col("_n") == F.col("_known")))) if every else true
    return df.crossJoin(F.broadcast(edge)).where(holds).drop("_edge", "_n", "_known")  # the edge is one row
