"""Aggregate functions that Spark lacks or defines otherwise.  Each is a Column of built-in aggregates."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quern.functions.registry import FUNCTIONS, alias, col, register
from quern.session import checkpointed

for _n, _as in {
    "avg": "avg", "mean": "avg", "bit_and": "bit_and", "bit_or": "bit_or", "bit_xor": "bit_xor", "bool_and": "bool_and", "bool_or": "bool_or", "count_if": "count_if", "countif": "count_if", "kurtosis_pop": "kurtosis", "median": "median",
    "stddev_pop": "stddev_pop", "stddev_samp": "stddev_samp", "stddev": "stddev_samp", "var_pop": "var_pop", "var_samp": "var_samp", "variance": "var_samp", "count": "count", "max": "max", "min": "min",
    "covar_pop": "covar_pop", "covar_samp": "covar_samp", "corr": "corr", "regr_avgx": "regr_avgx", "regr_avgy": "regr_avgy", "regr_count": "regr_count", "regr_intercept": "regr_intercept", "regr_r2": "regr_r2",
    "regr_slope": "regr_slope", "regr_sxx": "regr_sxx", "regr_sxy": "regr_sxy", "regr_syy": "regr_syy", "arg_max_null": "max_by", "arg_min_null": "min_by", "approx_count_distinct": "approx_count_distinct", "product": "product",
}.items():
    FUNCTIONS[f"agg_{_n}"] = lambda *a, _f=getattr(F, _as): _f(*map(col, a))


@register("agg_count_star")
def count_star():
    return F.count("*")


@register("agg_sum")
def sum_(x, integer: bool = False):
    """Integers add up to 128 bits (38 digits), so they don't overflow."""
    return F.sum(col(x).cast("decimal(38,0)") if integer else col(x))


@register("agg_favg", "agg_avg_double")
def favg(x):
    return F.avg(col(x).cast("double"))


@register("agg_kahan_sum", "agg_fsum", "agg_sumkahan")
def exact_sum(x, scale: int = 9):
    """A sum without rounding from term to term: fixed-point with ``scale`` digits."""
    return F.sum(col(x).cast(f"decimal(38,{scale})")).cast("double")


@register("agg_any_value")
def any_value(x):
    return F.first(col(x), ignorenulls=True)


@register("agg_first", "agg_arbitrary")
def first(x, order):
    return F.min_by(col(x), col(order))


@register("agg_last")
def last(x, order):
    return F.max_by(col(x), col(order))


def _both(x: Column, y: Column) -> Column:
    return F.when(col(x).isNotNull(), col(y))


@register("agg_arg_max", "agg_argmax", "agg_max_by")
def arg_max(x, y, n: int | None = None):
    """x at the largest y; rows with a null in either don't count.  With n: the n of the largest y."""
    if n is None:
        return F.max_by(col(x), _both(x, y))
    ordered = F.array_sort(F.collect_list(F.when(col(x).isNotNull() & col(y).isNotNull(), F.struct((-col(y)).alias("y"), col(x).alias("x")))))
    return F.transform(F.slice(ordered, 1, n), lambda s: s["x"])


@register("agg_arg_min", "agg_argmin", "agg_min_by")
def arg_min(x, y, n: int | None = None):
    if n is None:
        return F.min_by(col(x), _both(x, y))
    ordered = F.array_sort(F.collect_list(F.when(col(x).isNotNull() & col(y).isNotNull(), F.struct(col(y).alias("y"), col(x).alias("x")))))
    return F.transform(F.slice(ordered, 1, n), lambda s: s["x"])


@register("agg_arg_max_nulls_last")
def arg_max_nulls_last(x, y):
    return F.max_by(col(x), F.struct(col(y).isNotNull(), col(y)))


@register("agg_arg_min_nulls_last")
def arg_min_nulls_last(x, y):
    return F.min_by(col(x), F.struct(col(y).isNull(), col(y)))


@register("agg_max_n")
def max_n(x, n: int):
    return F.slice(F.sort_array(F.collect_list(col(x)), asc=False), 1, n)


@register("agg_min_n")
def min_n(x, n: int):
    return F.slice(F.sort_array(F.collect_list(col(x))), 1, n)


@register("agg_list", "agg_array_agg")
def list_(x, order=None):
    """Nulls are elements, too."""
    if order is None:
        return F.transform(F.collect_list(F.struct(col(x).alias("x"))), lambda s: s["x"])
    return F.transform(F.array_sort(F.collect_list(F.struct(col(order).alias("o"), col(x).alias("x")))), lambda s: s["x"])


@register("agg_string_agg", "agg_group_concat", "agg_listagg")
def string_agg(x, sep: str = ",", order=None):
    ordered = F.array_sort(F.collect_list(F.when(col(x).isNotNull(), F.struct(col(order if order is not None else x).alias("o"), col(x).alias("x")))))
    return F.when(F.count(col(x)) > 0, F.array_join(F.transform(ordered, lambda s: s["x"]), sep))


@register("agg_quantile_cont")
def quantile_cont(x, q: float | list[float]):
    return F.percentile(col(x), q)


@register("agg_quantile_disc", "agg_quantile")
def quantile_disc(x: str, q: float):
    return F.expr(f"percentile_disc({q}) WITHIN GROUP (ORDER BY {x})")


@register("agg_approx_quantile", "agg_reservoir_quantile")
def approx_quantile(x, q: float):
    return F.approx_percentile(col(x), q)


@register("agg_approx_top_k")
def approx_top_k(x, k: int):
    return F.transform(F.call_function("approx_top_k", col(x), F.lit(k)), lambda s: s["item"])


def _n(x: Column) -> Column:
    return F.count(col(x))


@register("agg_sem")
def sem(x):
    """Standard error of the mean."""
    return F.stddev_pop(col(x)) / F.sqrt(_n(x))


@register("agg_skewness")
def skewness(x):
    n = _n(x)
    return F.when(n > 2, F.skewness(col(x)) * F.sqrt(n * (n - 1)) / (n - 2))


@register("agg_kurtosis")
def kurtosis(x):
    """Excess of the sample, corrected for bias."""
    n = _n(x)
    return F.when(n > 3, (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * F.kurtosis(col(x)) + 6))


@register("agg_bitstring_agg")
def bitstring_agg(x, low: int, high: int):
    """A bit per whole number from low to high: 1 where it occurs."""
    seen = F.collect_set(col(x))
    return F.array_join(F.transform(F.sequence(F.lit(low), F.lit(high)), lambda i: F.when(F.array_contains(seen, i.cast("long")), "1").otherwise("0")), "")


#: Shares of a group's rows beyond which its median doesn't lie (another quantile: as far around it), and the accuracy of the two values there.
AROUND, ACCURACY = (0.498, 0.502), 10_000
#: Groups whose ends or medians may be broadcast.
BROADCAST_GROUPS = 100_000


def _same(keys: list[str], prefix: str) -> Column:
    same = F.lit(True)
    for k in keys:
        same &= F.col(k).eqNullSafe(F.col(f"{prefix}{k}"))
    return same


def _small(groups: DataFrame) -> DataFrame:
    """A row a group, marked for a broadcast where there are few, so that the values stay where they are."""
    return F.broadcast(groups) if groups.count() <= BROADCAST_GROUPS else groups


def _picked(values: DataFrame, ends: DataFrame, keys: list[str]) -> DataFrame:
    """(_m_ keys, i, a, b, part, sure): the values on both sides of the place of each quantile i of groups, among the values
    from low to high, and how far it lies from a to b; sure: they lie there."""
    joined = values.join(_small(ends), _same(keys, "_m_")).where("value <= high")
    named = [*[f"_m_{k}" for k in keys], "i"]
    spots = joined.groupBy(*named, "place", F.expr("if(value < low, null, value)").alias("spot")).agg(F.count("*").alias("rows"))
    upto = F.sum("rows").over(Window.partitionBy(*named).orderBy(F.asc_nulls_first("spot")).rowsBetween(Window.unboundedPreceding, 0))
    spots = spots.withColumn("upto", upto)
    at = lambda rank: F.min(F.when(F.col("upto") > rank, F.col("spot")))
    missed = F.coalesce(F.max(F.expr("spot is null and upto > floor(place)")), F.lit(False))
    found = spots.groupBy(*named).agg(at(F.floor("place")).alias("a"), at(F.ceil("place")).alias("b"), F.max(F.col("place") - F.floor("place")).alias("part"), missed.alias("missed"))
    return found.select(*named, "a", "b", "part", (~F.col("missed") & F.col("b").isNotNull()).alias("sure"))


def _beside(values: DataFrame, keys: list[str], fractions: list[float], discrete: list[float] | None = None) -> DataFrame:
    """(_m_ keys, i, a, b, part): the values on both sides of the quantiles of the column value (a double, not null), numbered
    through fractions and discrete, and how far each lies from a to b (a discrete one: at a).  No group's values are gathered:
    a sketch gives two values around a quantile, rows below are counted, and only distinct values between them are put in
    order.  Where a sketch is off, all distinct values of that group are put in order, in a sort that spills."""
    every = [*fractions, *(discrete or [])]
    shares = [min(1.0, max(0.0, q - 0.5 + share)) for q in every for share in AROUND]
    ends = values.groupBy(*[F.col(k).alias(f"_m_{k}") for k in keys]).agg(F.count("*").alias("n"), F.percentile_approx("value", shares, ACCURACY).alias("ends"))
    place = lambda i, q: ((F.col("n") - 1) * F.lit(float(q)) if i < len(fractions) else F.greatest(F.ceil(F.col("n") * F.lit(float(q))) - 1, F.lit(0))).cast("double")
    around = [F.struct(F.lit(i).alias("i"), place(i, q).alias("place"), F.col("ends")[2 * i].alias("low"), F.col("ends")[2 * i + 1].alias("high")) for i, q in enumerate(every)]
    ends = checkpointed(ends.where("n > 0").select(*[f"_m_{k}" for k in keys], F.inline(F.array(*around))))
    found = checkpointed(_picked(values, ends, keys))
    sure = found.where("sure").drop("sure")
    again = found.where("not sure").select(*[F.col(f"_m_{k}").alias(f"_again_{k}") for k in keys], F.col("i").alias("_again_i"))
    if again.isEmpty():
        return sure
    same = F.col("i") == F.col("_again_i")
    for k in keys:
        same &= F.col(f"_m_{k}").eqNullSafe(F.col(f"_again_{k}"))
    whole = ends.join(again, same, "left_semi").withColumn("low", F.lit(float("-inf"))).withColumn("high", F.lit(float("nan")))
    return sure.unionByName(_picked(values, whole, keys).drop("sure"))


def medians(values: DataFrame, keys: list[str]) -> DataFrame:
    """(_m_ keys, middle): exact medians of the column value (a double, not null)."""
    middle = F.when(F.col("a") == F.col("b"), F.col("a")).otherwise(F.col("a") * 0.5 + F.col("b") * 0.5)
    return _beside(values, keys, [0.5]).select(*[f"_m_{k}" for k in keys], middle.alias("middle"))


def _between(a: float, b: float, part: float) -> float:
    """The value at ``part`` of the way from a to b, a's share not rounded before the sum."""
    try:
        return math.fma(a, 1 - part, b * part)
    except (ValueError, OverflowError):  # infinities, or beyond the largest double
        return a * (1 - part) + b * part


def quantiles(df: DataFrame, keys: list[str], x: Column | str, fractions: list[float], discrete: list[float] | None = None) -> DataFrame:
    """(_m_ keys, quantiles): an array of the exact quantiles, between two values on the line through them, and of the
    ``discrete`` ones, each the first value that so large a share of the rows doesn't exceed.

    The last digit is that of a fused sum, which Spark's ``percentile`` (agg_quantile_cont) doesn't form."""
    values = df.select(*keys, col(x).cast("double").alias("value")).where("value is not null")
    between = F.udf(_between, "double", useArrow=False)
    one = F.when((F.col("a") == F.col("b")) | (F.col("part") == 0), F.col("a")).otherwise(between("a", "b", "part"))
    found = _beside(values, keys, fractions, discrete).select(*[f"_m_{k}" for k in keys], "i", one.alias("value"))
    found = found.groupBy(*[f"_m_{k}" for k in keys]).agg(F.array_sort(F.collect_list(F.struct("i", "value"))).alias("found"))
    return found.select(*[f"_m_{k}" for k in keys], F.transform("found", lambda s: s["value"]).alias("quantiles"))


def top_n(df: DataFrame, keys: list[str], x: Column | str, y: Column | str, n: int, largest: bool = True) -> DataFrame:
    """(_m_ keys, top): an array of x at the n largest (or smallest) y of the rows with both, in that order, as agg_arg_max and
    agg_arg_min with n; x and y alike: agg_max_n and agg_min_n.  Each task keeps n rows a group before the shuffle, so that
    no group's values are gathered."""
    named = [f"_m_{k}" for k in keys]
    values = df.select(*[F.col(k).alias(m) for k, m in zip(keys, named, strict=True)], col(x).alias("x"), col(y).alias("y")).where("x is not null and y is not null")
    place = F.row_number().over(Window.partitionBy(*named).orderBy(F.desc("y") if largest else F.asc("y"), "x"))
    kept = values.withColumn("place", place).where(F.col("place") <= n)
    return kept.groupBy(*named).agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "x"))), lambda s: s["x"]).alias("top"))


def mad(df: DataFrame, keys: list[str], x: Column | str) -> DataFrame:
    """(keys, mad): the median of the distances from the group's median, joined back."""
    values = df.select(*keys, col(x).cast("double").alias("value")).where("value is not null")
    distances = values.join(_small(medians(values, keys)), _same(keys, "_m_")).select(*keys, F.abs(F.col("value") - F.col("middle")).alias("value"))
    found = medians(distances, keys)
    return found.select(*[F.col(f"_m_{k}").alias(k) for k in keys], F.col("middle").alias("mad"))


# Aggregates over the counts of values: two levels, so that no group's rows are gathered.
def value_counts(df: DataFrame, keys: list[str], x: Column | str) -> DataFrame:
    """(keys, value, n) for the values of x that aren't null."""
    return df.select(*keys, col(x).alias("value")).where("value is not null").groupBy(*keys, "value").agg(F.count("*").alias("n"))


def histogram(df: DataFrame, keys: list[str], x: Column | str) -> DataFrame:
    """(keys, histogram): a map from value to number of rows, in the order of values."""
    return value_counts(df, keys, x).groupBy(*keys).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("value", "n")))).alias("histogram"))


def histogram_exact(df: DataFrame, keys: list[str], x: Column | str, bins: list) -> DataFrame:
    """(keys, histogram): rows whose value is each of the bins."""
    found = [F.struct(F.lit(b).alias("value"), F.sum(F.when(F.col("value") == b, F.col("n")).otherwise(0)).alias("n")) for b in bins]
    return value_counts(df, keys, x).groupBy(*keys).agg(F.map_from_entries(F.array(*found)).alias("histogram"))


def histogram_bins(df: DataFrame, x: Column | str, low: float, high: float, n: int) -> DataFrame:
    """(bin, count): rows per bin of equal width, a bin's upper bound included."""
    width = (high - low) / n
    upper = F.lit(low) + F.greatest(F.ceil((col(x) - low) / width), F.lit(1)) * width
    return df.select(upper.alias("bin")).where("bin is not null").groupBy("bin").agg(F.count("*").alias("count"))


def entropy(df: DataFrame, keys: list[str], x: Column | str) -> DataFrame:
    """(keys, entropy) in bits."""
    counts = value_counts(df, keys, x)
    n = F.sum("n")
    return counts.groupBy(*keys).agg((F.log2(n) - F.sum(F.col("n") * F.log2("n")) / n).alias("entropy"))


def mode(df: DataFrame, keys: list[str], x: Column | str, order: Column | str) -> DataFrame:
    """(keys, mode): the commonest value; of equally common ones that which comes first in ``order``."""
    counts = df.select(*keys, col(x).alias("value"), col(order).alias("o")).where("value is not null").groupBy(*keys, "value").agg(F.count("*").alias("n"), F.min("o").alias("o"))
    return counts.groupBy(*keys).agg(F.min_by("value", F.struct(-F.col("n"), F.col("o"))).alias("mode"))


@register("agg_weighted_avg", "agg_wavg")
def weighted_avg(x, weight):
    """Of rows with both a value and a weight."""
    both = col(x).isNotNull() & col(weight).isNotNull()
    return F.sum(F.when(both, col(x) * col(weight))) / F.sum(F.when(both, col(weight)))


@register("agg_geomean", "agg_geometric_mean")
def geomean(x):
    return F.exp(F.avg(F.ln(col(x))))


def histogram_values(df: DataFrame, x: Column | str, bins: list) -> DataFrame:
    """(bin, count): rows per bin, whose upper bound is included, and of values beyond the last one (bin null)."""
    upper = F.lit(None)
    for b in sorted(bins, reverse=True):
        upper = F.when(col(x) <= b, F.lit(b)).otherwise(upper)
    found = df.where(col(x).isNotNull()).select(upper.alias("bin")).groupBy("bin").agg(F.count("*").alias("count"))
    empty = df.sparkSession.createDataFrame([(b,) for b in bins], f"bin {found.schema['bin'].dataType.simpleString()}")
    return empty.join(found, "bin", "left").select("bin", F.coalesce("count", F.lit(0)).alias("count")).unionByName(found.where("bin IS NULL"))


alias("agg_list", "agg_collect")
