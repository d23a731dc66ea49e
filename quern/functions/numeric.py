"""Numeric functions.  Where Spark has the function with the same results it is used as it is."""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quern.functions.registry import FUNCTIONS, alias, col, register

for _n in "atan atan2 atanh bit_count cbrt cos cosh cot degrees exp radians sin sinh tan tanh asinh".split():
    FUNCTIONS[_n] = lambda *a, _f=getattr(F, _n): _f(*map(col, a))
FUNCTIONS["pi"] = F.pi


def _domain(x: Column, ok: Column, value: Column, what: str) -> Column:
    """``value`` where ok (or null); elsewhere the query fails, as out-of-domain arguments must."""
    return F.when(x.isNull() | ok, value).otherwise(F.raise_error(F.lit(f"{what} is undefined there")).cast("double"))


@register()
def acos(x):
    x = col(x).cast("double")
    return _domain(x, F.isnan(x) | (F.abs(x) <= 1), F.acos(x), "acos")


@register()
def asin(x):
    x = col(x).cast("double")
    return _domain(x, F.isnan(x) | (F.abs(x) <= 1), F.asin(x), "asin")


@register()
def acosh(x):
    return F.acosh(col(x))


@register()
def sqrt(x):
    x = col(x).cast("double")
    return _domain(x, F.isnan(x) | (x >= 0), F.sqrt(x), "sqrt")


@register()
def ln(x):
    x = col(x).cast("double")
    return _domain(x, F.isnan(x) | (x > 0), F.ln(x), "ln")


@register()
def log10(x):
    x = col(x).cast("double")
    return _domain(x, F.isnan(x) | (x > 0), F.log10(x), "log10")


@register()
def log2(x):
    x = col(x).cast("double")
    return _domain(x, F.isnan(x) | (x > 0), F.log2(x), "log2")


@register()
def log(*args):
    """One argument: base 10.  Two: base, then value."""
    return log10(args[0]) if len(args) == 1 else ln(args[1]) / ln(args[0])


@register("abs", "@")
def abs_(x):
    return F.abs(col(x))


@register("pow", "power", "**", "^")
def pow_(x, y):
    return F.pow(col(x).cast("double"), col(y).cast("double"))


@register("ceil", "ceiling")
def ceil(x):
    """Of a double a double, of an integer itself."""
    return F.ceil(col(x)).cast("double")


@register()
def floor(x):
    return F.floor(col(x)).cast("double")


@register()
def trunc(x):
    x = col(x)
    return F.when(x >= 0, F.floor(x)).otherwise(F.ceil(x)).cast("double")


@register("round")
def round_(x, n=0):
    return F.round(col(x), n)


@register("round_even", "roundbankers")
def round_even(x, n=0):
    return F.bround(col(x), n)


@register()
def even(x):
    """The next even integer away from zero."""
    x = col(x)
    return (F.signum(x) * F.ceil(F.abs(x) / 2) * 2).cast("double")


@register()
def sign(x):
    return F.signum(col(x)).cast("tinyint")


@register()
def signbit(x):
    x = col(x).cast("double")
    return (x < 0) | ((x == 0) & F.startswith(x.cast("string"), F.lit("-")))


@register()
def isnan(x):
    x = col(x)
    return F.when(x.isNotNull(), F.isnan(x))


@register()
def isinf(x):
    return F.abs(col(x).cast("double")) == F.lit(float("inf"))


@register()
def isfinite(x):
    x = col(x).cast("double")
    return ~isnan(x) & ~isinf(x)


@register("+", "add")
def add(x, y):
    return col(x) + col(y)


@register("-", "subtract")
def subtract(x, y):
    return col(x) - col(y)


@register("*", "multiply")
def multiply(x, y):
    return col(x) * col(y)


@register("/")
def divide(x, y):
    """Always floating: a zero divisor gives an infinity, or NaN for 0 / 0."""
    x, y = col(x).cast("double"), col(y).cast("double")
    by_zero = F.when((x == 0) | F.isnan(x), F.lit(float("nan"))).otherwise(F.signum(x) * F.lit(float("inf")))
    return F.when(y == 0, by_zero).otherwise(F.try_divide(x, y))


@register("//", "divide")
def int_divide(x, y):
    """Integer division; a zero divisor gives null."""
    x, y = col(x), col(y)
    return F.call_function("div", x, F.when(y != 0, y))


@register("%", "mod", "fmod")
def mod(x, y):
    """The sign is the dividend's; a zero divisor gives null."""
    return F.try_mod(col(x), col(y))


@register()
def fdiv(x, y):
    return F.floor(divide(x, y)).cast("double")


@register("&")
def bit_and(x, y):
    return col(x).bitwiseAND(col(y))


@register("|")
def bit_or(x, y):
    return col(x).bitwiseOR(col(y))


@register()
def xor(x, y):
    return col(x).bitwiseXOR(col(y))


@register("~")
def bit_not(x):
    return F.bitwise_not(col(x))


@register("<<")
def shift_left(x, n: int):
    return F.shiftleft(col(x), n)


@register(">>")
def shift_right(x, n: int):
    return F.shiftright(col(x), n)


@register("factorial", "!__postfix")
def factorial(x):
    """Exact up to 33!, by the gamma function's table of products."""
    x = col(x)
    table = F.array(*[F.lit(str(math.factorial(i))).cast("decimal(38,0)") for i in range(34)])
    return F.when(x < 0, 1).otherwise(F.get(table, x.cast("int")))


@register("gcd", "greatest_common_divisor")
def gcd(x, y):
    """Euclid's steps, at most as many as a 64-bit number can take."""
    start = F.struct(F.abs(col(x).cast("long")).alias("a"), F.abs(col(y).cast("long")).alias("b"))
    step = lambda s, _: F.struct(F.when(s["b"] == 0, s["a"]).otherwise(s["b"]).alias("a"), F.coalesce(F.try_mod(s["a"], s["b"]), F.lit(0).cast("long")).alias("b"))
    return F.when(col(x).isNotNull() & col(y).isNotNull(), F.aggregate(F.sequence(F.lit(1), F.lit(92)), start, step, lambda s: s["a"]))


@register("lcm", "least_common_multiple")
def lcm(x, y):
    x, y = col(x).cast("long"), col(y).cast("long")
    return F.when((x == 0) | (y == 0), F.lit(0).cast("long")).otherwise(F.abs(F.call_function("div", x, gcd(x, y)) * y))


@F.pandas_udf(T.DoubleType())
def _gamma(x: pd.Series) -> pd.Series:
    return x.map(math.gamma, na_action="ignore")


@F.pandas_udf(T.DoubleType())
def _lgamma(x: pd.Series) -> pd.Series:
    return x.map(math.lgamma, na_action="ignore")


@F.pandas_udf(T.DoubleType())
def _nextafter(x: pd.Series, y: pd.Series) -> pd.Series:
    return pd.Series([None if pd.isna(a) or pd.isna(b) else math.nextafter(a, b) for a, b in zip(x, y, strict=True)])


FUNCTIONS["gamma"] = lambda x: _gamma(col(x).cast("double"))
FUNCTIONS["lgamma"] = lambda x: _lgamma(col(x).cast("double"))
FUNCTIONS["nextafter"] = lambda x, y: _nextafter(col(x).cast("double"), col(y).cast("double"))


@register()
def greatest(*xs):
    return F.greatest(*map(col, xs))


@register()
def least(*xs):
    return F.least(*map(col, xs))


@register()
def equi_width_bins(low: float, high: float, n: int):
    """Upper bounds of n bins of equal width."""
    return F.transform(F.sequence(F.lit(1), F.lit(n)), lambda i: F.lit(low) + i * (F.lit(high) - F.lit(low)) / n)


alias("xor", "bitwise_xor")
