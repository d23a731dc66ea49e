"""Column helpers by the names that data-frame users know: casts, arithmetic, strings, dates, aggregates, and null-strict semantics.

Names with a dot are written with an underscore (``as_numeric``).  Strings name columns, as everywhere here; other
values are literals.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quern.functions.registry import FUNCTIONS, call, col

VERBS: dict[str, object] = {}


def verb(*names: str):
    def keep(fn):
        for n in names or (fn.__name__.rstrip("_"),):
            VERBS[n] = fn
        return fn

    return keep


for _name, _type in {
    "as_numeric": "double", "as_double": "double", "as_character": "string", "as_logical": "boolean", "as_raw": "binary", "as_Date": "date",
    "as_POSIXct": "timestamp_ntz", "as_integer64": "bigint", "as_date": "date", "as_datetime": "timestamp_ntz",
}.items():
    VERBS[_name] = lambda x, _t=_type: col(x).cast(_t)
VERBS["as_integer"] = lambda x: F.rint(col(x).cast("double")).cast("int")


# Arithmetic: R's modulus has the divisor's sign, its whole division rounds down.
@verb("%%")
def modulus(x, y):
    x, y = col(x), col(y)
    return x - y * F.floor(x / F.nullif(y, F.lit(0)))


@verb("%/%")
def whole_division(x, y):
    return F.floor(col(x) / F.nullif(col(y), F.lit(0)))


VERBS["^"] = lambda x, y: F.pow(col(x), col(y))
VERBS["bitwOr"] = lambda x, y: col(x).bitwiseOR(col(y))
VERBS["bitwAnd"] = lambda x, y: col(x).bitwiseAND(col(y))
VERBS["bitwXor"] = lambda x, y: col(x).bitwiseXOR(col(y))
VERBS["bitwNot"] = lambda x: F.bitwise_not(col(x))
VERBS["bitwShiftL"] = lambda x, n: F.shiftleft(col(x), n)
VERBS["bitwShiftR"] = lambda x, n: F.shiftright(col(x), n)
VERBS["log10"], VERBS["log2"] = (lambda x: call("log10", x)), (lambda x: call("log2", x))
VERBS["round"] = lambda x, digits=0: F.bround(col(x), digits)
VERBS["is_nan"] = lambda x: F.coalesce(F.isnan(col(x)), F.lit(False))
VERBS["is_infinite"] = lambda x: F.coalesce(F.abs(col(x)) == float("inf"), F.lit(False))
VERBS["is_finite"] = lambda x: F.coalesce(~F.isnan(col(x)) & (F.abs(col(x)) != float("inf")), F.lit(False))
VERBS["is_distinct_from"] = lambda x, y: ~col(x).eqNullSafe(col(y))
VERBS["is_not_distinct_from"] = lambda x, y: col(x).eqNullSafe(col(y))


@verb("log")
def log(x, base: float | None = None):
    return call("ln", x) if base is None else call("ln", x) / F.ln(F.lit(float(base)))


# Strings.
VERBS["grepl"] = lambda pattern, x: F.regexp_like(col(x), F.lit(pattern))
VERBS["str_detect"] = lambda x, pattern: F.regexp_like(col(x), F.lit(pattern))
VERBS["str_ilike"] = lambda x, pattern: col(x).ilike(pattern)
VERBS["regexpr"] = lambda pattern, x: F.when(F.regexp_like(col(x), F.lit(pattern)), F.length(F.regexp_substr(col(x), F.lit(f"^(?s:.*?)(?={pattern})"))) + 1).otherwise(-1)
VERBS["str_replace"] = lambda x, pattern, new: call("regexp_replace", x, pattern, new)
VERBS["str_replace_all"] = lambda x, pattern, new: F.regexp_replace(col(x), pattern, new)
VERBS["str_remove"] = lambda x, pattern: call("regexp_replace", x, pattern, "")
VERBS["str_remove_all"] = lambda x, pattern: F.regexp_replace(col(x), pattern, "")
VERBS["str_squish"] = lambda x: F.trim(F.regexp_replace(col(x), r"\s+", " "))
VERBS["str_to_sentence"] = lambda x: F.concat(F.upper(F.substring(col(x), 1, 1)), F.lower(F.substring(col(x), 2, 1 << 30)))
VERBS["str_starts"] = lambda x, pattern: F.regexp_like(col(x), F.lit(f"^(?:{pattern})"))
VERBS["str_ends"] = lambda x, pattern: F.regexp_like(col(x), F.lit(f"(?:{pattern})$"))
VERBS["paste"] = lambda *x, sep=" ": F.concat_ws(sep, *[col(v).cast("string") for v in x])
VERBS["paste0"] = lambda *x: F.concat_ws("", *[col(v).cast("string") for v in x])
VERBS["str_c"] = lambda *x, sep="": F.concat_ws(sep, *[col(v).cast("string") for v in x])


@verb()
def str_pad(x, width: int, side: str = "left", pad: str = " "):
    x = col(x)
    longer = F.greatest(F.length(x), F.lit(width))
    if side == "left":
        return F.lpad(x, longer, F.lit(pad))
    if side == "right":
        return F.rpad(x, longer, F.lit(pad))
    raise ValueError("side is left or right")


# Dates.
for _name in ("seconds", "minutes", "hours", "days", "weeks", "months", "years"):
    VERBS[_name] = lambda n, _f=FUNCTIONS[f"to_{_name}"]: _f(F.lit(n) if not isinstance(n, (str, Column)) else n)
VERBS["yday"] = lambda x: F.dayofyear(col(x))
VERBS["get_year"], VERBS["get_month"], VERBS["get_day"] = (lambda x: F.year(col(x))), (lambda x: F.month(col(x))), (lambda x: F.day(col(x)))
VERBS["add_days"] = lambda x, n: F.date_add(col(x), col(n))
VERBS["add_years"] = lambda x, n: F.add_months(col(x), col(n) * 12)
VERBS["date_build"] = lambda y, m=1, d=1: F.make_date(col(y), col(m), col(d))
VERBS["date_count_between"] = lambda a, b: F.datediff(col(b), col(a))
VERBS["difftime"] = lambda a, b: F.datediff(col(a), col(b))


@verb()
def month(x, label: bool = False, abbr: bool = True):
    return F.date_format(col(x), "MMM" if abbr else "MMMM") if label else F.month(col(x))


@verb()
def quarter(x, type: str = "quarter", fiscal_start: int = 1):  # noqa: A002
    """The quarter, with its year (``year.quarter``) or its first day (``date_first``)."""
    if fiscal_start != 1:
        raise ValueError("fiscal years begin in January")
    x = col(x)
    if type == "year.quarter":
        return F.concat(F.year(x), F.lit("."), F.quarter(x))
    return F.trunc(x, "quarter") if type == "date_first" else F.quarter(x)


@verb()
def qday(x):
    """Day of the quarter, from 1."""
    return F.datediff(col(x), F.trunc(col(x), "quarter")) + 1


@verb()
def wday(x, week_start: int = 7, label: bool = False, abbr: bool = True):
    """Day of the week, from 1; week_start 1 is Monday, 7 Sunday."""
    if label:
        return F.date_format(col(x), "EEE" if abbr else "EEEE")
    return F.pmod(F.weekday(col(x)) - (week_start - 1), F.lit(7)) + 1


@verb()
def floor_date(x, unit: str = "second", week_start: int = 7):
    x = col(x)
    if unit == "week":
        return F.date_sub(x, F.pmod(F.weekday(x) - (week_start - 1), F.lit(7)))
    return F.date_trunc(unit, x)


# Aggregates, also over windows.
VERBS["prod"] = lambda x: F.product(col(x))
VERBS["median"] = lambda x: F.median(col(x))
VERBS["cor"], VERBS["cov"] = (lambda x, y: F.corr(col(x), col(y))), (lambda x, y: F.covar_samp(col(x), col(y)))
VERBS["sd"], VERBS["var"] = (lambda x: F.stddev_samp(col(x))), (lambda x: F.var_samp(col(x)))
VERBS["all"], VERBS["any"] = (lambda x: F.bool_and(col(x))), (lambda x: F.bool_or(col(x)))
VERBS["str_flatten"] = lambda x, sep="": call("agg_string_agg", x, sep)
VERBS["first"], VERBS["last"] = (lambda x, order: F.min_by(col(x), col(order))), (lambda x, order: F.max_by(col(x), col(order)))
VERBS["n_distinct"] = lambda *x: F.count_distinct(*map(col, x))
VERBS["quantile"] = lambda x, p: F.percentile(col(x), p)


# Null-strict semantics: a null is a missing value that spreads, unless na_rm leaves it out; NaN is not null.
@verb("r_sum")
def r_sum(x, na_rm: bool = False):
    total = F.coalesce(F.sum(col(x)), F.lit(0))
    return total if na_rm else F.when(F.count_if(col(x).isNull()) == 0, total)


@verb("r_min")
def r_min(x, na_rm: bool = False):
    return F.min(col(x)) if na_rm else F.when(F.count_if(col(x).isNull()) == 0, F.min(col(x)))


@verb("r_max")
def r_max(x, na_rm: bool = False):
    return F.max(col(x)) if na_rm else F.when(F.count_if(col(x).isNull()) == 0, F.max(col(x)))


@verb("r_any")
def r_any(x, na_rm: bool = False):
    """Three-valued: true if any is, else null if any is null."""
    found = F.coalesce(F.bool_or(col(x)), F.lit(False))
    return found if na_rm else F.when(found, True).when(F.count_if(col(x).isNull()) == 0, False)


@verb("r_all")
def r_all(x, na_rm: bool = False):
    held = F.coalesce(F.bool_and(col(x)), F.lit(True))
    return held if na_rm else F.when(~held, False).when(F.count_if(col(x).isNull()) == 0, True)


VERBS["is_na"] = lambda x: col(x).isNull()
VERBS["r_in"] = lambda x, values: F.coalesce(col(x).isin([v for v in values if v is not None]), F.lit(False)) | (col(x).isNull() & F.lit(None in values))
VERBS["if_else"] = lambda test, yes, no: F.when(col(test).isNull(), None).when(col(test), col(yes)).otherwise(col(no))
for _op, _fn in {
    "+": lambda x, y: x + y, "-": lambda x, y: x - y, "*": lambda x, y: x * y,
    "==": lambda x, y: x == y, "!=": lambda x, y: x != y, "<": lambda x, y: x < y, "<=": lambda x, y: x <= y, ">": lambda x, y: x > y, ">=": lambda x, y: x >= y,
    "&": lambda x, y: x & y, "|": lambda x, y: x | y,
}.items():
    VERBS[f"r_{_op}"] = lambda x, y, _f=_fn: _f(col(x), col(y))
VERBS["r_!"] = lambda x: ~col(x)


@verb("r_/")
def r_divide(x, y):
    """By zero: infinities, and NaN for 0 / 0."""
    x, y = col(x).cast("double"), col(y).cast("double")
    by_zero = F.when(x > 0, float("inf")).when(x < 0, float("-inf")).when(x.isNotNull(), float("nan"))
    return F.when(y == 0, by_zero).otherwise(F.try_divide(x, y))


def apply(name: str, *args: object, **named: object) -> Column:
    """The verb of this name, applied."""
    return VERBS[name](*args, **named)
