"""Date, time and interval functions over DATE and zone-less TIMESTAMP columns."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from quern.functions.registry import FUNCTIONS, alias, col, register

for _n, _as in {"year": "year", "quarter": "quarter", "month": "month", "day": "day", "dayofmonth": "dayofmonth", "dayofyear": "dayofyear", "hour": "hour", "minute": "minute", "week": "weekofyear", "weekofyear": "weekofyear", "last_day": "last_day"}.items():
    FUNCTIONS[_n] = lambda x, _f=getattr(F, _as): _f(col(x))


@register()
def second(x):
    return F.second(col(x))


def _micros(x: Column) -> Column:
    """Microseconds since 1970 of a zone-less timestamp."""
    return F.unix_micros(F.to_utc_timestamp(F.to_timestamp(x.cast("timestamp_ntz").cast("string")), "UTC"))


def _of_micros(us: Column) -> Column:
    return F.timestamp_micros(us).cast("timestamp_ntz")


@register("dayofweek", "weekday")
def dayofweek(x):
    """Sunday is 0."""
    return F.dayofweek(col(x)) - 1


@register()
def isodow(x):
    return F.weekday(col(x)) + 1


@register()
def isoyear(x):
    return F.extract(F.lit("YEAROFWEEK"), col(x))


@register()
def yearweek(x):
    return isoyear(x) * 100 + F.weekofyear(col(x))


@register()
def dayname(x):
    return F.date_format(col(x), "EEEE")


@register()
def monthname(x):
    return F.date_format(col(x), "MMMM")


@register()
def decade(x):
    return (F.year(col(x)) / 10).cast("long")


@register()
def century(x):
    return F.ceil(F.year(col(x)) / 100)


@register()
def millennium(x):
    return F.ceil(F.year(col(x)) / 1000)


@register()
def era(x):
    return F.when(F.year(col(x)) > 0, 1).otherwise(0)


@register()
def microsecond(x):
    return F.pmod(_micros(col(x)), F.lit(60_000_000))


@register()
def millisecond(x):
    return F.floor(microsecond(x) / 1000)


@register()
def nanosecond(x):
    return microsecond(x) * 1000


@register()
def epoch(x):
    return _micros(col(x)) / F.lit(1e6)


@register()
def epoch_ms(x):
    return F.floor(_micros(col(x)) / 1000)


@register()
def epoch_us(x):
    return _micros(col(x))


@register()
def epoch_ns(x):
    return _micros(col(x)) * 1000


@register()
def julian(x):
    x = col(x)
    day = F.datediff(x.cast("date"), F.lit("1970-01-01").cast("date")) + 2440588
    return day + (_micros(x) - _micros(x.cast("date").cast("timestamp_ntz"))) / F.lit(86_400_000_000.0)


_YEARS = {"decade": 10, "century": 100, "millennium": 1000}


@register("date_trunc", "datetrunc")
def date_trunc(part: str, x):
    x = col(x)
    if part in _YEARS:
        n = _YEARS[part]
        return F.make_timestamp_ntz(F.floor(F.year(x) / n).cast("int") * n, F.lit(1), F.lit(1), F.lit(0), F.lit(0), F.lit(0))
    return F.date_trunc({"isoweek": "week"}.get(part, part), x).cast("timestamp_ntz")


_PARTS = {"doy": "dayofyear", "dow": "dayofweek", "weekday": "dayofweek", "yearweek": "yearweek", "epoch": "epoch"}


@register("date_part", "datepart", "extract")
def date_part(part: str | list[str], x):
    """A list of parts gives a struct."""
    if isinstance(part, str):
        return FUNCTIONS[_PARTS.get(part, part)](x).cast("double" if part in ("epoch", "julian") else "long")
    return F.struct(*[date_part(p, x).alias(p) for p in part])


@register("date_diff", "datediff")
def date_diff(part: str, a, b):
    """Boundaries of the part that lie between."""
    a, b = col(a), col(b)
    if part in ("decade", "century", "millennium", "year", "quarter", "month"):
        months = lambda x: F.year(x) * 12 + F.month(x) - 1
        size = {"month": 1, "quarter": 3, "year": 12}.get(part) or 12 * _YEARS[part]
        return (F.floor(months(b) / size) - F.floor(months(a) / size)).cast("long")
    if part == "week":  # whole weeks between the days
        return (F.datediff(b.cast("date"), a.cast("date")) / 7).cast("long")
    size = {"day": 86_400_000_000, "hour": 3_600_000_000, "minute": 60_000_000, "second": 1_000_000, "millisecond": 1_000, "microsecond": 1}[part]
    return (F.floor(_micros(b) / size) - F.floor(_micros(a) / size)).cast("long")


@register("date_sub", "datesub")
def date_sub(part: str, a, b):
    """Whole parts elapsed."""
    a, b = col(a).cast("timestamp_ntz"), col(b).cast("timestamp_ntz")
    size = {"month": 1, "quarter": 3, "year": 12, "decade": 120, "century": 1200, "millennium": 12000}.get(part)
    if size is None:
        return F.timestamp_diff(part.upper(), a, b)
    # Months whose last days are fewer count as whole at their end.
    months = (F.year(b) - F.year(a)) * 12 + F.month(b) - F.month(a)
    there = F.timestamp_add("MONTH", months, a)
    whole = months - F.when((a <= b) & (there > b), 1).when((a > b) & (there < b), -1).otherwise(0)
    return (whole / size).cast("long")


@register()
def age(a, b):
    """(months, days, micros) from b to a, borrowing days of the month before a's."""
    a, b = col(a).cast("timestamp_ntz"), col(b).cast("timestamp_ntz")
    months = F.timestamp_diff("MONTH", b, a)
    rest = _micros(a) - _micros(F.timestamp_add("MONTH", months, b))
    day = 86_400_000_000
    return F.struct(months.cast("long").alias("months"), (rest / day).cast("long").alias("days"), (rest % day).alias("micros"))


@register()
def make_date(y, m, d):
    return F.make_date(col(y), col(m), col(d))


@register()
def make_timestamp(*args):
    """From microseconds, or from year, month, day, hour, minute and second."""
    if len(args) == 1:
        return _of_micros(col(args[0]).cast("long"))
    return F.make_timestamp_ntz(*[col(x).cast("int") for x in args[:5]], col(args[5]))


@register()
def make_timestamp_ms(ms):
    return F.timestamp_millis(col(ms).cast("long")).cast("timestamp_ntz")


@register()
def make_timestamp_ns(ns):
    """Nanoseconds below the microsecond are lost."""
    return _of_micros(F.floor(col(ns) / 1000).cast("long"))


@register()
def make_time(h, m, s):
    """The time of day as text, since Spark's own type for it is not on by default; microseconds only where there are some."""
    micros = F.round(col(s) * 1_000_000).cast("long")
    whole = F.format_string("%02d:%02d:%02d", col(h), col(m), F.floor(micros / 1_000_000))
    return F.concat(whole, F.when(micros % 1_000_000 == 0, "").otherwise(F.regexp_replace(F.format_string(".%06d", micros % 1_000_000), "0+$", "")))


@register()
def to_timestamp(seconds):
    return F.timestamp_seconds(col(seconds))


for _n, _m in {"to_years": 12, "to_months": 1, "to_quarters": 3, "to_decades": 120, "to_centuries": 1200, "to_millennia": 12000}.items():
    FUNCTIONS[_n] = lambda n, _m=_m: F.make_ym_interval(F.lit(0), (col(n) * _m).cast("int"))
for _n, _u in {"to_days": 86400, "to_weeks": 7 * 86400, "to_hours": 3600, "to_minutes": 60, "to_seconds": 1}.items():
    FUNCTIONS[_n] = lambda n, _u=_u: F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), (col(n) * _u).cast("decimal(18,6)"))
FUNCTIONS["to_milliseconds"] = lambda n: F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), (col(n) / 1000).cast("decimal(18,6)"))
FUNCTIONS["to_microseconds"] = lambda n: F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), (col(n) / 1000000).cast("decimal(18,6)"))


@register()
def normalized_interval(months, days, micros):
    """30 days make a month, 24 hours a day."""
    day = 86_400_000_000
    us = col(micros) + col(days) * day
    days_ = F.floor(us / day)
    return F.struct((col(months) + F.floor(days_ / 30)).alias("months"), (days_ % 30).alias("days"), (us % day).alias("micros"))


@register()
def time_bucket(x, micros: int = 0, months: int = 0, origin: str | None = None):
    """The bucket's start.  Widths of months count from 2000-01-01, others from Monday 2000-01-03, unless told."""
    x = col(x)
    if months:
        o = F.lit(origin or "2000-01-01").cast("timestamp_ntz")
        count = lambda t: F.year(t) * 12 + F.month(t) - 1
        first = F.floor((count(x) - count(o)) / months) * months
        return F.timestamp_add("MONTH", first, o)
    start = _micros(F.lit(origin or "2000-01-03").cast("timestamp_ntz"))
    return _of_micros(F.floor((_micros(x) - start) / micros) * micros + start)


@register("date_add")
def date_add(x, interval):
    """A timestamp, also for a date."""
    return col(x).cast("timestamp_ntz") + col(interval)


@register("days_in_month")
def days_in_month(x):
    return F.day(F.last_day(col(x))).cast("long")


@register("ago")
def ago(interval):
    return F.current_timestamp() - col(interval)


@register()
def timezone(zone: str, x):
    """The instant at which clocks in the zone show x."""
    return F.to_utc_timestamp(col(x).cast("timestamp"), zone)


@register()
def timezone_hour(x):
    return F.floor(F.unix_seconds(F.to_timestamp(col(x).cast("string"))) * 0).cast("long")


@register()
def timezone_minute(x):
    return timezone_hour(x)


FUNCTIONS["now"] = FUNCTIONS["get_current_timestamp"] = FUNCTIONS["transaction_timestamp"] = F.current_timestamp
FUNCTIONS["current_date"] = FUNCTIONS["today"] = F.current_date

#: strftime tokens as datetime patterns: fixed values.
TOKENS = {"Y": "yyyy", "y": "yy", "m": "MM", "d": "dd", "-d": "d", "-m": "M", "H": "HH", "-H": "H", "I": "hh", "-I": "h", "M": "mm", "-M": "m", "S": "ss", "-S": "s", "f": "SSSSSS", "g": "SSS", "p": "a", "j": "DDD", "-j": "D", "b": "MMM", "B": "MMMM", "a": "EEE", "A": "EEEE", "%": "'%'", "F": "yyyy-MM-dd", "T": "HH:mm:ss", "X": "HH:mm:ss", "x": "yyyy-MM-dd", "z": "xx", "Z": "z"}


def pattern(fmt: str) -> str:
    """A strftime format as a datetime pattern."""
    out = ""
    for token in re.findall(r"%-?.|[^%]+", fmt):
        out += TOKENS[token[1:]] if token[0] == "%" else re.sub(r"[A-Za-z]+", lambda m: f"'{m[0]}'", token)
    return out


@register()
def strftime(x, fmt: str):
    return F.date_format(col(x), pattern(fmt))


@register()
def strptime(s, fmt: str | list[str]):
    """Fails where no format fits."""
    s = col(s)
    if isinstance(fmt, str):
        return F.to_timestamp_ntz(s, F.lit(pattern(fmt)))
    found = try_strptime(s, fmt)
    return F.when(s.isNull() | found.isNotNull(), found).otherwise(F.raise_error(F.lit("no format fits")).cast("timestamp_ntz"))


@register()
def try_strptime(s, fmt: str | list[str]):
    return F.coalesce(*[F.try_to_timestamp(col(s), F.lit(pattern(f))).cast("timestamp_ntz") for f in ([fmt] if isinstance(fmt, str) else fmt)])


alias("dayofweek", "dow")
